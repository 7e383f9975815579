"""Fixed-length sequence encoding with a vocabulary built over the corpus.

Layout rules of the original encoder are kept: ``[BOS] tokens [EOS] PAD...``,
truncated to the length *including* the two specials, attention mask 1 for
real positions, and label ids with PAD replaced by -100.  Tokens are
lower-cased whitespace words; ids come from a frequency-ranked vocabulary
(ids 0-3 are BOS, PAD, EOS, UNK).

Plan: Spark makes the token arrays and cuts them to the length; over Arrow
batches the flat token column is looked up in the vocabulary in one vectorised
call and laid out by the list offsets.  Tokens never become rows: no shuffle,
no sort.  The vocabulary's size is fixed by ``VOCAB_SIZE``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import (
    BOS_ID, EOS_ID, LABEL_IGNORE_ID, MAX_INPUT_LENGTH, MAX_TARGET_LENGTH, PAD_ID, UNK_ID, VOCAB_SIZE,
)
from ..functions.ranking import bucket_offsets
from ..functions.text import word_tokens
from ..session import materialize
from .heavy import frequent_counts

N_SPECIAL = 4
GRID = 1 << 18  # ids laid out at once


def tokens_of(text_cols: Sequence[str]) -> F.Column:
    """The tokens of several text columns as one array."""
    return F.flatten(F.array(*[F.coalesce(word_tokens(c), F.array().cast("array<string>")) for c in text_cols]))


def build_vocabulary(df: DataFrame, text_cols: Sequence[str], size: int = VOCAB_SIZE, heavy_first: bool = False) -> DataFrame:
    """ENC-1: ``(token, id, n)`` for the ``size - 4`` most frequent tokens
    (count desc, then token), ids from 4.

    Counting is a partial aggregation, written once.  A table of (count, tokens with it)
    gives the least count that still fits wholly and how many of the next
    count are let in; rarer tokens are left out by a filter, so only the kept ones and the ties
    at the cut are ranked.  Those are ranked exactly within buckets of (count, first characters), so no task
    merges the candidates of all others.  (The window over the counts runs in one task: it holds
    one row per distinct count.)  With ``heavy_first`` only tokens that can be among the kept ones are
    counted (``operators.heavy``): for corpora whose distinct tokens outnumber ``size`` by far.
    """
    limit = size - N_SPECIAL
    if heavy_first:
        counts = frequent_counts(df, tokens_of(text_cols), limit)
    else:
        counts = materialize(df.select(F.explode(tokens_of(text_cols)).alias("token")).groupBy("token")
                             .agg(F.count(F.lit(1)).cast("bigint").alias("n")), "token-counts")
    # rows before a count, from the most frequent on: a table of distinct counts only
    per = counts.groupBy("n").agg(F.count(F.lit(1)).alias("_m"))
    before = Window.orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(per.withColumn("_before", F.coalesce(F.sum("_m").over(before), F.lit(0)))
                         .where(F.col("_before") < limit).select("n", "_before"), "token-places")
    rarest = starts.agg(F.min("n")).first()[0]
    # within one count, tokens are ordered by their first characters, then whole
    kept = counts.where(F.col("n") >= F.lit(rarest)).withColumn("_b", F.substring("token", 1, 2))
    inner = bucket_offsets(kept, "_b", ["n"]).select("n", "_b", "_start").join(starts, "n")
    rank = F.row_number().over(Window.partitionBy("n", "_b").orderBy("token"))
    ranked = (kept.withColumn("_r", rank).join(inner, ["n", "_b"])
              .withColumn("id", (F.col("_before") + F.col("_start") + F.col("_r") + (N_SPECIAL - 1)).cast("int")))
    return ranked.where(F.col("id") < size).select("token", "id", "n")


def attention_mask(ids: F.Column, length: int) -> F.Column:
    """ENC-3: 1 for every non-pad position, 0 for padding."""
    n = F.size(F.filter(ids, lambda x: x != PAD_ID))
    return F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(length) - n))


def mask_labels(ids: F.Column) -> F.Column:
    """ENC-4: PAD ids become -100 (ignored by a loss)."""
    return F.transform(ids, lambda x: F.when(x == PAD_ID, F.lit(LABEL_IGNORE_ID)).otherwise(x))


def encode_columns(df: DataFrame, vocab: DataFrame, specs: Sequence[tuple[str, str, int]],
                   keys: Sequence[str] = ("id",), carry: Sequence[str] = (), most: int = VOCAB_SIZE) -> DataFrame:
    """ENC-2 for several text columns at once.

    ``specs`` = ``[(text_col, out_ids_col, length), ...]``.  Every text gives
    exactly ``length`` ids, also when it has no tokens or is null.  ``carry``
    columns are passed through.  The vocabulary (pass a written one: it is read
    while the plan is built) is sent to the workers as two Arrow columns; one of more
    than ``most`` rows is refused.  Batches are laid out in slices of at most ``GRID`` ids, so what a
    worker holds beside a batch does not grow with its rows.
    """
    words = vocab.select("token", "id").limit(most + 1).toPandas().sort_values("id")
    if len(words) > most:
        raise ValueError(f"the vocabulary has more than {most} tokens")
    held = df.sparkSession.sparkContext.broadcast((words["token"].tolist(), words["id"].to_numpy("int32")))
    toks = [F.slice(F.coalesce(word_tokens(col), F.array().cast("array<string>")), 1, length - 2).alias(f"_t{i}")
            for i, (col, _, length) in enumerate(specs)]
    src = df.select(*keys, *carry, *toks)
    plain = [f for f in src.schema.fields if not f.name.startswith("_t")]
    schema = T.StructType(plain + [T.StructField(out, T.ArrayType(T.IntegerType(), False), False) for _, out, _ in specs])
    layouts = [(f"_t{i}", length) for i, (_, _, length) in enumerate(specs)]
    names = [f.name for f in plain]
    rows = max(1, GRID // max((length for _, length in layouts), default=1))

    def run(batches):
        known, ids_of = pa.array(held.value[0], pa.string()), held.value[1]
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                b = whole.slice(at, rows)
                out = [b.column(n) for n in names]
                for name, length in layouts:
                    out.append(_laid_out(b.column(name), known, ids_of, length))
                yield pa.RecordBatch.from_arrays(out, names=[f.name for f in schema.fields])

    return src.mapInArrow(run, schema)


def _laid_out(tokens: pa.ListArray, known: pa.Array, ids_of: np.ndarray, length: int) -> pa.ListArray:
    """``[BOS] ids [EOS] PAD...`` of each token list, as lists of ``length`` ids."""
    rows, sizes = len(tokens), np.asarray(pc.list_value_length(tokens).to_numpy(zero_copy_only=False), np.int64)
    at = pc.index_in(tokens.flatten().cast(pa.string()), value_set=known)
    at = np.asarray(at.fill_null(-1).to_numpy(zero_copy_only=False), np.int64)
    ids = np.where(at >= 0, ids_of[at] if len(ids_of) else UNK_ID, UNK_ID).astype(np.int32)
    grid = np.full((rows, length), PAD_ID, np.int32)
    grid[:, 0] = BOS_ID
    grid[np.arange(rows), sizes + 1] = EOS_ID
    row = np.repeat(np.arange(rows), sizes)
    grid[row, np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1] = ids
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * length, pa.int32()), pa.array(grid.ravel()))


def encode_fixed(df: DataFrame, vocab: DataFrame, text_col: str, length: int,
                 keys: Sequence[str] = ("id",), carry: Sequence[str] = (),
                 ids_col: str = "input_ids", mask_col: str = "attention_mask") -> DataFrame:
    """ENC-2 + ENC-3 for one text column."""
    enc = encode_columns(df, vocab, [(text_col, ids_col, length)], keys, carry)
    return enc.withColumn(mask_col, attention_mask(F.col(ids_col), length))


def encode_pairs(df: DataFrame, vocab: DataFrame, keys: Sequence[str] = ("id",),
                 input_col: str = "input_text", target_col: str = "target_text",
                 input_length: int = MAX_INPUT_LENGTH, target_length: int = MAX_TARGET_LENGTH,
                 carry: Sequence[str] = ()) -> DataFrame:
    """ENC-5: per pair ``input_ids``, ``attention_mask`` (input) and ``labels``
    (target ids with PAD -> -100)."""
    enc = encode_columns(df, vocab, [(input_col, "input_ids", input_length),
                                     (target_col, "_target_ids", target_length)], keys, carry)
    return (enc.withColumn("attention_mask", attention_mask(F.col("input_ids"), input_length))
            .withColumn("labels", mask_labels(F.col("_target_ids"))).drop("_target_ids"))


def arrays_as_text(df: DataFrame, cols: Sequence[str], sep: str = ",") -> DataFrame:
    """Comparable text form of integer array columns."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.array_join(F.col(c).cast("array<string>"), sep))
    return out
