"""Classify questions by keyword lexicon and answer them from the bank.

A lexicon in code is compiled into expressions; one that is a table becomes a keyword automaton.
The whole answering path is native expressions plus one join against the bank
(one row per intent; Spark broadcasts it while its bytes allow) and one scalar
subquery for the ``general`` entry: no Python worker, and no shuffle of the
questions against a bank of usual size.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.automaton import Automaton
from ..functions.constants import (
    EMPTY_MESSAGE_NOTICE, FALLBACK_INTENT, MODEL_PROMPT_PREFIX, NO_PLACEHOLDER_PREFIX,
    NO_PLACEHOLDER_SEPARATOR, QUERY_PLACEHOLDER, SEED, STOCK_LEXICON,
)
from ..functions.hashing import pick_index
from ..functions.lexicon import Lexicon
from ..session import materialize

#: a lexicon up to this size (six times its keywords, intents and 8 bytes a row) is sent to the workers whole
LEXICON_BYTES = 64 << 20
TEXTS = 1000  # texts whose hits become rows at once


# --- RSP-4: intent classification ----------------------------------------------------


def intent_expr(text: Column, lexicon: Lexicon = STOCK_LEXICON) -> tuple[Column, Column]:
    """(intent, score) for a lexicon compiled into column expressions.

    score(intent) = number of its keywords occurring as substrings of the
    lower-cased text; the highest score wins, ties go to the earlier intent,
    no hit gives ``general``.
    """
    low = F.lower(text)
    cands = []
    for prio, (intent, kws) in enumerate(lexicon, start=1):
        score = F.lit(0)
        for kw in kws:
            score = score + F.when(low.contains(kw), 1).otherwise(0)
        cands.append(F.struct(score.alias("s"), F.lit(-prio).alias("p"), F.lit(intent).alias("i")))
    best = F.greatest(*cands) if len(cands) > 1 else cands[0]
    score = F.coalesce(best["s"], F.lit(0))
    return F.when(score > 0, best["i"]).otherwise(F.lit(FALLBACK_INTENT)), score


def classify_intent(df: DataFrame, text_col: str = "query", lexicon: Lexicon = STOCK_LEXICON,
                    out: str = "intent", score_col: str | None = None) -> DataFrame:
    """Add the predicted intent (and optionally its score) as columns.

    For a lexicon in code; one that is a table goes to ``classify_intent_join``.
    """
    intent, score = intent_expr(F.col(text_col), lexicon)
    out_df = df.withColumn(out, intent)
    return out_df.withColumn(score_col, score) if score_col else out_df


class _Matcher:
    """Lexicon rows as flat arrays, sent to the workers; each makes the automaton once, where it first matches.

    ``groups`` are the (intent, priority) pairs in the order in which they win ties.
    """

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        one = lambda c: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        names, prio = one(rows["intent"]).dictionary_encode(), one(rows["priority"])
        code = names.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        low = np.where(prio.is_null().to_numpy(zero_copy_only=False), 1 << 32,
                       prio.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + (1 << 31))
        pairs, group = np.unique((code + 1 << 33) + low, return_inverse=True)
        known, low = names.dictionary.to_pylist() + [None], pairs & (1 << 33) - 1
        groups = pd.DataFrame({"intent": pd.Series([known[k - 1] for k in (pairs >> 33).tolist()], dtype=object),
                               "priority": pd.Series([None if k == 1 << 32 else k - (1 << 31) for k in low.tolist()], dtype="Int64")})
        order = groups.sort_values(["priority", "intent"], ascending=[True, False], kind="stable").index.to_numpy()
        groups = groups.iloc[order]
        self.intents = pa.array(groups["intent"].tolist(), pa.string())
        self.priorities = pa.array(groups["priority"].astype(object).where(groups["priority"].notna(), None).tolist(), pa.int32())
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        words, group = one(rows["keyword"]), rank[group]
        empty = pc.equal(words, "").to_numpy(zero_copy_only=False)
        self.always = group[empty].astype(np.int64)
        kept = np.flatnonzero(~empty)
        words = words.take(pa.array(kept))
        by_word = pc.sort_indices(words)  # by bytes, which is by code points
        words = words.take(by_word).dictionary_encode()
        self.words, self.group_of = words.dictionary, group[kept[by_word.to_numpy()]]
        self.begin = np.searchsorted(words.indices.to_numpy(), np.arange(len(self.words) + 1)).astype(np.int32)
        self.automaton = None

    def _made(self) -> Automaton:
        if self.automaton is None:
            n = len(self.words)
            at = np.concatenate([[0], np.cumsum(pc.utf8_length(self.words).to_numpy(), dtype=np.int64)])
            whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), self.words), "")[0].as_py() if n else ""
            self.words = None
            self.automaton = Automaton.of_sorted(np.frombuffer(whole.encode("utf-32-le"), np.uint32), at, np.arange(n, dtype=np.int32))
        return self.automaton

    def hits(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, group, keywords of the group in the text), by text and group."""
        text, word = self._made().found(texts)
        n, many = len(self.intents), self.begin[word + 1] - self.begin[word]
        at = np.repeat(self.begin[word], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        pairs = np.concatenate([np.repeat(text, many) * n + self.group_of[at],
                                (np.arange(len(texts))[:, None] * n + self.always).ravel()])
        pairs, count = np.unique(pairs, return_counts=True)
        return pairs // n, pairs % n, count


def _lexicon_part(df: DataFrame, part: DataFrame):
    """The rows of a lexicon of checked size, sent to the workers."""
    return df.sparkSession.sparkContext.broadcast(_Matcher(part.select("intent", "priority", "keyword").toArrow()))


def _best_intent(held) -> Callable[[Column], Column]:
    @F.pandas_udf("i string, s int")
    def best(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher = held.value
        names = np.asarray(matcher.intents.to_pylist(), object)
        for texts in batches:
            given = np.flatnonzero(texts.notna().to_numpy())
            text, group, count = matcher.hits(texts.iloc[given].tolist())
            order = np.lexsort((group, -count, text))  # most hits, then the earlier group
            lead = order[np.unique(text[order], return_index=True)[1]]
            intent, score = np.full(len(texts), FALLBACK_INTENT, object), np.zeros(len(texts), np.int32)
            intent[given[text[lead]]], score[given[text[lead]]] = names[group[lead]], count[lead]
            yield pd.DataFrame({"i": intent, "s": score})

    return best


def _all_hits(df: DataFrame, low: Column, keys: Sequence[str], held) -> DataFrame:
    """A row (keys, intent ``i``, priority ``p``, hits ``s``) for each intent that a text has hits of."""
    src = df.select(*keys, low.alias("_low"))
    schema = T.StructType([*src.schema.fields[:-1], T.StructField("i", T.StringType()), T.StructField("p", T.IntegerType()),
                           T.StructField("s", T.IntegerType())])

    def run(batches):
        matcher = held.value
        for b in batches:
            for at in range(0, b.num_rows, TEXTS):
                part = b.slice(at, TEXTS)
                texts = part.column(part.num_columns - 1)
                given = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False))
                text, group, count = matcher.hits(texts.drop_null().to_pylist())
                row, group = pa.array(given[text]), pa.array(group)
                yield pa.RecordBatch.from_arrays(
                    [c.take(row) for c in part.columns[:-1]] + [matcher.intents.take(group), matcher.priorities.take(group),
                                                                pa.array(count, pa.int32())], names=schema.names)

    return src.mapInArrow(run, schema)


def classify_intent_join(df: DataFrame, lexicon: DataFrame, text_col: str = "query",
                         keys: Sequence[str] = ("id",), out: str = "intent",
                         score_col: str | None = None, most_bytes: int = LEXICON_BYTES) -> DataFrame:
    """RSP-4 for a lexicon that is a table of any size.

    The keywords become an Aho-Corasick automaton that the workers run over Arrow batches: one pass
    over each text whatever the size of the lexicon, no exchange.  The score of an intent is the number of its
    keywords in the lower-cased text (an empty keyword is in every text); the most hits win, then
    the lower priority, then the last intent by name.  Null keywords are left out, null texts hold none.

    The lexicon's bytes are checked first, by one small aggregation; they count the letters of its keywords
    sixfold, since these are what an automaton grows with.  One above ``most_bytes`` is dealt into parts by keyword; each part's hits are written, and counts, not texts, are then added up by ``keys``
    (which must tell the rows apart) and joined back.
    """
    lex = (lexicon.where(F.col("keyword").isNotNull())
           .select(F.col("intent").cast("string"), F.col("priority").cast("int"), F.col("keyword").cast("string")).distinct())
    size = lex.agg(F.coalesce(F.sum(6 * F.octet_length("keyword") + F.coalesce(F.octet_length("intent"), F.lit(0)) + 8), F.lit(0))).first()[0]
    parts = max(1, math.ceil(size / most_bytes))
    low = F.lower(F.col(text_col))
    if parts == 1:
        rows = df.withColumn("_b", _best_intent(_lexicon_part(df, lex))(low))
        rows = rows.withColumn(out, F.col("_b.i"))
        return (rows.withColumn(score_col, F.col("_b.s")) if score_col else rows).drop("_b")
    found, lex = None, materialize(lex, "lexicon-rows")
    for k in range(parts):
        part = lex.where(F.pmod(F.xxhash64("keyword"), F.lit(parts)) == k)
        hits = materialize(_all_hits(df, low, keys, _lexicon_part(df, part)), "lexicon-hits")
        found = hits if found is None else found.unionByName(hits)
    scores = found.groupBy(*keys, "i", "p").agg(F.sum("s").alias("s"))
    best = scores.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.max(F.struct(F.col("s"), (-F.col("p")).alias("p"), F.col("i"))).alias("_b"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & df[k].eqNullSafe(F.col(f"_k{i}"))
    rows = df.join(best, same, "left").withColumn(out, F.coalesce(F.col("_b.i"), F.lit(FALLBACK_INTENT)))
    if score_col:
        rows = rows.withColumn(score_col, F.coalesce(F.col("_b.s"), F.lit(0)).cast("int"))
    return rows.drop("_b", *[f"_k{i}" for i in range(len(keys))])


# --- RSP-5..8: lookup, pick, render, route ------------------------------------------------


def bank_lookup(df: DataFrame, bank: DataFrame, intent_col: str = "intent",
                out: str = "templates") -> DataFrame:
    """RSP-5: ``bank[intent]``, else ``bank['general']``, else null.

    The bank has one row per intent.  Whether its side is broadcast is left to
    Spark, which goes by the bytes it finds (at run time, too), so no size is
    guessed here.  The ``general`` entry is an uncorrelated scalar subquery
    (evaluated once, never joined).
    """
    entries = bank.select(F.col("intent").alias("_bi"), F.col("templates").alias("_bt"))
    general = entries.where(F.col("_bi") == FALLBACK_INTENT).select("_bt").limit(1).scalar()
    joined = df.join(entries, F.col(intent_col) == F.col("_bi"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_bt"), general)).drop("_bi", "_bt")


def pick_template(templates: Column, query: Column, seed: int = SEED) -> Column:
    """RSP-6: one entry chosen by ``md5(seed|query)``; null for an empty list."""
    n = F.coalesce(F.size(templates), F.lit(0))
    idx = pick_index(seed, [query], n)
    return F.when(n > 0, F.element_at(templates, idx.cast("int")))


def render_response(template: Column, query: Column) -> Column:
    """RSP-7: replace every ``{query}``; a template without it is prefixed."""
    return (F.when(template.contains(QUERY_PLACEHOLDER),
                   F.replace(template, F.lit(QUERY_PLACEHOLDER), query))
            .otherwise(F.concat(F.lit(NO_PLACEHOLDER_PREFIX), query,
                                F.lit(NO_PLACEHOLDER_SEPARATOR), template)))


def model_prompt(query: Column) -> Column:
    """RSP-8: the prompt of the model route."""
    return F.concat(F.lit(MODEL_PROMPT_PREFIX), query)


# --- RSP-10 / RSP-11 ------------------------------------------------------------------


def answer_questions(df: DataFrame, bank: DataFrame | None, lexicon: Lexicon = STOCK_LEXICON,
                     text_col: str = "query", use_templates: bool = True, seed: int = SEED) -> DataFrame:
    """RSP-10: guard -> classify -> lookup -> pick -> render / route.

    Adds ``intent, route, response, prompt``.  ``route`` is ``guard`` for a null
    or empty message (answered with a notice), ``template`` when a template
    was found and templates are on, else ``model`` (``response`` null,
    ``prompt`` set for a generator, see ``generate_batch``).  With templates
    off the bank is not looked at (it may be None).
    """
    q = F.col(text_col)
    empty = q.isNull() | (q == "")
    classified = classify_intent(df, text_col, lexicon, out="_intent")
    looked = (bank_lookup(classified, bank, "_intent", "_tpl") if use_templates
              else classified.withColumn("_tpl", F.lit(None).cast("array<string>")))
    has_tpl = F.coalesce(F.size("_tpl"), F.lit(0)) > 0
    route = (F.when(empty, F.lit("guard"))
             .when(has_tpl, F.lit("template"))
             .otherwise(F.lit("model")))
    template = pick_template(F.col("_tpl"), q, seed)
    return (looked
            .withColumn("route", route)
            .withColumn("intent", F.when(~empty, F.col("_intent")))
            .withColumn("response", F.when(F.col("route") == "guard", F.lit(EMPTY_MESSAGE_NOTICE))
                        .when(F.col("route") == "template", render_response(template, q)))
            .withColumn("prompt", F.when(F.col("route") == "model", model_prompt(q)))
            .drop("_intent", "_tpl"))


def side_by_side(df: DataFrame, bank: DataFrame, lexicon: Lexicon = STOCK_LEXICON,
                 text_col: str = "query", seed: int = SEED) -> DataFrame:
    """RSP-11: both paths for each question in one row (no join: the model
    path is a projection of the same row)."""
    a = answer_questions(df, bank, lexicon, text_col, True, seed)
    return (a.withColumnRenamed("route", "template_route")
            .withColumnRenamed("response", "template_response")
            .drop("prompt")
            .withColumn("model_prompt", F.when(~(F.col(text_col).isNull() | (F.col(text_col) == "")),
                                               model_prompt(F.col(text_col)))))


# --- RSP-9 / UDF-1: generator hook ---------------------------------------------------------


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType) -> DataFrame:
    """UDF-1: a user function from a batch of rows to a batch of rows, over
    Arrow batches of bounded size; ``schema`` is that of its result."""
    def run(batches):
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def generate_batch(df: DataFrame, generate: Callable[[pd.Series], pd.Series],
                   prompt_col: str = "prompt", out: str = "generated",
                   seconds_col: str = "generate_seconds") -> DataFrame:
    """RSP-9: run a caller-supplied text generator over Arrow batches of prompts.

    ``generate`` maps a pandas Series of prompts to a Series of texts.  Rows
    with a null prompt are passed through with a null result.  The mean
    wall-clock seconds per generated row of each batch is recorded.
    """
    schema = T.StructType(df.schema.fields + [
        T.StructField(out, T.StringType(), True), T.StructField(seconds_col, T.DoubleType(), True)])

    def run(batches):
        for pdf in batches:
            mask = pdf[prompt_col].notna()
            gen = pd.Series([None] * len(pdf), index=pdf.index, dtype=object)
            secs = pd.Series([None] * len(pdf), index=pdf.index, dtype=object)
            if mask.any():
                t0 = time.perf_counter()
                res = generate(pdf.loc[mask, prompt_col])
                per = (time.perf_counter() - t0) / int(mask.sum())
                gen.loc[mask] = list(res)
                secs.loc[mask] = per
            pdf[out] = gen
            pdf[seconds_col] = secs.astype("float64")
            yield pdf

    return df.mapInPandas(run, schema)


def generate_distinct(df: DataFrame, generate: Callable[[pd.Series], pd.Series], prompt_col: str = "prompt",
                      out: str = "generated", seconds_col: str = "generate_seconds", frequent: int = 1000) -> DataFrame:
    """RSP-9 with one call a distinct prompt: the generator sees each text once, its results are written and
    joined back by a digest of the prompt.

    Equal prompts get the same result.  Results of the ``frequent`` most common prompts are sent to every
    task (at most that many rows), so a prompt that a third of all rows share is not shuffled; rows
    without a prompt get a null result and are spread.
    """
    digest = F.unhex(F.md5(prompt_col))
    once = df.where(F.col(prompt_col).isNotNull()).groupBy(digest.alias("_d")).agg(F.first(prompt_col).alias(prompt_col), F.count(F.lit(1)).alias("_n"))
    made = materialize(generate_batch(once, generate, prompt_col, out, seconds_col).select("_d", "_n", out, seconds_col), "generated")
    common = made.orderBy(F.desc("_n"), "_d").limit(frequent)
    near = F.broadcast(common.select(F.col("_d").alias("_nd"), F.col(out).alias("_no"), F.col(seconds_col).alias("_ns")))
    far = made.join(F.broadcast(common.select("_d")), "_d", "left_anti").select(F.col("_d").alias("_fd"), F.col(out).alias("_fo"), F.col(seconds_col).alias("_fs"))
    rows = df.withColumn("_d", digest).join(near, F.col("_d") == F.col("_nd"), "left")
    done = F.col("_nd").isNotNull() | F.col("_d").isNull()
    rows = rows.withColumn("_d", F.when(~done, F.col("_d"))).withColumn("_s", F.when(done, F.xxhash64(F.monotonically_increasing_id())).otherwise(0))
    rows = rows.join(far.withColumn("_z", F.lit(0).cast("long")), (F.col("_d") == F.col("_fd")) & (F.col("_s") == F.col("_z")), "left")
    return rows.select(*df.columns, F.coalesce("_no", "_fo").alias(out), F.coalesce("_ns", "_fs").alias(seconds_col))


def inference_table(test: DataFrame, n: int = 10, seed: int = SEED, keys: Sequence[str] = ("id",),
                    generate: Callable[[pd.Series], pd.Series] | None = None) -> DataFrame:
    """RSP-12: input, target and prompt for ``n`` sampled test rows; with a
    generator also the generated text and its seconds."""
    from .prepare import sample_n

    s = sample_n(test, n, seed, keys, pos_col="pos").select(
        *keys, "pos", F.col("input_text").alias("input"), F.col("target_text").alias("target"),
        model_prompt(F.col("input_text")).alias("prompt"))
    if generate is None:
        return s
    return generate_batch(s, generate, "prompt", "generated", "inference_time")
