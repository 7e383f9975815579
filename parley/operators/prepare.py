"""Clean, format, de-duplicate, sample and split question/answer pairs.

Determinism: "random" choices order rows by ``md5(seed|key...)`` and break
ties on the key, so results are reproducible, replay-safe after executor loss,
and checkable by SQL.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ..functions.bloom import bits_for, bloom_filter, may_hold
from ..functions.constants import (
    BATTERY_MODEL_PREFIX, PREVIEW_ROWS, SEED, TEST_SHARE, VAL_SHARE,
)
from ..functions.hashing import order_hash
from ..functions.ranking import Cut, bucket_offsets, label_by_cut_points, rank_cuts, within
from ..session import materialize

# --- projections -------------------------------------------------------------


def format_pairs(df: DataFrame, keys: Sequence[str] = ("id",),
                 instruction: str = "instruction", response: str = "response") -> DataFrame:
    """PRJ-1 + PRJ-2: instruction -> input_text, response -> target_text, keep
    ``category`` / ``intent`` when present (everything else, e.g. flags, drops)."""
    cols = [F.col(k) for k in keys]
    cols += [F.col(instruction).alias("input_text"), F.col(response).alias("target_text")]
    cols += [F.col(c) for c in ("category", "intent") if c in df.columns]
    return df.select(*cols)


def drop_rename(df: DataFrame, drop: Sequence[str] = ("sentence", "idx"),
                rename: tuple[str, str] = ("label", "labels")) -> DataFrame:
    """PRJ-3: remove the raw text columns and rename the label column."""
    out = df.drop(*[c for c in drop if c in df.columns])
    return out.withColumnRenamed(*rename)


def select_features(df: DataFrame, keep: Sequence[str] = ("input_ids", "attention_mask", "labels"),
                    keys: Sequence[str] = ()) -> DataFrame:
    """PRJ-4: keep only model features (and optional keys)."""
    return df.select(*keys, *keep)


# --- filters and limits --------------------------------------------------------


def drop_missing(df: DataFrame, subset: Sequence[str] = ("instruction", "response")) -> DataFrame:
    """FLT-1: drop a row when any of ``subset`` is null."""
    return df.na.drop(how="any", subset=list(subset))


def train_or_sample(train: DataFrame, sample: DataFrame | None, use_sample: bool) -> DataFrame:
    """FLT-3: the sample replaces train only when switched on and present."""
    return sample if (use_sample and sample is not None) else train


def preview(df: DataFrame, keys: Sequence[str] = ("id",), n: int = PREVIEW_ROWS) -> DataFrame:
    """LIM-1: first ``n`` rows in key order (TakeOrderedAndProject, no global sort)."""
    return df.orderBy(*keys).limit(n)


def in_prefix(pos: F.Column, n: int = BATTERY_MODEL_PREFIX) -> F.Column:
    """LIM-2 predicate: 0-based position below ``n``."""
    return pos < n


def battery_prefix(df: DataFrame, pos_col: str = "pos", n: int = BATTERY_MODEL_PREFIX) -> DataFrame:
    """LIM-2: rows whose 0-based position is below ``n``."""
    return df.where(in_prefix(F.col(pos_col), n))


# --- distinct --------------------------------------------------------------------


def pair_digest(subset: Sequence[str]) -> Column:
    """64 bits of a pair: equal pairs (nulls equal nulls) have equal digests."""
    return F.xxhash64(*subset)


def duplicate_candidates(df: DataFrame, subset: Sequence[str] = ("instruction", "response")) -> tuple[DataFrame, DataFrame]:
    """(candidates, others): all rows whose ``subset`` occurs more than once with few besides, and the rest.

    Digests are counted on a narrow table (map-side combined, so a pair repeated a billion times is one row
    per task); the repeated ones are written and go into a Bloom filter that is tested at the scan.  Only if
    there are too many for a filter of bounded size, rows are told by a join with the digests.  The
    candidates carry their digest as ``_pd``.
    """
    repeated = materialize(df.select(pair_digest(subset).alias("_pd")).groupBy("_pd")
                           .agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("_pd"), "repeated-digests")
    marked, bits = df.withColumn("_pd", pair_digest(subset)), bits_for(repeated.count())
    if bits is None:
        return marked.join(repeated, "_pd", "left_semi"), marked.join(repeated, "_pd", "left_anti")
    maybe = may_hold(materialize(bloom_filter(repeated, "_pd", bits), "repeated-filter"), F.col("_pd"), bits)
    return marked.where(maybe), marked.where(~maybe)


def dedup_pairs(df: DataFrame, subset: Sequence[str] = ("instruction", "response"),
                keys: Sequence[str] = ("id",)) -> DataFrame:
    """DST-1: one row per exact ``subset`` value (nulls equal nulls), the first in key order.

    Rows without a key come after those with one; among rows of equal keys the least by the other columns
    stays, so exact repeats leave one row.  Keys need not be unique.

    Rows that are no candidates (see :func:`duplicate_candidates`) pass through as they are: their texts are
    never shuffled.  Candidates are told apart by their texts in a window, so a digest that two pairs
    share, or one that the filter lets through by chance, only costs work.  The window's limit keeps one row
    per pair and task before its shuffle.
    """
    candidates, others = duplicate_candidates(df, subset)
    rest = [f.name for f in df.schema.fields if f.name not in (*subset, *keys) and not isinstance(f.dataType, MapType)]
    order = [F.col(f"`{c}`").asc_nulls_last() for c in (*keys, *rest)]
    w = Window.partitionBy("_pd", *subset).orderBy(*order)
    first = candidates.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    return others.select(*df.columns).unionByName(first.select(*df.columns))


def label_vocabulary(df: DataFrame, columns: Sequence[str] = ("category", "intent"),
                     keys: Sequence[str] = ("id",)) -> DataFrame:
    """DST-2: distinct values per column in order of first appearance.

    Null counts as a value.  Output ``(field, value, position)``; empty when
    any of ``columns`` is missing (the original requires all of them).  The
    first of ``keys`` is a number; a value that occurs only in rows without it comes after
    all others.
    """
    if not all(c in df.columns for c in columns):
        return df.sparkSession.createDataFrame([], "field string, value string, position bigint")
    first = F.struct(*[F.col(k) for k in keys])
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"), first.alias("k"))
        for c in columns])).alias("s")).select("s.*")
    placed = F.col(f"k.{keys[0]}").isNotNull()
    firsts = stacked.groupBy("field", "value").agg(F.min(F.when(placed, F.col("k"))).alias("k"))
    # places by counts of key buckets and a rank within each: no task holds all values of a field
    last = F.lit((1 << 63) - 1)  # values without any key come last, by value
    firsts = firsts.withColumn("_b", F.coalesce(F.floor(F.col(f"k.{keys[0]}") / F.lit(1 << 16)), last))
    offsets = bucket_offsets(firsts, "_b", ["field"]).select("field", "_b", "_start")
    w = Window.partitionBy("field", "_b").orderBy("k", F.col("value").asc_nulls_last())
    return (firsts.withColumn("_r", F.row_number().over(w)).join(offsets, ["field", "_b"])
            .select("field", "value", (F.col("_start") + F.col("_r")).alias("position")))


def label_vocabulary_or_default(prepared: DataFrame | None, raw: DataFrame | None,
                                keys: Sequence[str] = ("id",)) -> DataFrame:
    """DST-2 with the original fall-back chain: labels of the prepared train
    data, else of the raw data, else the fixed lists (a missing source is
    ``None``; one without both label columns counts as empty)."""
    from ..sources.files import default_labels, first_non_empty

    present = [d for d in (prepared, raw) if d is not None]
    if not present:
        raise ValueError("give at least one source (or call sources.files.default_labels)")
    cands = [label_vocabulary(d, keys=keys) for d in present]
    return first_non_empty(cands, default_labels(present[0].sparkSession))


# --- sampling ----------------------------------------------------------------------


def sample_n(df: DataFrame, n: int, seed: int = SEED, keys: Sequence[str] = ("id",),
             pos_col: str | None = None) -> DataFrame:
    """SMP-1: exactly ``min(n, rows)`` rows without replacement.

    Planned as TakeOrderedAndProject: every partition keeps its own best ``n``
    and only those are merged.  With ``pos_col`` the 1-based sample order is
    kept (computed over the ``n`` rows only).
    """
    ordered = df.withColumn("_h", order_hash(seed, keys)).orderBy("_h", *keys).limit(n)
    if pos_col is None:
        return ordered.drop("_h")
    w = Window.orderBy("_h", *keys)  # over at most n rows
    return ordered.withColumn(pos_col, F.row_number().over(w)).drop("_h")


def shuffle_take(df: DataFrame, n: int, seed: int = SEED, keys: Sequence[str] = ("id",),
                 pos_col: str = "shuffle_pos") -> DataFrame:
    """SMP-2: seeded shuffle then the first ``n`` in shuffled order (all rows if fewer)."""
    return sample_n(df, n, seed, keys, pos_col=pos_col)


def shuffled(df: DataFrame, seed: int = SEED, keys: Sequence[str] = ("id",), pos_col: str = "shuffle_pos") -> DataFrame:
    """SMP-2 over a whole table: every row with its 1-based place in the seeded
    order, from counts of hash buckets and a rank within each (no global sort)."""
    base = df.withColumn("_h", order_hash(seed, keys)).withColumn("_b", F.substring("_h", 1, 3))
    offsets = bucket_offsets(base, "_b").select("_b", "_start")  # at most 16^3 rows
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_h", *keys))
    return (base.withColumn(pos_col, rank).join(F.broadcast(offsets), "_b")
            .withColumn(pos_col, F.col("_start") + F.col(pos_col)).drop("_h", "_b", "_start"))


def sample_per_group(df: DataFrame, group: str, n: int, seed: int = SEED,
                     keys: Sequence[str] = ("id",), rank_col: str = "_rank") -> DataFrame:
    """SMP-3: up to ``n`` rows per non-null group value.

    WindowGroupLimit keeps ``n`` rows per group in every map task before the
    shuffle, so a group holding a third of all rows costs ``n`` rows per task.
    """
    w = Window.partitionBy(group).orderBy("_h", *keys)
    return (df.where(F.col(group).isNotNull())
            .withColumn("_h", order_hash(seed, keys))
            .withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= n).drop("_h"))


# --- exact-size split ----------------------------------------------------------------


def split_counts(n: int, test_size: float = TEST_SHARE, val_size: float = VAL_SHARE) -> tuple[int, int, int]:
    """Sizes (train, val, test) for ``n`` rows: test = ceil(t*n), then
    val = ceil(v/(1-t) * (n - test)) of the rest; train the remainder."""
    n_test = math.ceil(test_size * n)
    n_val = math.ceil((val_size / (1 - test_size)) * (n - n_test))
    return n - n_test - n_val, n_val, n_test


def split_train_val_test(df: DataFrame, keys: Sequence[str] = ("id",), seed: int = SEED,
                         test_size: float = TEST_SHARE, val_size: float = VAL_SHARE,
                         hex_digits: int = 4) -> DataFrame:
    """SPL-1: exact-size, disjoint, covering split; adds ``split`` in {train, val, test}.

    Rank order is ``md5(seed|key)`` then key.  The first ``ceil(t*n)`` ranks are
    test, the next ``ceil(v/(1-t)*(n-n_test))`` are val, the rest train.  No
    global sort: see ``label_by_cut_points``.

    The input is read twice (bucket counts, then labels) and the two reads
    prune columns differently, so Spark cannot share an upstream shuffle
    between them: at scale pass a written (or otherwise cheap to scan) input,
    as ``plans.flows.prepare_corpus`` does.
    """
    adjusted = val_size / (1 - test_size)
    n_test = F.ceil(F.col("_total") * F.lit(test_size))
    n_val = F.ceil(F.lit(adjusted) * (F.col("_total") - n_test))
    hashed = df.withColumn("_h", order_hash(seed, keys))
    cuts = [("test", n_test), ("val", n_test + n_val)]
    return label_by_cut_points(hashed, "_h", list(keys), cuts, "train", hex_digits).drop("_h")


@dataclass(frozen=True)
class SplitCuts:
    """Where a seeded order is cut: rows up to the first cut are test, up to the second val, the rest train."""

    seed: int
    keys: tuple[str, ...]
    test: Cut | None
    val: Cut | None


def split_cuts(df: DataFrame, keys: Sequence[str] = ("id",), seed: int = SEED,
               test_size: float = TEST_SHARE, val_size: float = VAL_SHARE, hex_digits: int = 4) -> SplitCuts:
    """The two exact cuts of SPL-1, found by order-statistic selection over the keys alone.

    Rows are counted per leading digits of ``md5(seed|key)``; only the buckets that hold a cut are refined
    by further digits until a few rows are left (two or three narrow scans, at most ``2 * 16^hex_digits``
    counts a round).  Keys must be unique and not null.
    """
    def ranks(n: int) -> list[int]:
        _, n_val, n_test = split_counts(n, test_size, val_size)
        return [n_test, n_test + n_val]

    test, val = rank_cuts(df, order_hash(seed, keys), keys, ranks, hex_digits)
    return SplitCuts(seed, tuple(keys), test, val)


def with_split(df: DataFrame, cuts: SplitCuts) -> DataFrame:
    """SPL-1 as a predicate: ``split`` from a comparison of each row with two constants.

    One narrow pass without any exchange; as well for a stream or a part of the rows.
    """
    hash_ = order_hash(cuts.seed, cuts.keys)
    return df.withColumn("split", F.when(within(hash_, cuts.keys, cuts.test), F.lit("test"))
                         .when(within(hash_, cuts.keys, cuts.val), F.lit("val")).otherwise(F.lit("train")))


def split_sizes(split_df: DataFrame, test_size: float = TEST_SHARE, val_size: float = VAL_SHARE) -> DataFrame:
    """AGG-8: rows per split, with the requested shares as text."""
    shares = f"{1 - test_size - val_size:.1f}/{val_size:.1f}/{test_size:.1f}"
    return (split_df.groupBy("split").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
            .withColumn("shares", F.lit(shares)))


def split_metadata(raw: DataFrame, split_df: DataFrame, columns: Sequence[str],
                   paths: dict[str, str] | None = None) -> DataFrame:
    """SNK-3 content: one row with raw and cleaned sizes, split sizes, columns.

    ``raw_size`` is before cleaning and ``clean_size`` after (the original
    records only the size after cleaning, under a misleading name).
    """
    sizes = split_df.agg(
        F.count(F.lit(1)).cast("bigint").alias("clean_size"),
        F.sum(F.when(F.col("split") == "train", 1).otherwise(0)).cast("bigint").alias("train_size"),
        F.sum(F.when(F.col("split") == "val", 1).otherwise(0)).cast("bigint").alias("val_size"),
        F.sum(F.when(F.col("split") == "test", 1).otherwise(0)).cast("bigint").alias("test_size"),
    )
    raw_n = raw.agg(F.count(F.lit(1)).cast("bigint").alias("raw_size"))
    out = sizes.withColumn("raw_size", raw_n.scalar()).withColumn(
        "columns", F.lit(",".join(columns)))
    for name, p in (paths or {}).items():
        out = out.withColumn(f"{name}_path", F.lit(p))
    return out
