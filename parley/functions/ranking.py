"""Exact ranks and cut points without a single-partition sort.

``row_number()`` over an un-partitioned window moves every row into one task.
The helpers here split the ordered domain into buckets whose order agrees with
the total order (leading md5 hex digits for hash orders, ``turn div chunk``
for numeric orders), count rows per bucket with a partial aggregation, turn
the small count table into offsets, and only then rank inside buckets.

``label_by_cut_points`` goes one step further for exact-size splits: a row
whose whole bucket lies on one side of every cut point is labelled from the
bucket offsets alone; only the (at most one per cut) buckets that straddle a
cut are ranked row by row.  The data is scanned, never globally sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_HEX_DIGITS = 5  # 16**5 = 1,048,576 bucket rows: the proven bound for broadcast


def bucket_offsets(df: DataFrame, bucket_col: str, group_cols: Sequence[str] = (),
                   weight: Column | None = None) -> DataFrame:
    """Per (group, bucket): row count ``_n``, rows before it ``_start``, group total ``_total``.

    The input is aggregated (map-side partial) before any shuffle; the window
    then runs on the small count table only.
    """
    w = F.lit(1) if weight is None else weight
    counts = df.groupBy(*group_cols, bucket_col).agg(F.sum(w).cast("bigint").alias("_n"))
    before = (Window.partitionBy(*group_cols).orderBy(bucket_col)
              .rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy(*group_cols)
    return (counts
            .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint"))
            .withColumn("_total", F.sum("_n").over(whole).cast("bigint")))


def label_by_cut_points(df: DataFrame, hash_col: str, order_cols: Sequence[str],
                        cuts: Sequence[tuple[str, Column]], last_label: str,
                        hex_digits: int = 4) -> DataFrame:
    """Label rows by their exact 1-based rank in ``(hash_col, *order_cols)`` order.

    ``cuts`` is an ordered list of ``(label, upper_rank)`` where ``upper_rank``
    is a Column over ``_total`` (the row count); rows with rank <= the first
    upper bound get the first label, and so on; the rest get ``last_label``.
    Adds column ``split``.  ``hash_col`` must be uniform hex (md5) so buckets of
    its leading ``hex_digits`` digits are balanced.
    """
    if not 1 <= hex_digits <= MAX_HEX_DIGITS:
        raise ValueError(f"hex_digits must be in 1..{MAX_HEX_DIGITS}")
    base = df.withColumn("_b", F.substring(F.col(hash_col), 1, hex_digits))
    offs = bucket_offsets(base, "_b")
    for i, (_, upper) in enumerate(cuts):
        offs = offs.withColumn(f"_c{i}", upper.cast("bigint"))
    offs = offs.drop("_total")
    # offs has at most 16**hex_digits rows (bounded by construction): broadcast.
    joined = base.join(F.broadcast(offs), "_b")

    lo, hi = F.col("_start"), F.col("_start") + F.col("_n")
    whole = None
    prev = F.lit(0)
    for i, (label, _) in enumerate(cuts):
        c = F.col(f"_c{i}")
        cond = (lo >= prev) & (hi <= c)
        whole = F.when(cond, F.lit(label)) if whole is None else whole.when(cond, F.lit(label))
        prev = c
    whole = whole.when(lo >= prev, F.lit(last_label))
    labelled = joined.withColumn("split", whole)

    sure = labelled.where(F.col("split").isNotNull())
    rank_w = Window.partitionBy("_b").orderBy(hash_col, *order_cols)
    edge = (labelled.where(F.col("split").isNull())
            .withColumn("_r", F.col("_start") + F.row_number().over(rank_w)))
    by_rank = None
    for i, (label, _) in enumerate(cuts):
        cond = F.col("_r") <= F.col(f"_c{i}")
        by_rank = F.when(cond, F.lit(label)) if by_rank is None else by_rank.when(cond, F.lit(label))
    edge = edge.withColumn("split", by_rank.otherwise(F.lit(last_label))).drop("_r")

    drop = ["_b", "_n", "_start"] + [f"_c{i}" for i in range(len(cuts))]
    return sure.unionByName(edge).drop(*drop)


@dataclass(frozen=True)
class Cut:
    """The last row of an order that belongs before a cut: its hash and its keys."""

    hash: str
    keys: tuple


def rank_cuts(df: DataFrame, hash_: Column, keys: Sequence[str], ranks: Callable[[int], Sequence[int]],
              hex_digits: int = 4, few: int = 1000) -> list[Cut | None]:
    """The rows of given 1-based ranks in (hash, keys) order; None for a rank below 1.

    ``ranks`` makes the ranks from the number of rows.  Distributed selection: counts per leading
    ``hex_digits`` of the hash (a uniform hex text) find the bucket of each rank, the next digits of that
    bucket's rows refine it, until at most ``few`` rows are left to be sorted.  Each round is one scan of
    the keys, and at most ``16^hex_digits`` counts a rank reach the driver.
    """
    if not 1 <= hex_digits <= MAX_HEX_DIGITS:
        raise ValueError(f"hex_digits must be in 1..{MAX_HEX_DIGITS}")
    rows = df.select(hash_.alias("_h"), *keys)
    wanted: list[tuple[int, str, int]] | None = None  # (rank within the bucket, bucket, rows of the bucket)
    for digits in range(hex_digits, 32 + hex_digits, hex_digits):
        open_ = rows
        if wanted is not None:
            if all(n <= few for _, _, n in wanted):
                break
            open_ = rows.where(F.col("_h").substr(1, digits - hex_digits).isin([b for _, b, _ in wanted]))
        counts = sorted(open_.groupBy(F.col("_h").substr(1, digits).alias("_b")).agg(F.count(F.lit(1)).alias("_n")).collect())
        if wanted is None:
            wanted = [(r, "", 0) for r in ranks(sum(n for _, n in counts))]
        refined = []
        for rank, bucket, size in wanted:
            for b, n in counts:
                if rank > 0 and b.startswith(bucket):
                    if rank <= n:
                        bucket, size = b, n
                        break
                    rank -= n
            refined.append((rank, bucket, size))
        wanted = refined
    live = sorted({b for r, b, _ in wanted if r > 0})
    last = rows.where(F.col("_h").substr(1, len(live[0])).isin(live)).collect() if live else []
    cuts: list[Cut | None] = []
    for rank, bucket, _ in wanted:
        inside = sorted((r["_h"], *r[1:]) for r in last if r["_h"].startswith(bucket)) if rank > 0 else []
        cuts.append(Cut(inside[rank - 1][0], tuple(inside[rank - 1][1:])) if inside else None)
    return cuts


def within(hash_: Column, keys: Sequence[str], cut: Cut | None) -> Column:
    """Whether a row is at or before a cut in (hash, keys) order."""
    if cut is None:
        return F.lit(False)
    at = F.lit(True)
    for k, v in reversed(list(zip(keys, cut.keys))):
        at = (F.col(k) < F.lit(v)) | ((F.col(k) == F.lit(v)) & at)
    return (hash_ < cut.hash) | ((hash_ == cut.hash) & at)


def running_count(df: DataFrame, group_cols: Sequence[str], order_col: str,
                  flag: Column, out: str, chunk: int = 4096) -> DataFrame:
    """Inclusive running count of ``flag`` rows per group in ``order_col`` order.

    Two-phase so that a hot group (a third of all rows under one key) is
    spread over ``chunk``-sized windows: per (group, order_col div chunk) counts,
    offsets over that small table, then a window per chunk.  ``order_col``
    must be integral and unique within a group.
    """
    base = (df.withColumn("_f", F.when(flag, 1).otherwise(0))
            .withColumn("_k", F.floor(F.col(order_col) / F.lit(chunk)).cast("bigint")))
    offs = bucket_offsets(base, "_k", group_cols, weight=F.col("_f")).drop("_n", "_total")
    names = [*group_cols, "_k"]
    offs = offs.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(names)], "_start")
    same = F.lit(True)
    for i, c in enumerate(names):  # a null group is a group
        same = same & F.col(c).eqNullSafe(F.col(f"_o{i}"))
    joined = base.join(offs, same).drop(*[f"_o{i}" for i in range(len(names))])
    w = (Window.partitionBy(*group_cols, "_k").orderBy(order_col)
         .rowsBetween(Window.unboundedPreceding, 0))
    return (joined.withColumn(out, (F.col("_start") + F.sum("_f").over(w)).cast("bigint"))
            .drop("_f", "_k", "_start"))
