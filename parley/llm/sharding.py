"""Sharding: best-fit-decreasing bin packing of indivisible groups by a balanced tree.

Rows with equal texts are one indivisible group of their summed size.  Groups larger than a small
fixed share of all bytes are items of their own; there are at most ``shards * resolution`` such groups
whatever the input.  Smaller groups are gathered by a hash of their text into as many composite items.
The items (bounded in number) are sorted by size and each enters the bin with the least room
that holds it, found in a balanced tree of rooms.  The capacity is fixed while packing; the smallest
one that needs no more than the wanted shards is searched, so shards end up near equal in bytes.

Slots: rows of a shard are numbered gapless in two steps, by counts of (shard, sub-bucket) and a rank
within a sub-bucket, so no task sorts a whole shard.

Edge cases: a null text is an empty one (size 1); repeated rows keep their own slots; null ids come
first; an empty table gives an empty result; one group larger than an even share makes its shard
larger than the others, since groups are never divided; extra columns are ignored.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import written

RESOLUTION = 2048  # items per shard: bounds the item table at 2 * shards * RESOLUTION rows
SUB_BUCKETS = 512


class Rooms:
    """A balanced search tree (treap) of (room, bin) with the least entry at or above a room."""

    __slots__ = ("root", "rng")

    def __init__(self):
        self.root, self.rng = None, random.Random(7)

    def _split(self, node, key):
        """(entries below key, entries from key on); a node is [key, priority, left, right]."""
        if node is None:
            return None, None
        if node[0] < key:
            a, b = self._split(node[3], key)
            node[3] = a
            return node, b
        a, b = self._split(node[2], key)
        node[2] = b
        return a, node

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._join(a[3], b)
            return a
        b[2] = self._join(a, b[2])
        return b

    def add(self, key):
        a, b = self._split(self.root, key)
        self.root = self._join(self._join(a, [key, self.rng.random(), None, None]), b)

    def take(self, room):
        """Takes out and returns the least entry with at least this room, or None."""
        a, b = self._split(self.root, (room, -1))
        if b is None:
            self.root = a
            return None
        at = b
        while at[2] is not None:
            at = at[2]
        key = at[0]
        _, rest = self._split(b, (key[0], key[1] + 1))
        self.root = self._join(a, rest)
        return key


def pack(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Bin of each item, best fit decreasing; None if more than ``most`` bins would be needed.

    An item above the capacity gets a bin of its own.
    """
    tree, bins, out = Rooms(), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[i])
        if found is None:
            if bins == most:
                return None
            found, bins = (max(capacity, sizes[i]), bins), bins + 1
        out[i] = found[1]
        if found[0] > sizes[i]:
            tree.add((found[0] - sizes[i], found[1]))
    return out


def near_equal(sizes: list[int], shards: int) -> list[int]:
    """Bins of the smallest capacity (to one part in a million) that needs at most ``shards`` bins."""
    if not sizes:
        return []
    low = max(-(-sum(sizes) // shards), max(sizes))
    best = pack(sizes, low, shards)
    if best is not None:
        return best
    width, high = max(1, low // 100_000), low
    while best is None:
        low, high, width = high, high + width, 2 * width
        best = pack(sizes, high, shards)
    while high - low > max(1, high // 1_000_000):
        mid = (low + high) // 2
        tried = pack(sizes, mid, shards)
        low, high, best = (low, mid, tried) if tried is not None else (mid, high, best)
    return best


def shard(documents: DataFrame, shards: int = 8, resolution: int = RESOLUTION) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    spark = documents.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = written(documents.select(
        F.col("doc_id").cast("long"), (F.length(F.encode(text, "UTF-8")) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"), F.unhex(F.md5(text)).alias("_group")), "shard-rows")
    groups = rows.groupBy("_group").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    share = total / (shards * resolution)
    buckets = shards * resolution
    bucket = F.pmod(F.xxhash64("_group"), F.lit(buckets)).cast("int")
    item = F.when(F.col("bytes") > share, F.col("_group"))  # null: part of a composite item
    items = written(groups.groupBy(item.alias("_big"), F.when(F.col("bytes") <= share, bucket).alias("_bucket")).agg(F.sum("bytes").alias("bytes")), "shard-items")
    found = items.orderBy(F.desc("bytes"), "_big", "_bucket").collect()  # at most 2 * buckets rows
    bins = near_equal([r["bytes"] for r in found], shards)
    schema = "_big binary, _bucket int, shard int"
    placed = spark.createDataFrame([(r["_big"] and bytes(r["_big"]), r["_bucket"], b) for r, b in zip(found, bins)], schema)
    big = placed.where("_big is not null").select(F.col("_big").alias("_group"), F.col("shard").alias("_own"))
    small = placed.where("_bucket is not null").select("_bucket", F.col("shard").alias("_shared"))
    out = (rows.withColumn("_bucket", bucket).join(F.broadcast(big), "_group", "left").join(F.broadcast(small), "_bucket", "left")
           .select("doc_id", "size", "text_crc32", F.coalesce("_own", "_shared").alias("shard")))
    return with_slots(out)


def with_slots(rows: DataFrame) -> DataFrame:
    """Adds ``slot``: 0.. gapless within each shard, in order of (sub-bucket, doc_id, checksum)."""
    rows = rows.withColumn("_sub", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(SUB_BUCKETS)).cast("int"))
    counts = rows.groupBy("shard", "_sub").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_sub", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rank = Window.partitionBy("shard", "_sub").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("_rank", F.row_number().over(rank) - 1).join(F.broadcast(offsets), ["shard", "_sub"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("_start") + F.col("_rank")).cast("long").alias("slot")))
