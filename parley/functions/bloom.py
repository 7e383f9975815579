"""A Bloom filter as a column: built by a distributed aggregate, tested inside a scan.

Its bits are 64-bit words, set by a ``bit_or`` per word; the words become one array in a scalar subquery,
which Spark evaluates once and hands to every task.  A value that was put in always passes; one that
was not passes now and then, so what follows must not rely on the filter alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 4
LEAST_BITS, MOST_BITS = 1 << 10, 1 << 26  # up to 8 MiB in every task
BITS_PER_VALUE, FEWEST_BITS_PER_VALUE = 12, 4  # wanted (0.6 % pass by chance); below the second (16 %) do without


def bits_for(values: int) -> int | None:
    """Size for so many values, a power of two; None if none within the bound is of use."""
    if values * FEWEST_BITS_PER_VALUE > MOST_BITS:
        return None
    return min(MOST_BITS, max(LEAST_BITS, 1 << (values * BITS_PER_VALUE - 1).bit_length() if values else LEAST_BITS))


def _places(value: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(value, F.lit(k)), F.lit(bits)) for k in range(HASHES)]


def bloom_filter(values: DataFrame, column: str, bits: int) -> DataFrame:
    """One row ``words``: the filter of a column as an array of ``bits / 64`` integers."""
    at = values.select(F.explode(F.array(*_places(F.col(column), bits))).alias("at"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("at", F.lit(64)).cast("int"))
    words = at.groupBy(F.floor(F.col("at") / 64).alias("id")).agg(F.bit_or(one).alias("word"))
    every = values.sparkSession.range(bits // 64).join(words, "id", "left").select("id", F.coalesce("word", F.lit(0)).alias("word"))
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "word"))), lambda x: x["word"]).alias("words"))


def may_hold(filter_: DataFrame, value: Column, bits: int) -> Column:
    """Whether the filter may hold ``value``."""
    words, out = filter_.scalar(), F.lit(True)
    for at in _places(value, bits):
        out = out & (F.bit_get(F.get(words, F.floor(at / 64).cast("int")), F.pmod(at, F.lit(64)).cast("int")) == 1)
    return out
