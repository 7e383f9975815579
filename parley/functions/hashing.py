"""Deterministic, engine-independent order and choice.

Random sampling is replaced by ordering on ``md5(seed|key...)`` with ties broken
on the key itself.  md5 hex text is produced identically by Spark and by
SQL engines such as DuckDB, so a seeded "random" sample, split or choice is
reproducible in an oracle and across re-executions after a lost executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_cols(keys: Sequence[str | Column]) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def order_hash(seed: int | str, keys: Sequence[str | Column]) -> Column:
    """``md5(concat_ws('|', seed, key1, key2, ...))`` as lower-case hex.

    Keys must be non-null and unique per row (``concat_ws`` skips nulls, so
    a null key would merge two positions).
    """
    parts = [F.lit(str(seed))] + [c.cast("string") for c in _as_cols(keys)]
    return F.md5(F.concat_ws("|", *parts))


def hash_prefix_int(hex_col: Column, digits: int = 8) -> Column:
    """Leading ``digits`` hex digits of an md5 as a non-negative bigint."""
    return F.conv(F.substring(hex_col, 1, digits), 16, 10).cast("bigint")


def pick_index(seed: int | str, keys: Sequence[str | Column], n: Column) -> Column:
    """1-based index in ``[1, n]`` chosen by hash; null when ``n`` is 0/null."""
    h = hash_prefix_int(order_hash(seed, keys))
    return F.when(n > 0, F.pmod(h, n) + 1)
