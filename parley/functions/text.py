"""Text column helpers (all native Spark expressions, no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII whitespace only, so that Java regex and RE2 (SQL oracles) agree.
WS_CLASS = "[ \\t\\n\\r\\f]"
TOKEN_SPLIT = WS_CLASS + "+"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Remove leading and trailing whitespace including tab and newline."""
    return F.regexp_replace(col_(c), f"^{WS_CLASS}+|{WS_CLASS}+$", "")


def first_line(c: str | Column) -> Column:
    return F.substring_index(col_(c), "\n", 1)


def word_tokens(c: str | Column) -> Column:
    """Lower-cased whitespace tokens, empty tokens removed (array<string>)."""
    return F.filter(F.split(F.lower(col_(c)), TOKEN_SPLIT), lambda t: t != "")


def after_first(c: str | Column, sep: str) -> Column:
    """Text after the first ``sep`` if it occurs, else the text unchanged."""
    c = col_(c)
    pos = F.instr(c, sep)
    return F.when(pos > 0, c.substr(pos + F.lit(len(sep)), F.lit(2147483647))).otherwise(c)
