"""Keyword lexicons: ordered ``(intent, [keywords])`` lists and their table form.

A lexicon is ordered: the position of an intent is its priority, and ties in
score go to the earlier intent.  As a table it is ``(intent, priority,
keyword)``; ``priority`` starts at 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .constants import STOCK_LEXICON

Lexicon = Sequence[tuple[str, Sequence[str]]]

LEXICON_SCHEMA = T.StructType([
    T.StructField("intent", T.StringType(), False),
    T.StructField("priority", T.IntegerType(), False),
    T.StructField("keyword", T.StringType(), False),
])

# A lexicon for the synthetic stand-in text, where the stock keywords almost
# never occur.  Its intents are stand-in corpus intents (document sources) so
# the template bank has entries for them; "unbanked" has none, which exercises
# the general/model fall-back.  Chosen to produce multi-hits and ties.
PROBE_LEXICON: list[tuple[str, list[str]]] = [
    ("src3", ["the", "der"]),
    ("src7", ["tion", "que"]),
    ("src11", ["ing", "und"]),
    ("src15", ["ment", "sch", "eau"]),
    ("unbanked", ["when", "ein"]),
]


def lexicon_rows(lexicon: Lexicon = STOCK_LEXICON) -> list[tuple[str, int, str]]:
    return [(intent, prio, kw)
            for prio, (intent, kws) in enumerate(lexicon, start=1)
            for kw in kws]


def lexicon_frame(spark: SparkSession, lexicon: Lexicon = STOCK_LEXICON) -> DataFrame:
    return spark.createDataFrame(lexicon_rows(lexicon), LEXICON_SCHEMA)
