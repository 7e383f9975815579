"""Statistics of whole texts as native Spark expressions.

Words are runs of anything but space and the control characters 9 to 13.  Every expression works
on the full text of a row and needs no shuffle.  Null and empty texts have no words and all counts 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import WS, let

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"

FEATURES = ["words_log", "word_len", "symbol_rate", "upper_rate", "bang_rate", "digit_rate",
            "dup_line_rate", "repeat_rate", "herdan"]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.btrim(text, F.lit(WS)), SPACE), "")


def _removed(text: Column, pattern: str) -> Column:
    """Code points of the matches of a pattern that matches runs of a character class."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def dup_lines(text: Column) -> Column:
    """Lines (split at \\n) with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _covered(grams: Column) -> Column:
    """Words in windows that occur twice or more, from the window hashes in text order."""
    ranked = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s):
        flagged = F.transform(s, lambda x, j: F.when(
            (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]), x["i"]))
        return F.sort_array(F.filter(flagged, lambda x: x.isNotNull()))

    first = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    return F.aggregate(let(ranked, starts), first,
                       lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")),
                       lambda a: a["n"].cast("long"))


def repeat_words(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text, first copies included.

    Windows are compared by a 64-bit hash within one text; only texts that have an equal pair sort.
    """
    grams = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    found = let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(_covered(g)))
    return F.when(F.size(w) < 3, F.lit(0).cast("long")).otherwise(found)


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds struct column ``_s`` of counts of the whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    s = let(words_of(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
        repeat_words(w).alias("n_repeat_words"),
        _removed(t, SYMBOLS).alias("n_symbols"),
        dup_lines(t).alias("n_dup_lines"),
        _removed(t, r"\p{Lu}+").alias("n_upper"),
        _removed(t, r"!+").alias("n_bang"),
        _removed(t, r"[0-9]+").alias("n_digits"),
        F.size(F.split(t, "\n")).cast("long").alias("n_lines")))
    return df.withColumn("_s", s)


def features(s: str = "_s") -> list[Column]:
    """The features of :data:`FEATURES` as doubles, from the counts."""
    c = lambda k: F.col(f"{s}.{k}").cast("double")
    words, chars = F.greatest(c("n_words"), F.lit(1.0)), F.greatest(c("word_chars"), F.lit(1.0))
    made = {
        "words_log": F.log2(1.0 + c("n_words")), "word_len": c("word_chars") / words, "symbol_rate": c("n_symbols") / words,
        "upper_rate": c("n_upper") / chars, "bang_rate": c("n_bang") / words, "digit_rate": c("n_digits") / chars,
        "dup_line_rate": c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1.0)), "repeat_rate": c("n_repeat_words") / words,
        "herdan": F.log2(1.0 + c("n_distinct")) / F.log2(1.0 + words),  # vocabulary growth, little moved by length
    }
    return [F.round(made[k], 6).alias(k) for k in FEATURES]
