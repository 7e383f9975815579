"""Spelling variants: words at one edit from a much more frequent word.

1. Words are counted over whole texts: each task counts its own and the counts are summed.
2. Near words (exactly one inserted, deleted or replaced code point) share a half: if the edit lies in the second
   half of the shorter word the first halves are equal, else the second ones.  Words meet in buckets
   of (length, half); a bucket of more than ``MOST`` words is halved again by the rest that its words
   do not share, as often as needed (the rest gets shorter each time), so no bucket stays large and
   none is cut.
3. Within a bucket the rests are sorted and scanned (:func:`near_in`): the three-wide band of the edit matrix is
   kept a row per code point, adjacent words go on from the row of their common prefix, and as soon as a
   whole row exceeds one edit all following words that share the prefix so far are skipped.
4. Each bucket gives a row per word (near words, best of them), not per pair; these are combined by word.
   Roots follow forms by doubling: a form is at least five times as frequent, so chains are short.

Edge cases: null texts have no words; a null doc_id plants no edit; empty and very long texts and
repeated rows count as they are; ties between forms go to the smallest word in code-point order; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import tasks, written

LEAST_LETTERS, LEAST_COUNT, TIMES = 6, 5, 5
MOST, HELD_WORDS = 1_000, 300_000
PLANT = 199
_RUN = re.compile(r"[a-zÀ-ÿ]{%d,}" % LEAST_LETTERS)


def word_counts(documents: DataFrame, plant: int | None = None, held: int = HELD_WORDS) -> DataFrame:
    """(word, n) of all words of at least six letters, A-Z lower-cased.

    With ``plant``, runs whose checksum with the doc_id is a multiple of it lose a letter first.
    """
    def run(batches):
        counts: Counter = Counter()
        for b in batches:
            texts = pc.ascii_lower(b.column("text").cast(pa.large_string()))
            for doc_id, text in zip(b.column("doc_id").to_pylist(), texts):
                found = Counter(_RUN.findall(text.as_py() or ""))
                if plant and doc_id is not None:
                    start = zlib.crc32(f"{doc_id}:".encode())
                    for word in [w for w in found if zlib.crc32(w.encode(), start) % plant == 0]:
                        at = zlib.crc32(word.encode(), start) % len(word)
                        counts[word[:at] + word[at + 1:]] += found.pop(word)
                counts.update(found)
                if len(counts) > held:
                    yield _as_batch(counts)
                    counts = Counter()
        yield _as_batch(counts)

    parts = documents.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return parts.where(F.char_length("word") >= LEAST_LETTERS).groupBy("word").agg(F.sum("n").alias("n"))


def _as_batch(counts):
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def near_in(rests: list[str], lcp: list[int], jump: list[int], q: int) -> list[int]:
    """Places behind ``q`` of the sorted ``rests`` that are one edit from rest ``q``.

    ``lcp[i]`` is the common prefix of rests i - 1 and i, ``jump[i]`` the next place with a shorter one.
    """
    word, out, end = rests[q], [], len(rests)
    m = len(word)
    rows = [(9, 0, 1 if m else 9)]  # distances of d letters of the other word to d - 1, d, d + 1 of this one
    i, keep = q + 1, 0
    while i < end:
        other = rests[i]
        del rows[keep + 1:]
        d, n = keep, len(other)
        a, b, c = rows[d]
        dead = False
        while d < n:
            x = other[d]
            d += 1
            # columns d - 1, d, d + 1 from the row above
            e = min(a + (d < 2 or word[d - 2] != x), b + 1) if d - 1 <= m else 9
            f = min(b + (word[d - 1] != x), c + 1, e + 1) if d <= m else 9
            g = min(c + (word[d] != x), f + 1) if d + 1 <= m else 9
            a, b, c = e, f, g
            rows.append((a, b, c))
            if a > 1 and b > 1 and c > 1:
                dead = True
                break
        if not dead and -1 <= m - n <= 1 and rows[n][m - n + 1] == 1:
            out.append(i)
        i += 1
        if dead:
            while i < end and lcp[i] >= d:
                i = jump[i]
        if i < end:
            keep = lcp[i]  # words that were skipped share more than that with the last one
    return out


def _scanned(bucket: list[tuple[str, str, int]], length: int, path: str, out: dict) -> None:
    """Adds the near pairs of one bucket of (rest, word, n) to ``out``: word -> [near words, best]."""
    bucket.sort()
    rests = [r for r, _, _ in bucket]
    size = len(rests)
    lcp = [0] * size
    for i in range(1, size):
        a, b, k = rests[i - 1], rests[i], 0
        low = min(len(a), len(b))
        while k < low and a[k] == b[k]:
            k += 1
        lcp[i] = k
    jump, open_ = [size] * size, []
    for i in range(size):
        while open_ and lcp[open_[-1]] > lcp[i]:
            jump[open_.pop()] = i
        open_.append(i)
    for q in range(size - 1):
        for i in near_in(rests, lcp, jump, q):
            (_, a, n), (_, b, o) = bucket[q], bucket[i]
            if min(len(a), len(b)) != length or not _first_met(a, b, length, path):
                continue
            for x, y, k in ((a, b, o), (b, a, n)):
                best = (-k, y)
                seen = out.get(x)
                if seen is None:
                    out[x] = [1, best]
                else:
                    seen[0] += 1
                    if best < seen[1]:
                        seen[1] = best


def _shared(length: int, path: str) -> tuple[int, int]:
    """Letters that all words of a bucket share in front and at the end: ``p`` the first half, ``s`` the second."""
    front = end = 0
    rest = length
    for step in path:
        half = rest // 2
        if step == "p":
            front, rest = front + half, rest - half
        else:
            end, rest = end + rest - half, half
    return front, end


def _first_met(a: str, b: str, length: int, path: str) -> bool:
    """Whether a pair belongs to this bucket: one that shares both halves belongs to the first."""
    for i, step in enumerate(path):
        if step == "s":
            front, end = _shared(length, path[:i])
            half = (length - front - end) // 2
            if a[front: front + half] == b[front: front + half]:
                return False
    return True


def _half(keyed: DataFrame) -> DataFrame:
    """The two halves of the rest as new buckets: rows (length, path, front, end, word, n)."""
    rest = F.col("length") - F.char_length("front") - F.char_length("end")
    half = F.floor(rest / 2).cast("int")
    def part(start: Column, size: Column) -> Column:
        return F.substring(F.col("word"), start, size)
    more = F.concat("front", part(F.char_length("front") + 1, half))
    back = rest - half
    less = F.concat(part(F.char_length("word") - F.char_length("end") - back + 1, back), F.col("end"))
    steps = F.array(F.struct(F.concat("path", F.lit("p")).alias("path"), more.alias("front"), F.col("end").alias("end")),
                    F.struct(F.concat("path", F.lit("s")).alias("path"), F.col("front").alias("front"), less.alias("end")))
    return keyed.select("length", "word", "n", F.explode(steps).alias("_s")).select("length", "_s.*", "word", "n")


KEY = ["length", "path", "front", "end"]


def near_words(vocabulary: DataFrame, most: int = MOST) -> DataFrame:
    """(word, n_near, form_of, form_n): near words of each word that has any, and the most frequent of them."""
    size = F.char_length("word")
    rows = vocabulary.select("word", "n", F.explode(F.array(size, size - 1)).alias("length"))
    keyed, parts = _half(rows.where("length > 0").withColumns({"path": F.lit(""), "front": F.lit(""), "end": F.lit("")})), None
    while True:
        keyed = written(keyed, "spelling-buckets")
        halves = F.col("length") - F.char_length("front") - F.char_length("end") > 1
        sizes = keyed.groupBy(*KEY).agg(F.count("*").alias("_c"))
        large = written(sizes.where((F.col("_c") > most) & halves).select(*KEY), "large-buckets")
        found = written(_scan(keyed.join(large, KEY, "left_anti")), "near-words")
        parts = found if parts is None else parts.unionByName(found)
        if large.isEmpty():
            break
        keyed = _half(keyed.join(large, KEY, "left_semi"))
    best = F.min(F.struct(F.col("least"), F.col("form"))).alias("_b")
    return parts.groupBy("word").agg(F.sum("near").alias("n_near"), best).select("word", "n_near", F.col("_b.form").alias("form_of"), (-F.col("_b.least")).alias("form_n"))


def _scan(keyed: DataFrame) -> DataFrame:
    """Near words within each bucket: rows (word, near, least, form), streamed over sorted partitions."""
    schema = pa.schema([("word", pa.string()), ("near", pa.int64()), ("least", pa.int64()), ("form", pa.string())])

    def emitted(out):
        rows = [(w, c, b[0], b[1]) for w, (c, b) in out.items()]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches):
        key, bucket, out = None, [], {}
        for b in batches:
            for length, path, front, end, word, n in zip(*(b.column(c).to_pylist() for c in KEY + ["word", "n"])):
                if (length, path, front, end) != key:
                    if len(bucket) > 1:
                        _scanned(bucket, key[0], key[1], out)
                    key, bucket = (length, path, front, end), []
                bucket.append((word[len(front): len(word) - len(end)], word, n))
            if len(out) > 100_000:
                yield emitted(out)
                out = {}
        if len(bucket) > 1:
            _scanned(bucket, key[0], key[1], out)
        if out:
            yield emitted(out)

    dealt = keyed.select(*KEY, "word", "n").repartition(tasks(keyed.sparkSession), *KEY).sortWithinPartitions(*KEY)
    return dealt.mapInArrow(run, "word string, near long, least long, form string")


def variants(vocabulary: DataFrame, times: int = TIMES, most: int = MOST) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of a vocabulary (word, n).

    A word's form is its most frequent near word, if that is at least ``times`` as frequent.  At most
    some thousand words can be one edit from a word, so no join key of the roots is hot.
    """
    near = near_words(vocabulary, most)
    enough = F.col("form_n") >= times * F.col("n")
    table = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("form_of")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"))
    table = written(table, "spelling-forms")
    roots = table.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        roots = written(roots, "spelling-roots")
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        if roots.join(on.select("root"), "root", "left_semi").isEmpty():
            break
        roots = roots.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
    return table.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(documents: DataFrame, plant: int | None = None, least: int = LEAST_COUNT) -> DataFrame:
    """The variants among all words of ``documents`` that occur at least ``least`` times."""
    return variants(written(word_counts(documents, plant).where(F.col("n") >= least), "vocabulary"))
