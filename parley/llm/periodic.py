"""Periodic runs of words by longest common extensions over difference-cover samples.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and length
of at least max(6, 4 q) that no neighbouring word extends keeping period q.

1. Words of a batch of texts become integers, each text ended by a 0.  Only suffixes at positions of a
   difference cover modulo ``v`` are sorted: first by (text, v words), then by doubling, where only
   groups that are still tied are sorted again (:class:`Extensions`).
2. The longest common extension of two positions of a text compares fewer than ``v`` words until both
   reach sampled positions; the rest is a range minimum over the neighbouring samples' common
   prefixes, from a sparse table.
3. For every period q up to a quarter of a text, positions on a grid are extended (:func:`runs_of`).  A
   run of period q holds at least max(6 - q, 3 q) consecutive positions that equal those q on, so a
   grid of that spacing meets each: n / (3 q) positions a period, O(n log n) a text (harmonic sum).

A text is one row, so it is worked on in one task; batches are cut at ``BATCH_WORDS`` words, and a longer
text takes a sparser cover, so that samples and tables stay a small multiple of its words.

Edge cases: null and empty texts have no words, no runs and an empty collapsed text; texts under six words
have no runs; very long texts are worked on whole; repeated rows and null ids are treated each; equal
runs of several periods count with the smallest; an empty table gives an empty result; of extra columns
only those asked for (``keys``) are kept.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import let
from parley.llm.textstats import words_of

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
BATCH_WORDS, GRID_POINTS = 100_000, 1_000_000
#: modulus and a set whose differences meet every remainder (perfect difference sets)
COVERS = {7: (0, 1, 3), 31: (1, 5, 11, 24, 25, 27), 73: (0, 1, 3, 7, 15, 31, 36, 54, 63)}
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


class Extensions:
    """Longest common extensions of positions of the same text, for many texts laid end to end.

    ``words`` holds numbers from 1 on and one 0 behind each text; ``text_of`` numbers each position's text.
    """

    def __init__(self, words: np.ndarray, text_of: np.ndarray, v: int = 7):
        self.v, self.cover = v, np.array(COVERS[v])
        self.words = np.concatenate([words, np.zeros(2 * v, words.dtype)])
        size, d = len(words), len(self.cover)
        self.place = np.full(v, -1)  # of a remainder within the cover
        self.place[self.cover] = np.arange(d)
        self.shift = np.zeros(v, np.int64)  # for a distance: x with x and x + distance in the cover
        for x in self.cover:
            self.shift[(self.cover - x) % v] = x
        blocks = size // v + 1
        position = (np.arange(blocks)[:, None] * v + self.cover).ravel()
        position = position[position < size]
        self.levels = self._sorted(position, text_of, d)
        common = self._neighbours(position, text_of, d)
        self.table = [common]
        while 2 << (len(self.table) - 1) <= len(common):
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))
        self.rank = self.levels[-1]
        self.levels = None

    def _sorted(self, position, text_of, d) -> list[np.ndarray]:
        """Ranks of the samples by their first v, 2v, 4v... words; the last ranks are all distinct."""
        bits = max(1, int(self.words.max()).bit_length())
        keys, per = [text_of[position]], max(1, 62 // bits)
        for at in range(0, self.v, per):
            key = np.zeros(len(position), np.int64)
            for k in range(at, min(at + per, self.v)):
                key = (key << bits) | self.words[position + k]
            keys.append(key)
        self.order = np.lexsort(keys[::-1])
        new = np.zeros(len(position), bool)
        new[:1] = True
        for key in keys:
            s = key[self.order]
            new[1:] |= s[1:] != s[:-1]
        levels, step = [], d
        while True:
            first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            rank = np.empty(len(new), np.int32)
            rank[self.order] = first
            levels.append(rank)
            tied = ~new
            tied[:-1] |= ~new[1:]
            slots = np.flatnonzero(tied)
            if not len(slots):
                return levels
            rows = self.order[slots]
            mine, next_ = rank[rows], rank[rows + step]
            by = np.lexsort((next_, mine))
            self.order[slots] = rows[by]
            mine, next_ = mine[by], next_[by]
            new = new.copy()
            new[slots[1:]] |= (mine[1:] == mine[:-1]) & (next_[1:] != next_[:-1])
            step *= 2

    def _neighbours(self, position, text_of, d) -> np.ndarray:
        """Common prefix of each sample and the one sorted before it (0 for the first of a text)."""
        common = np.zeros(len(position), np.int32)
        same = np.flatnonzero(text_of[position[self.order[1:]]] == text_of[position[self.order[:-1]]])
        a, b = self.order[same], self.order[same + 1]
        off = np.zeros(len(same), np.int64)
        for k in range(len(self.levels) - 2, -1, -1):
            rank = self.levels[k]
            off += np.where(rank[a + off] == rank[b + off], d << k, 0)
        length, i, j = off // d * self.v, position[a + off], position[b + off]
        live = np.arange(len(same))
        for t in range(self.v):
            live = live[self.words[i[live] + t] == self.words[j[live] + t]]
            length[live] += 1
        common[same + 1] = length
        return common

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that follow alike from i and from j on, i < j, both within one text."""
        v, out = self.v, np.zeros(len(i), np.int64)
        wait = (self.shift[(j - i) % v] - i) % v
        live = np.arange(len(i))
        for t in range(v):
            due = wait[live] == t
            if due.any():
                ready = live[due]
                out[ready] += self._sampled(i[ready] + t, j[ready] + t)
                live = live[~due]
            live = live[self.words[i[live] + t] == self.words[j[live] + t]]
            if not len(live):
                break
            out[live] += 1
        return out

    def _sampled(self, i, j):
        d = len(self.cover)
        a, b = (self.rank[x // self.v * d + self.place[x % self.v]].astype(np.int64) for x in (i, j))
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp(high - low)[1] - 1
        out = np.empty(len(i), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.table[k][low[at]], self.table[k][high[at] - (1 << int(k))])
        return out


def _grids(first, last, starts, sizes):
    """(start of text, period, spacing, points) of pairs of text and period, for a slice of texts."""
    most = sizes[first:last] // LEAST_EXPONENT
    text = np.repeat(np.arange(first, last), most)
    period = np.arange(most.sum()) - np.repeat(np.cumsum(most) - most, most) + 1
    gap = np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period) - period
    return starts[text], period, gap, np.maximum(0, (sizes[text] - period) // gap)


def runs_of(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, v: int = 7) -> np.ndarray:
    """Rows (start, end, period) of all runs, in places of ``words``, by start and period.

    Text t takes ``sizes[t]`` words from ``starts[t]`` on and one 0 behind them.
    """
    found = [np.zeros((0, 3), np.int64)]
    if not len(words) or not (sizes >= LEAST_LENGTH).any():
        return found[0]
    extensions = Extensions(words, np.repeat(np.arange(len(sizes)), sizes + 1), v)
    begin, period, gap, points = _grids(0, len(sizes), starts, sizes)
    edges = np.searchsorted(np.cumsum(points), np.arange(0, points.sum() + GRID_POINTS, GRID_POINTS))
    for lo, hi in zip(edges, np.append(edges[1:], len(points))):
        found.append(_runs_on_grid(extensions, begin[lo:hi], period[lo:hi], gap[lo:hi], points[lo:hi]))
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    once = np.ones(len(rows), bool)  # a multiple of the smallest period has the same ends
    once[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    rows = rows[once]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _runs_on_grid(extensions, begin, period, gap, points):
    words = extensions.words
    q, g = np.repeat(period, points), np.repeat(gap, points)
    nth = np.arange(len(q)) - np.repeat(np.cumsum(points) - points, points)
    low = np.repeat(begin, points)
    x = low + g - 1 + nth * g
    alike = np.flatnonzero(words[x] == words[x + q])
    ahead = np.zeros(len(x), np.int64)
    ahead[alike] = extensions.of(x[alike], x[alike] + q[alike])
    # the first grid point of a stretch: the one before does not reach it
    alike = alike[(nth[alike] == 0) | (ahead[alike - 1] < g[alike])]
    x, q, g, low, ahead = x[alike], q[alike], g[alike], low[alike], ahead[alike]
    need = np.maximum(0, g - ahead)  # words before x that must follow alike, too
    may = np.flatnonzero(x - need >= low)
    may = may[extensions.of(x[may] - need[may], x[may] - need[may] + q[may]) >= need[may]]
    x, q, g, low, ahead, need = x[may], q[may], g[may], low[may], ahead[may], need[may]
    left, right = np.maximum(low, x - g + 1), x - need
    while True:
        open_ = np.flatnonzero(left < right)
        if not len(open_):
            break
        mid = (left[open_] + right[open_]) // 2
        reach = extensions.of(mid, mid + q[open_]) >= x[open_] - mid
        right[open_[reach]] = mid[reach]
        left[open_[~reach]] = mid[~reach] + 1
    return np.stack([right, x + ahead + q, q], 1)


class _Numbers(dict):
    def __missing__(self, word):
        n = self[word] = len(self) + 1
        return n


def _batches(texts):
    """Lists of word lists, each of about ``BATCH_WORDS`` words or of one text."""
    held, size = [], 0
    for text in texts:
        words = _WORD.findall(text) if text else []
        if held and size + len(words) > BATCH_WORDS:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def _worked(batch: list[list[str]]):
    """Per text its runs (start, length, period) and the kept words joined by a space."""
    sizes = np.array([len(w) for w in batch], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    words, numbers = np.zeros(int((sizes + 1).sum()), np.int64), _Numbers()
    for at, own in zip(starts, batch):
        words[at: at + len(own)] = list(map(numbers.__getitem__, own))
    v = 7 if len(words) < 2_000_000 else 31 if len(words) < 20_000_000 else 73
    rows = runs_of(words, starts, sizes, v)
    lists, kept = [[] for _ in batch], {}
    text = np.searchsorted(starts, rows[:, 0], "right") - 1
    for t, (a, e, q) in zip(text.tolist(), rows.tolist()):
        at = int(starts[t])
        lists[t].append({"start": a - at, "length": e - a, "period": q})
        kept.setdefault(t, []).append((a - at + q, e - at))
    texts = []
    for t, own in enumerate(batch):
        if t in kept:
            depth = np.zeros(len(own) + 1, np.int64)
            for a, e in kept[t]:
                depth[a] += 1
                depth[e] -= 1
            own = [own[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0).tolist()]
        texts.append(" ".join(own))
    return lists, texts


def with_runs(documents: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys``, ``n_words``, ``runs`` (start, length and period in words, by start and period) and
    ``collapsed`` (the words that no run holds behind its first period, joined by one space)."""
    source = documents.select(*keys, "text")
    schema = T.StructType([source.schema[k] for k in keys] + [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    runs_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches):
        for b in batches:
            at = 0
            for batch in _batches(b.column("text").to_pylist()):
                lists, texts = _worked(batch)
                yield pa.RecordBatch.from_arrays(
                    [b.column(k).slice(at, len(batch)) for k in keys] + [pa.array([len(w) for w in batch], pa.int64()), pa.array(lists, runs_type), pa.array(texts, pa.string())],
                    names=[f.name for f in schema.fields])
                at += len(batch)

    return source.mapInArrow(run, schema)


def collapse(documents: DataFrame) -> DataFrame:
    """``documents`` with every run in ``text`` cut to its first period; texts without a run are unchanged."""
    found = with_runs(documents.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in documents.columns])), ("_row",))
    text = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col("_row.text"))
    return found.select(*[text.alias("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in documents.columns])


def planted(doc_id: Column, text: Column) -> Column:
    """The text, for every tenth id (by checksum) with a repeated passage from some word on."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, a + (i - a) % p))), " ")

    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), let(words_of(text), repeated)).otherwise(text)


def digests(found: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Number of runs, the run of the greatest exact length / period, and digests of runs and kept words."""
    better = lambda a, x: x["length"] * a["period"] > a["length"] * x["period"]  # noqa: E731 - ties: the earlier one
    top = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, x: F.when(better(a, x), x).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    rows = found.select(*keys, F.size("runs").cast("long").alias("n_runs"), top.alias("_top"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select(*keys, "n_runs", "_top.start", "_top.length", "_top.period",
                       F.expr("1000 * _top.length div _top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
