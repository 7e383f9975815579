"""Benchmark decontamination by CGK embedding and bit sampling, with exact edit verification.

Texts and items are sequences of lower-cased words.  A CGK random walk reads a sequence, writes the
word under its head at each step and moves on or stays by a random bit of (step, word): it maps
sequences of small edit distance to outputs of small Hamming distance.  For each class of item lengths,
``REPEATS`` walks with ``SAMPLED`` output places each make keys of the items and of the windows
that begin at every word of every text.  A window that shares a key with an item is verified: the exact word edit
distance of the item to the text from there on, at the best end, must be at most
``(1 - SIMILARITY) * item length``.

Windows that cannot qualify are skipped before the walk without loss: every word outside the items'
vocabulary costs an edit, so a window with more of them than allowed is no match.  Items are taken in
blocks of ``BLOCK_ITEMS``, each broadcast and run against all texts, whatever the table's size.

With places agreeing at a rate p, a walk misses a match with 1 - p^SAMPLED; the repeats are
chosen so that p = 0.5 is found with at least ``RECALL``.  Unedited passages are always found.

Edge cases: null and empty texts hold nothing; items under five words are no evidence and match
nothing; equal items are one search and report under each id; null item ids are left out; a null
doc_id is reported as such; empty tables give empty results; extra columns are ignored or, in
:func:`drop_contaminated` (which judges each row by its own text), kept.
"""

from __future__ import annotations

import math
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.align import distances_by_end
SIMILARITY, LEAST_WORDS, SAMPLED, RECALL = 0.8, 5, 3, 0.95
REPEATS = math.ceil(math.log(1 - RECALL) / math.log(1 - 0.5**SAMPLED))
BLOCK_ITEMS = 5_000
_WORD = re.compile(r"\w+")
_P = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN, STOP = 0, 1


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class Items:
    """The keys of one block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY):
        self.similarity, by = similarity, {}
        for item_id, text in items:
            w = tuple(words_of(text))
            if len(w) >= LEAST_WORDS and item_id is not None:
                by.setdefault(w, []).append(item_id)
        self.ids = list(by.values())
        self.vocabulary: dict[str, int] = {}
        self.words = [[self.vocabulary.setdefault(x, len(self.vocabulary) + 2) for x in w] for w in by]
        self.sets = [frozenset(w) for w in self.words]
        rng = np.random.default_rng(11)
        self.hashes = rng.integers(1, 1 << 63, len(self.vocabulary) + 2, np.uint64) * np.uint64(2) + np.uint64(1)
        self.hashes[STOP] = 0  # the walk stays there
        self.classes = []
        low, longest = LEAST_WORDS, max(map(len, self.words), default=0)
        while low <= longest:
            high = max(low + 1, low * 4 // 3 + 1)
            own = [i for i, w in enumerate(self.words) if low <= len(w) < high]
            if own:
                self.classes.append(self._class(low, high, own, rng))
            low = high

    def allowed(self, n: int) -> int:
        return int(round((1 - self.similarity) * n, 6))

    def _class(self, low, high, own, rng):
        steps = max(low, low * 7 // 5)
        moves = rng.integers(1, 1 << 63, (REPEATS, steps), np.uint64) * np.uint64(2) + np.uint64(1)
        places = [sorted(rng.choice(steps, SAMPLED, replace=False).tolist()) for _ in range(REPEATS)]
        flat, starts = [], []
        for i in own:
            starts.append(len(flat))
            flat += self.words[i] + [STOP]
        out = {"low": low, "spare": self.allowed(high - 1), "moves": moves, "places": places, "tables": []}
        flat, starts = np.asarray(flat, np.int64), np.asarray(starts, np.int64)
        for walk in range(REPEATS):
            first = np.zeros(len(self.hashes), bool)
            keys, _ = self._walk(flat, starts, out, walk, first)
            order = np.argsort(keys, kind="stable")
            out["tables"].append((keys[order], np.asarray(own)[order], first))
        return out

    def _walk(self, flat, starts, c, walk, first=None):
        """(keys, starts) of one walk over the windows at ``starts``.

        ``first``, if given, is told the words at the first place; else windows whose word there is
        no item's are left out at that point, since their keys could not match.
        """
        moves, places = c["moves"][walk], c["places"][walk]
        at, key = starts.copy(), np.zeros(len(starts), np.uint64)
        for step in range(places[-1] + 1):
            word = flat[at]
            if step == places[0]:
                if first is None:
                    kept = c["tables"][walk][2][word]
                    at, key, starts, word = at[kept], key[kept], starts[kept], word[kept]
                else:
                    first[word] = True
            h = self.hashes[word]
            if step in places:
                key = (key ^ h) * _P
                key ^= key >> np.uint64(32)
            at += ((h * moves[step]) >> np.uint64(63)).astype(np.int64)
        return key, starts

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word, window words, distance): the best window of each match."""
        get, parts = self.vocabulary.get, []
        for t in texts:
            w = words_of(t)
            parts.append(np.fromiter(map(get, w, repeat(UNKNOWN)), np.int64, len(w)))
        stop = np.asarray([STOP])
        flat = np.concatenate([x for p in parts for x in (p, stop)]) if parts else stop
        sizes = np.asarray([len(p) for p in parts], np.int64)
        ends = np.cumsum(sizes + 1) - 1  # the stop behind each text
        unknown = np.concatenate([[0], np.cumsum(flat == UNKNOWN)])
        end_of = np.repeat(ends, sizes + 1)
        places = np.arange(len(flat))
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        for c in self.classes:
            to = np.minimum(places + c["low"], end_of)
            windows = places[unknown[to] - unknown[places] + (places + c["low"] - to) <= c["spare"]]
            windows = windows[windows < end_of[windows]]
            pairs = set()
            for walk, (table, item, _) in enumerate(c["tables"]):
                keys, begin = self._walk(flat, windows, c, walk)
                lo, hi = np.searchsorted(table, keys, "left"), np.searchsorted(table, keys, "right")
                hit = np.flatnonzero(hi > lo)
                for k in hit.tolist():
                    at = int(begin[k])
                    pairs.update((at, int(i)) for i in item[lo[k]: hi[k]])
            for at, i in sorted(pairs):
                own = self.words[i]
                most = self.allowed(len(own))
                window = flat[at: min(at + len(own) + most, int(end_of[at]))].tolist()
                if len(self.sets[i].difference(window)) > most:  # each word that is missing costs an edit
                    continue
                scores = distances_by_end(own, window)
                size = min(range(len(scores)), key=lambda j: (scores[j], abs(j - len(own))))
                if size and scores[size] <= most:
                    text = int(np.searchsorted(ends, at))
                    first = at - int(ends[text] - sizes[text])
                    found[text, i] = min(found.get((text, i), (1 << 60, 0, 0)), (scores[size], first, size))
        return [(t, i, first, size, d) for (t, i), (d, first, size) in sorted(found.items())]


_held: dict[str, object] = {}


def _items(value, similarity: float) -> Items:
    """The keys of a broadcast block, made once per worker."""
    if _held.get("value") is not value or _held.get("similarity") != similarity:
        _held.update(value=value, similarity=similarity, items=Items(value, similarity))
    return _held["items"]


def _blocks(benchmark: DataFrame):
    """The items as broadcast blocks of about BLOCK_ITEMS rows each."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("item_id is not null and text is not null")
    n = max(1, -(-items.count() // BLOCK_ITEMS))
    for k in range(n):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        yield spark.sparkContext.broadcast([tuple(r) for r in block])


def matches(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, batch: int = 500) -> DataFrame:
    """doc_id, item_id, first_word, window_words, distance, similarity of every match."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("first_word", pa.int32()), ("window_words", pa.int32()), ("distance", pa.int32()), ("similarity", pa.float64())])
    docs, out = documents.select(F.col("doc_id").cast("long"), "text"), None
    for held in _blocks(benchmark):
        def run(batches, held=held):
            own = _items(held.value, similarity)
            for b in batches:
                for at in range(0, b.num_rows, batch):
                    part = b.slice(at, batch)
                    ids = part.column("doc_id").to_pylist()
                    rows = [(ids[t], item, first, size, d, 1 - d / len(own.words[i]))
                            for t, i, first, size, d in own.search(part.column("text").to_pylist()) for item in own.ids[i]]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        part = docs.mapInArrow(run, "doc_id long, item_id long, first_word int, window_words int, distance int, similarity double")
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, batch: int = 500) -> DataFrame:
    """The rows whose text holds no benchmark item, columns unchanged; a filter without a shuffle."""
    out = documents
    for held in _blocks(benchmark):
        def run(batches, held=held):
            own = _items(held.value, similarity)
            for b in batches:
                for at in range(0, b.num_rows, batch):
                    part = b.slice(at, batch)
                    bad = {t for t, *_ in own.search(part.column("text").to_pylist())}
                    yield part.take(pa.array([i for i in range(part.num_rows) if i not in bad], pa.int64()))

        out = out.mapInArrow(run, documents.schema)
    return out
