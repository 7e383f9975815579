"""Language identification by cross-parsing entropy.

Per language a bounded sample of labelled text (``symbols`` normalised symbols, taken from
``sample_docs`` hash-chosen rows) becomes a suffix automaton.  A text is parsed from left to right
into the longest phrases that occur in the sample, by walking the automaton until no transition is
left; the language whose sample needs the fewest phrases, normalised by log2 of its length, wins:
``phrases * log2(sample length) / symbols`` estimates the cross entropy in bits a symbol.

Texts are lower-cased, runs of non-letters become one space, and letters of no sample, which end a
phrase, share one symbol.  For speed the automata are one dense table over states and the ``WIDTH`` most
frequent symbols; the steps by all other letters, as of further scripts, are a sorted list.  Texts are cut into blocks whose
parses start anew (``block`` symbols), and all blocks of a batch walk in step; every symbol of every
text is read.

Edge cases: null texts and texts without a letter are ``und`` with score 0; ties go to the first
language in order; without learnable rows every text is ``und``; repeated rows and null ids are
predicted each; extra columns are ignored.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SYMBOLS, SAMPLE_DOCS, SAMPLE_CHARS = 20_000, 60, 2_000  # per language: the bound of the sample
TABLE_SYMBOLS = 400_000  # all languages together
WIDTH = 64  # symbols of the dense table: 1 space, 2 letter of no sample, then the most frequent letters


@dataclass(frozen=True)
class Model:
    """Languages with their sample texts (already normalised) and the alphabet."""

    alphabet: str
    samples: tuple[tuple[str, str], ...]


def normalise(text: str) -> str:
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def train(rows: DataFrame, symbols: int = SYMBOLS) -> Model:
    """Learns from (doc_id, text, lang) rows; the driver gets at most ``SAMPLE_DOCS`` pieces a language."""
    ids = rows.where("lang is not null and text is not null").select(
        "lang", F.substring("text", 1, SAMPLE_CHARS).alias("text"), F.xxhash64(F.lit("lang"), F.col("doc_id").cast("string")).alias("h"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    found = ids.withColumn("_k", rank).where(F.col("_k") <= SAMPLE_DOCS).drop("_k").orderBy("lang", "h", "text").collect()
    texts: dict[str, list[str]] = {}
    for r in found:
        texts.setdefault(r["lang"], []).append(normalise(r["text"]))
    symbols = min(symbols, max(1000, TABLE_SYMBOLS // max(1, len(texts))))
    samples = tuple((k, " ".join(x for x in v if x)[:symbols]) for k, v in sorted(texts.items()))
    samples = tuple((k, v) for k, v in samples if v)
    counts: dict[str, int] = {}
    for _, v in samples:
        for c in v:
            counts[c] = counts.get(c, 0) + 1
    counts.pop(" ", None)
    return Model("".join(sorted(counts, key=lambda c: (-counts[c], c))), samples)


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    go, link, size, last = [{}], [-1], [0], 0
    for c in codes:
        new = len(go)
        go.append({})
        link.append(0)
        size.append(size[last] + 1)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return go


class Parser:
    """Counts phrases of many texts against all languages at once."""

    def __init__(self, model: Model, block: int = 512):
        self.block, self.languages = block, [k for k, _ in model.samples]
        kind = np.zeros(sys.maxunicode + 1, np.int32)  # 0 is no letter
        codes = {c: i for i, c in enumerate(model.alphabet, 3)}
        for point in range(sys.maxunicode + 1):
            c = chr(point)
            if c.isalpha():
                kind[point] = codes.get(c.lower(), 2)
        self.kind = kind
        parts, base, self.roots = [], 0, []
        self.many, rare, roots = len(codes) + 3, {}, []  # steps by letters beyond the table, and those of the roots
        self.bits = np.array([np.log2(max(2, len(v))) for _, v in model.samples])
        for _, v in model.samples:
            go = automaton([1 if c == " " else codes.get(c, 2) for c in v])
            t = np.full((len(go), WIDTH), -1, np.int32)
            for s, step in enumerate(go):
                for c, to in step.items():
                    if c < WIDTH:
                        t[s, c] = to
                    else:
                        rare[(s + base) * self.many + c] = (to + base) * WIDTH
            roots.append([(go[0].get(c, 0) + base) * WIDTH + 1 for c in range(WIDTH, self.many)])
            # a missing step ends the phrase and starts the next from the root (low bit 1)
            first = np.where(t[0] >= 0, t[0], 0)
            t = np.where(t >= 0, (t + base) * WIDTH, (first[None, :] + base) * WIDTH + 1)
            parts.append(t.astype(np.int32))
            self.roots.append(base * WIDTH)
            base += len(go)
        self.rare = np.array(sorted(rare), np.int64)
        self.rare_to = np.array([rare[k] for k in self.rare.tolist()], np.int32)
        self.rare_first = np.array(roots, np.int32).reshape(len(roots), max(0, self.many - WIDTH))
        self.table = np.concatenate(parts).ravel() if parts else np.zeros(0, np.int32)

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbols of all texts in a row, their count by text, letters by text)."""
        raw = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        code = self.kind[np.minimum(raw, sys.maxunicode)]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        owner = np.repeat(np.arange(len(texts)), sizes + 1)[:-1] if len(texts) else np.zeros(0, np.int64)
        letter = code > 0
        keep = letter.copy()
        if len(code) > 1:
            same = owner[1:] == owner[:-1]
            keep[1:] |= letter[:-1] & same  # the first separator after a letter
        n = np.bincount(owner, keep, len(texts)).astype(np.int64)
        letters = np.bincount(owner, letter, len(texts)).astype(np.int64)
        code = np.where(letter, code, 1)[keep]
        return code, n, letters

    def phrases(self, code: np.ndarray, n: np.ndarray) -> np.ndarray:
        """(texts, languages) phrase counts; blocks of all texts walk in step, longest first."""
        starts = np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n
        blocks = -(-n // self.block)
        owner = np.repeat(np.arange(len(n)), blocks)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        at, size = starts[owner] + k * self.block, np.minimum(self.block, n[owner] - k * self.block)
        order = np.argsort(-size, kind="stable")
        at, size, owner = at[order], size[order], owner[order]
        many = len(self.roots)
        state = np.repeat(np.asarray(self.roots, np.int32)[:, None], len(at), 1)
        count = np.ones((many, len(at)), np.int32)
        alive = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")  # blocks longer than step
        for step, m in enumerate(alive):
            c = code[at[:m] + step]
            far = np.flatnonzero(c >= WIDTH) if len(self.rare) else ()
            v = self.table[state[:, :m] + (np.where(c < WIDTH, c, 2) if len(far) else c)]
            if len(far):
                key = (state[:, far] // WIDTH).astype(np.int64) * self.many + c[far]
                k = np.minimum(np.searchsorted(self.rare, key), len(self.rare) - 1)
                v[:, far] = np.where(self.rare[k] == key, self.rare_to[k], self.rare_first[:, c[far] - WIDTH])
            flag = v & 1
            count[:, :m] += flag
            state[:, :m] = v ^ flag
        return np.stack([np.bincount(owner, c, len(n)) for c in count], 1) if many else np.zeros((len(n), 0))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        code, n, letters = self.symbols(texts)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        bits = self.phrases(code, n) * self.bits / np.maximum(n, 1)[:, None]
        best = bits.argmin(1)
        weight = np.exp(bits.min(1)[:, None] - bits)
        score = np.where(letters > 0, 1.0 / weight.sum(1), 0.0)
        return [self.languages[b] if k else "und" for b, k in zip(best, letters)], score


_parsers: dict[Model, Parser] = {}


def _parser(model: Model) -> Parser:
    if model not in _parsers:
        _parsers.clear()
        _parsers[model] = Parser(model)
    return _parsers[model]


def predict(documents: DataFrame, model: Model, batch: int = 2000) -> DataFrame:
    """doc_id, lang_pred and score of every document, from its whole text alone."""
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        parser = _parser(held.value)
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                langs, score = parser.predict([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(langs, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(by))
