"""Best-fit packing of tokenised documents into sequences of a fixed number of tokens.

1. ``pieces``: every whole text is tokenised; the ids and an end id make one piece, or, beyond the
   capacity, pieces of exactly the capacity behind a first one that may be shorter.  Words between
   single spaces are tokenised once per worker and their ids kept (pre-tokenisation never joins
   across such a space).  Only (key, length, checksum) rows leave the tasks.
2. ``pack``: hierarchical residual packing.  Pieces are spread over groups of bounded size; each
   group is packed best-fit decreasing.  Bins that are nearly full are done.  The others become items
   of the next round, in fewer groups, until one group holds all residue or a round no longer
   saves a bin.  No task holds more than about ``group_rows`` items.

Edge cases: null text counts as empty (a single end id); repeated rows are packed each; a null
doc_id is kept; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import written

KEPT_WORDS = 400_000  # words whose ids a worker keeps, twice: the newest and those before
_TWO_SPACES, _PLAIN = re.compile(r"\s\s"), re.compile(r"( ?([^\W\d_]+))([^\w\s]*)")
#: Byte-level vocabularies write printable bytes as themselves and the others, in order, from code point 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_WRITTEN = np.asarray([ord(_BYTES.get(b, chr(b))) for b in range(256)], "<u4")  # byte -> code point

_loaded: dict[str, "WordIds"] = {}


def _parts(text: str) -> list[str]:
    """The text cut before single spaces (and around single line breaks) between other characters;
    the parts join to the text."""
    if not _TWO_SPACES.search(text):  # then a line break, too, is a token of its own
        out = []
        for i, line in enumerate(text.split("\n")):
            words = line.split(" ")
            out += ["\n"] * (i > 0) + [words[0]]
            out.extend(map(" ".__add__, words[1:]))
        return out
    words = text.split(" ")
    out, held = [], words[0]
    for a, b in zip(words, words[1:]):
        if a and b and not a[-1].isspace() and not b[0].isspace():
            out.append(held)
            held = " " + b
        else:
            held += " " + b
    out.append(held)
    return out


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit bytes, by way of kept word ids.

    For byte-level BPE tokenizers without a normaliser.  A word of letters (with a space before) and the
    punctuation behind it are one token each of the pre-tokenizer, so they go to the BPE model at
    once; all else goes through the pre-tokenizer first.

    ``added``: texts that hold the string of an added token (such as an end-of-text mark) get the ids of
    the tokenizer's plain call, which takes the string as that token; else it is ordinary text.
    """

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer, self.kept, self.old = Tokenizer.from_file(path), {}, {}
        own = [x.content for x in self.tokenizer.get_added_tokens_decoder().values() if x.content] if added else []
        self.added = re.compile("|".join(map(re.escape, own))) if own else None
        self.tokenizer.encode_special_tokens = not added
        if self.tokenizer.normalizer is not None or type(self.tokenizer.pre_tokenizer).__name__ != "ByteLevel":
            raise ValueError("a byte-level tokenizer without a normaliser is needed")
        self.tokenize = self.tokenizer.model.tokenize

    @classmethod
    def of(cls, path: str) -> "WordIds":
        """One per worker and file."""
        if path not in _loaded:
            _loaded[path] = cls(path, added=True)
        return _loaded[path]

    def _model(self, token: str) -> bytes:
        return array("I", [x.id for x in self.tokenize(token)]).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Keeps the ids of new words; letters and punctuation are written as byte-level tokens all at once."""
        kept, old, model, new, split = self.kept, self.old, self._model, set(), ([], [], [])
        for w in words:
            plain = _PLAIN.fullmatch(w)
            if plain and plain[2].isalpha():
                head, tail = plain[1], plain[3]
                new.add(head)
                if tail:
                    new.add(tail)
                    for at, x in zip(split, (w, head, tail)):
                        at.append(x)
            else:
                kept[w] = b"".join([model(t) for t, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(w)])
        letters = []
        for w in new.difference(kept):
            if w in old:
                kept[w] = old[w]
            else:
                letters.append(w)
        if letters:  # they hold no line break
            points = _WRITTEN[np.frombuffer("\n".join(letters).encode("utf-8"), np.uint8)]
            for w, token in zip(letters, points.tobytes().decode("utf-32-le").split(_BYTES[10])):
                kept[w] = model(token)
        for w, head, tail in zip(*split):
            kept[w] = kept[head] + kept[tail]

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.kept) > KEPT_WORDS:
            self.kept, self.old = {}, self.kept
        whole = {i for i, t in enumerate(texts) if self.added.search(t)} if self.added else set()
        parts = [[] if i in whole else _parts(t) for i, t in enumerate(texts)]
        kept, old = self.kept, self.old
        new = []
        for w in set().union(*parts).difference(kept):
            if w and w not in old:
                new.append(w)
            else:
                kept[w] = old[w] if w else b""
        self._learn(new)
        get = kept.__getitem__
        return [self._whole(t) if i in whole else b"".join(map(get, p)) for i, (t, p) in enumerate(zip(texts, parts))]

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all but the first have exactly the capacity."""
    first = n % capacity or min(n, capacity)
    yield 0, first
    for start in range(first, n, capacity):
        yield start, capacity


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(documents: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, batch: int = 500) -> DataFrame:
    """One row per piece of each document."""
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches):
        encode = WordIds.of(tokenizer_path)
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                rows = [(i, k, start, n, zlib.crc32(ids[4 * start: 4 * (start + n)]))
                        for i, x in zip(part.column("doc_id").to_pylist(), encode([t or "" for t in part.column("text").to_pylist()]))
                        for ids in (x + end,) for k, (start, n) in enumerate(cut(len(ids) // 4, capacity))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: (bin, offset) of each item and the fill of each bin."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    fill: list[int] = []
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by room left
    rooms: list[int] = []  # the rooms that have a bin, sorted
    for i in order.tolist():
        n = int(lengths[i])
        k = bisect_left(rooms, n)
        if k == len(rooms):
            b, room = len(fill), capacity
            fill.append(0)
        else:
            room = rooms[k]
            b = open_at[room].pop()
            if not open_at[room]:
                del rooms[k]
        bins[i], offsets[i] = b, fill[b]
        fill[b] += n
        room -= n
        if room:
            if not open_at[room]:
                insort(rooms, room)
            open_at[room].append(b)
    return bins, offsets, np.asarray(fill, np.int64)


def _groups(rows: int, group_rows: int) -> int:
    return max(1, -(-rows // group_rows))


def pack(items: DataFrame, scratch: str = "packing", capacity: int = 1024, group_rows: int = 100_000, full: int | None = None) -> DataFrame:
    """``items`` (with long ``length`` of 1..capacity) plus ``sequence_id`` and ``offset``.

    ``full``: a bin of at least so many tokens is done (default: all but 1/64 of the capacity).
    """
    spark = items.sparkSession
    full = capacity - capacity // 64 if full is None else full
    uid = items.withColumn("_uid", F.monotonically_increasing_id())
    uid = written(uid, f"{scratch}-items")
    total = uid.count()
    n = _groups(total, group_rows)

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_uid", kind="stable")
        bins, offsets, fill = best_fit(pdf["length"].to_numpy(), capacity)
        first = pdf["_group"].iloc[0] << 40
        return pd.DataFrame({"_uid": pdf["_uid"].to_numpy(), "_bin": bins + first, "offset": offsets, "_fill": fill[bins]})

    placed = (uid.select("_uid", "length", F.pmod(F.xxhash64("_uid"), F.lit(n)).alias("_group"))
              .groupBy("_group").applyInPandas(local, "_uid long, _bin long, offset long, _fill long"))
    placed = written(placed, f"{scratch}-round0")
    residue = (placed.where(F.col("_fill") < full).where("offset = 0")
               .select(F.col("_bin").alias("_item"), F.col("_fill"), F.array(F.struct(F.col("_bin").alias("bin"), F.lit(0).cast("long").alias("base"))).alias("_members")))
    residue = written(residue, f"{scratch}-residue0")
    moves, members, level = [], "array<struct<bin:bigint,base:bigint>>", 0
    left, groups = residue.count(), n

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_item", kind="stable").reset_index(drop=True)
        bins, offsets, fill = best_fit(pdf["_fill"].to_numpy(), capacity)
        joined: list[list] = [[] for _ in fill]
        for b, o, ms in zip(bins, offsets, pdf["_members"]):
            joined[b].extend({"bin": m["bin"], "base": m["base"] + o} for m in ms)
        return pd.DataFrame({"_item": [min(m["bin"] for m in ms) for ms in joined], "_fill": fill, "_members": joined})

    while left > 1 and groups > 1:
        level += 1
        groups = _groups(left, group_rows)
        merged = (residue.withColumn("_group", F.pmod(F.xxhash64("_item", F.lit(level)), F.lit(groups)))
                  .groupBy("_group").applyInPandas(merge, f"_item long, _fill long, _members {members}"))
        merged = written(merged, f"{scratch}-residue{level}")
        now = merged.count()
        if groups == 1 or now >= left:
            residue, left = merged, 0
        else:
            moves.append(merged.where(F.col("_fill") >= full))
            residue = merged.where(F.col("_fill") < full)
            left = residue.count()
    moves.append(residue)
    found = None
    for m in moves:
        part = m.where(F.size("_members") > 1).select(F.col("_item").alias("_to"), F.explode("_members").alias("m")).select("_to", F.col("m.bin").alias("_bin"), F.col("m.base").alias("_base"))
        found = part if found is None else found.unionByName(part)
    if found is not None:
        placed = placed.join(found, "_bin", "left").select("_uid", F.coalesce("_to", "_bin").alias("_bin"), (F.col("offset") + F.coalesce("_base", F.lit(0))).alias("offset"))
    placed = placed.select("_uid", F.col("_bin").alias("sequence_id"), "offset")
    return uid.join(placed, "_uid").drop("_uid")


def pack_documents(documents: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """The pieces of all documents with their place: sequence_id and offset."""
    return pack(pieces(documents, tokenizer_path, capacity, end_id), capacity=capacity)
