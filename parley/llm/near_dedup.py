"""Near-duplicate classes by Order MinHash, verified by banded alignment.

1. Every whole text becomes its lower-cased words.  Texts of the same word sequence are one node.
2. Order MinHash: the shingles of ``SHINGLE`` words get their occurrence number as a label; for each of
   ``SKETCHES`` hash orders the ``KEPT`` least labelled shingles are kept in text order, and their
   sequence is one bucket key.  The sizes are chosen for recall at the word edit similarity that is
   verified: an edit spoils three shingles of three words, so a fifth of the words edited at random
   leaves a shingle similarity of about 0.34.  Texts under ``SHORT`` words have too few of them and are
   sketched by ``SHORT_SHINGLE`` words; those near the limit are sketched both ways, so that any two
   texts whose lengths allow the similarity share a way.
3. Every member of a bucket is aligned with the bucket's least member (never all pairs); two
   texts are near-duplicates if 1 - distance / longer length is at least ``SIMILARITY``, distance being
   the word edit distance of a banded alignment.
4. Connected components of these links are found by star steps.  Members of one bucket that are then
   still in different components meet in tiles of bounded size, where a bag-of-words bound on the
   distance leaves few alignments; no pairs leave a tile but links, no link between bucket mates of
   different components is lost, and components are taken over all links.

Edge cases: null text counts as empty; texts without a word are equal only to the same text; texts
of fewer words than a shingle are one shingle; fewer shingles than ``KEPT`` are all kept; repeated rows and equal
texts share a class; null ids come last when a class's least id is chosen; an empty table gives an
empty result; extra columns are ignored or, in :func:`drop_copies`, kept.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.align import distance_within
from parley.llm.common import joined, tasks, written
from parley.llm.components import components

SHINGLE, SKETCHES, KEPT, SIMILARITY = 3, 40, 2, 0.8
SHORT, SHORT_SHINGLE = 50, 2
TILE_ROWS, TILE_WORDS, BAG = 700, 1_000_000, 1024
_WORD = re.compile(r"\w+")
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SEEDS = np.array([xxhash.xxh64_intdigest(b"order", seed=s) for s in range(64)], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * _P2
    return x ^ (x >> np.uint64(29))


class WordHashes(dict):
    """Word to 64-bit hash, kept for frequent words."""

    def __missing__(self, word):
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def of(self, text: str) -> np.ndarray:
        words = _WORD.findall(text.lower())
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def labelled_shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles in text order, equal ones made distinct by occurrence number."""
    n = max(1, len(words) - size + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(size, len(words))):
        h = (h ^ words[k: k + n]) * _P1 + np.uint64(k + 1)
        h ^= h >> np.uint64(32)
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    if same.any():
        run = np.arange(n)
        start = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), run, 0))
        occurrence = np.empty(n, np.uint64)
        occurrence[order] = (run - start).astype(np.uint64)
        h = h + occurrence * _P2
    return _mix(h)


def _sketches(words: np.ndarray, size: int, count: int, kept: int) -> np.ndarray:
    h = labelled_shingles(words, size)
    out, k = np.empty(count, np.uint64), min(kept, len(h))
    step = count if len(h) < 20_000 else 1
    for at in range(0, count, step):
        seeds = _SEEDS[at: min(at + step, count)]
        v = _mix(h[None, :] * (seeds[:, None] | np.uint64(1)) ^ seeds[:, None])
        least, every = np.empty((len(seeds), k), np.int64), np.arange(len(seeds))
        for i in range(k):
            least[:, i] = v.argmin(1)
            v[every, least[:, i]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        least.sort(1)
        key = seeds + np.uint64(size)
        for i in range(k):
            key = _mix((key ^ h[least[:, i]]) * _P1)
        out[at: at + step] = key
    return out


def sketches(words: np.ndarray, similarity: float = SIMILARITY, count: int = SKETCHES, kept: int = KEPT) -> np.ndarray:
    """One bucket key per hash order, for texts near ``SHORT`` words per order and shingle size."""
    n, keys = len(words), []
    if n and n < SHORT:
        keys.append(_sketches(words, SHORT_SHINGLE, count, kept))
    if n >= similarity * SHORT:
        keys.append(_sketches(words, SHINGLE, count, kept))
    return np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)


SKETCHED = "doc_id long, text_key binary, node_key binary, n_words int, words binary, sketches array<long>"


def sketched(documents: DataFrame, similarity: float = SIMILARITY, batch: int = 1000) -> DataFrame:
    """Word hashes, node key and bucket keys of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.binary()), ("node_key", pa.binary()), ("n_words", pa.int32()), ("words", pa.binary()), ("sketches", pa.list_(pa.int64()))])

    def run(batches):
        hashes = WordHashes()
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                rows = []
                for doc_id, key, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text_key", "text"))):
                    w = hashes.of(text or "")
                    node = hashlib.blake2b(w.tobytes() if len(w) else b"no word" + key, digest_size=16).digest()
                    rows.append((doc_id, key, node, len(w), (w & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), sketches(w, similarity)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return documents.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), "text").mapInArrow(run, SKETCHED)


def text_key():
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def _bag(words: np.ndarray) -> np.ndarray:
    """Word counts by hash remainder: a substitution moves two of them, any other edit one."""
    return np.bincount(words % BAG, minlength=BAG).astype(np.int32)


def _apart(x: np.ndarray, y: np.ndarray, most: int) -> bool:
    """Whether the halves of two texts show that more than ``most`` edits part them.

    With both cut at one place, the bags of the first and of the second parts differ by at most twice the edits
    and once the difference of the lengths: what an alignment shifts across the cut it has to insert or
    delete on either side, but for that difference.  Unlike the whole bag this sees the order.
    """
    half = min(len(x), len(y)) // 2
    bags = np.abs(_bag(x[:half]) - _bag(y[:half])).sum() + np.abs(_bag(x[half:]) - _bag(y[half:])).sum()
    return bool(bags > 2 * most + abs(len(x) - len(y)))


def _similar(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """The (a, b) pairs whose alignment reaches the similarity, with their distance."""
    n = tasks(pairs.sparkSession, 4)
    both = (pairs.join(words.select(F.col("node").alias("a"), F.col("words").alias("wa")), "a")
            .join(words.select(F.col("node").alias("b"), F.col("words").alias("wb")), "b").repartition(n, "a", "b"))
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("distance", pa.int32())])

    def run(batches):
        for batch in batches:
            rows = []
            for a, b, wa, wb in zip(*(batch.column(c) for c in ("a", "b", "wa", "wb"))):
                x, y = (np.frombuffer(w.as_py(), "<u4") for w in (wa, wb))
                most = int(round((1 - similarity) * max(len(x), len(y)), 6))
                if np.abs(_bag(x) - _bag(y)).sum() > 2 * most or _apart(x, y, most):
                    continue
                d = distance_within(x.tolist(), y.tolist(), most)
                if d is not None:
                    rows.append((a.as_py(), b.as_py(), d))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return both.select("a", "b", "wa", "wb").mapInArrow(run, "u long, v long, distance int")


def _tile_links(bucket: int, lo: int, hi: int, node, salt, root, words: list[np.ndarray], keys: list, similarity: float) -> list[tuple[int, int]]:
    """Links that connect different components among the members of one tile.

    A pair belongs to the tile if this bucket is the least of those that both share.  The bag of words bounds
    the edit distance from below (a substitution moves two counts, any other edit one), so only pairs
    that may reach the similarity are aligned, the likeliest first, and none whose components are linked by then.
    """
    n, bags = np.asarray([len(w) for w in words]), np.zeros((len(words), BAG), np.int32)
    for i, w in enumerate(words):
        bags[i] = _bag(w)
    lower = [{k for k in own if k < bucket} for own in keys]  # their buckets before this one
    top, lists, out = np.array(root, np.int64), {}, []

    def listed(i):
        if i not in lists:
            lists[i] = words[i].tolist()
        return lists[i]

    for i in range(1, len(words)):
        longer = np.maximum(n[:i], n[i])
        most = np.floor(np.round((1 - similarity) * longer, 6)).astype(np.int64)
        may = (top[:i] != top[i]) & (np.abs(n[:i] - n[i]) <= most)
        if lo != hi:
            may &= salt[:i] != salt[i]
        j = np.array([k for k in np.flatnonzero(may).tolist() if lower[k].isdisjoint(lower[i])], np.int64)
        if not len(j):
            continue
        apart = np.abs(bags[j] - bags[i]).sum(1)
        near = apart <= 2 * most[j]
        for k in j[near][np.argsort(apart[near], kind="stable")].tolist():
            if top[k] == top[i] or _apart(words[k], words[i], int(most[k])):
                continue
            if distance_within(listed(k), listed(i), int(most[k])) is not None:
                out.append((node[k], node[i]))
                top[top == top[k]] = top[i]
    return out


def _late_links(members: DataFrame, roots: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """Links between members of one bucket that the stars left in different components.

    Members of a bucket's largest component need to meet the others only, so they are dealt into parts of
    bounded size on one side and the others on the other side (negative numbers and those from 0 on); the
    others meet among themselves, too.  Each pair of parts is one tile, so that no task holds more than
    two parts and all members of different components meet.
    """
    parts = lambda rows, n_words: F.ceil(F.greatest(rows / TILE_ROWS, n_words / TILE_WORDS)).cast("int")
    placed = members.join(roots, members["node"] == roots["node"], "left").select("bucket", members["node"], "n_words", F.coalesce("root", members["node"]).alias("root"))
    by_root = placed.groupBy("bucket", "root").agg(F.count("*").alias("rows"), F.sum("n_words").alias("size"))
    apart = (by_root.groupBy("bucket").agg(F.sum("rows").alias("rows"), F.sum("size").alias("size"), F.max(F.struct("rows", "size", "root")).alias("top"))
             .where("rows > top.rows").withColumn("large", F.col("top.rows") > TILE_ROWS // 2))
    own = F.col("large").cast("int")
    apart = apart.select("bucket", F.when(F.col("large"), F.col("top.root")).alias("large_root"), (own * parts(F.col("top.rows"), F.col("top.size"))).alias("large_parts"),
                         F.greatest(F.lit(1), parts(F.col("rows") - own * F.col("top.rows"), F.col("size") - own * F.col("top.size"))).alias("parts"))
    inside = F.col("root").eqNullSafe(F.col("large_root"))
    spread = lambda n: F.pmod(F.xxhash64("node"), F.greatest(n, F.lit(1))).cast("int")
    tile = lambda a, b: F.struct(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: tile(F.col("salt"), o))
    large = F.transform(F.sequence(F.lit(0), F.greatest(F.col("large_parts"), F.lit(1)) - 1), lambda o: tile(F.col("salt"), -1 - o))
    tiles = F.when(inside | (F.col("large_parts") == 0), others).otherwise(F.concat(others, large))
    dealt = (placed.join(apart, "bucket").withColumn("salt", F.when(inside, -1 - spread(F.col("large_parts"))).otherwise(spread(F.col("parts"))))
             .select("bucket", "node", "root", "salt", F.explode(tiles).alias("_t")).select("bucket", "node", "root", "salt", "_t.lo", "_t.hi"))

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", kind="stable")
        own = [np.frombuffer(w, "<u4") for w in pdf["words"]]
        first = pdf.iloc[0]
        found = _tile_links(int(first["bucket"]), int(first["lo"]), int(first["hi"]), pdf["node"].tolist(), pdf["salt"].to_numpy(), pdf["root"].tolist(),
                            own, [k.tolist() for k in pdf["sketches"]], similarity)
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    with_words = dealt.join(words, "node").withColumn("sketches", F.filter("sketches", lambda k: k < F.col("bucket")))
    return with_words.groupBy("bucket", "lo", "hi").applyInPandas(link, "u long, v long")


def classes(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_key, class_id (the class's least doc_id), class_size and ``kept`` of every row.

    ``kept`` marks the row(s) of the least (doc_id, text) of the class.
    """
    rows = written(sketched(documents, similarity), "sketched", "zstd")
    nodes = written(rows.groupBy("node_key").agg(
        F.first("n_words").alias("n_words"), F.first("sketches").alias("sketches"), F.count("*").alias("copies"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("least"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    buckets = nodes.select("node", "n_words", F.explode(F.array_distinct("sketches")).alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min(F.struct("node", "n_words")).alias("least"), F.count("*").alias("members")).where("members > 1").select("bucket", "least")
    members = written(buckets.join(shared, "bucket"), "bucket-members")
    longer, apart = F.greatest("n_words", "least.n_words"), F.abs(F.col("n_words") - F.col("least.n_words"))
    first = written(members.where(F.col("node") != F.col("least.node")).where(apart <= F.floor(F.round((1 - similarity) * longer, 6)))
                    .select(F.col("least.node").alias("a"), F.col("node").alias("b")).distinct(), "star-pairs")
    wanted = (nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "node_key"))
    words = written(rows.select("node_key", "words", "sketches").join(wanted, "node_key").groupBy("node").agg(
        F.first("words").alias("words"), F.first("sketches").alias("sketches")), "words", "zstd")
    links = written(_similar(first, words, similarity).select("u", "v"), "star-links")
    roots = components(links)
    late = written(_late_links(members, roots, words, similarity), "late-links")
    roots = components(links.unionByName(late))
    named = (nodes.join(roots, "node", "left").select("node_key", "copies", "least", F.coalesce("root", "node").alias("root")))
    named = written(named, "named")
    least = named.groupBy("root").agg(F.min("least").alias("first"), F.sum("copies").alias("class_size"))
    by_key = joined(named, written(least, "classes"), "root").select("node_key", F.col("first.doc_id").alias("class_id"), F.col("first.text_key").alias("_key"), "class_size")
    return rows.select("doc_id", "text_key", "node_key").join(by_key, "node_key").select(
        "doc_id", "text_key", "class_id", "class_size", (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_key") == F.col("_key"))).alias("kept"))


def drop_copies(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, columns unchanged: that of the least doc_id (then of any equal row)."""
    kept = classes(documents, similarity).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    rows = documents.withColumn("_text_key", text_key())
    joined = rows.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")), "left_semi")
    return joined.dropDuplicates(["doc_id", "_text_key"]).drop("_text_key")
