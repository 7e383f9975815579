"""Near-duplicate classes against all pairs by word edit similarity, on families that share passages and words."""

import random
import re

import numpy as np
import pytest

from parley.llm import near_dedup
from parley.llm.align import distances_by_end
from tests.llm.test_edges import VOCAB, edited, prose


def corpus(seed):
    r, texts = random.Random(seed), []
    passage, line = prose(40, 1), "is it so. "
    for f in range(12):
        base = prose(r.choice([12, 60, 120]), 100 * seed + f).split()
        for k in range(6):
            w = edited(base, int(len(base) * r.choice([0.02, 0.1, 0.15, 0.22])), 1000 * f + k) if k else base
            texts.append(" ".join(w))
    texts += [prose(60, 7000 + i) + " " + passage for i in range(15)]  # a common passage
    texts += [prose(r.choice([20, 60]), 8000 + i) + " " + line * 40 for i in range(15)]  # a repeated line
    words = prose(60, 5).split()
    for i in range(15):  # the same words in other orders
        r.shuffle(words)
        texts.append(" ".join(words))
    return texts


def classes_of_links(n, links):
    top = list(range(n))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i
    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("rows", [400, 9])
def test_classes_equal_all_pairs(spark, monkeypatch, rows):
    monkeypatch.setattr(near_dedup, "TILE_ROWS", rows)  # 9: buckets are dealt into tiles
    texts = corpus(3)
    words = [re.findall(r"\w+", t.lower()) for t in texts]
    links = []
    for i, a in enumerate(words):
        for j in range(i):
            if abs(len(a) - len(words[j])) <= 0.2 * max(len(a), len(words[j])) and distances_by_end(a, words[j])[-1] <= round(0.2 * max(len(a), len(words[j])), 6):
                links.append((j, i))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs).collect()}
    met = sum(got[a] == got[b] for a, b in links)
    assert met >= 0.99 * len(links)
    # nothing else is joined: links inside the found classes alone give these classes again
    assert classes_of_links(len(texts), [(a, b) for a, b in links if got[a] == got[b]]) == [got[i] for i in range(len(texts))]


def test_halves_never_part_what_is_similar():
    r = random.Random(1)
    for _ in range(5000):
        a = [r.randint(0, 5) for _ in range(r.randint(1, 40))]
        b = list(a)
        for _ in range(r.randint(0, 10)):
            i = r.randrange(len(b) + 1)
            b[i: i + r.choice([0, 1])] = [r.randint(0, 5)] * r.choice([0, 1])
        if r.random() < 0.2:
            b = [r.randint(0, 5) for _ in range(r.randint(0, 40))]
        assert not near_dedup._apart(np.array(a, np.int64), np.array(b, np.int64), distances_by_end(a, b)[-1])


def test_each_pair_is_aligned_in_one_bucket(monkeypatch):
    seen = []
    monkeypatch.setattr(near_dedup, "_apart", lambda x, y, most: seen.append((x.tobytes(), y.tobytes())) or True)
    r, w = random.Random(2), [r.encode() for r in VOCAB[:60]]
    texts = []
    for _ in range(8):
        r.shuffle(w)
        texts.append(np.frombuffer(b"".join(x[:4].ljust(4) for x in w), "<u4"))
    keys = [sorted(r.sample(range(12), 8)) for _ in texts]
    for bucket in range(12):
        at = [i for i, k in enumerate(keys) if bucket in k]
        near_dedup._tile_links(bucket, 0, 0, at, np.zeros(len(at)), at, [texts[i] for i in at], [keys[i] for i in at], 0.8)
    assert len(seen) == len(set(seen)) == sum(bool(set(a) & set(b)) for i, a in enumerate(keys) for b in keys[:i])
