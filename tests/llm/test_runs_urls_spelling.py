"""Operators 11 to 13 against brute force, and their edge cases."""

import collections
import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.llm import common, periodic, spelling, url_reputation
from parley.llm.queries import QUERIES, URL_RULES

DOCS = "doc_id long, text string, lang string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# 11
def brute_runs(w):
    out, seen = [], set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q) and i > s and (s, i) not in seen and not any(a == s and a + n == i + q for a, n, _ in out):
                out.append((s, i + q - s, q))
            i += 1 if i == s else 0
    return sorted(out, key=lambda r: (r[0], r[2]))


def repeated(n, kinds, seed):
    r = random.Random(seed)
    w = [f"w{r.randint(1, kinds)}" for _ in range(n)]
    if n and r.random() < 0.7:
        a = r.randrange(n)
        p = 1 + (n - a) // r.randint(3, 10)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


@pytest.mark.parametrize("v", sorted(periodic.COVERS))
def test_runs_equal_brute_force(v, monkeypatch):
    r = random.Random(v)
    for trial in range(60):
        monkeypatch.setattr(periodic, "GRID_POINTS", r.choice([7, 100, 10**6]))
        batch = [repeated(r.choice([0, 1, 5, 6, 7, 20, 60, 200]), r.choice([1, 2, 3, 50]), 100 * trial + k) for k in range(r.randint(1, 6))]
        sizes = np.array([len(w) for w in batch])
        starts, numbers = np.cumsum(sizes + 1) - sizes - 1, periodic._Numbers()
        words = np.zeros((sizes + 1).sum(), np.int64)
        for s, w in zip(starts, batch):
            words[s: s + len(w)] = [numbers[x] for x in w]
        rows = periodic.runs_of(words, starts, sizes, v)
        for s, w in zip(starts, batch):
            assert [(a - s, e - a, q) for a, e, q in rows.tolist() if s <= a < s + len(w)] == brute_runs(w)


def test_covers_meet_every_distance():
    for v, cover in periodic.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))


def test_extensions_equal_direct_comparison():
    r = random.Random(2)
    for v in periodic.COVERS:
        w = np.array([r.randint(1, 2) for _ in range(40)] * 6 + [0], np.int64)
        ext = periodic.Extensions(w, np.zeros(len(w), np.int64), v)
        i, j = (np.array(x) for x in zip(*sorted(random.Random(v).sample([(a, b) for b in range(240) for a in range(b)], 2000))))
        want = [next(k for k in range(len(w)) if w[a + k] != w[b + k]) for a, b in zip(i.tolist(), j.tolist())]
        assert ext.of(i, j).tolist() == want


def expected_digest(doc_id, text):
    w = WORDS.findall(text or "")
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_periodic_query_equals_brute_force(spark, tmp_path):
    rows = [(i, " ".join(repeated(random.Random(i).choice([0, 3, 30, 150]), random.Random(i).choice([2, 40]), i)), "en") for i in range(120)]
    rows += [(5, rows[5][1], "en"), (None, "a " * 9, None), (200, None, "en"), (201, "", "en"), (202, " \t\x0b", "en"), (203, ("x y z\n" * 3000) + "é\u00a0é " * 7, "en"),
             (204, "a a a a a a", None), (205, "a b a b a b a b c c c c c c", "x")]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()
    want = collections.Counter((i, *expected_digest(i, t)) for i, t, _ in rows)
    assert collections.Counter(tuple(r) for r in got) == want


def test_collapse_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, "a b a b a b a b end", "en"), (1, "a b a b a b a b end", "en"), (2, " kept  as it\nis ", None), (None, None, "x")], DOCS)
    docs = docs.withColumns({"runs": F.lit("r"), "collapsed": F.lit(1), "n_words": F.lit(2)})
    out = periodic.collapse(docs)
    assert out.columns == docs.columns
    assert collections.Counter((r["doc_id"], r["text"], r["runs"]) for r in out.collect()) == {(1, "a b end", "r"): 2, (2, " kept  as it\nis ", "r"): 1, (None, None, "r"): 1}
    assert periodic.collapse(docs.where("false")).count() == 0


# 12
def test_hosts_domains_and_suffixes(spark):
    rows = [("HTTP://A.B.Example.CO.uk:80/x?y", "a.b.example.co.uk:80", "/x", "example.co.uk", "co.uk"), ("https://u@www.x.org#z", "u@www.x.org", "", "x.org", "org"),
            ("ftp://10.0.0.1/a/b", "10.0.0.1", "/a/b", "10.0.0.1", "10.0.0.1"), ("http://local/", "local", "/", "local", "local"), ("no url", "", "", "", ""), (None, "", "", "", ""),
            ("x://?q", "", "", "", ""), ("a://ÄB.de/p://q", "Äb.de", "/p://q", "Äb.de", "de"), ("http://co.uk/", "co.uk", "/", "co.uk", "uk")]
    df = spark.createDataFrame(rows, "url string, h string, p string, d string, s string")
    host = url_reputation.host_of(F.col("url"))
    for r in df.select("*", host.alias("host"), url_reputation.path_of(F.col("url")).alias("path"), url_reputation.domain_of(host).alias("domain")).withColumn("suffix", url_reputation.suffix_of(F.col("domain"))).collect():
        assert (r["host"], r["path"], r["domain"], r["suffix"]) == (r["h"], r["p"], r["d"], r["s"])


def plain_strength(rows):
    rows = [r for r in rows if r[0]]
    beyond, room = sum((k - n * m) ** 2 - n * m * (1 - m) for n, k, m in rows), sum(n * (n - 1) * m * (1 - m) for n, _, m in rows)
    return 10.0 if room <= 0 else 1000.0 if beyond <= 0 else min(1000.0, max(2.0, room / beyond - 1))


def test_reputation_equals_plain_python(spark):
    r = random.Random(4)
    hosts = [f"h{i}.d{i % 7}.{'com' if i % 3 else 'org'}" for i in range(60)]
    rate = {h: (0.95 if i % 10 == 3 else 0.1) for i, h in enumerate(hosts)}
    out = [(h, int(r.random() < rate[h]), r.randint(1, 3)) for h in hosts[:50] for _ in range(r.randint(0, 30))] + [("", 1, 9), (hosts[0], None, 5)]
    got = {x["host"]: x for x in url_reputation.reputation(spark.createDataFrame([(h,) for h in hosts + hosts[:9] + [""]], "host string"), spark.createDataFrame(out, "host string, bad int, times long")).collect()}
    count = {h: [0, 0] for h in hosts}
    for h, b, t in out:
        if h and b is not None:
            count[h][0] += t
            count[h][1] += b * t
    def grouped(key):
        g = collections.defaultdict(lambda: [0, 0])
        for h, (n, k) in count.items():
            g[key(h)][0] += n
            g[key(h)][1] += k
        return g
    dom, suf = (lambda h: h.split(".", 1)[1]), (lambda h: h.rsplit(".", 1)[1])
    n, k = (sum(c[i] for c in count.values()) for i in (0, 1))
    mean, level = (k + 1) / (n + 2), grouped(suf)
    m = plain_strength([(*c, mean) for c in level.values()])
    up = {s: (k + m * mean) / (n + m) for s, (n, k) in level.items()}
    level = grouped(dom)
    m = plain_strength([(*c, up[suf(d)]) for d, c in level.items()])
    upd = {d: (k + m * up[suf(d)]) / (n + m) for d, (n, k) in level.items()}
    m = plain_strength([(*c, upd[dom(h)]) for h, c in count.items()])
    assert set(got) == set(hosts)
    for h, (n, k) in count.items():
        a, b = k + m * upd[dom(h)], n - k + m * (1 - upd[dom(h)])
        bound = 1 / (1 + math.exp(-(math.log(a / b) - 1.645 * math.sqrt(1 / a + 1 / b))))
        assert (got[h]["n"], got[h]["bad"]) == (n, k) and abs(got[h]["bound"] - bound) < 1e-9 and abs(got[h]["mean"] - a / (a + b)) < 1e-9
    blocked = {h for h in hosts if got[h]["bound"] >= 0.5}
    assert blocked and all(rate[h] > 0.5 for h in blocked)


def test_bound_is_near_the_beta_quantile():
    for a, b in ((2, 2), (5, 3), (20, 4), (3, 30), (200, 150)):
        x = np.linspace(1e-6, 1 - 1e-6, 200_001)
        logs = (a - 1) * np.log(x) + (b - 1) * np.log(1 - x)
        mass = np.cumsum(np.exp(logs - logs.max()))
        exact = x[np.searchsorted(mass, 0.05 * mass[-1])]
        assert abs(1 / (1 + math.exp(-(math.log(a / b) - 1.645 * math.sqrt(1 / a + 1 / b)))) - exact) < 0.03


def test_joined_keeps_every_row(spark):
    left = spark.createDataFrame([("hot", i) for i in range(60)] + [(f"k{i % 20}", i) for i in range(40)] + [(None, i) for i in range(5)], "key string, i long").repartition(4)
    right = spark.createDataFrame([("hot", 1.0), ("other", 3.0)] + [(f"k{i}", float(i)) for i in range(15)], "key string, v double")
    for heavy in (1, 3, 1000):
        got = collections.Counter((r["key"], r["i"], r["v"]) for r in common.joined(left, right, "key", heavy=heavy).collect())
        known = {r["key"]: r["v"] for r in right.collect()}
        assert got == collections.Counter((r["key"], r["i"], known.get(r["key"])) for r in left.collect())


def test_rules_and_verdicts(spark):
    urls = ["http://a.example.net/en/1", "http://a.example.net/de/1", "http://net/", "http://net", "http://example.com/de/", "http://x.example.com/de", "http://z.org/fr/x?q",
            "http://notexample.net/en/", "http://bad.test/1", "http://good.test/1", None, "", "mailto:x", "http://EXAMPLE.COM/de/"]
    want = [("example.net/en/", "allow"), ("net/", "block"), ("net/", "block"), (None, "allow"), ("example.com/de/", "block"), (None, "allow"), ("org/fr/", "allow"),
            ("net/", "block"), (None, "block"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"), ("example.com/de/", "block")]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)] + [(0, urls[0], "mine"), (None, urls[8], "mine")], "page_id long, url string, verdict string")
    outcomes = spark.createDataFrame([("bad.test", 1, 40), ("good.test", 0, 40), ("good.test", 1, 2)], "host string, bad int, times long")
    out = url_reputation.judge(pages.withColumn("n", F.lit("x")), outcomes, URL_RULES).collect()
    assert len(out) == len(urls) + 2 and all(r["n"] == "x" for r in out)
    assert {(r["page_id"], r["rule"], r["verdict"]) for r in out} == {(i, *w) for i, w in enumerate(want)} | {(None, *want[8])}
    nothing = url_reputation.judge(pages, outcomes.where("false"), URL_RULES).collect()
    assert {r["verdict"] for r in nothing if r["rule"] is None} == {"allow"}
    assert url_reputation.judge(pages.where("false"), outcomes, URL_RULES).count() == 0


def test_page_outcomes_meet_documents(spark):
    pages = spark.createDataFrame([(1, "http://h.x/1", "<article><h1>T</h1><p>One &amp; two<br>three</article>"), (2, "http://h.x/2", "<article><p>other</article>"), (3, "http://h.x/3", None), (4, None, "<article>One two three"),
                                   (5, "http://g.x/", "<article><h1>One</h1>One two <b>three</b></article>")], "page_id long, url string, html string")
    docs = spark.createDataFrame([(7, "One & two\nthree", "en"), (7, "One & two\nthree", "en"), (8, "other", "en"), (9, None, "en")], DOCS)
    labels = spark.createDataFrame([(7, 1, 1), (8, 1, 0), (9, 0, 0), (None, 0, 0), (10, None, None)], "doc_id long, quality int, toxic int")
    assert {tuple(r) for r in url_reputation.page_outcomes(pages, docs, labels).collect()} == {("h.x", 1, 1), ("h.x", 0, 1), ("g.x", 1, 1)}


# 13
def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_spelling(counts):
    table, form = {}, {}
    for w, n in counts.items():
        mates = [x for x in counts if near(w, x)]
        best = min(mates, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * n else None
        table[w] = (n, len(mates), form[w] and counts[form[w]])
    def root(w):
        return w if form[w] is None else root(form[w])
    return {(w, form[w], root(w), *t) for w, t in table.items()}


def vocabulary(seed, letters, size, long):
    r = random.Random(seed)
    words = {"".join(r.choice(letters) for _ in range(r.randint(6, long))) for _ in range(size)}
    for w in sorted(words)[: size // 2]:
        i = r.randrange(len(w))
        words.add(r.choice([w[:i] + w[i + 1:], w[:i] + r.choice(letters) + w[i:], w[:i] + r.choice(letters) + w[i + 1:]]))
    return {w: int(5 * 6 ** r.uniform(0, 4)) for w in sorted(words) if len(w) >= 6}


@pytest.mark.parametrize("letters,size,long,most", [("abé", 250, 9, 10), ("abcdefgh", 300, 12, 3), ("ab", 200, 8, 1000), ("xyz", 150, 40, 4)])
def test_variants_equal_brute_force(spark, letters, size, long, most):
    counts = vocabulary(size, letters, size, long)
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3), most=most).collect()
    assert len(got) == len(counts)
    assert {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == brute_spelling(counts)


def test_scan_equals_pairs():
    r = random.Random(1)
    for t in range(300):
        words = sorted({"".join(r.choice("ab" if t % 2 else "abcde") for _ in range(r.randint(0, 8))) for _ in range(r.randint(2, 60))})
        lcp = [0] + [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(words, words[1:])]
        jump = [next((k for k in range(i + 1, len(words)) if lcp[k] < lcp[i]), len(words)) for i in range(len(words))]
        for q in range(len(words)):
            assert spelling.near_in(words, lcp, jump, q) == [i for i in range(q + 1, len(words)) if near(words[q], words[i])]


def test_spelling_query_equals_brute_force(spark, tmp_path):
    words = list(vocabulary(9, "abcdÀé", 120, 9))
    r = random.Random(6)
    rows = [(i, " ".join(r.choices(words, [1 / (k + 1) for k in range(len(words))], k=r.choice([0, 5, 400]))).upper() if i % 5 == 0 else
             "; ".join(r.choices(words, k=200)), "en") for i in range(60)]
    rows += [(3, rows[3][1], "en"), (None, rows[4][1], None), (300, None, "en"), (301, "", None), (302, "shorte " * 9 + "x" * 5000 + " Ünterès×÷ÿ ünterès×÷ÿ" * 5, "de")]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    counts = collections.Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = None if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
            if h is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    want = brute_spelling({w: n for w, n in counts.items() if len(w) >= 6 and n >= 5})
    got = QUERIES["op13_spelling"](spark, str(tmp_path)).collect()
    assert {tuple(x) for x in got} == want and len(got) == len(want)


def test_spelling_edges(spark):
    docs = spark.createDataFrame([(1, "abcdef " * 6, "en"), (2, "abcdeg " * 40, "en")], DOCS)
    odd = docs.withColumns({"word": F.lit("w"), "n": F.lit("x"), "length": F.lit(1), "front": F.lit(0)})
    assert {tuple(r) for r in spelling.word_counts(docs.union(docs), held=1).collect()} == {("abcdef", 12), ("abcdeg", 80)}
    want = {("abcdef", "abcdeg", "abcdeg", 6, 1, 40), ("abcdeg", None, "abcdeg", 40, 1, None)}
    assert {tuple(r) for r in spelling.spelling_groups(odd).collect()} == want
    assert spelling.spelling_groups(docs.where("false")).count() == 0
