"""Surrogates in their written form: an independent plain-Python bijection, distinctness, coreference."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from parley.llm import pii

CLASSES = ["0123456789", "αβγδεζηθικλμνξοπρστυφχψω".upper(), "αβγδεζηθικλμνξοπρστυφχψω", "абвгдеёжзийклмнопрстуфхцчшщъыьэюя".upper(), "абвгдеёжзийклмнопрстуфхцчшщъыьэюя",
           "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]


def replaced(spark, texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return [r["text"] for r in pii.replace(df, key).orderBy("doc_id").collect()]


def plain_permuted(text, seed, hexed=False):
    half = len(text) // 2
    a, b = text[:half], text[half:]
    for r in range(1, pii.ROUNDS + 1):
        moving, other = (a, b) if r % 2 == 0 else (b, a)
        digest, out = hashlib.sha512(f"{seed}|{r}|{other}".encode()).digest(), ""
        for i, c in enumerate(moving, 1):
            letters = next((x[:6] if hexed and x[0] in "aA" else x for x in CLASSES if c in (x[:6] if hexed and x[0] in "aA" else x)), None)
            out += c if letters is None else letters[(letters.index(c) + digest[i % 64]) % len(letters)]
        a, b = (out, b) if r % 2 == 0 else (a, out)
    return a + b


def test_permutation_equals_plain_python_and_is_one_to_one(spark):
    texts = ["", "7", "42", "0123456789", "AKIAab09Zz", "пароль-Ω12", "+49/x", "a" * 200] + [f"{i:03d}" for i in range(1000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for hexed in (False, True):
        got = {r["t"]: r["p"] for r in df.select("t", pii.permuted(F.col("t"), F.lit("s|x"), F.lit(hexed)).alias("p")).collect()}
        if not hexed:
            assert got == {t: plain_permuted(t, "s|x") for t in texts}
        assert len(set(got.values())) == len(texts) and {got[f"{i:03d}"] for i in range(1000)} == {f"{i:03d}" for i in range(1000)}


def test_phones_are_distinct_and_never_real(spark):
    real = [f"+1 {i:04d}" for i in range(2000)]
    out = [re.fullmatch(r"number (\+1 \d{4}) here", t)[1] for t in replaced(spark, [f"number {x} here" for x in real])]
    assert len(set(out)) == 2000 and not set(out) & set(real)


def test_one_number_has_one_surrogate_in_every_spelling(spark):
    texts = ["+15551234567 or +1 5551234567 or +1 (555) 123-4567", "+493012345678, +49 30 1234 5678", "4539578763621486 4539 5787 6362 1486", "DE89370400440532013000 DE89 3704 0044 0532 0130 00"]
    for text, found, head in zip(texts, replaced(spark, texts), ("1", "49", "4", "DE")):
        spellings = [re.sub("[^0-9A-Z]", "", x) for x in re.split(r" or |, |(?<=\d{16}) (?=4539|\d{4} )|(?<=\d{20}) ", found)]
        assert len(set(spellings)) == 1 and spellings[0].startswith(head) and spellings[0] != re.sub("[^0-9A-Z]", "", re.split(r" or |, ", text)[0])
        assert re.sub("[0-9]", "9", found) == re.sub("[0-9]", "9", text)  # the written form stays


def test_names_beyond_titles_and_hyphens(spark):
    out = replaced(spark, ["Mr Smith-Jones came", "Dear John Smith, hello", "Regards,\nMary-Ann Lee", "Dear Mrs Smith", "Dear customer, Hello World"])
    assert re.fullmatch(r"Mr [A-Z][a-z]+-[A-Z][a-z]+ came", out[0]) and "Smith" not in "".join(out)
    assert re.fullmatch(r"Dear [A-Z][a-z]+ [A-Z][a-z]+, hello", out[1]) and re.fullmatch(r"Regards,\n[A-Z][a-z]+-[A-Z][a-z]+ [A-Z][a-z]+", out[2])
    assert re.fullmatch(r"Dear Mrs [A-Z][a-z]+ina", out[3]) and out[4] == "Dear customer, Hello World"


@pytest.mark.parametrize("held", [pii.MOST_HELD, 0])
def test_later_attempts_reach_every_text(spark, monkeypatch, held):
    monkeypatch.setattr(pii, "MOST_HELD", held)  # 0: texts are joined with their later surrogates
    real = [f"+1 {i:03d}0" for i in range(300)]
    texts = [f"a {x} b" for x in real] + ["nothing", None, ""] + [f"{real[5]}, {real[5]} and {real[6]}"] * 20 + [" ; ".join(real)] * 2
    out = replaced(spark, texts)
    one = {x: re.fullmatch(r"a (\+1 \d{4}) b", t)[1] for x, t in zip(real, out)}
    assert len(set(one.values())) == 300 and not set(one.values()) & set(real)
    assert out[300:303] == ["nothing", None, ""] and set(out[303:323]) == {f"{one[real[5]]}, {one[real[5]]} and {one[real[6]]}"}
    assert set(out[323:]) == {" ; ".join(one[x] for x in real)}


def test_crowded_formats_stay_distinct(spark):
    found = spark.createDataFrame([("phone", f"+1{i:04d}") for i in range(4000)] + [("phone", "+494444"), ("ssn", "123456789")], "kind string, norm string")
    got = pii.surrogates(found, "k").collect()
    assert len({r["surrogate"] for r in got}) == 4002 and {r["attempt"] for r in got if r["norm"].startswith("+1")} == {0}
