"""The registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import chat, decontaminate, langid, near_dedup, packing, periodic, pii, quality_gam, quality_rules, sharding, spelling, url_reputation, warc
from parley.llm.common import table, written
from parley.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.write_and_read(spark, table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = langid.remainder(F.col("doc_id"), 4) == 2
    model = langid.train(docs.where(~F.coalesce(held, F.lit(False))).select("doc_id", "text", "lang"))
    return langid.predict(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs.select("doc_id", "text"), rules).select("doc_id", "_q.*")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = langid.remainder(F.col("doc_id"), 3) == 1
    model = quality_gam.train(docs, table(spark, sf_dir, "labels"), keep=~held)
    return quality_gam.classify(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.format_messages(chat.reconstruct(chat.as_events(turns))))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.with_surrogates(docs).select("doc_id", F.col("_p_new").alias("text"), F.col("_p_n").alias("n_replaced"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", periodic.planted(F.col("doc_id"), F.col("text")).alias("text"))
    return periodic.digests(periodic.with_runs(docs))


URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    outcomes = written(url_reputation.page_outcomes(pages, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), "page-outcomes")
    return url_reputation.judge(pages.select("page_id", "url"), outcomes, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.spelling_groups(table(spark, sf_dir, "documents"), spelling.PLANT)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {f.__name__: f for f in (op1_warc, op2_language, op3_quality_rules, op4_sharding, op5_decontamination, op6_quality_classifier,
                                   op7_packing, op8_near_dedup, op9_chat, op10_pii, op11_periodic_runs, op12_url_filter, op13_spelling)}
#: bare base32 of a SHA-1, from its 160 bits
_BASE32 = """list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + CAST(list_sum(list_transform(range(5), lambda k: CAST(substr(bits, CAST(i * 5 + k + 1 AS BIGINT), 1) AS INTEGER) * CAST(pow(2, 4 - k) AS INTEGER))) AS BIGINT), 1)),
  lambda a, b: a || b)"""
_BITS = """list_reduce(list_transform(range(40), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111',
  CAST(strpos('0123456789abcdef', substr(sha, CAST(i + 1 AS BIGINT), 1)) * 4 - 3 AS BIGINT), 4)), lambda a, b: a || b)"""

def _strength(level: str) -> str:
    """Beta-binomial precision of a level's rows (n, bad, up), as ``url_reputation.strength``."""
    return f"""(SELECT CASE WHEN room <= 0 THEN 10.0 WHEN beyond <= 0 THEN 1000.0 ELSE least(1000.0, greatest(2.0, room / beyond - 1)) END
  FROM (SELECT coalesce(sum((bad - n * up) * (bad - n * up) - n * up * (1 - up)), 0.0) AS beyond, coalesce(sum(n * (n - 1) * up * (1 - up)), 0.0) AS room FROM {level} WHERE n > 0))"""


#: SQL can't express the other operators (learned models, sketches, token ids, drawn surrogates, packing, checksums).
ORACLES: dict[str, str] = {
    "op1_warc": f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, strlen(html) AS n, sha1(html) AS sha, min(page_id) OVER (PARTITION BY html) AS first FROM p),
b AS (SELECT *, {_BITS} AS bits FROM s)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM b""",
    "op9_chat": r"""WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
  15 + length(role) + length(text) + (length(text) - length(replace(replace(text, '\', ''), '#', ''))) + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS size FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(length(loss)) AS BIGINT) AS loss_chars, sha256(string_agg(loss, '' ORDER BY turn)) AS loss_sha256, CAST(sum(size) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
    "op12_url_filter": rf"""WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
  regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(?:<h1>.*?</h1>)?(.*?)</article>', 1), '<[^>]*>|&#?[a-zA-Z0-9]+;', '', 'g'), '[^\p{{L}}\p{{N}}]+', '', 'g') AS shown FROM pages),
k AS (SELECT regexp_replace(text, '[^\p{{L}}\p{{N}}]+', '', 'g') AS shown, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM documents JOIN labels USING (doc_id) WHERE text IS NOT NULL AND coalesce(quality, toxic) IS NOT NULL GROUP BY 1),
c AS (SELECT host, count(*) AS n, sum(bad) AS bad FROM p JOIN k USING (shown) GROUP BY host),
h0 AS (SELECT host, coalesce(n, 0) AS n, coalesce(bad, 0) AS bad, regexp_replace(host, '^.*@|:[0-9]*$', '', 'g') AS name FROM (SELECT DISTINCT host FROM p WHERE host <> '') LEFT JOIN c USING (host)),
h1 AS (SELECT *, CASE WHEN regexp_matches(name, '^[0-9.]*$') OR NOT contains(name, '.') THEN name
  WHEN regexp_matches(name, '(^|\.)[^.]+\.(ac|co|com|edu|gov|net|org)\.[a-z]{{2}}$') THEN regexp_extract(name, '([^.]+\.(?:ac|co|com|edu|gov|net|org)\.[a-z]{{2}})$', 1)
  ELSE regexp_extract(name, '([^.]*\.[^.]*)$', 1) END AS domain FROM h0),
h AS (SELECT *, CASE WHEN regexp_matches(domain, '^[0-9.]*$') OR NOT contains(domain, '.') THEN domain ELSE regexp_extract(domain, '^[^.]*\.(.*)$', 1) END AS suffix FROM h1),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (sum(sum(bad)) OVER () + 1) / (sum(sum(n)) OVER () + 2) AS up FROM h GROUP BY suffix),
s AS (SELECT suffix, (bad + m * up) / (n + m) AS up FROM s0, (SELECT {_strength('s0')} AS m)),
d0 AS (SELECT domain, suffix, n, bad, up FROM (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY domain, suffix) JOIN s USING (suffix)),
d AS (SELECT domain, (bad + m * up) / (n + m) AS up FROM d0, (SELECT {_strength('d0')} AS m)),
r0 AS (SELECT host, n, bad, up FROM h JOIN d USING (domain)),
r AS (SELECT host, bad + m * up AS a, n - bad + m * (1 - up) AS b FROM r0, (SELECT {_strength('r0')} AS m)),
v AS (SELECT host, CASE WHEN 1 / (1 + exp(-(ln(a / b) - 1.645 * sqrt(1 / a + 1 / b)))) >= 0.5 THEN 'block' ELSE 'allow' END AS own FROM r),
f AS (SELECT page_id, host, path, CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, f.host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' ELSE coalesce(own, 'allow') END AS verdict
FROM f LEFT JOIN v ON f.host = v.host""",
}
