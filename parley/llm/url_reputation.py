"""URL filter: rules first, then empirical-Bayes reputation of hosts.

Labelled outcomes of pages (bad or not) are counted by host.  Bad rates are shrunk in three steps, each
through a beta-binomial prior around the mean of the level above: suffixes towards all outcomes,
registered domains towards their suffix, hosts towards their domain.  The strength of each step's
prior is fitted to the counts of its level by moments (how far group rates scatter beyond what their
sizes explain), so large groups speak for themselves and small or unlabelled ones follow their parents.
A host is blocked if the lower posterior bound of its bad rate reaches ``LIMIT``: the ``Z`` point of
the posterior beta distribution, normal on the logit scale.

Rules (verdict, host, path) come first: a rule fits its host and all subdomains if the url's path starts with
the rule's, and the longest wins (ties: the longer host, then block).  Rules are compiled into one ordered
``CASE WHEN``, at most ``MOST_RULES`` of them.

All counts are aggregates over all rows, combined before each shuffle.  Verdicts go back to the rows by
:func:`parley.llm.common.joined`, which sends keys that hold a thousandth of all rows or more (so at most 1,000 of them) to
every task and shuffles only the rest, so a host with a third of all pages is no hot task.

Edge cases: a null url or one without ``://`` has empty host and path, fits no rule and, having no host,
is allowed; a host without a dot, or an address of digits, is its own domain with itself as
suffix; rows with repeated ids are judged each, null ids alike; without any outcome every host has
the same rate of one half of no weight and is allowed; labels that are null count as not given; an
empty table gives an empty result; extra columns pass through (internal ones begin with ``_u_``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import joined, written

LIMIT, Z = 0.5, 1.645
STRENGTHS = (2.0, 1000.0, 10.0)  # least, greatest, and that of a level without two outcomes in a group
MOST_RULES = 1_000
#: second-level labels that belong to the suffix below a two-letter top level
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def domain_of(host: Column) -> Column:
    """Registered domain: the suffix and one label more; user names and ports are left out."""
    name = F.regexp_replace(host, r"^.*@|:[0-9]*$", "")
    wide = r"[^.]+\.(?:" + "|".join(SECOND_LEVEL) + r")\.[a-z]{2}$"
    return (F.when(name.rlike(r"^[0-9.]*$") | ~name.contains("."), name)
            .when(name.rlike(r"(?:^|\.)" + wide), F.regexp_extract(name, wide, 0))
            .otherwise(F.substring_index(name, ".", -2)))


def suffix_of(domain: Column) -> Column:
    return F.when(domain.rlike(r"^[0-9.]*$") | ~domain.contains("."), domain).otherwise(F.regexp_extract(domain, r"^[^.]*\.(.*)$", 1))


def strength(level: DataFrame) -> float:
    """Beta-binomial precision of rows (n, bad, parent mean ``up``), by moments."""
    n, k, m = F.col("n"), F.col("bad"), F.col("up")
    seen, least, most, usual = F.coalesce, *STRENGTHS
    r = level.where("n > 0").agg(
        seen(F.sum((k - n * m) * (k - n * m) - n * m * (1 - m)), F.lit(0.0)).alias("beyond"),
        seen(F.sum(n * (n - 1) * m * (1 - m)), F.lit(0.0)).alias("room")).first()
    if r["room"] <= 0:
        return usual
    rho = r["beyond"] / r["room"]
    return most if rho <= 0 else min(most, max(least, 1 / rho - 1))


def _mean(m: float) -> Column:
    return (F.col("bad") + m * F.col("up")) / (F.col("n") + m)


def reputation(hosts: DataFrame, outcomes: DataFrame, z: float = Z) -> DataFrame:
    """host, n, bad, mean and bound of the posterior bad rate for every distinct non-empty host.

    ``outcomes`` has rows (host, bad, times): so many labelled pages, bad being 0 or 1.
    """
    counts = outcomes.where("bad is not null and host <> ''").groupBy("host").agg(F.sum("times").alias("n"), F.sum(F.col("bad") * F.col("times")).alias("bad"))
    table = hosts.select("host").where("host <> ''").distinct().join(counts, "host", "full")
    table = table.select("host", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("bad", F.lit(0)).alias("bad"), domain_of(F.col("host")).alias("domain"))
    table = written(table.withColumn("suffix", suffix_of(F.col("domain"))), "hosts")
    domains = written(table.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "domains")
    suffixes = written(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "suffixes")
    n, bad = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    suffixes = suffixes.withColumn("up", F.lit((bad + 1) / (n + 2)))
    suffixes = suffixes.select("suffix", _mean(strength(suffixes)).alias("up"))
    domains = written(joined(domains, suffixes, "suffix"), "domains")
    domains = domains.select("domain", _mean(strength(domains)).alias("up"))
    table = written(joined(table, domains, "domain"), "hosts")
    m = F.lit(strength(table))
    a, b = F.col("bad") + m * F.col("up"), F.col("n") - F.col("bad") + m * (1 - F.col("up"))
    bound = 1 / (1 + F.exp(-(F.log(a / b) - z * F.sqrt(1 / a + 1 / b))))
    return table.select("host", "n", "bad", (a / (a + b)).alias("mean"), bound.alias("bound"))


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(verdict, rule) of the longest fitting rule, null fields if none fits."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    none = F.struct(F.lit(None).cast("string").alias("verdict"), F.lit(None).cast("string").alias("rule"))
    out = none
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(out)
    return out


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]], limit: float = LIMIT, z: float = Z) -> DataFrame:
    """``pages`` with host, path, rule and verdict (allow or block) of its url."""
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("_u_rule", ruled(F.col("host"), F.col("path"), rules))
    found = reputation(rows.select("host"), outcomes, z).select("host", (F.col("bound") >= limit).alias("_u_bad"))
    own = F.when(F.col("_u_bad"), F.lit("block")).otherwise(F.lit("allow"))
    rows = joined(rows, written(found, "host-verdicts"), "host")
    return rows.select(*[F.col(f"`{c}`") for c in keep], "host", "path", F.col("_u_rule.rule").alias("rule"), F.coalesce("_u_rule.verdict", own).alias("verdict"))


def letters(text: Column) -> Column:
    """Only the letters and digits of a text: what a page and the document it shows have in common."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}]+", "")


def article(html: Column) -> Column:
    """The text of a page's article behind its heading, without tags and character references."""
    inside = F.regexp_extract(html, r"(?s)<article>(?:<h1>.*?</h1>)?(.*?)</article>", 1)
    return F.regexp_replace(inside, r"<[^>]*>|&#?[a-zA-Z0-9]+;", "")


def page_outcomes(pages: DataFrame, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad, times) of the pages whose article is the text of a labelled document.

    A document is bad if it is labelled of low quality or toxic; texts of several labels are bad if one of
    them is.  Texts meet by a digest of their letters and digits, so no text is shuffled.
    """
    bad = ((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int")
    marked = labels.where("doc_id is not null and coalesce(quality, toxic) is not null").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    texts = documents.where("text is not null").select("doc_id", F.unhex(F.md5(letters(F.col("text")))).alias("_u_text"))
    known = texts.join(marked, "doc_id").groupBy("_u_text").agg(F.max("bad").alias("bad"))
    shown = pages.select(host_of(F.col("url")).alias("host"), F.unhex(F.md5(letters(article(F.col("html"))))).alias("_u_text"))
    # pages of one host and text count together, so that a common text is one row a host
    shown = shown.where("host <> ''").groupBy("host", "_u_text").agg(F.count("*").alias("times"))
    return shown.join(known, "_u_text").select("host", "bad", "times")
