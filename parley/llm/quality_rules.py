"""Quality rules: a learned decision list of threshold conjunctions (native Spark expressions).

``learn`` fits on a bounded sample of labelled rows (parameter ``sample_rows``): Spark computes the
features of the sample's whole texts, cut points by quantiles and a table of (cell, label) counts,
where a cell is the vector of bins.  Sequential covering then works on these counts alone: a rule
grows by the condition of the largest information gain on two thirds of the sample, is pruned from
the end on the last third, and is kept if it is precise there.  What it covers is taken out and the
next rule is learned.  The list becomes one ordered ``CASE WHEN`` expression, so that applying it
to any number of documents is one scan without a shuffle and without Python.

Edge cases: null and empty texts have no words and fail the base rule; rows with repeated ids are
judged each; a null doc_id is judged alike; without usable labels there are no rules and only the
base rule holds; extra columns pass through (internal columns begin with ``_q_``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm import textstats
from parley.llm.common import sampled_labels, written

SAMPLE_ROWS = 20_000  # labelled rows that the rules are fitted on (bound of the sample)


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    cut: float

    def expression(self) -> Column:
        return F.col(self.feature) >= self.cut if self.at_least else F.col(self.feature) < self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.cut:g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    bad: int
    good: int

    def expression(self) -> Column:
        out = self.conditions[0].expression()
        for c in self.conditions[1:]:
            out = out & c.expression()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def labelled_cells(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS):
    """(cuts by feature, cells): a cell is (bins, for_pruning, bad, good) of the labelled sample."""
    sample = F.broadcast(sampled_labels(labels, "quality", sample_rows).select(F.col("doc_id").alias("_q_id"), F.col("label").alias("_q_label")))
    rows = documents.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("_q_id"))
    rows = textstats.with_counts(rows).select("_q_label", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("_q_prune"), *textstats.features())
    rows = written(rows, "rules-sample")
    grid = [i / 16 for i in range(1, 16)]
    quantiles = rows.groupBy("_q_label").agg(*(F.percentile_approx(f, grid, 2000).alias(f) for f in textstats.FEATURES)).collect()
    cuts = {f: sorted({v for r in quantiles for v in r[f] or []}) for f in textstats.FEATURES}
    bins = [sum(((F.col(f) >= c).cast("int") for c in cuts[f]), F.lit(0)).alias(f) for f in textstats.FEATURES]
    cells = rows.groupBy(*bins, "_q_prune").agg(F.sum(1 - F.col("_q_label")).alias("bad"), F.sum("_q_label").alias("good")).collect()
    return cuts, [(tuple(r[f] for f in textstats.FEATURES), r["_q_prune"], r["bad"], r["good"]) for r in cells]


def _counts(cells, conditions, index):
    bad = good = 0
    for bins, _, b, g in cells:
        if all((bins[index[f]] > k) == up for f, up, k in conditions):
            bad, good = bad + b, good + g
    return bad, good


def _grow(cells, cuts, index, most):
    """Adds the condition of the largest gain until a rule covers no good row."""
    conditions, inside = [], cells
    while len(conditions) < most:
        bad, good = sum(c[2] for c in inside), sum(c[3] for c in inside)
        if not bad or not good:
            break
        base, best = math.log2(bad / (bad + good)), None
        for f, i in index.items():
            by = {}
            for bins, _, b, g in inside:
                p = by.setdefault(bins[i], [0, 0])
                p[0] += b
                p[1] += g
            below_b = below_g = 0
            for k in range(len(cuts[f])):  # bins 0..k lie below cut k
                b, g = by.get(k, (0, 0))
                below_b, below_g = below_b + b, below_g + g
                for up, nb, ng in ((True, bad - below_b, good - below_g), (False, below_b, below_g)):
                    if nb and (nb, ng) != (bad, good):
                        gain = nb * (math.log2(nb / (nb + ng)) - base)
                        if best is None or gain > best[0]:
                            best = (gain, f, up, k)
        if best is None or best[0] <= 1e-9:
            break
        conditions.append(best[1:])
        inside = [c for c in inside if (c[0][index[best[1]]] > best[3]) == best[2]]
    return conditions


def learn(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, max_rules: int = 12,
          max_conditions: int = 4, min_precision: float = 0.97, min_bad: int = 3) -> list[Rule]:
    """The ordered rules that reject; see the module's text."""
    cuts, cells = labelled_cells(documents, labels, sample_rows)
    index = {f: i for i, f in enumerate(textstats.FEATURES)}
    return cover(cells, cuts, index, max_rules, max_conditions, min_precision, min_bad)


def cover(cells, cuts, index, max_rules=12, max_conditions=4, min_precision=0.97, min_bad=3) -> list[Rule]:
    """Sequential covering over (bins, for_pruning, bad, good) cells."""
    rules: list[Rule] = []
    tried = [c for c in cells if not c[1]]  # what rules may still grow on
    while len(rules) < max_rules:
        conditions = _grow(tried, cuts, index, max_conditions)
        if not conditions:
            break
        prune, fit = [c for c in cells if c[1]], []
        for n in range(1, len(conditions) + 1):
            (bad, good), (p_bad, p_good) = _counts(cells, conditions[:n], index), _counts(prune, conditions[:n], index)
            if bad >= min_bad and bad >= min_precision * (bad + good) and p_bad >= min_precision * (p_bad + p_good):
                fit.append(((p_bad - p_good) / (p_bad + p_good) if p_bad + p_good else -1.0, -n, bad, good))
        outside = lambda cs, rows: [c for c in rows if not all((c[0][index[f]] > k) == up for f, up, k in cs)]
        if fit:
            _, n, bad, good = max(fit)
            conditions = conditions[:-n]
            rules.append(Rule(tuple(Condition(f, up, cuts[f][k]) for f, up, k in conditions), bad, good))
            cells = outside(conditions, cells)
        tried = outside(conditions, tried)  # a rule that doesn't hold up isn't grown again
    return rules


def first_rule(rules: list[Rule]) -> Column:
    """1-based number of the first rule that fires, or null, as one ordered conditional expression."""
    out = F.lit(None).cast("int")
    for i, r in reversed(list(enumerate(rules, 1))):
        out = F.when(r.expression(), F.lit(i)).otherwise(out)
    return out


def judge(documents: DataFrame, rules: list[Rule]) -> DataFrame:
    """``documents`` with struct ``_q``: the counts, ``base_failed``, ``rule`` and ``kept``."""
    s = lambda k: F.col(f"_s.{k}")
    held = documents.withColumn("_q_row", F.struct(*documents.columns)).select("_q_row", F.col("text").alias("_q_text"))
    counted = textstats.with_counts(held, "_q_text").select("_q_row", "_s", *textstats.features())
    failed = (s("n_words") < 50) | (100 * s("n_repeat_words") > 50 * s("n_words"))
    judged = counted.select("_q_row", "_s", failed.alias("base_failed"), first_rule(rules).alias("rule"))
    return judged.select("_q_row.*", F.struct(
        s("n_words").alias("n_words"), s("word_chars").alias("word_chars"), s("n_symbols").alias("n_symbols"),
        s("n_dup_lines").alias("n_dup_lines"), s("n_repeat_words").alias("n_repeat_words"), "base_failed", "rule",
        (~F.col("base_failed") & F.col("rule").isNull()).alias("kept")).alias("_q"))


def keep_good(documents: DataFrame, rules: list[Rule]) -> DataFrame:
    """The documents that neither the base rule nor a learned rule rejects, columns unchanged."""
    columns = [F.col(f"`{c}`") for c in documents.columns]
    return judge(documents, rules).where("_q.kept").select(*columns)
