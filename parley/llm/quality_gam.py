"""Quality classifier: a generalised additive model with pairwise interactions.

Spark computes the features of whole texts natively.  On a bounded sample of labelled rows
(``sample_rows``) cyclic boosting adds shallow trees, one feature after the other, to per-feature
lookup tables over quantile bins; the pairs whose quadrant cuts explain most of what is left get
two-dimensional tables in the same way.  Scoring adds table entries by bin, a column at a time
(a pandas UDF over numbers only; texts never leave the JVM).

Edge cases: null and empty texts have all counts 0 and get the score of those features; without
labels of both kinds the score is the labelled share of 1 (0.5 with no label at all).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm import textstats
from parley.llm.common import sampled_labels

SAMPLE_ROWS = 20_000  # labelled rows that the model is fitted on (bound of the sample)
BINS, PAIR_BINS = 32, 8


@dataclass
class Gam:
    intercept: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def raw(self, columns: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(columns[0]) if columns else 0, self.intercept)
        for x, c, t in zip(columns, self.cuts, self.tables):
            out += t[np.searchsorted(c, x, side="right")]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            out += t[np.searchsorted(self.pair_cuts[i], columns[i], side="right"), np.searchsorted(self.pair_cuts[j], columns[j], side="right")]
        return out

    def score(self, columns: list[np.ndarray]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.raw(columns)))


def _steps(bins: np.ndarray, residual: np.ndarray, weight: np.ndarray, n: int, leaves: int, l2: float) -> np.ndarray:
    """A tree over ordered bins: up to ``leaves`` constant pieces, the best cut of any piece first."""
    g, h = np.bincount(bins, residual, n), np.bincount(bins, weight, n)
    pieces = [(0, n)]
    for _ in range(leaves - 1):
        best = (1e-9, None, None)
        for a, b in pieces:
            if b - a < 2:
                continue
            cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
            lg, lh, rg, rh = cg[:-1], ch[:-1], cg[-1] - cg[:-1], ch[-1] - ch[:-1]
            gain = lg**2 / (lh + l2) + rg**2 / (rh + l2) - cg[-1] ** 2 / (ch[-1] + l2)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (a, b), a + k + 1)
        if best[1] is None:
            break
        a, b = best[1]
        pieces = [p for p in pieces if p != (a, b)] + [(a, best[2]), (best[2], b)]
    out = np.zeros(n)
    for a, b in pieces:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + l2)
    return out


def _quadrants(bi, bj, residual, weight, n, l2):
    """The best pair of cuts over an n x n grid: (gain, table of four constants)."""
    cell = bi * n + bj
    g, h = (np.bincount(cell, v, n * n).reshape(n, n).cumsum(0).cumsum(1) for v in (residual, weight))
    best = (0.0, np.zeros((n, n)))
    for a in range(n - 1):
        for b in range(n - 1):
            q = [(x[a, b], x[a, -1] - x[a, b], x[-1, b] - x[a, b], x[-1, -1] - x[a, -1] - x[-1, b] + x[a, b]) for x in (g, h)]
            gain = sum(x * x / (y + l2) for x, y in zip(*q))
            if gain > best[0]:
                v = [x / (y + l2) for x, y in zip(*q)]
                t = np.empty((n, n))
                t[: a + 1, : b + 1], t[: a + 1, b + 1:], t[a + 1:, : b + 1], t[a + 1:, b + 1:] = v
                best = (gain, t)
    return best


def fit(columns: list[np.ndarray], label: np.ndarray, rounds: int = 60, pair_rounds: int = 20, n_pairs: int = 6,
        rate: float = 0.15, leaves: int = 3, l2: float = 1.0) -> Gam:
    """Cyclic boosting of log odds; every cycle visits each feature once, then each chosen pair."""
    n = len(label)
    share = (label.sum() + 0.5) / (n + 1.0) if n else 0.5
    model = Gam(float(np.log(share / (1 - share))))
    if n == 0 or label.min() == label.max():
        return model
    cut = lambda x, k: np.unique(np.quantile(x, np.arange(1, k) / k, method="nearest"))
    both = lambda x, k: np.unique(np.concatenate([cut(x[label == v], k) for v in (0, 1)]))
    model.cuts = [both(x, BINS) for x in columns]
    model.pair_cuts = [cut(x, PAIR_BINS) for x in columns]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, x, side="right") for c, x in zip(model.cuts, columns)]
    coarse = [np.searchsorted(c, x, side="right") for c, x in zip(model.pair_cuts, columns)]
    total = np.full(n, model.intercept)

    def slope():
        p = 1.0 / (1.0 + np.exp(-total))
        return label - p, p * (1 - p)

    for _ in range(rounds):
        for k, b in enumerate(bins):
            r, w = slope()
            t = rate * _steps(b, r, w, len(model.tables[k]), leaves, l2)
            model.tables[k] += t
            total += t[b]
    r, w = slope()
    found = sorted(((_quadrants(coarse[i], coarse[j], r, w, PAIR_BINS, l2)[0], i, j) for i in range(len(bins)) for j in range(i)), reverse=True)
    model.pairs = [(i, j) for gain, i, j in found[:n_pairs] if gain > 1e-6]
    model.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(model.pairs):
            r, w = slope()
            t = rate * _quadrants(coarse[i], coarse[j], r, w, PAIR_BINS, l2)[1]
            model.pair_tables[k] += t
            total += t[coarse[i], coarse[j]]
    return model


def train(documents: DataFrame, labels: DataFrame, keep: Column | None = None, sample_rows: int = SAMPLE_ROWS) -> Gam:
    """Fits on a hash sample of labelled rows, one a doc_id; ``keep`` restricts by doc_id which rows may be learned from."""
    sample = F.broadcast(sampled_labels(labels, "quality", sample_rows, keep).select(F.col("doc_id").alias("_id"), F.col("label").alias("_label")))
    rows = documents.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("_id"))
    counted = textstats.with_counts(rows).select("_id", "_label", *textstats.features())
    data = counted.groupBy("_id").agg(F.min(F.struct("_label", *textstats.FEATURES)).alias("_row")).select("_row.*").toPandas()
    return fit([data[f].to_numpy(float) for f in textstats.FEATURES], data["_label"].to_numpy(float))


def score_column(model: Gam) -> Column:
    """The score over the columns of :data:`textstats.FEATURES`."""
    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(model.score([c.to_numpy(float) for c in columns]))

    return score(*(F.col(f) for f in textstats.FEATURES))


def classify(documents: DataFrame, model: Gam) -> DataFrame:
    """doc_id, score and predicted of every document, from its whole text."""
    scored = textstats.with_counts(documents.select("doc_id", "text")).select("doc_id", *textstats.features()).select("doc_id", score_column(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
