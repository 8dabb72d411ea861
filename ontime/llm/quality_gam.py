"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into bins. Boosting cycles over the features; each step
fits one shallow tree to the log-loss gradients of that feature's bins and
adds it, scaled down, to the feature's lookup table. Then the pairs with the
largest gain on the residual get two-dimensional tables, boosted the same way.
A score is the sigmoid of one table entry per feature and pair.

Bounds. The fit sees at most ``max_rows`` labelled rows (20,000), the smallest
by a seeded hash of the id. Labels are learned only from rows whose
crc32(id as text) mod 3 is not 1. Scoring reads every row.

Defined cases. NULL text is scored as an empty one. NULL labels are ignored;
repeated label rows count once with the smallest label. Without labelled rows
every score is 0.5; with one class only, the scores are that class's share.
Rows without an id are never learned from. Empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import hash_sample, learnable, with_row
from ontime.llm.quality_rules import stats_table
from ontime.llm.text_stats import COUNTS, feature_matrix, text_stats

RIDGE = 1.0  # added to the second derivatives


@dataclass
class Gam:
    """Bin edges per feature, one table per feature, and tables over pairs of coarse bins."""
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        logit = np.full(len(x), self.intercept)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            logit += table[np.searchsorted(edges, x[:, f], "right")]
        for i, j, table in self.pairs:
            logit += table[np.searchsorted(self.coarse[i], x[:, i], "right"),
                           np.searchsorted(self.coarse[j], x[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _quantile_edges(x: np.ndarray, bins: int) -> np.ndarray:
    values = np.unique(x)
    if len(values) <= bins:
        return (values[1:] + values[:-1]) / 2
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best two-way cut of bins with gradient and curvature sums."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl ** 2 / (hl + RIDGE) + gr ** 2 / (hr + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf value of every bin for a depth-two tree over ordered bins."""
    out = np.full(len(g), g.sum() / (h.sum() + RIDGE))
    gain, at = _best_cut(g, h)
    if gain <= 0:
        return out
    for lo, hi in ((0, at), (at, len(g))):
        sub, cut = _best_cut(g[lo:hi], h[lo:hi])
        for a, b in (((lo, lo + cut), (lo + cut, hi)) if sub > 0 else ((lo, hi),)):
            out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and cell values of a tree that cuts one axis and then each side along the other."""
    base = g.sum() ** 2 / (h.sum() + RIDGE)
    best = (0.0, np.full(g.shape, g.sum() / (h.sum() + RIDGE)))
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        for at in range(1, gg.shape[0]):
            out, total = np.empty(gg.shape), 0.0
            for rows in (slice(0, at), slice(at, None)):
                gs, hs = gg[rows].sum(axis=0), hh[rows].sum(axis=0)
                _, cut = _best_cut(gs, hs)
                for cols in (slice(0, cut), slice(cut, None)):
                    a, b = gs[cols].sum(), hs[cols].sum()
                    out[rows, cols] = a / (b + RIDGE)
                    total += a * a / (b + RIDGE)
            if total - base > best[0]:
                best = (total - base, out.T if turned else out)
    return best


def fit_gam(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.1, bins: int = 64,
            n_pairs: int = 6, pair_bins: int = 8, pair_rounds: int = 20) -> Gam:
    """Fit on a feature matrix and 0/1 labels (driver-sized; see ``max_rows``)."""
    if not len(y):
        return Gam(0.0)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Gam(float(np.log(share / (1 - share))))
    if y.min() == y.max():
        return model
    model.edges = [_quantile_edges(x[:, f], bins) for f in range(x.shape[1])]
    model.coarse = [_quantile_edges(x[:, f], pair_bins) for f in range(x.shape[1])]
    at = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    logit = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f, places in enumerate(at):
            g, h = slopes()
            n = len(model.tables[f])
            step = rate * _tree(np.bincount(places, g, n), np.bincount(places, h, n))
            model.tables[f] += step
            logit += step[places]

    rough = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.coarse)]
    width = [len(e) + 1 for e in model.coarse]

    def cells(i, j):
        g, h = slopes()
        place = rough[i] * width[j] + rough[j]
        size = width[i] * width[j]
        return tuple(np.bincount(place, v, size).reshape(width[i], width[j]) for v in (g, h))

    gains = sorted(((_pair_tree(*cells(i, j))[0], i, j) for i, j in combinations(range(x.shape[1]), 2)), reverse=True)
    model.pairs = [(i, j, np.zeros((width[i], width[j]))) for gain, i, j in gains[:n_pairs] if gain > 0]
    for _ in range(pair_rounds):
        for i, j, table in model.pairs:
            step = rate * _pair_tree(*cells(i, j))[1]
            table += step
            logit += step[rough[i], rough[j]]
    return model


def learn_quality(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", max_rows: int = 20_000, **options) -> Gam:
    """Fit on the learnable labelled rows of a table of ``id_col`` and COUNTS."""
    truth = (labels.where(learnable(id_col) & F.col("quality").isNotNull()).groupBy(id_col)
             .agg(F.min("quality").alias("_y")))
    rows = hash_sample(stats.select(id_col, *COUNTS).join(truth, id_col), id_col, max_rows).toPandas()
    rows = rows.sort_values([id_col, *COUNTS], kind="stable")
    return fit_gam(feature_matrix(rows[list(COUNTS)].to_numpy(np.int64).reshape(-1, len(COUNTS))),
                   rows["_y"].to_numpy(np.float64), **options)


def quality_score(model: Gam):
    """Column function: struct of COUNTS -> score."""
    @F.arrow_udf("double")
    def score(stats: pa.Array) -> pa.Array:
        counts = np.stack([c.to_numpy(zero_copy_only=False) for c in stats.flatten()], axis=1)
        return pa.array(model.scores(feature_matrix(counts)))
    return score


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    **options) -> DataFrame:
    """``id_col``, score, predicted (1 if score >= 0.5) of every document; texts are read once."""
    stats = stats_table(docs, id_col, text_col)
    score = quality_score(learn_quality(stats, labels, id_col, **options))(F.struct(*COUNTS))
    return stats.select(id_col, score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def filter_by_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_score: float = 0.5, **options) -> DataFrame:
    """The documents with a score of at least ``min_score``; all columns stay."""
    model = learn_quality(stats_table(docs, id_col, text_col), labels, id_col, **options)
    return (with_row(docs, quality_score(model)(text_stats(F.col(text_col))).alias("_score"))
            .where(F.col("_score") >= min_score).select("_row.*"))
