"""Quality rules: isolation forests on rule statistics.

The base rules reject short texts and texts that repeat themselves. The rest
is judged by path lengths over random splits: each tree isolates rows of a
small sample by random features and cuts, and a row that ends on short paths
is unlike the others. One forest sees all statistics together, and one each
statistic alone, since a row that is odd in one of many statistics is seldom
cut by it in the joint trees. A forest of one statistic is a step function of
it, so it is applied as a table of cuts and scores.

Every forest has its own threshold, calibrated from labelled rows: the lowest
that loses at most the forest's part of ``max_clean_loss`` of the rows of quality
1, if it rejects a larger share of those of quality 0. Otherwise the forest
rejects nothing. A document is kept if no forest rejects it.

Bounds. The trees see ``trees * sample`` rows (64 * 256 by default), the
smallest by a seeded hash of the row, so the same rows on any layout. The
calibration reads all labelled rows that are not held out (``common.learnable``)
as a histogram of scores for each forest.

Defined cases. NULL text has no words and fails the base rules. NULL or
repeated label rows: a document counts as quality 1 if any label says so;
NULL labels are ignored. Without labels of both qualities the forests reject
nothing. Repeated rows are judged alike; empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import hash_sample, learnable, utf8, with_row
from ontime.llm.text_stats import COUNTS, FEATURES, feature_matrix, text_counts, text_stats
from ontime.session import cut_lineage

MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
SCORE_BINS = 2000


def average_path(n: float) -> float:
    """Mean path of an unsuccessful search in a binary tree of n rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


@dataclass
class Forest:
    """Trees as flat arrays; a leaf's feature is -1 and its cut holds the path still to add."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    depth: int
    sample: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1] of each row; higher is more unlike the rest."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, left in zip(self.feature, self.cut, self.left):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                inner = f >= 0
                right = x[rows, f] >= cut[node]
                node = np.where(inner, left[node] + right, node)
                total += inner
            total += cut[node]
        return 2.0 ** (-total / len(self.feature) / max(average_path(self.sample), 1e-9))


def grow_forest(x: np.ndarray, trees: int = 64, sample: int = 256, seed: int = 42) -> Forest:
    """Isolation trees over shuffled slices of ``x``."""
    rng = np.random.default_rng(seed)
    x = x[rng.permutation(len(x))]
    sample = max(1, min(sample, len(x)))
    depth = max(1, int(np.ceil(np.log2(sample))))
    size = 2 ** (depth + 1)
    feature, cut, left = np.full((trees, size), -1), np.zeros((trees, size)), np.zeros((trees, size), np.int64)
    for t in range(trees):
        start = (t * sample) % max(1, len(x) - sample + 1)
        todo, used = [(0, x[start:start + sample], 0)], 1
        while todo:
            node, rows, level = todo.pop()
            low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(1), np.zeros(1))
            varied = np.flatnonzero(high > low)
            if level == depth or len(rows) <= 1 or not len(varied):
                cut[t, node] = average_path(len(rows))
                continue
            f = int(rng.choice(varied))
            at = rng.uniform(low[f], high[f])
            feature[t, node], cut[t, node], left[t, node] = f, at, used
            right = rows[:, f] >= at
            todo += [(used, rows[~right], level + 1), (used + 1, rows[right], level + 1)]
            used += 2
    return Forest(feature, cut, left, depth, sample)


@dataclass
class StepForest:
    """The forest of one statistic: its score from each cut to the next."""
    column: int
    cuts: np.ndarray
    steps: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.steps[np.searchsorted(self.cuts, x[:, self.column], "right")]


def step_forest(x: np.ndarray, column: int, trees: int, sample: int) -> StepForest:
    forest = grow_forest(x[:, [column]], trees, sample, seed=43 + column)
    cuts = np.unique(forest.cut[forest.feature >= 0])
    return StepForest(column, cuts, forest.scores(np.append(-np.inf, cuts)[:, None]))


@dataclass
class RuleModel:
    """The joint forest, then one a statistic; a score above the threshold of its forest rejects."""
    forests: list
    thresholds: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """(rows, forests) anomaly scores."""
        return np.stack([f.scores(x) for f in self.forests], axis=1)

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """Largest ratio of a score to its threshold; a row is rejected above 1."""
        if not len(x) or not self.forests:
            return np.zeros(len(x))
        return (self.scores(x) / self.thresholds).max(axis=1)


def base_failed(s: str = "") -> Column:
    return (F.col(f"{s}n_words") < MIN_WORDS) | (
        100 * F.col(f"{s}n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{s}n_words"))


def _features_of(stats: pa.Array) -> np.ndarray:
    return feature_matrix(np.stack([c.to_numpy(zero_copy_only=False) for c in stats.flatten()], axis=1))


def _anomaly(model: RuleModel):
    @F.arrow_udf("double")
    def score(stats: pa.Array) -> pa.Array:
        return pa.array(model.anomaly(_features_of(stats)))
    return score


def _score_bins(model: RuleModel):
    @F.arrow_udf("array<int>")
    def bins(stats: pa.Array) -> pa.Array:
        found = np.floor(model.scores(_features_of(stats)) * SCORE_BINS).astype(np.int32)
        return pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1], pa.array(found.ravel()))
    return bins


def _stats_struct() -> Column:
    return F.struct(*COUNTS)


def fit_rules(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", trees: int = 64, sample: int = 256,
              max_clean_loss: float = 0.005) -> RuleModel:
    """Forests and thresholds from a table of ``id_col`` and COUNTS, and one of ``id_col``, quality."""
    passed = stats.where(~base_failed())
    rows = hash_sample(passed.select(id_col, *COUNTS), id_col, trees * sample).toPandas()
    if not len(rows):
        return RuleModel([], np.zeros(0))
    # the same rows come in any order, so fix it
    rows = rows.sort_values([*COUNTS, id_col], kind="stable")
    x = feature_matrix(rows[list(COUNTS)].to_numpy())
    forests = [grow_forest(x, trees, sample), *(step_forest(x, c, trees, sample) for c in range(len(FEATURES)))]
    model = RuleModel(forests, np.ones(len(forests)))
    truth = labels.where("quality IS NOT NULL").groupBy(id_col).agg(F.max("quality").alias("_quality"))
    bins = (passed.where(learnable(id_col)).join(truth, id_col)
            .select("_quality", F.posexplode(_score_bins(model)(_stats_struct())).alias("_forest", "_bin"))
            .groupBy("_quality", "_forest", "_bin").count().toPandas())
    part = max_clean_loss / len(forests)
    model.thresholds = np.array([_threshold(bins[bins["_forest"] == i], part) for i in range(len(forests))])
    return model


def _threshold(bins: pd.DataFrame, max_clean_loss: float) -> float:
    """Lowest bin edge above which at most ``max_clean_loss`` of the quality-1 rows lie; 1, above which no score
    lies, unless a larger share of the quality-0 rows than of those lies there."""
    by_quality = {q: rows.groupby("_bin")["count"].sum() for q, rows in bins.groupby("_quality")}
    clean, bad = by_quality.get(1), by_quality.get(0)
    if clean is None or bad is None:
        return 1.0
    above = clean.sort_index(ascending=False).cumsum()
    lost = above[above > max_clean_loss * clean.sum()]
    edge = lost.index.max() + 1
    gains = bad[bad.index >= edge].sum() / bad.sum() > clean[clean.index >= edge].sum() / clean.sum()
    return float(edge / SCORE_BINS) if gains else 1.0


def judge(stats: DataFrame, model: RuleModel) -> DataFrame:
    """Adds base_failed, anomaly (:meth:`RuleModel.anomaly`) and kept to a table with COUNTS."""
    return (stats.withColumn("base_failed", base_failed()).withColumn("anomaly", _anomaly(model)(_stats_struct()))
            .withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= 1)))


def stats_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and COUNTS of every document, computed once (reliable checkpoint)."""
    return cut_lineage(docs.select(id_col, text_stats(F.col(text_col)).alias("_s")).select(id_col, "_s.*"))


def filter_by_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    **options) -> DataFrame:
    """The documents that pass the base rules and the calibrated forests; all columns stay."""
    model = fit_rules(stats_table(docs, id_col, text_col), labels, id_col, **options)
    passes = _passes(model)
    return with_row(docs, passes(utf8(text_col)).alias("_ok")).where("_ok").select("_row.*")


def _passes(model: RuleModel):
    """Text -> whether it passes the base rules and the forests; the counts are taken once."""
    @F.arrow_udf("boolean")
    def passes(texts: pa.Array) -> pa.Array:
        counts = np.array([text_counts(t.as_py()) for t in texts], np.int64).reshape(-1, len(COUNTS))
        words, repeated = counts[:, COUNTS.index("n_words")], counts[:, COUNTS.index("n_repeat_words")]
        ok = (words >= MIN_WORDS) & (100 * repeated <= MAX_REPEAT_PERCENT * words)
        ok[ok] = model.anomaly(feature_matrix(counts[ok])) <= 1
        return pa.array(ok)
    return passes
