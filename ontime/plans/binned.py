"""Tree fits over counted cells instead of rows (ML8-ML10).

Spark's trees see of a row only its label and, for each feature, its bin between the split candidates that are found
first (``maxBins`` - 1 at most). Rows of the same label and bins are in the same node of every tree, so they are counted
once, and every pass of a fit reads the cells: at most ``labels * maxBins ** features``, whatever the number of rows and
their values. The cells have bin numbers as features and row counts as weights; in the fitted trees, each threshold is
then set to its split candidate, which gives the trees of a fit on the rows.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import StorageLevel, TaskContext, inheritable_thread_target
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassificationModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.plans.ml_common import MOST_PARTITIONS, ROWS_PER_PARTITION, fit_layout

# Up to so many rows (MOST_PARTITIONS full partitions of a fit input) Spark draws a forest's bootstrap row by row.
MOST_ROWS_DRAWN_SINGLY = MOST_PARTITIONS * ROWS_PER_PARTITION
# Trees of a forest that are grown at the same time: each is a row of short jobs.
TREES_AT_ONCE = 5


def candidates(values: Counter, expected: float, most: int) -> list[float]:
    """Spark's split candidates, ``most`` at most, of one feature.

    ``values``: sampled rows by value; zeros make up the ``expected`` number of rows, as in Spark, which counts the
    others only. Few values: the middle between each two; else a cut where a running count is next to a multiple of a stride.
    """
    weights = {v: float(n) for v, n in values.items() if v != 0.0}
    seen = sum(weights.values())
    if not weights:
        return []
    if expected - seen > np.finfo(float).eps * seen * 100:
        weights[0.0] = expected - seen
    at = sorted(weights)
    middles = [(a + b) / 2.0 for a, b in zip(at, at[1:])]
    if len(middles) <= most:
        return middles
    stride = expected / (most + 1)
    cuts, target, running = [], stride, weights[at[0]]
    for middle, value in zip(middles, at[1:]):
        before, running = running, running + weights[value]
        if abs(before - target) < abs(running - target):
            cuts.append(middle)
            target += stride
    return cuts


def split_candidates(points: DataFrame, rows: int, max_bins: int, seed: int) -> list[list[float]]:
    """For each column the candidates that a tree fit on these ``rows`` rows finds: from max_bins ** 2 of them (10,000 at
    least), drawn as Spark draws them, or from all."""
    max_bins = min(max_bins, rows)
    fraction = min(1.0, max(max_bins * max_bins, 10_000) / rows)
    if fraction < 1:
        spark = points.sparkSession
        drawn = points._jdf.rdd().sample(False, fraction, spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt())
        points = DataFrame(spark._jsparkSession.createDataFrame(drawn.toJavaRDD(), points._jdf.schema()), spark)
    return [candidates(Counter(column), fraction * rows, max_bins - 1) for column in zip(*points.collect())]


def bin_of(x: Column, cuts: list[float], first: int = 0) -> Column:
    """The number of ``cuts`` below ``x``, by halving."""
    if not cuts:
        return F.lit(first)
    at = len(cuts) // 2
    return F.when(x <= cuts[at], bin_of(x, cuts[:at], first)).otherwise(bin_of(x, cuts[at + 1:], first + at + 1))


def counted_cells(rows: DataFrame, cuts: list[list[float]]) -> DataFrame:
    """(label, b0, b1, ..., n): ``rows`` (label, features) counted by label and the bins of their features."""
    label, *features = rows.columns
    bins = rows.select(F.col(label).alias("label"), *[bin_of(F.col(f), c).alias(f"b{i}") for i, (f, c) in enumerate(zip(features, cuts))])
    return bins.groupBy(*bins.columns).agg(F.count(F.lit(1)).alias("n"))


def bootstrap_counts(cells: DataFrame, trees: int, seed: int) -> DataFrame:
    """``cells`` with ``drawn``: for each tree, how often the rows of the cell are in its bootstrap sample.

    A row is drawn Poisson(1) times, so n rows are drawn Poisson(n) times. The draws follow the partitions and the order
    of the cells, which depend on the cells alone (:func:`fit_layout`).
    """
    schema = T.StructType([*cells.schema.fields, T.StructField("drawn", T.ArrayType(T.LongType()))])

    def draw(batches):
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in batches:
            yield batch.assign(drawn=list(rng.poisson(batch["n"].to_numpy()[:, None], (len(batch), trees))))
    return cells.mapInPandas(draw, schema)


class BinnedRows:
    """Cells of ``rows`` (label, features: numbers), to fit tree estimators with ``max_bins`` and ``seed``.

    ``vectors``: the same rows in the same order as (features, label), as the estimators read them."""

    def __init__(self, rows: DataFrame, vectors: DataFrame, max_bins: int, seed: int):
        rows = rows.select(*[F.col(c).cast("double").alias(c) for c in rows.columns])
        self.vectors, self.rows = vectors, rows.count()
        self.cuts = split_candidates(rows.select(*rows.columns[1:]), self.rows, max_bins, seed)
        counted = counted_cells(rows, self.cuts).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            names = [f"b{i}" for i in range(len(self.cuts))]
            self.cells = fit_layout(counted, ["label", *names]).select(
                "label", array_to_vector(F.array(*[F.col(c).cast("double") for c in names])).alias("features"), "n",
            ).persist(StorageLevel.MEMORY_AND_DISK)
            found = counted.agg(F.count(F.lit(1)).alias("cells"), *[F.array_sort(F.collect_set(c)).alias(c) for c in names]).first()
            self.cells.count()
        finally:
            counted.unpersist()
        self.bins = [found[c] for c in names]
        # so many bins that the candidates in the cells are found from all of them
        self.max_bins = max(max_bins, math.isqrt(found["cells"]) + 1)

    def close(self) -> None:
        self.cells.unpersist()

    def fit(self, estimator):
        """The model of ``estimator`` on the rows."""
        if isinstance(estimator, RandomForestClassifier):
            if self.rows <= MOST_ROWS_DRAWN_SINGLY:
                return estimator.fit(self.vectors)
            return self._forest(estimator)
        return self._with_candidates(estimator, [self._fitted(estimator, self.cells, "n")])

    def _fitted(self, estimator, cells: DataFrame, weight: str):
        return estimator.copy({estimator.weightCol: weight, estimator.maxBins: self.max_bins}).fit(cells)

    def _forest(self, estimator: RandomForestClassifier) -> RandomForestClassificationModel:
        """Each tree is a forest of one on the cells, weighted by what its bootstrap sample has of them."""
        trees = estimator.getNumTrees()
        strategy = estimator.getFeatureSubsetStrategy()
        strategy = ("sqrt" if trees > 1 else "all") if strategy == "auto" else strategy
        drawn = bootstrap_counts(self.cells, trees, estimator.getSeed()).persist(StorageLevel.MEMORY_AND_DISK)
        seeds = np.random.default_rng(estimator.getSeed()).integers(2 ** 62, size=trees).tolist()

        def grow(i: int):
            one = estimator.copy({estimator.numTrees: 1, estimator.bootstrap: False, estimator.seed: seeds[i],
                                  estimator.featureSubsetStrategy: strategy})
            return self._fitted(one, drawn.select("label", "features", F.col("drawn")[i].cast("double").alias("w")), "w")
        try:
            drawn.count()
            with ThreadPoolExecutor(TREES_AT_ONCE) as pool:
                return self._with_candidates(estimator, list(pool.map(inheritable_thread_target(self.vectors.sparkSession)(grow), range(trees))))
        finally:
            drawn.unpersist()

    def _with_candidates(self, estimator, models: list):
        """One model of the trees of ``models``, whose thresholds lie between bins, with split candidates as thresholds."""
        jvm, java = self.vectors.sparkSession._jvm, [m._java_obj for m in models]
        ml, features = jvm.org.apache.spark.ml, len(self.cuts)

        def node(of):
            stats = of.impurityStats()
            getattr(stats, "rawCount_$eq")(round(stats.count()))  # rows, not cells
            if of.subtreeDepth() == 0:
                return ml.tree.LeafNode(of.prediction(), of.impurity(), stats)
            i = of.split().featureIndex()
            bins = self.bins[i]
            cut = self.cuts[i][bins[bisect_left(bins, of.split().threshold()) - 1]]
            return ml.tree.InternalNode(of.prediction(), of.impurity(), of.gain(), node(of.leftChild()), node(of.rightChild()),
                                        ml.tree.ContinuousSplit(i, cut), stats)

        def array(of, kind):
            out = self.vectors.sparkSession.sparkContext._gateway.new_array(kind, len(of))
            for i, tree in enumerate(of):
                out[i] = tree
            return out

        def classifier(tree, classes):
            return ml.classification.DecisionTreeClassificationModel(tree.uid(), node(tree.rootNode()), features, classes)
        classes = java[0].numClasses()
        if isinstance(models[0], DecisionTreeClassificationModel):
            rebuilt = DecisionTreeClassificationModel(classifier(java[0], classes))
        elif isinstance(models[0], RandomForestClassificationModel):
            trees = [classifier(tree, classes) for model in java for tree in model.trees()]
            rebuilt = RandomForestClassificationModel(ml.classification.RandomForestClassificationModel(
                estimator.uid, array(trees, ml.classification.DecisionTreeClassificationModel), features, classes))
        else:
            trees = [ml.regression.DecisionTreeRegressionModel(tree.uid(), node(tree.rootNode()), features) for tree in java[0].trees()]
            rebuilt = GBTClassificationModel(ml.classification.GBTClassificationModel(
                estimator.uid, array(trees, ml.regression.DecisionTreeRegressionModel),
                array(list(java[0].treeWeights()), jvm.double), features, classes))
        return estimator._copyValues(rebuilt)
