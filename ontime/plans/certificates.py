"""What fitted models must satisfy, as plans over the data (ML7, ML8, ML13, ML14, ML17, ML19).

A fit has no SQL form, but each has an identity whose other side is a plain
aggregate: the score equations of a logistic model, the best Gini split by
counting, importances from the node table of a saved tree, the moments of a
covariance spectrum, the sums of squares about k-means centres.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime.operators.ranking import running_total
from ontime.session import cut_lineage


def score_equations(model: PipelineModel, training: DataFrame, label: str, features: list[str],
                    tolerance: float = 1e-3) -> DataFrame:
    """(feature, observed, fitted, solved): sum of y * x and of p * x over the training rows, the constant 1 included.

    At the optimum of an unpenalised logistic fit both are equal for every
    feature (the gradient is zero). ``solved``: equal within ``tolerance`` of the
    sum of |x|. One pass, one aggregate.
    """
    formula, fitted = model.stages[0], model.stages[-1]
    scored = fitted.transform(formula.transform(training)).select(
        F.col("label").alias("__y"), vector_to_array(fitted.getProbabilityCol())[1].alias("__p"), *features)
    terms = {"(constant)": F.lit(1.0), **{f: F.col(f).cast("double") for f in features}}
    wide = scored.agg(*[agg.alias(f"{kind}{i}") for i, x in enumerate(terms.values()) for kind, agg in (
        ("o", F.sum(F.col("__y") * x)), ("f", F.sum(F.col("__p") * x)), ("s", F.sum(F.abs(x))))])
    rows = [F.struct(F.lit(name).alias("feature"), F.col(f"o{i}").alias("observed"), F.col(f"f{i}").alias("fitted"),
                     (F.abs(F.col(f"o{i}") - F.col(f"f{i}")) <= tolerance * F.col(f"s{i}")).alias("solved"))
            for i, name in enumerate(terms)]
    return wide.select(F.inline(F.array(*rows)))


def gini_splits(df: DataFrame, feature: str, label: str) -> DataFrame:
    """Every binary split ``feature <= at_most`` with its Gini gain: (feature, at_most, n_left, n_right, gain).

    The rows are reduced to one histogram row per value (map-side first); running
    totals over the values give both sides of every split, so the search is
    exhaustive without another look at the rows, for any number of values.
    """
    one = F.when(F.col(label) == 1, 1).otherwise(0)
    rows = df.where(F.col(feature).isNotNull() & F.col(label).isNotNull())
    hist = rows.groupBy(F.col(feature).cast("double").alias("at_most")).agg(F.count(F.lit(1)).alias("n"), F.sum(one).alias("pos"))
    cum = cut_lineage(running_total(hist, "at_most", ["n", "pos"], ["nl", "pl"]))
    total = cum.agg(F.sum("n").alias("n_all"), F.sum("pos").alias("p_all"))

    def gini(pos, n):
        return 1 - (pos / n) * (pos / n) - ((n - pos) / n) * ((n - pos) / n)
    nl, pl, n, p = (F.col(c).cast("double") for c in ("nl", "pl", "n_all", "p_all"))
    gain = gini(p, n) - nl / n * gini(pl, nl) - (n - nl) / n * gini(p - pl, n - nl)
    return (cum.crossJoin(F.broadcast(total)).where(F.col("nl") < F.col("n_all"))  # one row of totals
            .select(F.lit(feature).alias("feature"), "at_most", F.col("nl").alias("n_left"),
                    (F.col("n_all") - F.col("nl")).alias("n_right"), gain.alias("gain")))


def best_gini_split(df: DataFrame, feature: str, label: str, digits: int = 12) -> DataFrame:
    """The split of largest gain (rounded to ``digits``), the smallest value on ties: one row, or none."""
    best = F.max(F.struct(F.round("gain", digits).alias("gain"), (-F.col("at_most")).alias("low"), "n_left", "n_right"))
    return (gini_splits(df, feature, label).agg(best.alias("b")).where("b IS NOT NULL")
            .select(F.lit(feature).alias("feature"), (-F.col("b.low")).alias("at_most"), "b.n_left", "b.n_right", "b.gain"))


def stump_left_rows(df: DataFrame, feature: str, label: str, max_bins: int = 1024) -> DataFrame:
    """One row (n_left): rows left of the split that a depth-one tree fits; all rows if it makes none.

    A regression tree on the 0/1 label: its variance is half the Gini impurity, so it takes the same split, and
    it keeps a split whose sides name the same class, which a classifier drops. Exact while the values fit ``max_bins``.
    """
    vectors = VectorAssembler(inputCols=[feature], outputCol="__x").transform(df.na.drop("any", subset=[feature, label]))
    tree = DecisionTreeRegressor(maxDepth=1, maxBins=max_bins, featuresCol="__x", labelCol=label, seed=42).fit(vectors)
    sides = tree.transform(vectors).groupBy("prediction").agg(F.min(feature).alias("low"), F.count(F.lit(1)).alias("n"))
    return sides.agg(F.min_by("n", "low").alias("n_left"))


def importance_from_nodes(tables: dict[str, DataFrame], features: list[str]) -> DataFrame:
    """(Model, feature, importance) from the node tables of saved tree models.

    A split's weight is its gain times its node's rows, summed per tree and
    feature. Forests (and single trees) scale each tree to 1 before they add
    trees up, boosted trees do not; at last a model's weights are scaled to 1.
    """
    parts = []
    for model, table in tables.items():
        ensemble = "nodeData" in table.columns
        n = table.select(F.col("treeID").alias("tree"), "nodeData.*") if ensemble else table.select(F.lit(0).alias("tree"), "*")
        boosted = F.lit(model == "Gradient Boosted Trees")
        stats = F.col("impurityStats")
        # a class count for each label, or (rows, sum, sum of squares) of a regression tree
        rows = F.when(boosted, stats[0]).otherwise(F.aggregate(stats, F.lit(0.0), lambda a, v: a + v))
        parts.append(n.where("leftChild >= 0").select(
            F.lit(model).alias("Model"), "tree", F.col("split.featureIndex").alias("at"), (F.col("gain") * rows).alias("w"),
            boosted.alias("boosted")))
    per_tree = reduce(DataFrame.unionByName, parts).groupBy("Model", "boosted", "tree", "at").agg(F.sum("w").alias("w"))
    tree_sum = F.sum("w").over(Window.partitionBy("Model", "tree"))  # a few numbers per tree
    scaled = per_tree.select("Model", "at", F.when(F.col("boosted") | (tree_sum == 0), F.col("w")).otherwise(F.col("w") / tree_sum).alias("w"))
    summed = scaled.groupBy("Model", "at").agg(F.sum("w").alias("w"))
    shares = summed.select("Model", "at", F.try_divide("w", F.sum("w").over(Window.partitionBy("Model"))).alias("importance"))
    names = F.array(*[F.lit(f) for f in features])
    every = shares.select("Model").distinct().select("Model", F.posexplode(names).alias("at", "feature"))
    return (every.join(shares, ["Model", "at"], "left")
            .select("Model", "feature", F.coalesce("importance", F.lit(0.0)).alias("importance")))


def binned_scores(scored: DataFrame, score_col: str = "score", label_col: str = "label", bins: int = 1000) -> DataFrame:
    """(bin, at_least, pos, neg): scores from the highest down in at most ``bins`` bins of about equal weight.

    A bin holds whole score values; a value belongs to the bin in which its first
    row falls. Rows are summed per value, running totals give each value its
    place, and bins are sums again: bins of parts of the data can be merged.
    """
    rows = scored.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
    one = F.when(F.col(label_col) == 1, 1).otherwise(0)
    values = rows.groupBy(F.col(score_col).cast("double").alias("at_least")).agg(F.sum(one).alias("pos"), F.count(F.lit(1)).alias("n"))
    cum = cut_lineage(running_total(values, "at_least", ["pos", "n"], ["tp", "seen"], descending=True))
    total = cum.agg(F.sum("n").alias("total"))
    place = F.floor((F.col("seen") - F.col("n")) * bins / F.col("total")).cast("int")
    return (cum.crossJoin(F.broadcast(total)).groupBy(place.alias("bin"))  # one row of totals
            .agg(F.min("at_least").alias("at_least"), F.sum("pos").alias("pos"), (F.sum("n") - F.sum("pos")).alias("neg")))


def roc_from_bins(binned: DataFrame, digits: int = 10) -> DataFrame:
    """ROC points (FPR, TPR, threshold) at the lower ends of bins; bins of one table at most, so one window is enough."""
    down = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    return binned.select(
        F.round(F.try_divide(F.sum("neg").over(down), F.sum("neg").over(whole)), digits).alias("FPR"),
        F.round(F.try_divide(F.sum("pos").over(down), F.sum("pos").over(whole)), digits).alias("TPR"),
        F.col("at_least").alias("threshold"))


def auc_from_bins(binned: DataFrame) -> DataFrame:
    """One row (auc): the area under the curve through the bins' ends (trapezoids)."""
    down = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    steps = binned.select("neg", "pos", F.sum("pos").over(down).alias("tp"))
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    return steps.agg(F.try_divide(area, F.sum("neg") * F.sum("pos")).alias("auc"))


def exact_auc(scored: DataFrame, score_col: str = "score", label_col: str = "label") -> DataFrame:
    """One row (auc) of the exact curve: ties count half. Running totals over the values, no pairs."""
    rows = scored.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
    one = F.when(F.col(label_col) == 1, 1).otherwise(0)
    values = rows.groupBy(F.col(score_col).cast("double").alias("s")).agg(F.sum(one).alias("pos"), F.sum(1 - one).alias("neg"))
    cum = running_total(values, "s", ["pos", "neg"], ["tp", "fp"], descending=True)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    return cum.agg(F.try_divide(area, F.sum("neg") * F.sum("pos")).alias("auc"))


def spectrum_moments(variance: DataFrame) -> DataFrame:
    """(components, first, second) of the shares of a spectrum (R17's PCValue, percent).

    The first moment is 1; the second is the squared Frobenius norm of the
    covariance matrix over its squared trace, which needs no eigenvalue.
    """
    share = F.col("PCValue") / 100
    return variance.agg(F.count(F.lit(1)).alias("components"), F.sum(share).alias("first"), F.sum(share * share).alias("second"))


def kmeans_sums(model: KMeansModel, points: DataFrame, features_col: str = "features") -> DataFrame:
    """(n_points, within, between): squared distances to the own centre, and of the centres to the mean of all points.

    They add up to the total sum of squares only if every centre is the mean of
    its members, which is what a converged fit promises.
    """
    own = model.transform(points.select(features_col)).select(vector_to_array(features_col).alias("x"), "prediction")
    centres = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in model.clusterCenters()])

    def squared(a, b):
        return F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v)
    width = len(model.clusterCenters()[0])
    mean = points.select(vector_to_array(features_col).alias("x")).agg(F.array(*[F.avg(F.col("x")[i]) for i in range(width)]).alias("m"))
    centre = F.element_at(centres, F.col("prediction") + 1)
    return (own.crossJoin(F.broadcast(mean))  # one row
            .agg(F.count(F.lit(1)).alias("n_points"), F.sum(squared(F.col("x"), centre)).alias("within"),
                 F.sum(squared(centre, F.col("m"))).alias("between")))
