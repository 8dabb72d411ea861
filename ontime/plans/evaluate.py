"""Model evaluation as DataFrame plans: classification metrics (ML12),
ROC points (ML13) and silhouette (ML20).

Each one reduces the scored rows first (confusion matrix, one row per
distinct score, one row per cluster) so no step holds all rows in one task.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.operators.ranking import running_total
from ontime.session import cut_lineage

# Metric names in report order.
METRICS = ["f1", "weightedRecall", "weightedPrecision", "accuracy"]


def confusion_metrics(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                      digits: int = 10, by=(), count_col: str | None = None) -> DataFrame:
    """(*by, Metric, Performance) for f1, weightedRecall, weightedPrecision and accuracy,
    with the definitions of ``MulticlassClassificationEvaluator``:
    per-class precision / recall / F1 weighted by the class's true count.
    ``by`` gives one set of metrics per group (e.g. per model) in the same pass.
    ``count_col``: the rows are counts already (a confusion matrix)."""
    by = list(by)
    rows_of = F.sum(count_col) if count_col else F.count(F.lit(1))
    cm = pred.groupBy(*by, F.col(label_col).alias("l"), F.col(pred_col).alias("p")).agg(rows_of.cast("double").alias("n"))
    per_class = (cm.select(*by, F.inline(F.array(
        F.struct(F.col("l").alias("c"), F.col("n").alias("actual"), F.lit(0.0).alias("predicted"),
                 F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0.0).alias("tp")),
        F.struct(F.col("p").alias("c"), F.lit(0.0).alias("actual"), F.col("n").alias("predicted"),
                 F.lit(0.0).alias("tp")))))
        .groupBy(*by, "c").agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"),
                          F.sum("tp").alias("tp")))
    prec = F.when(F.col("predicted") == 0, 0.0).otherwise(F.col("tp") / F.col("predicted"))
    rec = F.when(F.col("actual") == 0, 0.0).otherwise(F.col("tp") / F.col("actual"))
    scored = per_class.select(*by, "actual", "tp", prec.alias("prec"), rec.alias("rec"))
    f1 = F.when(F.col("prec") + F.col("rec") == 0, 0.0) \
        .otherwise(2 * F.col("prec") * F.col("rec") / (F.col("prec") + F.col("rec")))
    total = F.sum("actual")
    wide = scored.groupBy(*by).agg(
        (F.sum(f1 * F.col("actual")) / total).alias("f1"),
        (F.sum(F.col("rec") * F.col("actual")) / total).alias("weightedRecall"),
        (F.sum(F.col("prec") * F.col("actual")) / total).alias("weightedPrecision"),
        (F.sum("tp") / total).alias("accuracy"))
    rows = F.array(*[F.struct(F.lit(m).alias("Metric"), F.round(F.col(m), digits).alias("Performance"))
                     for m in METRICS])
    return wide.select(*by, F.inline(rows))


def roc_points(scored: DataFrame, score_col: str = "score", label_col: str = "label",
               digits: int = 10) -> DataFrame:
    """Exact ROC curve (FPR, TPR, threshold): one point per distinct score,
    plus (0, 0) first and (1, 1) last, as Spark's binary metrics emit.

    Scores are reduced to (positives, negatives) per distinct value, then a
    bucketed running sum walks them from the highest score down. A row
    without a score or a label is on no point of the curve.
    """
    scored = scored.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
    per_score = scored.groupBy(F.col(score_col).alias("threshold")).agg(
        F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label_col) == 1, 0).otherwise(1)).alias("neg"))
    cum = running_total(per_score, "threshold", ["pos", "neg"], ["tp", "fp"], descending=True)
    totals = cum.agg(F.struct(F.sum("pos").alias("P"), F.sum("neg").alias("N"))).scalar()  # the rows are scored once
    curve = cum.select(
        F.round(F.try_divide(F.col("fp"), totals.getField("N")), digits).alias("FPR"),
        F.round(F.try_divide(F.col("tp"), totals.getField("P")), digits).alias("TPR"),
        F.col("threshold").cast("double").alias("threshold"))
    spark = scored.sparkSession
    ends = spark.createDataFrame([(0.0, 0.0, None), (1.0, 1.0, None)],
                                 "FPR double, TPR double, threshold double")
    return curve.unionByName(ends)


def _as_double_array(col):
    return F.transform(col, lambda v: v.cast("double"))


def silhouette_points(df: DataFrame, features_col: str, cluster_col: str, centres_per_block: int = 256) -> DataFrame:
    """Per-point silhouette with squared Euclidean distance (ML20).

    For a point x and cluster C, sum over y in C of |x - y|^2 is
    |C| |x|^2 + sum |y|^2 - 2 x . sum y, so only per-cluster count, sum of
    squared norms and vector sum are needed; no pairs of points are formed.
    Those k rows are packed into blocks of ``centres_per_block``; a point
    meets every block once, and its own mean and its nearest other mean are
    the smallest over the blocks, whatever k is.
    Own-cluster mean uses |C| - 1; a singleton cluster scores 0.
    """
    ftype = df.schema[features_col].dataType
    feats = F.col(features_col)
    if not isinstance(ftype, T.ArrayType):
        feats = vector_to_array(feats)
    pts = df.select(F.col(cluster_col).alias("c"), _as_double_array(feats).alias("x"))
    pts = pts.withColumn("nx", F.aggregate(F.transform("x", lambda v: v * v), F.lit(0.0),
                                           lambda a, v: a + v))
    stats = cut_lineage(pts.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum("nx").alias("y"),
                                             Summarizer.sum(array_to_vector("x")).alias("z"))
                        .select("c", "n", "y", vector_to_array("z").alias("z")))
    n_blocks = max(1, -(-stats.count() // centres_per_block))
    blocks = (stats.groupBy(F.pmod(F.xxhash64("c"), F.lit(n_blocks)).alias("__block"))
              .agg(F.collect_list(F.struct("c", "n", "y", "z")).alias("__t")))

    def mean_dist(s):
        dot = F.aggregate(F.zip_with(F.col("x"), s["z"], lambda p, q: p * q), F.lit(0.0),
                          lambda a, v: a + v)
        return s["n"] * F.col("nx") + s["y"] - 2 * dot

    if n_blocks > 1:  # equal points of a cluster have one value, so they meet the blocks once, under their content
        pts = pts.groupBy("c", "x", "nx").agg(F.count(F.lit(1)).alias("copies"))
    else:
        pts = pts.withColumn("copies", F.lit(1).cast("bigint"))
    met = (pts.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))))
           .join(blocks, "__block"))
    per = met.withColumn("d", F.transform("__t", lambda s: F.struct(
        s["c"].alias("c"), s["n"].alias("n"), mean_dist(s).alias("sum"))))
    own = F.get(F.filter("d", lambda e: e["c"] == F.col("c")), 0)
    others = F.transform(F.filter("d", lambda e: e["c"] != F.col("c")),
                         lambda e: e["sum"] / e["n"])
    per = per.select("c", "x", "copies", own.alias("own"), F.array_min(others).alias("b"))
    if n_blocks > 1:
        per = (per.groupBy("c", "x").agg(F.max("copies").alias("copies"), F.max("own").alias("own"), F.min("b").alias("b"))
               .withColumn("copies", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))))
    size = F.col("own.n")
    a = F.col("own.sum") / (size - 1)
    b = F.col("b")
    s = (F.when(size <= 1, F.lit(0.0))
         .when(a < b, 1 - a / b).when(a > b, b / a - 1).otherwise(F.lit(0.0)))
    return per.select("c", s.alias("silhouette"))


def silhouette(df: DataFrame, features_col: str, cluster_col: str, digits: int = 9) -> DataFrame:
    """Mean silhouette over all points, one row (n_points, n_clusters, silhouette)."""
    pts = silhouette_points(df, features_col, cluster_col)
    return pts.agg(F.count(F.lit(1)).alias("n_points"), F.count_distinct("c").alias("n_clusters"),
                   F.round(F.avg("silhouette"), digits).alias("silhouette"))
