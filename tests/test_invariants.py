
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from __spark_entry__ import queries
from ontime.plans.cluster import pca_project, scaled_vectors
from ontime.plans.evaluate import confusion_metrics
from ontime.sources.readers import read_table
from tests.conftest import SF_SMALL


def test_percents_add_to_100_per_carrier(spark):
    q = queries()
    for name, label in (("arrival_delay_buckets", "ArrDelayBucketMapped"), ("cancellation_causes", "TypeCause")):
        sums = q[name](spark, SF_SMALL).groupBy("name").agg(F.sum("Percent").alias("s")).collect()
        assert sums and all(abs(r.s - 100.0) < 1e-9 for r in sums), name


def test_metrics_on_a_hand_made_confusion_matrix(spark):
    # label 1: 40 rows (30 right, 10 predicted 0); label 0: 60 rows (50 right, 10 predicted 1)
    rows = [(1.0, 1.0)] * 30 + [(1.0, 0.0)] * 10 + [(0.0, 0.0)] * 50 + [(0.0, 1.0)] * 10
    got = {r.Metric: r.Performance for r in confusion_metrics(spark.createDataFrame(rows, "label double, prediction double")).collect()}
    p1, r1, p0, r0 = 30 / 40, 30 / 40, 50 / 60, 50 / 60
    f1_1, f1_0 = 2 * p1 * r1 / (p1 + r1), 2 * p0 * r0 / (p0 + r0)
    assert got["accuracy"] == pytest.approx(0.8)
    assert got["weightedPrecision"] == pytest.approx(0.4 * p1 + 0.6 * p0)
    assert got["weightedRecall"] == pytest.approx(0.4 * r1 + 0.6 * r0)
    assert got["f1"] == pytest.approx(0.4 * f1_1 + 0.6 * f1_0)


def test_roc_is_monotone_from_origin_to_one(spark):
    roc = queries()["roc_points"](spark, SF_SMALL).where("threshold is not null").orderBy(F.desc("threshold")).collect()
    fpr = [r.FPR for r in roc]
    tpr = [r.TPR for r in roc]
    assert fpr == sorted(fpr) and tpr == sorted(tpr)
    assert (fpr[-1], tpr[-1]) == (1.0, 1.0)


def test_pca_ratios_non_increasing_and_sum_to_100(spark):
    rows = queries()["pca_variance"](spark, SF_SMALL).orderBy("NPC").collect()
    vals = [r.PCValue for r in rows]
    assert all(a >= b - 1e-9 for a, b in zip(vals, vals[1:]))
    assert sum(vals) == pytest.approx(100.0)
    assert rows[-1].PCCum == pytest.approx(100.0)


def test_kmeans_centres_are_member_means(spark):
    emb = read_table(spark, SF_SMALL, "embeddings")
    projected = pca_project(scaled_vectors(emb, "embedding", keep=("vec_id",)), keep=("vec_id",))
    model = KMeans(k=4, seed=42, featuresCol="pcs").fit(projected)
    pred = model.transform(projected)
    means = (pred.groupBy("prediction")
             .agg(*[F.avg(vector_to_array("pcs")[i]).alias(f"m{i}") for i in range(3)]).collect())
    centres = model.clusterCenters()
    # centres come from the last iteration's assignment; with converged k-means they equal member means
    for r in means:
        assert [r.m0, r.m1, r.m2] == pytest.approx(list(centres[r.prediction]), abs=1e-3)


def test_silhouette_in_range(spark):
    rows = queries()["kmeans_silhouette"](spark, SF_SMALL).collect()
    assert all(-1.0 <= r.Silhouette <= 1.0 for r in rows)
    s = queries()["silhouette_given_labels"](spark, SF_SMALL).first().silhouette
    assert -1.0 <= s <= 1.0
