"""Identities of fitted models, against brute force on small rows."""

import itertools

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from __spark_entry__ import queries
from ontime.plans import certificates
from ontime.plans.evaluate import roc_points
from tests.conftest import SF_SMALL


def gini(pos, n):
    return 1 - (pos / n) ** 2 - (1 - pos / n) ** 2


def test_gini_splits_equal_brute_force(spark):
    rows = [(float(x), float(y)) for x, y in [(1, 0), (1, 1), (2, 0), (2, 0), (3, 1), (5, 1), (5, 1), (8, 0)]]
    df = spark.createDataFrame([*rows, (None, 1.0), (4.0, None)], "x double, y double")
    want = {}
    n, pos = len(rows), sum(y for _, y in rows)
    for v in sorted({x for x, _ in rows})[:-1]:
        left = [y for x, y in rows if x <= v]
        right = [y for x, y in rows if x > v]
        want[v] = (len(left), len(right), gini(pos, n) - len(left) / n * gini(sum(left), len(left)) - len(right) / n * gini(sum(right), len(right)))
    got = {r.at_most: (r.n_left, r.n_right, pytest.approx(r.gain)) for r in certificates.gini_splits(df, "x", "y").collect()}
    assert want == got
    best = certificates.best_gini_split(df, "x", "y").first()
    assert best.gain == pytest.approx(max(g for _, _, g in want.values())) and best.at_most == max(want, key=lambda v: (round(want[v][2], 12), -v))
    assert certificates.best_gini_split(df.where("x = 1"), "x", "y").collect() == []
    assert certificates.best_gini_split(df.limit(0), "x", "y").collect() == []
    assert certificates.stump_left_rows(df.where("x IS NOT NULL AND y IS NOT NULL"), "x", "y").first().n_left == best.n_left


def test_areas_and_bins(spark):
    rng = np.random.default_rng(3)
    rows = [(float(round(s, 1)), float(rng.random() < s)) for s in rng.random(400)] + [(None, 1.0), (0.5, None)]
    df = spark.createDataFrame(rows, "score double, label double")
    used = [r for r in rows if None not in r]
    pairs = [(p, q) for (p, a), (q, b) in itertools.product(used, used) if a == 1 and b == 0]
    want = sum((p > q) + (p == q) / 2 for p, q in pairs) / len(pairs)
    assert certificates.exact_auc(df).first().auc == pytest.approx(want)
    # as many bins as rows: the curve is exact
    fine = certificates.binned_scores(df, bins=len(used))
    assert certificates.auc_from_bins(fine).first().auc == pytest.approx(want)
    points = {(r.FPR, r.TPR) for r in certificates.roc_from_bins(fine).collect()}
    assert points <= {(r.FPR, r.TPR) for r in roc_points(df).collect()} | {(1.0, 1.0)}
    few = certificates.binned_scores(df, bins=4)
    assert few.count() <= 4 and few.agg(F.sum(F.col("pos") + F.col("neg"))).first()[0] == len(used)
    assert certificates.binned_scores(df.limit(0)).collect() == []


def test_importances_equal_those_of_the_models(spark):
    rows = queries()["importance_from_nodes"](spark, SF_SMALL).collect()
    assert len(rows) == 12 and {r.Model for r in rows} == {"Decision Tree", "Random Forest", "Gradient Boosted Trees"}
    assert all(abs(r.importance - r.stated) < 1e-9 for r in rows)
    for model in {r.Model for r in rows}:
        assert sum(r.importance for r in rows if r.Model == model) == pytest.approx(1)


def test_kmeans_sums_fail_for_centres_that_are_no_means(spark):
    x = np.random.default_rng(1).normal(size=(60, 3))
    points = spark.createDataFrame([(Vectors.dense(v),) for v in x], ["features"])
    total = float(((x - x.mean(axis=0)) ** 2).sum())
    done = KMeans(k=3, seed=42, maxIter=100, tol=1e-9).fit(points)
    r = certificates.kmeans_sums(done, points).first()
    assert r.n_points == 60 and r.within + r.between == pytest.approx(total)
    early = certificates.kmeans_sums(KMeans(k=3, seed=42, maxIter=1, initMode="random").fit(points), points).first()
    assert early.within + early.between != pytest.approx(total, rel=1e-6)
