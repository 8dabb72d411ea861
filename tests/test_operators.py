"""Operators against Spark's own implementations or brute force."""

import random

import pytest
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

from ontime.operators import (
    distinct_tuple_count,
    join_with_suffix,
    running_total,
    stratified_sample,
    top_k_with_ties,
    tumbling_count,
)
from ontime.operators.sizing import bounded_broadcast, fits, row_count_at_most
from ontime.plans.evaluate import confusion_metrics, roc_points, silhouette
from ontime.plans.ml_common import hash_split
from ontime.plans.stats import correlation_pairs, min_max_scale


def test_top_k_equals_rank_filter(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 20)) for i in range(300)] + [(999, None)]
    df = spark.createDataFrame(rows, "id int, n int")
    for k in (1, 5, 17, 400):
        want = df.where("n is not null").withColumn("rk", F.rank().over(Window.orderBy(F.desc("n")))) \
            .where(F.col("rk") <= k).select("id")
        assert sorted(r.id for r in top_k_with_ties(df, "n", k).collect()) == sorted(r.id for r in want.collect())


def test_top_k_all_ties(spark):
    df = spark.createDataFrame([(i, 5) for i in range(50)], "id int, n int")
    assert top_k_with_ties(df, "n", 3).count() == 50


def test_running_total_equals_window(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.randint(0, 500), rnd.randint(1, 9)) for _ in range(2000)], "k int, v int")
    got = {r.k: r.v_cum for r in running_total(df, "k", ["v"], keys_per_bucket=60).collect()}
    per = df.groupBy("k").agg(F.sum("v").alias("v"))
    want = {r.k: r.c for r in per.select("k", F.sum("v").over(Window.orderBy("k")).alias("c")).collect()}
    assert got == want
    down = {r.k: r.v_cum for r in running_total(df, "k", ["v"], keys_per_bucket=60, descending=True).collect()}
    want_down = {r.k: r.c for r in per.select("k", F.sum("v").over(Window.orderBy(F.desc("k"))).alias("c")).collect()}
    assert down == want_down


def test_distinct_tuples_count_null(spark):
    df = spark.createDataFrame([("x", "a", None), ("x", "a", "b"), ("x", "a", None)], "g string, a string, b string")
    assert distinct_tuple_count(df, "g", ["a", "b"]).first().n == 2


def test_full_join_suffix_and_null_keys(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    right = spark.createDataFrame([("b", 20), ("c", 30), (None, 40)], "k2 string, n int")
    got = sorted(join_with_suffix(left, right, "k", "k2", "full").collect(), key=lambda r: (r.k or "~", r.n_x or 0))
    assert [tuple(r) for r in got] == [("a", 1, None), ("b", 2, 20), ("c", None, 30), (None, None, 40), (None, 3, None)]


def test_confusion_metrics_match_evaluator(spark):
    rnd = random.Random(11)
    rows = [(float(rnd.randint(0, 2)), float(rnd.randint(0, 2))) for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = {r.Metric: r.Performance for r in confusion_metrics(df).collect()}
    for m in got:
        want = MulticlassClassificationEvaluator(metricName=m).evaluate(df)
        assert got[m] == pytest.approx(want, abs=1e-9)


def test_roc_points_brute_force(spark):
    rnd = random.Random(5)
    rows = [(round(rnd.random(), 2), rnd.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "score double, label int")
    got = sorted((r.FPR, r.TPR) for r in roc_points(df).collect())
    pos = sum(lbl for _, lbl in rows)
    neg = len(rows) - pos
    want = [(0.0, 0.0), (1.0, 1.0)]
    for t in sorted({s for s, _ in rows}):
        tp = sum(1 for s, lbl in rows if s >= t and lbl == 1)
        fp = sum(1 for s, lbl in rows if s >= t and lbl == 0)
        want.append((round(fp / neg, 10), round(tp / pos, 10)))
    assert got == sorted(want)


def test_silhouette_matches_evaluator(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(c * 3, 1.0) for _ in range(4)], c) for i in range(300) for c in [i % 3]]
    rows.append((999, [50.0, 50.0, 50.0, 50.0], 7))  # a singleton cluster scores 0
    df = spark.createDataFrame(rows, "id int, x array<double>, c int")
    got = silhouette(df, "x", "c").first().silhouette
    vec = df.select(array_to_vector("x").alias("features"), F.col("c").cast("double").alias("prediction"))
    assert got == pytest.approx(ClusteringEvaluator().evaluate(vec), abs=1e-8)


def test_min_max_matches_scaler(spark):
    rows = [(1.0, 5.0, 2.0), (3.0, 5.0, -1.0), (2.0, 5.0, 4.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = [tuple(r) for r in min_max_scale(df, ["a", "b", "c"]).collect()]
    vec = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v").transform(df)
    want = [tuple(r.s.toArray()) for r in MinMaxScaler(inputCol="v", outputCol="s").fit(vec).transform(vec).collect()]
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == pytest.approx(w, abs=1e-12)


def test_correlation_pairs_lower_triangle(spark):
    rows = [(float(i), 2.0 * i + 1, float((i * 7) % 5), 1.0) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    got = {(r.x, r.y): r.r for r in correlation_pairs(df).collect()}
    assert set(got) == {("b", "a"), ("c", "a"), ("c", "b"), ("k", "a"), ("k", "b"), ("k", "c")}
    assert got[("b", "a")] == 1.0
    assert got[("k", "a")] is None  # constant column


def test_stratified_sample_bounds_each_group(spark):
    df = spark.range(1000).withColumn("g", (F.col("id") % 3).cast("int"))
    got = stratified_sample(df, "g", 10, F.xxhash64("id"))
    assert sorted(r["count"] for r in got.groupBy("g").count().collect()) == [10, 10, 10]


def test_hash_split_is_repeatable_and_disjoint(spark):
    df = spark.range(2000)
    a1, b1 = hash_split(df.repartition(7), key_cols=["id"])
    a2, _ = hash_split(df.repartition(3), key_cols=["id"])
    ids1 = {r.id for r in a1.collect()}
    assert ids1 == {r.id for r in a2.collect()}
    assert ids1.isdisjoint({r.id for r in b1.collect()})
    assert 0.65 < len(ids1) / 2000 < 0.75


def test_tumbling_count_alignment(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2013, 1, 1, 5),), (dt.datetime(2013, 1, 2, 23, 59),), (None,)],
                               "ts timestamp_ntz")
    got = [tuple(r) for r in tumbling_count(df, "ts", 12).collect()]
    assert got == [(dt.datetime(2012, 12, 22), 2)]


def test_bounded_broadcast_checks_size(spark):
    small = spark.range(10)
    assert row_count_at_most(small, 10) and not row_count_at_most(small, 9)
    wide = small.select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    assert fits(wide, 10, 20_000) and not fits(wide, 10, 5_000) and not fits(wide, 9)
    assert not fits(small.select(F.lit(None).alias("a b")), 10, 79) and fits(small.select(F.lit(None).alias("a b")), 10, 80)
    plan_df = spark.range(100).join(bounded_broadcast(small, 5), "id")
    assert plan_df.count() == 10


def test_running_total_over_a_dst_gap(spark):
    """Wall-clock keys across a spring-forward gap keep their order in any session zone."""
    import datetime as dt
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        keys = [dt.datetime(2024, 3, 10, 1, 30), dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 3, 0),
                dt.datetime(2024, 3, 10, 3, 15)]
        df = spark.createDataFrame([(k, 1) for k in keys], "k timestamp_ntz, v int")
        got = sorted((r.k, r.v_cum) for r in running_total(df, "k", ["v"], keys_per_bucket=1).collect())
        assert [c for _, c in got] == [1, 2, 3, 4]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_lookup_same_rows_with_or_without_broadcast(spark):
    from ontime.operators import lookup

    def key(t):
        return tuple((x is None, "" if x is None else str(x)) for x in t)

    facts = spark.createDataFrame([("a", 1), ("b", 2), ("z", 3), (None, 4)], "k string, v int")
    dim = spark.createDataFrame([("a", "A"), ("b", "B")], "code string, name string")
    small = sorted((tuple(r) for r in lookup(facts, dim, "k", "code").collect()), key=key)
    forced = sorted((tuple(r) for r in lookup(facts, dim, "k", "code", max_broadcast_rows=1).collect()), key=key)
    assert small == forced
    assert small == sorted([("a", 1, "A"), ("b", 2, "B"), ("z", 3, None), (None, 4, None)], key=key)
