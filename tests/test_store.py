"""Stored tables and models: written once, read by later sessions, laid out as declared."""

import contextlib
import io

import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from __spark_entry__ import queries
from ontime.functions.argmax import argmax_name
from ontime.operators.partitions import argmax_batch, map_partitions, melt_batch
from ontime.plans import catalog
from ontime.plans.model_store import ModelStore, rows_fingerprint
from ontime.sources import driver_tables as dt
from ontime.sources.store import Layout, buckets_for, fingerprint, open_stored, stored
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def make(spark):
    return spark.range(1000).select("id", (F.col("id") % 4).cast("int").alias("Part"), F.lit("x").alias("v"))


def test_written_once_and_read_by_a_second_session(spark, tmp_path):
    made = []

    def rows():
        made.append(1)
        return make(spark)
    layout = Layout(("id",), 4, ("Part",), ("id",))
    first = stored(spark, "t", "key1", rows, layout)
    assert first.columns == ["id", "Part", "v"] and first.schema["Part"].dataType.simpleString() == "int"
    other = spark.newSession()  # an own catalog session over the same storage
    spark.sql("DROP TABLE ontime_t_key1")
    again = stored(other, "t", "key1", rows, layout)
    assert made == [1]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, make(spark).collect()))
    assert stored(spark, "t", "key2", rows, layout).count() == 1000 and made == [1, 1]


def test_an_unfinished_write_is_not_read(spark, tmp_path):
    make(spark).write.parquet(f"{tmp_path}/half/data-1")  # no manifest
    assert open_stored(spark, f"{tmp_path}/half", "half") is None


def test_partition_filter_and_buckets_show_in_the_plan(spark):
    layout = Layout(("id",), 4, ("Part",), ("id",))
    a = stored(spark, "plan_a", "k", lambda: make(spark), layout)
    b = stored(spark, "plan_b", "k", lambda: spark.range(500).select("id", F.lit(1).alias("w")), Layout(("id",), 4, (), ("id",)))
    text = plan_of(a.where("Part = 2").select("id"))
    assert "PartitionFilters: [isnotnull(Part" in text and "(Part#" in text
    assert len(a.where("Part = 2").inputFiles()) >= 1
    text = plan_of(a.join(b.hint("merge"), "id"))
    assert "Exchange" not in text.split("Initial Plan")[0] and text.count("Bucketed: true") == 2
    assert a.join(b, "id").count() == 500


def test_fact_queries_read_the_stored_table_without_a_join(spark):
    for name in ("attribute_distribution", "airport_codes", "select_patterns", "full_join_counts", "delay_cause_share"):
        text = plan_of(queries()[name](spark, SF_SMALL))
        assert "lineitem" not in text and "customer" not in text, name
        if name != "full_join_counts":
            assert "Join" not in text, name


def test_stored_fact_equals_the_view(spark):
    t = catalog.Tables(spark, SF_SMALL)
    got, want = dt.stored_flights(t, dt.fact_key(spark, SF_SMALL)), dt.flight_view(t)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert rows_fingerprint(got) == rows_fingerprint(want)


def test_bucket_join_has_no_exchange_below_it(spark):
    text = plan_of(queries()["bucket_join"](spark, SF_SMALL))
    assert "SortMergeJoin" in text and text.count("Bucketed: true") == 2
    assert text.split("(1) ")[0].count("Exchange") <= 1  # that of the five sums


def test_partial_years_prune_folders_at_run_time(spark):
    assert "dynamicpruning" in plan_of(queries()["partial_years"](spark, SF_SMALL))


def test_fingerprints(spark, tmp_path):
    make(spark).write.parquet(f"{tmp_path}/a")
    one = fingerprint(spark, [f"{tmp_path}/a"], "1")
    assert one == fingerprint(spark, [f"{tmp_path}/a"], "1") != fingerprint(spark, [f"{tmp_path}/a"], "2")
    make(spark).limit(3).write.mode("append").parquet(f"{tmp_path}/a")
    assert one != fingerprint(spark, [f"{tmp_path}/a"], "1")
    assert buckets_for(10) == 4 and buckets_for(100_000_000) == 32


def test_rows_fingerprint_sees_rows_not_layout(spark):
    rows = [(1, None, "a"), (None, 1, "a"), (1, None, "a")]
    a = spark.createDataFrame(rows, "x int, y int, z string")
    assert rows_fingerprint(a) == rows_fingerprint(a.repartition(3).orderBy("x"))
    changed = [rows[:2], [(1, None, "a"), (1, None, "a"), (1, None, "a")], [(None, 1, "a"), (None, 1, "a"), (1, None, "a")]]
    assert len({rows_fingerprint(spark.createDataFrame(r, "x int, y int, z string")) for r in [rows, *changed]}) == 4


def test_models_are_fitted_once(spark, tmp_path):
    df = spark.range(200).selectExpr("cast(id % 7 as double) a", "cast(id % 7 > 3 as double) label")
    fits = []

    def fit():
        fits.append(1)
        v = VectorAssembler(inputCols=["a"], outputCol="features")
        return {"tree": PipelineModel(stages=[v, DecisionTreeClassifier().fit(v.transform(df))])}
    store = ModelStore(spark, f"{tmp_path}/models")
    first = store.fitted("m", df, fit, depth=5)["tree"].transform(df).select("a", "prediction").collect()
    ModelStore._loaded.clear()  # as a second session, which holds nothing
    second = ModelStore(spark, f"{tmp_path}/models").fitted("m", df.repartition(3), fit, depth=5)["tree"].transform(df)
    assert fits == [1] and second.select("a", "prediction").collect() == first
    store.fitted("m", df.limit(100), fit, depth=5)
    store.fitted("m", df, fit, depth=6)
    assert fits == [1, 1, 1]
    assert store.node_tables("m", df, depth=5)["tree"].where("leftChild >= 0").count() == 1
    with pytest.raises(LookupError):
        store.node_tables("m", df, depth=9)


def test_partition_functions(spark):
    cols = ["p", "q", "r"]
    rows = [(1, 3.0, 3.0, 1.0), (2, None, 2.0, 5.0), (3, None, None, None), (4, -1.0, -2.0, None)]
    df = spark.createDataFrame(rows, "id int, p double, q double, r double").repartition(3)
    got = map_partitions(df, argmax_batch(cols, "top"), "top string, id int, p double, q double, r double", batch_rows=1)
    assert sorted(got.select("id", "top").collect()) == sorted(df.select("id", argmax_name(cols).alias("top")).collect())
    melted = map_partitions(df, melt_batch(["id"], cols, "variable", "value"), "id int, name string, value double", names={"variable": "name"})
    assert sorted(map(str, melted.collect())) == sorted(map(str, df.unpivot(["id"], cols, "name", "value").collect()))
    assert map_partitions(df.limit(0), argmax_batch(cols, "top"), "top string, id int, p double, q double, r double").collect() == []
    assert map_partitions(df, lambda b: None, "id int").collect() == []
    sizes = map_partitions(spark.range(1000), lambda b: pa.table({"n": [len(b)]}), "n int", batch_rows=64)
    assert sum(r.n for r in sizes.collect()) == 1000 and max(r.n for r in sizes.collect()) <= 64
    with pytest.raises(Exception, match="declared"):
        map_partitions(df, lambda b: b, "id int").collect()


def test_fact_rows_are_written_where_they_are_joined(spark):
    """A partition of the join has rows of one bucket, so that the wide rows need no shuffle of their own."""
    t = catalog.Tables(spark, SF_SMALL)
    f = dt.flight_view(t, 8).select(F.spark_partition_id().alias("task"), F.pmod(F.hash("l_orderkey"), F.lit(4)).alias("bucket"))
    per_task = f.groupBy("task").agg(F.count_distinct("bucket").alias("n"), F.count("*").alias("rows")).collect()
    assert len(per_task) == 8 and {r.n for r in per_task} == {1}
    assert sum(r.rows for r in per_task) == t["lineitem"].count()
    assert plan_of(dt.flight_view(t, 8)).split("(1) ")[0].count("Exchange") <= plan_of(dt.flight_view(t)).split("(1) ")[0].count("Exchange") + 2
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "200")
    assert dt.joined_partitions(other, 64) == 256 and dt.joined_partitions(other, 512) == 512
    assert dt.joined_partitions(other, 4) is None  # a small table is shuffled into few files
