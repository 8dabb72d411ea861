"""Edge cases of the reports: NULL keys, odd files, sparse columns, layouts, time zones."""

import datetime as dt
import random
import subprocess
import sys

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ontime.functions.timefns import local_to_utc
from ontime.operators import join_with_suffix, running_total, union_all
from ontime.operators.ranking import numbered_rows
from ontime.plans import reports
from ontime.plans.classify import exact_roc, scored_by_all, train_classifiers
from ontime.plans.cluster import kmeans_silhouette
from ontime.plans.dashboard import FlightReports
from ontime.plans.evaluate import confusion_metrics, roc_points, silhouette
from ontime.plans.ml_common import fit_partitions, hash_split, split_label
from ontime.sources import load_flight_sources
from ontime.sources.readers import read_csv_text, unreadable_counts
from ontime.sources.schemas import FLIGHT_COLUMN_TYPES
from ontime.streaming import read_flight_stream, start_traffic_stream


@pytest.fixture
def zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda z: spark.conf.set("spark.sql.session.timeZone", z)
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("session", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_local_to_utc_in_any_session_zone(spark, zone, session):
    zone(session)
    rows = [(dt.datetime(2024, 3, 10, 4), "+05:00"), (dt.datetime(2024, 3, 10, 1, 30), "America/New_York"),
            (dt.datetime(2024, 3, 10, 3, 30), "America/New_York"), (dt.datetime(2024, 3, 10, 2, 30), "UTC"), (None, "UTC"),
            (dt.datetime(2024, 1, 1), None)]
    got = spark.createDataFrame(rows, "t timestamp_ntz, z string").select(local_to_utc(F.col("t"), F.col("z")).alias("u")).collect()
    assert [r.u for r in got] == [dt.datetime(2024, 3, 9, 23), dt.datetime(2024, 3, 10, 6, 30), dt.datetime(2024, 3, 10, 7, 30),
                                  dt.datetime(2024, 3, 10, 2, 30), None, None]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("keys", [[3, 1, None, 2, 1, None], [None, None], ["b", None, "a"], []])
def test_running_total_null_and_text_keys(spark, keys, descending):
    df = spark.createDataFrame([(k, 10 ** i) for i, k in enumerate(keys)], f"k {'string' if 'a' in keys else 'int'}, v bigint")
    got = {r.k: r.v_cum for r in running_total(df, "k", ["v"], keys_per_bucket=1, descending=descending).collect()}
    total, want = 0, {}
    for k in sorted({k for k in keys if k is not None}, reverse=descending) + ([None] if None in keys else []):
        total += sum(10 ** i for i, x in enumerate(keys) if x == k)
        want[k] = total
    assert got == want


def test_running_total_buckets_follow_the_keys(spark):
    df = spark.range(1000).select("id", F.lit(1).alias("v"))
    wide = df.select("id", F.sum("v").over(Window.orderBy("id")).alias("c"))
    for n in (7, 100, 10_000):
        got = running_total(df, "id", ["v"], keys_per_bucket=n)
        assert got.join(wide, "id").where("v_cum <> c").count() == 0 and got.count() == 1000


def test_roc_ignores_rows_without_a_score(spark):
    rows = [(0.9, 1), (0.8, 0), (None, 1), (None, 0), (0.4, 1), (0.1, 0), (0.5, None)]
    got = roc_points(spark.createDataFrame(rows, "score double, label int")).orderBy(F.desc("threshold")).collect()
    assert [(r.FPR, r.TPR) for r in got if r.threshold is not None] == [(0.0, 0.5), (0.5, 0.5), (0.5, 1.0), (1.0, 1.0)]


def test_silhouette_of_many_clusters(spark):
    rnd = random.Random(4)
    rows = [(i % 600, [rnd.gauss(i % 600, 0.1), rnd.gauss(0, 0.1)]) for i in range(1800)]
    df = spark.createDataFrame(rows, "c int, x array<double>")
    from ontime.plans.evaluate import silhouette_points
    many = {(r.c, round(r.silhouette, 9)) for r in silhouette_points(df, "x", "c", centres_per_block=50).collect()}
    one = {(r.c, round(r.silhouette, 9)) for r in silhouette_points(df, "x", "c", centres_per_block=10_000).collect()}
    assert many == one and silhouette(df, "x", "c").first().n_clusters == 600


def test_right_column_named_like_the_left_key(spark):
    left = spark.createDataFrame([("JFK", 1)], "Origin string, n int")
    right = spark.createDataFrame([("JFK", "else", 2)], "code string, Origin string, n int")
    got = join_with_suffix(left, right, "Origin", "code")
    assert got.columns == ["Origin", "n_x", "Origin_y", "n_y"] and tuple(got.first()) == ("JFK", 1, "else", 2)
    assert got.select("Origin").first().Origin == "JFK"


def test_whole_numbers_with_decimals_and_lost_values(spark, tmp_path):
    (tmp_path / "f.csv").write_text("Year,WheelsOff,ArrDelay,Origin\n2013,1530.00,4,JFK\n2013,15.5,x,LAX\n,,,\n")
    text = read_csv_text(spark, str(tmp_path / "f.csv"))
    from ontime.sources import read_flights_csv
    rows = read_flights_csv(spark, str(tmp_path / "f.csv")).collect()
    assert [(r.Year, r.WheelsOff, r.ArrDelay) for r in rows] == [(2013, 1530, 4.0), (2013, None, None), (None, None, None)]
    lost = {r.column: r.n for r in unreadable_counts(text, FLIGHT_COLUMN_TYPES).collect()}
    assert lost == {"Year": 0, "WheelsOff": 1, "ArrDelay": 1}


def test_csv_stream_reads_by_header(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("Dest,ArrDelay,Origin,Year\nLAX,5,JFK,2013\n")
    stream = read_flight_stream(spark, str(tmp_path / "in"), "csv")
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    r = spark.read.parquet(str(tmp_path / "out")).first()
    assert (r.Origin, r.Dest, r.Year, r.ArrDelay) == ("JFK", "LAX", 2013, 5.0)
    with pytest.raises(ValueError):
        start_traffic_stream(stream, "no_sink")


def test_one_carrier_without_late_flights(spark):
    schema = "Reporting_Airline string, ArrDelay double, CarrierDelay double, WeatherDelay double, NASDelay double, " \
             "SecurityDelay double, LateAircraftDelay double"
    df = spark.createDataFrame([("AA", 3.0, 1.0, 0.0, 0.0, 0.0, 0.0), ("BB", 20.0, 5.0, 0.0, 5.0, 0.0, 10.0)], schema)
    assert [r.value for r in reports.delay_cause_share(df, "AA").collect()] == [None] * 5
    assert [r.value for r in reports.delay_cause_share(df, "BB").collect()] == [25.0, None, 25.0, None, 50.0]


def sparse_flights(tmp_path, n=120):
    """A 58-column file: four diversion columns are always empty, others are filled."""
    names = list(FLIGHT_COLUMN_TYPES)
    names += [f"Extra{i}" for i in range(58 - len(names))]
    rnd, lines = random.Random(0), [",".join(names)]
    for _ in range(n):
        row = {c: str(rnd.randint(1, 60)) for c in names}
        row |= {"Year": "2013", "FlightDate": "2013-01-05", "Origin": "JFK", "Dest": "LAX", "Reporting_Airline": "AA", "Cancelled": "0.00"}
        row |= {c: "" for c in names if c.startswith(("Div1", "Div2"))}
        lines.append(",".join(row[c] for c in names))
    (tmp_path / "f.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "a.csv").write_text("carrier,name\nAA,American\n")
    (tmp_path / "p.csv").write_text("iata_code,name,latitude_deg,longitude_deg,timezone\nJFK,K,1,2,UTC\nLAX,L,3,4,UTC\n")
    return [str(tmp_path / f) for f in ("f.csv", "a.csv", "p.csv")]


def test_reports_on_a_file_with_empty_columns(spark, tmp_path):
    flights, carriers, airports = load_flight_sources(spark, *sparse_flights(tmp_path), cache=False, views=False)
    assert len(flights.columns) == 58
    named = ["ArrDelay", "DepDelay", "Distance", "TaxiIn", "TaxiOut"]
    r = FlightReports(spark, flights, carriers, airports, columns=named)
    assert r.correlation_matrix().count() == 10
    assert r.cluster_features().count() > 0 and r.pca_variance().count() == 5
    assert [x.NumberCluster for x in r.silhouette_by_k(ks=[2, 3]).collect()] == [2, 3]
    assert r.cluster_sample(k=2).count() > 0
    r.close()
    every = FlightReports(spark, flights, carriers, airports)
    for report in (every.correlation_matrix, every.cluster_features, every.pca_variance):
        with pytest.raises(ValueError, match="Div1TotalGTime: 120, .*Div2TotalGTime: 120"):
            report()


def test_split_without_a_key_ignores_the_layout(spark):
    df = spark.range(3000).select((F.col("id") % 40).cast("double").alias("a"), (F.col("id") % 3).cast("string").alias("b"))
    parts = []
    for n in (3, 7):
        train, test = hash_split(df.repartition(n))
        assert train.count() + test.count() == 3000 and 0.65 < train.count() / 3000 < 0.75
        parts.append(sorted((r.a, r.b, r["count"]) for r in train.groupBy("a", "b").count().collect()))
    assert parts[0] == parts[1]


def test_split_label_is_the_split(spark):
    df = spark.range(500).withColumn("s", split_label("id"))
    train, test = hash_split(df, ["id"])
    assert {r.s for r in train.collect()} == {"training"} and {r.s for r in test.collect()} == {"testing"}


def test_fits_do_not_depend_on_the_layout(spark):
    rnd = random.Random(8)
    rows = [(float(rnd.random() < 0.3 + 0.4 * (a > 0)), a, rnd.gauss(0, 1), float(rnd.randint(0, 3)), rnd.gauss(0, 1))
            for a in (rnd.gauss(0, 1) for _ in range(400))]
    df = spark.createDataFrame(rows, "OnTime double, DepDelay double, Distance double, TaxiIn double, TaxiOut double")
    forests, scores = [], []
    pcs = df.select(F.col("DepDelay").alias("PC1"), F.col("Distance").alias("PC2"), F.col("TaxiOut").alias("PC3"))
    from pyspark.ml.functions import array_to_vector
    pcs = pcs.withColumn("pcs", array_to_vector(F.array("PC1", "PC2", "PC3")))
    for n in (1, 2, 4):
        if n != 2:
            models = train_classifiers(df.repartition(n))
            forests.append(models["Random Forest"].stages[-1].featureImportances.toArray().tolist())
        scores.append([r.Silhouette for r in kmeans_silhouette(spark, pcs.repartition(n), ks=[2, 3]).orderBy("NumberCluster").collect()])
    assert forests[0] == forests[1] and scores[0] == scores[1] == scores[2]
    assert fit_partitions(10) == 1 and fit_partitions(10 ** 6) == 20 and fit_partitions(10 ** 11) == 20_000
    # one pass over the test rows gives what each model gives on its own
    one = {(r.Classifier, r.Metric): r.Performance for r in confusion_metrics(scored_by_all(models, df), by=["Classifier"]).collect()}
    for name, model in models.items():
        for r in confusion_metrics(model.transform(df)).collect():
            assert one[name, r.Metric] == r.Performance
    assert exact_roc(models, df).where("threshold IS NOT NULL").count() > 100


def test_union_by_name_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert sorted(map(str, map(tuple, union_all(a, b).collect()))) == ["(1, 'x', None)", "(None, 'y', 2.0)"]


def test_command_line_on_an_empty_configuration(tmp_path):
    """No spark.checkpoint.dir anywhere: the report still runs."""
    f, a, p = sparse_flights(tmp_path, 5)
    env = {**__import__("os").environ, "SPARK_CONF_DIR": str(tmp_path / "noconf")}
    (tmp_path / "noconf").mkdir()
    for extra in (["--report", "top_routes", "--k", "1"], ["--report", "correlation_matrix", "--columns", "ArrDelay,Distance"]):
        done = subprocess.run([sys.executable, "-m", "ontime", "--flights", f, "--carriers", a, "--airports", p, "--master", "local[2]",
                               *extra], capture_output=True, text=True, env=env, timeout=170,
                              cwd=__import__("os").path.dirname(__import__("os").path.dirname(__file__)))
        assert done.returncode == 0, done.stderr[-1500:]


def test_fit_partitions_stay_few_on_large_inputs():
    """Hundreds of jobs per fit: 1 GB had 504 partitions and 6 GB 2,000, so many answers to the driver for each job."""
    assert fit_partitions(25_200_000) <= 96 and fit_partitions(151_000_000) <= 96
    assert fit_partitions(4_800_000) == 96 and fit_partitions(4_700_000) == 94


def test_copies_are_written_out_in_many_tasks(spark):
    """Adaptive execution puts few small counted rows into one task; their copies must not stay there."""
    df = spark.range(40_000).select((F.col("id") % 40).alias("a"), F.when(F.col("id") % 40 == 7, F.lit(None)).otherwise(1.5).alias("b"))
    got = numbered_rows(df, copies_per_block=300).withColumn("task", F.spark_partition_id())
    tasks = [r["count"] for r in got.groupBy("task").count().collect()]
    assert len(tasks) == 4 and max(tasks) < 20_000
    assert max(r["count"] for r in numbered_rows(df.where("a = 7"), copies_per_block=100).groupBy(F.spark_partition_id()).count().collect()) < 900
    assert got.columns[:3] == ["a", "b", "__copy"]
    per_row = got.groupBy("a", "b").agg(F.count("*").alias("n"), F.count_distinct("__copy").alias("d"), F.min("__copy").alias("lo"),
                                        F.max("__copy").alias("hi")).collect()
    assert len(per_row) == 40 and all((r.n, r.d, r.lo, r.hi) == (1000, 1000, 1, 1000) for r in per_row)
