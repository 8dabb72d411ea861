"""The report facade over flight-shaped sources, and a skewed carrier."""

from pyspark.sql import functions as F

from ontime.plans.dashboard import FlightReports
from ontime.plans.reports import arrival_delay_buckets
from ontime.sources import driver_tables as dt
from ontime.sources.readers import load_tables
from tests.conftest import SF_SMALL


def test_facade_runs_every_report(spark):
    t = load_tables(spark, SF_SMALL, ["lineitem", "orders", "customer", "supplier", "nation"])
    flights = dt.flight_view(t).withColumns({
        "WheelsOff": F.col("l_linenumber") * 100 + 5, "AirTime": F.col("DepDelay") + 60.0})
    r = FlightReports(spark, flights, dt.carriers_view(t), dt.airports_view(t))
    assert r.arrival_delay_buckets().count() > 0
    assert r.top_routes(10).count() >= 20
    assert r.busiest_airports(5).count() >= 5
    windows = r.traffic_windows(days=12)
    assert windows.agg(F.sum("n")).first()[0] == 2 * flights.count()  # every flight leaves and lands
    assert r.correlation_matrix().count() == 18 * 17 // 2
    assert r.pca_variance().count() == 7  # ArrDelay, DepDelay, Distance, TaxiIn, TaxiOut, WheelsOff, AirTime
    assert r.silhouette_by_k(ks=[2, 3]).count() == 2
    assert r.cluster_sample(k=3).groupBy("prediction").count().count() <= 3
    r.close()


def test_fit_on_training_only(spark):
    t = load_tables(spark, SF_SMALL, ["lineitem", "orders", "customer", "supplier", "nation"])
    r = FlightReports(spark, dt.flight_view(t), dt.carriers_view(t), dt.airports_view(t), fit_on_training=True)
    sil = r.silhouette_by_k(ks=[2, 3]).collect()
    assert [x.NumberCluster for x in sil] == [2, 3] and all(-1 <= x.Silhouette <= 1 for x in sil)
    sample = r.cluster_sample(k=2)
    assert set(sample.columns) >= {"PC1", "PC2", "PC3", "prediction", "Cluster"}
    assert sample.count() > 0
    r.close()


def test_hot_carrier_gives_same_shares(spark):
    """One carrier holding a third of all rows: shares still sum to 100 per carrier."""
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 97).cast("string"))
        .alias("Reporting_Airline"),
        ((F.col("id") * 7919) % 120 - 30).cast("double").alias("ArrDelay"))
    carriers = spark.createDataFrame([("HOT", "Hot Air")], "carrier string, name string")
    shares = arrival_delay_buckets(hot, carriers)
    total = shares.where(F.col("name") == "Hot Air").agg(F.sum("Percent")).first()[0]
    assert abs(total - 100.0) < 1e-9
