"""The streaming traffic windows equal the batch report once all input is read."""

import os
import tempfile

import pytest

from ontime.plans.reports import traffic_windows
from ontime.sources.schemas import FLIGHTS_SCHEMA
from ontime.streaming import read_flight_stream, start_traffic_stream, streaming_traffic_windows


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_stream_equals_batch(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        _stream_equals_batch(spark, f"traffic_{zone.replace('/', '_')}")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def _stream_equals_batch(spark, query_name):
    src = tempfile.mkdtemp(prefix="ontime-stream-src-")
    airports = spark.createDataFrame(
        [("JFK", "Kennedy", -73.8, 40.6, "America/New_York"), ("LAX", "LA", -118.4, 33.9, "America/Los_Angeles")],
        "iata_code string, name string, longitude_deg double, latitude_deg double, timezone string")
    names = [f.name for f in FLIGHTS_SCHEMA.fields]
    batches = [
        [("JFK", "LAX", 2013, 1, d, 900 + d, 300.0) for d in range(1, 11)],
        [("LAX", "JFK", 2013, 2, d, 1400, 280.0) for d in range(1, 21)],
    ]
    for i, rows in enumerate(batches):
        full = [dict(zip(["Origin", "Dest", "Year", "Month", "DayofMonth", "WheelsOff", "AirTime"], r)) for r in rows]
        df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], FLIGHTS_SCHEMA)
        df.write.mode("overwrite").parquet(os.path.join(src, f"batch={i}"))
    stream = read_flight_stream(spark, os.path.join(src, "*"))
    counts = streaming_traffic_windows(stream, airports, days=12)
    q = start_traffic_stream(counts, query_name, output_mode="update", available_now=True,
                             memory_table=True)
    q.awaitTermination(120)
    got = {(r.Airport, r.Type, r.window_start, r.n)
           for r in spark.table(query_name).collect()}
    flights = spark.read.parquet(os.path.join(src, "*"))
    want = {(r.Airport, r.Type, r.window_start, r.n)
            for r in traffic_windows(flights, airports, days=12).collect()}
    # update mode may emit a window more than once; keep the last (largest) count
    latest = {}
    for a, t, w, n in got:
        latest[(a, t, w)] = max(n, latest.get((a, t, w), 0))
    assert {(a, t, w, n) for (a, t, w), n in latest.items()} == want


def test_stream_resumes_from_its_checkpoint(spark):
    """Append mode into Parquet, stopped and restarted on the same checkpoint:
    windows are emitted once, when the watermark has passed them, with the
    batch counts."""
    src = tempfile.mkdtemp(prefix="ontime-stream-src-")
    out = tempfile.mkdtemp(prefix="ontime-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="ontime-stream-ckpt-")
    airports = spark.createDataFrame([("JFK", "Kennedy", 0.0, 0.0, "UTC"), ("LAX", "LA", 0.0, 0.0, "UTC")],
                                     "iata_code string, name string, longitude_deg double, latitude_deg double, timezone string")
    names = [f.name for f in FLIGHTS_SCHEMA.fields]

    def land(i, month, days):
        rows = [dict(Origin="JFK", Dest="LAX", Year=2013, Month=month, DayofMonth=d, WheelsOff=1000, AirTime=60.0)
                for d in days]
        df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], FLIGHTS_SCHEMA)
        df.write.mode("overwrite").parquet(os.path.join(src, f"batch={i}"))

    def run():
        stream = read_flight_stream(spark, os.path.join(src, "*"))
        counts = streaming_traffic_windows(stream, airports, days=12, allowed_lateness="1 day")
        q = start_traffic_stream(counts, "resume_test", sink_path=out, checkpoint_location=ckpt,
                                 available_now=True)
        q.awaitTermination(120)

    land(0, 1, range(1, 29))
    run()
    land(1, 3, range(1, 29))
    run()
    got = {(r.Airport, r.Type, r.window_start, r.n) for r in spark.read.parquet(out).collect()}
    flights = spark.read.parquet(os.path.join(src, "*"))
    batch = traffic_windows(flights, airports, days=12).collect()
    done = {(r.Airport, r.Type, r.window_start, r.n) for r in batch if r.window_start.month == 1}
    assert done and done <= got
    assert len(got) == len({(a, t, w) for a, t, w, _ in got})  # each window written once
