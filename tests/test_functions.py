"""Scalar functions on hand-written rows (FIXTURES.md section 1)."""

import datetime as dt

from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from ontime.functions import (
    CANCELLATION_LABELS,
    DELAY_SPLITS,
    add_minutes,
    argmax_name,
    bucketize,
    delay_code,
    hhmm_timestamp,
    label_lookup,
    local_to_utc,
    matching_columns,
)
from ontime.sources.schemas import CAUSE_COLUMNS


def test_bucket_edges(spark):
    vals = [-0.5, 0.0, 4.9, 5.0, 15.0, 30.0, 60.0, 1e9, None]
    df = spark.createDataFrame([(v,) for v in vals], "ArrDelay double")
    got = [r[0] for r in df.select(bucketize(F.col("ArrDelay"))).collect()]
    assert got == [0.0, 1.0, 1.0, 2.0, 3.0, 4.0, 5.0, 5.0, None]
    ml = Bucketizer(splits=DELAY_SPLITS, inputCol="ArrDelay", outputCol="b", handleInvalid="keep")
    ref = [r.b for r in ml.transform(df.where("ArrDelay is not null")).collect()]
    assert got[:-1] == ref


def test_label_lookup_unknown_and_null(spark):
    df = spark.createDataFrame([("A",), ("D",), ("Z",), (None,)], "c string")
    got = [r[0] for r in df.select(label_lookup(F.col("c"), CANCELLATION_LABELS)).collect()]
    assert got == ["Carrier", "Security", None, None]


def test_argmax_first_wins_ties(spark):
    df = spark.createDataFrame([(3.0, 9.0, 9.0, 0.0, 0.0), (1.0, 1.0, 1.0, 1.0, 1.0),
                                (0.0, 0.0, 0.0, 0.0, 7.0)], ", ".join(f"{c} double" for c in CAUSE_COLUMNS))
    got = [r[0] for r in df.select(delay_code(argmax_name(CAUSE_COLUMNS))).collect()]
    assert got == ["Weather", "Carrier", "LateAircraft"]


def test_hhmm_values(spark):
    df = spark.createDataFrame([(2013, 1, 31, 29), (2013, 1, 31, 1530), (2013, 1, 31, 2400),
                                (2013, 1, 31, 2401), (2013, 1, 31, None)], "y int, m int, d int, w int")
    got = [r[0] for r in df.select(hhmm_timestamp(F.col("y"), F.col("m"), F.col("d"), F.col("w"))).collect()]
    assert got == [dt.datetime(2013, 1, 31, 0, 29), dt.datetime(2013, 1, 31, 15, 30),
                   dt.datetime(2013, 2, 1, 0, 0), None, None]


def test_arrival_instant_whole_minutes(spark):
    df = spark.createDataFrame([(dt.datetime(2013, 1, 1, 0, 0), 95.0)], "ts timestamp_ntz, air double")
    got = df.select(add_minutes(F.col("ts"), F.col("air"))).first()[0]
    assert got == dt.datetime(2013, 1, 1, 1, 35)


def test_local_to_utc_zone_and_null(spark):
    df = spark.createDataFrame([(dt.datetime(2013, 1, 1, 10, 0), "America/New_York"),
                                (dt.datetime(2013, 1, 1, 10, 0), "+05:00"),
                                (dt.datetime(2013, 1, 1, 10, 0), None)], "ts timestamp_ntz, tz string")
    got = [r[0] for r in df.select(local_to_utc(F.col("ts"), F.col("tz"))).collect()]
    assert got == [dt.datetime(2013, 1, 1, 15, 0), dt.datetime(2013, 1, 1, 5, 0), None]


def test_pattern_selection_case_insensitive(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5, 6)],
                               "CRSDepTime int, ArrDelay int, taxiIn int, WheelsOff int, Distance int, Origin int")
    assert matching_columns(df, ends_with=("time", "Delay"), starts_with=("Taxi", "wheels"),
                            names=("Distance",)) == ["CRSDepTime", "ArrDelay", "taxiIn", "WheelsOff", "Distance"]
