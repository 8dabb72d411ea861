"""Report semantics on hand-written flight rows (FIXTURES.md section 1)."""

import datetime as dt

import pytest

from ontime.plans import reports
from ontime.plans.classify import classification_set
from ontime.plans.cluster import with_delay_code

FLIGHT_COLS = ("Reporting_Airline string, Origin string, Dest string, Year int, Month int, "
               "DayofMonth int, WheelsOff int, AirTime double, ArrDelay double, Cancelled int, "
               "CancellationCode string, CarrierDelay double, WeatherDelay double, NASDelay double, "
               "SecurityDelay double, LateAircraftDelay double, DepDelay double, Distance double, "
               "TaxiIn double, TaxiOut double")
NAMES = [c.split()[0] for c in FLIGHT_COLS.split(", ")]


def flights(spark, rows):
    full = [tuple(r.get(n) for n in NAMES) for r in rows]
    return spark.createDataFrame(full, FLIGHT_COLS)


@pytest.fixture
def carriers(spark):
    return spark.createDataFrame([("AA", "American"), ("BB", "Blue")], "carrier string, name string")


@pytest.fixture
def airports(spark):
    return spark.createDataFrame(
        [("JFK", "Kennedy", -73.8, 40.6, "America/New_York"), ("LAX", "Los Angeles", -118.4, 33.9,
                                                                "America/Los_Angeles"),
         ("UTC", "Zulu", 0.0, 0.0, "UTC")],
        "iata_code string, name string, longitude_deg double, latitude_deg double, timezone string")


def test_null_delay_bucket_counts_in_denominator(spark, carriers):
    df = flights(spark, [dict(Reporting_Airline="AA", ArrDelay=v) for v in (1.0, 2.0, 20.0, None)])
    got = {r.ArrDelayBucketMapped: r.Percent for r in reports.arrival_delay_buckets(df, carriers).collect()}
    assert got == {"0 to 5 minutes": 50.0, "15 to 30 minutes": 25.0, None: 25.0}


def test_on_time_threshold(spark):
    df = flights(spark, [dict(ArrDelay=v, DepDelay=0.0, Distance=1.0, TaxiIn=1.0, TaxiOut=1.0)
                         for v in (15.0, 16.0, None)])
    assert [r.OnTime for r in classification_set(df).collect()] == [1.0, 0.0]


def test_delay_share_threshold_is_inclusive(spark):
    rows = [dict(Reporting_Airline="AA", ArrDelay=14.0, CarrierDelay=14.0),
            dict(Reporting_Airline="AA", ArrDelay=15.0, CarrierDelay=15.0, WeatherDelay=0.0)]
    got = {r.group: r.value for r in reports.delay_cause_share(flights(spark, rows), "AA").collect()}
    assert got["Carrier"] == 100.0
    assert got["Weather"] is None  # no positive minutes -> NULL share


def test_top_k_keeps_ties(spark, airports):
    rows = [dict(Origin="JFK", Dest="LAX")] * 3 + [dict(Origin="LAX", Dest="JFK")] * 3 + \
        [dict(Origin="UTC", Dest="JFK")]
    got = reports.top_routes(flights(spark, rows), airports, k=1)
    assert sorted({r.RouteID for r in got.collect()}) == ["JFKLAX", "LAXJFK"]
    assert got.count() == 4  # two end points per route


def test_route_with_null_end_counts(spark, carriers):
    rows = [dict(Reporting_Airline="AA", Origin="JFK", Dest=None),
            dict(Reporting_Airline="AA", Origin="JFK", Dest="LAX"),
            dict(Reporting_Airline="AA", Origin="JFK", Dest="LAX")]
    got = reports.routes_per_carrier(flights(spark, rows), carriers).collect()
    assert [(r.Reporting_Airline, r.n, r.name) for r in got] == [("AA", 2, "American")]


def test_cancellation_null_airline_single_group(spark, carriers):
    rows = [dict(Reporting_Airline=None, Cancelled=1, CancellationCode="A"),
            dict(Reporting_Airline=None, Cancelled=1, CancellationCode="B"),
            dict(Reporting_Airline="AA", Cancelled=1, CancellationCode="Z"),
            dict(Reporting_Airline="AA", Cancelled=0)]
    got = sorted((r.name or "", r.TypeCause or "", r.Percent)
                 for r in reports.cancellation_causes(flights(spark, rows), carriers).collect())
    assert got == [("", "Carrier", 50.0), ("", "Weather", 50.0), ("American", "", 100.0)]


def test_busiest_airport_seen_on_one_side(spark, airports):
    rows = [dict(Origin="JFK", Dest="LAX"), dict(Origin="LAX", Dest="JFK"),
            dict(Origin="UTC", Dest="JFK")]
    got = {r.Origin: (r.n_x, r.n_y, r.nTotal) for r in
           reports.busiest_airports(flights(spark, rows), airports, k=10).collect()}
    assert got == {"JFK": (1, 2, 3 / 10000), "LAX": (1, 1, 2 / 10000)}
    kept = reports.busiest_airports(flights(spark, rows), airports, k=10, coalesce_missing=True)
    assert {r.Origin for r in kept.collect()} == {"JFK", "LAX", "UTC"}


def test_cause_sum_filter(spark):
    rows = [dict(CarrierDelay=15.0, WeatherDelay=0.0, NASDelay=0.0, SecurityDelay=0.0, LateAircraftDelay=0.0),
            dict(CarrierDelay=16.0, WeatherDelay=0.0, NASDelay=0.0, SecurityDelay=0.0, LateAircraftDelay=0.0),
            dict(CarrierDelay=40.0, WeatherDelay=None, NASDelay=0.0, SecurityDelay=0.0, LateAircraftDelay=0.0)]
    got = with_delay_code(flights(spark, rows)).select("CarrierDelay", "DelayCode").collect()
    assert [(r.CarrierDelay, r.DelayCode) for r in got] == [(16.0, "Carrier")]


def test_traffic_windows_zone_and_unknown_airport(spark, airports):
    rows = [dict(Origin="JFK", Dest="LAX", Year=2013, Month=1, DayofMonth=1, WheelsOff=0, AirTime=95.0),
            dict(Origin="XXX", Dest="JFK", Year=2013, Month=1, DayofMonth=1, WheelsOff=1000, AirTime=60.0)]
    got = reports.traffic_windows(flights(spark, rows), airports, days=12, airport="JFK").collect()
    # the XXX flight has no zone -> no instant -> in no window
    assert [(r.Airport, r.window_start, r.n, r.Type) for r in got] == [
        ("JFK", dt.datetime(2012, 12, 22), 1, "Departures")]
    timed = reports.flight_instants(flights(spark, rows[:1]), airports).first()
    assert timed.ActualDepDate == dt.datetime(2013, 1, 1, 5, 0)
    assert timed.ActualArrDate == dt.datetime(2013, 1, 1, 6, 35)


def test_attribute_distribution_counts_null(spark):
    rows = [dict(CancellationCode=c) for c in ("A", "A", None)]
    got = {r.CancellationCode: r.n for r in
           reports.attribute_distribution(flights(spark, rows), "CancellationCode").collect()}
    assert got == {"A": 2, None: 1}
    with pytest.raises(ValueError):
        reports.attribute_distribution(flights(spark, rows), "nope")


def test_airport_codes_union(spark):
    rows = [dict(Origin="JFK", Dest="LAX"), dict(Origin="UTC", Dest="JFK")]
    assert sorted(r.Origin for r in reports.airport_codes(flights(spark, rows)).collect()) == \
        ["JFK", "LAX", "UTC"]
