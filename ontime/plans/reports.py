"""The dashboard's relational reports R1-R10 on the flight schema.

Inputs: ``flights`` (fact), ``carriers`` (carrier, name), ``airports``
(iata_code, name, longitude_deg, latitude_deg, timezone). Each report
returns a DataFrame; nothing fact-sized is collected. Building one may run
small jobs: the bounded size probe of a lookup table before a broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.functions.buckets import DELAY_SPLITS, bucketize
from ontime.functions.columns import resolve_column
from ontime.functions.labels import (
    CANCELLATION_LABELS,
    CAUSE_NAMES,
    DELAY_BUCKET_LABELS,
    label_lookup,
)
from ontime.functions.timefns import add_minutes, hhmm_timestamp, local_to_utc
from ontime.operators.aggregates import (
    conditional_sums,
    distinct_tuple_count,
    frequency,
    percent_of_group,
    share_of,
    unpivot,
)
from ontime.operators.joins import key_union, lookup
from ontime.operators.ranking import top_k_with_ties
from ontime.operators.windows import tumbling_count
from ontime.sources.schemas import CAUSE_COLUMNS

AIRLINE = "Reporting_Airline"


def attribute_distribution(flights: DataFrame, column: str) -> DataFrame:
    """(value of ``column``, n) for any column, NULL included."""
    return frequency(flights, resolve_column(flights, column))


def airport_codes(flights: DataFrame) -> DataFrame:
    """R2: every airport code seen as origin or destination."""
    return key_union(flights, "Origin", "Dest", "Origin")


def carrier_codes(flights: DataFrame) -> DataFrame:
    """Distinct carrier codes."""
    return flights.select(AIRLINE).distinct()


def flight_instants(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """UTC take-off from date + WheelsOff in the origin's zone, and
    landing = take-off + AirTime. Unknown origin zone -> NULL instants."""
    zones = airports.select("iata_code", "timezone")
    fl = lookup(flights, zones, "Origin", "iata_code")
    local = hhmm_timestamp(F.col("Year"), F.col("Month"), F.col("DayofMonth"), F.col("WheelsOff"))
    dep = local_to_utc(local, F.col("timezone"))
    return (fl.withColumn("ActualDepDate", dep)
            .withColumn("ActualArrDate", add_minutes(F.col("ActualDepDate"), F.col("AirTime"))))


def missing_zone_count(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Q9 companion: flights whose take-off instant is NULL (origin not in the
    airport table, no zone, or an invalid hhmm) and so fall in no window."""
    timed = flight_instants(flights.select("Origin", "Year", "Month", "DayofMonth", "WheelsOff",
                                           "AirTime"), airports)
    return timed.agg(F.count_if(F.col("ActualDepDate").isNull()).alias("dropped"),
                     F.count(F.lit(1)).alias("flights"))


def traffic_legs(flights: DataFrame, airports: DataFrame, airport=None) -> DataFrame:
    """Each flight as a departure row at its origin and an arrival row at its
    destination: (Airport, ts, Type), rows without an instant dropped."""
    cols = flights.select("Origin", "Dest", "Year", "Month", "DayofMonth", "WheelsOff", "AirTime")
    if airport is not None:
        cols = cols.where((F.col("Origin") == F.lit(airport)) | (F.col("Dest") == F.lit(airport)))
    timed = flight_instants(cols, airports)
    legs = timed.select(F.inline(F.array(
        F.struct(F.col("Origin").alias("Airport"), F.col("ActualDepDate").alias("ts"),
                 F.lit("Departures").alias("Type")),
        F.struct(F.col("Dest").alias("Airport"), F.col("ActualArrDate").alias("ts"),
                 F.lit("Arrivals").alias("Type")))))
    legs = legs.where(F.col("Airport").isNotNull() & F.col("ts").isNotNull())
    if airport is not None:
        legs = legs.where(F.col("Airport") == F.lit(airport))
    return legs


def traffic_windows(flights: DataFrame, airports: DataFrame, days: int = 12,
                    airport=None) -> DataFrame:
    """Take-offs and landings per ``days``-wide tumbling window.

    With ``airport`` the report of that one airport; without, every airport
    at once (column ``Airport``). One scan: each flight becomes a departure
    row and an arrival row, then a single aggregate counts (Airport, Type,
    window).
    """
    legs = traffic_legs(flights, airports, airport)
    return (legs.groupBy("Airport", "Type", F.window("ts", f"{int(days)} days").alias("w"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("Airport", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n", "Type"))


def routes_per_carrier(flights: DataFrame, carriers: DataFrame, route=("Origin", "Dest")) -> DataFrame:
    """Distinct routes per carrier (NULL end points count), with its name."""
    counts = distinct_tuple_count(flights, AIRLINE, list(route))
    return lookup(counts, carriers, AIRLINE, "carrier")


def cancellation_causes(flights: DataFrame, carriers: DataFrame) -> DataFrame:
    """Share of each cancellation code among a carrier's cancelled flights."""
    cancelled = flights.where(F.col("Cancelled") == 1)
    counts = frequency(cancelled, AIRLINE, "CancellationCode")
    shares = percent_of_group(counts, AIRLINE).withColumn(
        "TypeCause", label_lookup(F.col("CancellationCode"), CANCELLATION_LABELS))
    return lookup(shares, carriers, AIRLINE, "carrier").select("name", "Percent", "TypeCause")


def delay_cause_share(flights: DataFrame, carrier=None, min_delay: float = 15.0) -> DataFrame:
    """Per carrier, each cause's positive minutes as % of total ArrDelay
    over flights with ArrDelay >= min_delay. One pass for all five causes
    (and all carriers unless ``carrier`` is given). One carrier always has
    five rows, with NULL shares if none of its flights is late."""
    late = flights.where(F.col("ArrDelay") >= min_delay)
    total = {"ArrDelay": "__total"}
    if carrier is None:
        sums = conditional_sums(late, CAUSE_COLUMNS, group_cols=[AIRLINE], plain=total)
    else:
        code = F.lit(carrier).cast(flights.schema[AIRLINE].dataType)
        sums = conditional_sums(late.where(F.col(AIRLINE) == code), CAUSE_COLUMNS, plain=total).withColumn(AIRLINE, code)
    shares = sums.select(AIRLINE, *[share_of(F.col(c), F.col("__total")).alias(c) for c in CAUSE_COLUMNS])
    return unpivot(shares, [AIRLINE], CAUSE_COLUMNS, CAUSE_NAMES, "group", "value")


def arrival_delay_buckets(flights: DataFrame, carriers: DataFrame, splits=DELAY_SPLITS,
                          labels=DELAY_BUCKET_LABELS) -> DataFrame:
    """Share of each arrival-delay bucket among all of a carrier's flights
    (cancelled and NULL-delay flights included in the denominator).

    The buckets are known from the splits, so one aggregate per carrier
    counts every bucket, the NULL bucket and the total at once: a single
    shuffle of (carriers x tasks) partial rows, no second pass for totals.
    Only buckets that occur produce a row, as with a group count.
    """
    n_buckets = len(splits) - 1
    bucketed = flights.select(AIRLINE, bucketize(F.col("ArrDelay"), splits).alias("b"))
    wide = bucketed.groupBy(AIRLINE).agg(
        *[F.count_if(F.col("b") == float(i)).alias(f"b{i}") for i in range(n_buckets)],
        F.count_if(F.col("b").isNull()).alias("b_null"),
        F.count(F.lit(1)).alias("total"))
    cells = [F.struct(F.lit(float(i)).alias("ArrDelayBucket"), F.col(f"b{i}").alias("n"))
             for i in range(n_buckets)]
    cells.append(F.struct(F.lit(None).cast("double").alias("ArrDelayBucket"), F.col("b_null").alias("n")))
    shares = (wide.select(AIRLINE, "total", F.inline(F.array(*cells)))
              .where(F.col("n") > 0)
              .select(AIRLINE, (F.col("n") / F.col("total") * 100).alias("Percent"),
                      label_lookup(F.col("ArrDelayBucket"), labels).alias("ArrDelayBucketMapped")))
    return lookup(shares, carriers, AIRLINE, "carrier").select("name", "Percent", "ArrDelayBucketMapped")


def top_routes(flights: DataFrame, airports: DataFrame, k: int = 25) -> DataFrame:
    """The k busiest (Origin, Dest) pairs, ties kept, one row per end point
    with the airport's coordinates."""
    counts = frequency(flights, "Origin", "Dest")
    top = top_k_with_ties(counts, "n", k)
    ends = top.select(
        F.concat_ws("", F.col("Origin").cast("string"), F.col("Dest").cast("string")).alias("RouteID"),
        F.explode(F.array(F.col("Origin"), F.col("Dest"))).alias("AirportID"))
    return lookup(ends, airports, "AirportID", "iata_code").select(
        "RouteID", "longitude_deg", "latitude_deg", "name")


def airport_counts(flights: DataFrame, coalesce_missing: bool = False) -> DataFrame:
    """Departures (n_x) and arrivals (n_y) per airport in one scan: origin
    and destination become two tagged rows and a single aggregate counts
    both. An airport seen on one side only gets NULL on the other side
    (as the dashboard's full join), unless ``coalesce_missing``."""
    sides = flights.select(F.inline(F.array(
        F.struct(F.col("Origin").alias("Origin"), F.lit(1).alias("o"), F.lit(0).alias("d")),
        F.struct(F.col("Dest").alias("Origin"), F.lit(0).alias("o"), F.lit(1).alias("d")))))
    counts = (sides.where(F.col("Origin").isNotNull()).groupBy("Origin")
              .agg(F.sum("o").alias("n_x"), F.sum("d").alias("n_y")))
    if coalesce_missing:
        return counts
    return counts.select("Origin", F.nullif(F.col("n_x"), F.lit(0)).alias("n_x"),
                         F.nullif(F.col("n_y"), F.lit(0)).alias("n_y"))


def busiest_airports(flights: DataFrame, airports: DataFrame, k: int = 25,
                     scale: float = 10000.0, coalesce_missing: bool = False) -> DataFrame:
    """Departures (n_x), arrivals (n_y), their sum (nSum) and nSum / scale
    per airport, top k by that total with ties, plus the airport's columns.
    A NULL total (airport on one side only) is never ranked."""
    counts = airport_counts(flights, coalesce_missing)
    counts = counts.withColumn("nSum", F.col("n_x") + F.col("n_y"))
    counts = counts.withColumn("nTotal", F.col("nSum") / F.lit(float(scale)))
    top = top_k_with_ties(counts, "nTotal", k)
    return lookup(top, airports, "Origin", "iata_code")


def event_traffic_windows(events: DataFrame, days: int = 12) -> DataFrame:
    """R3 on an event stream: clicks and sign-ups are departures, all other
    events arrivals at the user's 'airport'; counts per tumbling window (T4, T5)."""
    kind = F.when(F.col("event_type").isin("click", "signup"), F.lit("Departures")).otherwise(F.lit("Arrivals"))
    legs = events.select(F.col("user_id").alias("Airport"), "ts", kind.alias("Type"))
    return tumbling_count(legs, "ts", days, group_cols=["Airport", "Type"])
