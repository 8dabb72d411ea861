"""Flight-shaped views over the driver's TPC-H-like tables.

The reference's flight CSVs are not available, so the reports run on a
fact view F built from lineitem / orders / customer / supplier (one row per
lineitem), with supplier standing in for carriers and nation for airports.
The same definitions are given as SQL text for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.operators.sizing import bounded_broadcast
from ontime.sources.store import Layout, buckets_for, fingerprint, stored


def flight_view(t: dict[str, DataFrame], partitions: int | None = None) -> DataFrame:
    """Fact view F.

    Join order keeps lineitem to a single shuffle: orders meets customer
    first (orders is the smaller side), supplier is broadcast after a size
    check, and lineitem is shuffled once on the order key (into ``partitions``
    when given, so that the rows of F lie as a table bucketed alike needs them).
    """
    customer = bounded_broadcast(t["customer"].select("c_custkey", "c_nationkey"))
    supplier = bounded_broadcast(t["supplier"].select("s_suppkey", "s_nationkey"))
    oc = (t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
          .join(customer, F.col("o_custkey") == F.col("c_custkey")))
    li = t["lineitem"].join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    if partitions:
        li, oc = li.repartition(partitions, "l_orderkey"), oc.repartition(partitions, "o_orderkey")
    f = li.join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
    cancelled = F.col("o_orderstatus") == "F"
    code = F.substring(F.lit("ABCDX"), F.substring("o_orderpriority", 1, 1).cast("int"), 1)
    return f.select(
        "l_orderkey", "l_linenumber",
        F.col("l_suppkey").cast("string").alias("Reporting_Airline"),
        F.col("s_nationkey").cast("string").alias("Origin"),
        F.col("c_nationkey").cast("string").alias("Dest"),
        F.year("o_orderdate").alias("Year"),
        F.month("o_orderdate").alias("Month"),
        F.dayofmonth("o_orderdate").alias("DayofMonth"),
        (2 * F.col("l_quantity") - 30).alias("ArrDelay"),
        # not a function of ArrDelay, so the on-time label is noisy
        (F.col("l_quantity") + 4 * F.col("l_linenumber") - 25).cast("double").alias("DepDelay"),
        (F.col("l_extendedprice") / 100).alias("Distance"),
        F.round(F.col("l_tax") * 100, 0).alias("TaxiIn"),
        F.round(F.col("l_discount") * 100, 0).alias("TaxiOut"),
        F.when(cancelled, 1).otherwise(0).alias("Cancelled"),
        F.when(cancelled, code).alias("CancellationCode"),
        F.col("l_quantity").alias("CarrierDelay"),
        F.round(F.col("l_discount") * 500, 0).alias("WeatherDelay"),
        F.round(F.col("l_tax") * 600, 0).alias("NASDelay"),
        (F.col("l_linenumber") * 5.0).alias("SecurityDelay"),
        F.when(F.col("l_returnflag") == "R", 40.0).when(F.col("l_returnflag") == "A", 20.0)
        .otherwise(0.0).alias("LateAircraftDelay"),
    )


# Part of a stored table's key: raise it when flight_view changes.
FACT_VERSION = "flights-2"
FACT_TABLES = ("lineitem", "orders", "customer", "supplier")


def fact_key(spark: SparkSession, sf_dir: str) -> str:
    """What the stored tables of a folder are known by: its source files as they are now."""
    return fingerprint(spark, [f"{sf_dir.rstrip('/')}/{n}.parquet" for n in FACT_TABLES], FACT_VERSION)


# A task that joins, sorts and writes a bucket of F, all years, has so few rows that the sort stays in memory.
FACT_ROWS_PER_BUCKET = 500_000


def joined_partitions(spark: SparkSession, buckets: int, most_files: int = 4) -> int | None:
    """Partitions of a join whose rows are written to ``buckets`` without another shuffle, or None.

    A multiple of the buckets, so that a partition has rows of one bucket; not below ``spark.sql.shuffle.partitions``, to
    which Spark raises a join's partitions; None if a bucket would get more than ``most_files`` files (small tables)."""
    parts = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // buckets)
    return parts * buckets if parts <= most_files else None


def stored_flights(t: dict[str, DataFrame], key: str) -> DataFrame:
    """F written once: a folder per year, bucketed and sorted by the order key (which spreads evenly, as a carrier may not).

    The join deals its narrow sides by the order key so that each partition has rows of one bucket: the wide rows of F
    are written where they are made and not shuffled (those of a small table are, into fewer files)."""
    lineitem = t["lineitem"]
    buckets = buckets_for(lineitem.count(), FACT_ROWS_PER_BUCKET)
    layout = Layout(("l_orderkey",), buckets, ("Year",), ("l_orderkey", "l_linenumber"))
    n = joined_partitions(lineitem.sparkSession, buckets)
    return stored(lineitem.sparkSession, "flights", key, lambda: flight_view(t, n), layout, dealt=n is not None)


def stored_orders(t: dict[str, DataFrame], key: str) -> DataFrame:
    """orders in the buckets of F, so that both join on the order key without an exchange."""
    orders = t["orders"]
    layout = Layout(("o_orderkey",), buckets_for(t["lineitem"].count(), FACT_ROWS_PER_BUCKET), (), ("o_orderkey",))
    return stored(orders.sparkSession, "orders", key, lambda: orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), layout)


def brand_route_view(t: dict[str, DataFrame]) -> DataFrame:
    """Carrier with a (part brand, customer nation) 'route' per lineitem: a
    pair with varied distinct counts per carrier (F has 25 routes for all)."""
    part = bounded_broadcast(t["part"].select("p_partkey", "p_brand"))
    customer = bounded_broadcast(t["customer"].select("c_custkey", "c_nationkey"))
    oc = t["orders"].select("o_orderkey", "o_custkey").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey") \
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    return li.join(oc, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_suppkey").cast("string").alias("Reporting_Airline"), F.col("p_brand").alias("Origin"),
        F.col("c_nationkey").cast("string").alias("Dest"))


def carriers_view(t: dict[str, DataFrame]) -> DataFrame:
    return t["supplier"].select(F.col("s_suppkey").cast("string").alias("carrier"), F.col("s_name").alias("name"))


def airports_view(t: dict[str, DataFrame]) -> DataFrame:
    """nation as airports: coordinates are key x constant; the zone is a fixed
    UTC offset of (key - 12) hours, e.g. '-12:00' .. '+12:00'."""
    key = F.col("n_nationkey")
    return t["nation"].select(
        key.cast("string").alias("iata_code"), F.col("n_name").alias("name"),
        (key * 7.0).alias("longitude_deg"), (key * 3.0).alias("latitude_deg"),
        F.format_string("%+03d:00", key - 12).alias("timezone"))


def event_flights(t: dict[str, DataFrame]) -> DataFrame:
    """Flight-shaped rows from events for the hhmm / time-zone path (T1-T3):
    the event's wall clock is the take-off time at the origin airport. Codes
    25 and 26 are in no airport table."""
    ts = F.col("ts")
    return t["events"].select(
        "event_id",
        (F.col("user_id") % 27).cast("string").alias("Origin"),
        (F.col("event_id") % 25).cast("string").alias("Dest"),
        F.year(ts).alias("Year"), F.month(ts).alias("Month"), F.dayofmonth(ts).alias("DayofMonth"),
        (F.hour(ts) * 100 + F.minute(ts)).alias("WheelsOff"),
        F.round("value", 0).alias("AirTime"),
    )


# ----------------------------------------------------------------------------
# SQL text of the same views (DuckDB and Spark SQL both accept it).

FLIGHT_SQL = """
select l_orderkey, l_linenumber,
       cast(l_suppkey as varchar) as Reporting_Airline, cast(s_nationkey as varchar) as Origin,
       cast(c_nationkey as varchar) as Dest,
       cast(year(o_orderdate) as integer) as Year, cast(month(o_orderdate) as integer) as Month,
       cast(day(o_orderdate) as integer) as DayofMonth,
       2*l_quantity-30 as ArrDelay, cast(l_quantity+4*l_linenumber-25 as double) as DepDelay, l_extendedprice/100 as Distance,
       round(l_tax*100,0) as TaxiIn, round(l_discount*100,0) as TaxiOut,
       case when o_orderstatus='F' then 1 else 0 end as Cancelled,
       case when o_orderstatus='F'
            then substr('ABCDX', cast(substr(o_orderpriority,1,1) as int), 1) end as CancellationCode,
       l_quantity as CarrierDelay, round(l_discount*500,0) as WeatherDelay,
       round(l_tax*600,0) as NASDelay, l_linenumber*5.0e0 as SecurityDelay,
       case l_returnflag when 'R' then 40.0e0 when 'A' then 20.0e0 else 0.0e0 end as LateAircraftDelay
from lineitem join orders on l_orderkey=o_orderkey
     join customer on o_custkey=c_custkey join supplier on l_suppkey=s_suppkey
"""

CARRIERS_SQL = "select cast(s_suppkey as varchar) as carrier, s_name as name from supplier"

BRAND_ROUTE_SQL = """
select cast(l_suppkey as varchar) as Reporting_Airline, p_brand as Origin, cast(c_nationkey as varchar) as Dest
from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey
     join customer on o_custkey = c_custkey
"""

# The zone offset in hours is n_nationkey - 12 (see airports_view).
AIRPORTS_SQL = """
select cast(n_nationkey as varchar) as iata_code, n_name as name, n_nationkey*7.0e0 as longitude_deg,
       n_nationkey*3.0e0 as latitude_deg, printf('%+03d:00', n_nationkey - 12) as timezone,
       n_nationkey - 12 as tz_offset_hours
from nation
"""

EVENT_FLIGHTS_SQL = """
select event_id, cast(user_id % 27 as varchar) as Origin, cast(event_id % 25 as varchar) as Dest,
       cast(year(ts) as integer) as Year, cast(month(ts) as integer) as Month,
       cast(day(ts) as integer) as DayofMonth,
       cast(hour(ts)*100 + minute(ts) as integer) as WheelsOff, round(value, 0) as AirTime
from events
"""


def with_views(sql: str, **views: str) -> str:
    """Prefix a query with CTEs: with_views(q, F=FLIGHT_SQL)."""
    ctes = ",\n".join(f"{name} as ({body})" for name, body in views.items())
    return f"with {ctes}\n{sql}"
