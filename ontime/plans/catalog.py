"""Registered queries over the driver tables, each with its DuckDB oracle text.

Every query reads whole driver tables (or views derived from them); the
oracle is the same computation written as plain SQL over the same tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.functions.buckets import bucketize, sql_bucketize
from ontime.functions.columns import drop_matching, select_matching
from ontime.functions.keys import fraction_threshold, hash_key, sql_hash_key
from ontime.functions.labels import CANCELLATION_LABELS, DELAY_BUCKET_LABELS, label_lookup, sql_case
from ontime.operators import (
    frequency,
    join_with_suffix,
    lookup,
    running_total,
    stratified_sample,
    top_k_with_ties,
    union_all,
)
from ontime.operators.partitions import argmax_batch, map_partitions, melt_batch
from ontime.plans import certificates, reports
from ontime.plans.classify import (
    FEATURES,
    MODEL_NAMES,
    classification_set,
    classifier_comparison,
    confusion_counts,
    exact_roc,
    feature_importance,
    logistic_roc,
    stored_split_and_train,
)
from ontime.plans.cluster import (
    assemble,
    cluster_features,
    cluster_sample,
    feature_columns,
    kmeans_silhouette,
    pca_project,
    pca_variance,
    scaled_vectors,
    with_delay_code,
)
from ontime.plans.evaluate import confusion_metrics, roc_points, silhouette
from ontime.plans.ml_common import fit_layout, hash_split
from ontime.plans.model_store import ModelStore, rows_fingerprint
from ontime.plans.relational import predicate_counts
from ontime.plans.stats import correlation_matrix, correlation_pairs, min_max_scale
from ontime.session import checkpoint_dir, cut_lineage
from ontime.sources import driver_tables as dt
from ontime.sources.readers import CSV_OPTIONS, cache_fact, read_csv_typed, read_table, register_views
from ontime.sources.schemas import CAUSE_COLUMNS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


class Tables(dict):
    """Lazy dict of driver tables for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name):
        df = read_table(self.spark, self.sf_dir, name)
        self[name] = df
        return df


_FACTS: dict = {}
_KEYS: dict = {}
# Session settings. The fact view is written once to the shared folder and then only read
# (S2, S6); "false" joins its four tables in every query. cacheFact keeps it in memory instead.
STORE_FACT_CONF = "spark.ontime.storeFact"
CACHE_FACT_CONF = "spark.ontime.cacheFact"


def _on(spark, conf: str, default: str) -> bool:
    return spark.conf.get(conf, default).lower() == "true"


def _key(spark, sf_dir) -> str:
    """The stored tables' key; the source files are listed once per session."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _KEYS:
        _KEYS[known] = dt.fact_key(spark, sf_dir)
    return _KEYS[known]


def _flights(spark, sf_dir):
    """Driver tables and the flight-shaped fact F, by default from its stored table.

    In memory (cacheFact) F is kept until :func:`release_facts`; dimensions stay uncached.
    """
    t = Tables(spark, sf_dir)
    if _on(spark, CACHE_FACT_CONF, "false"):
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _FACTS:
            _FACTS[key] = cache_fact(dt.flight_view(t))
        return t, _FACTS[key]
    if _on(spark, STORE_FACT_CONF, "true"):
        return t, dt.stored_flights(t, _key(spark, sf_dir))
    return t, dt.flight_view(t)


def release_facts() -> None:
    """Drop the fact views kept in memory."""
    for df in _FACTS.values():
        df.unpersist()
    _FACTS.clear()


def _sql_f(q: str, **extra) -> str:
    return dt.with_views(q, flights=dt.FLIGHT_SQL, **extra)


# --- R8 (flagship) ---------------------------------------------------------

@register("arrival_delay_buckets", _sql_f(f"""
, b as (select Reporting_Airline, {sql_bucketize('ArrDelay')} as ArrDelayBucket from flights)
, c as (select Reporting_Airline, ArrDelayBucket, count(*) as n from b group by 1, 2)
, p as (select Reporting_Airline, ArrDelayBucket,
               n / sum(n) over (partition by Reporting_Airline) * 100 as Percent from c)
select s.name, p.Percent, {sql_case('p.ArrDelayBucket', DELAY_BUCKET_LABELS)} as ArrDelayBucketMapped
from p left join carriers s on p.Reporting_Airline = s.carrier
""", carriers=dt.CARRIERS_SQL))
def q_arrival_delay_buckets(spark, sf_dir):
    t, f = _flights(spark, sf_dir)
    return reports.arrival_delay_buckets(f, dt.carriers_view(t))


# --- R1, R2, R6 --------------------------------------------------------------

@register("attribute_distribution", _sql_f("""
select CancellationCode, count(*) as n from flights group by 1
"""))
def q_attribute_distribution(spark, sf_dir):
    _, f = _flights(spark, sf_dir)
    return reports.attribute_distribution(f, "CancellationCode")


@register("airport_codes", _sql_f("""
select Origin from flights union select Dest from flights
"""))
def q_airport_codes(spark, sf_dir):
    _, f = _flights(spark, sf_dir)
    return reports.airport_codes(f)


@register("carrier_codes", _sql_f("""
select distinct Reporting_Airline from flights
"""))
def q_carrier_codes(spark, sf_dir):
    _, f = _flights(spark, sf_dir)
    return reports.carrier_codes(f)


# --- R4, R5, R7 --------------------------------------------------------------

@register("routes_per_carrier", _sql_f("""
, r as (select Reporting_Airline, count(*) as n
        from (select distinct Reporting_Airline, Origin, Dest from flights) d group by 1)
select r.Reporting_Airline, r.n, c.name from r left join carriers c on r.Reporting_Airline = c.carrier
""", carriers=dt.CARRIERS_SQL))
def q_routes_per_carrier(spark, sf_dir):
    t, f = _flights(spark, sf_dir)
    return reports.routes_per_carrier(f, dt.carriers_view(t))


@register("brand_routes_per_carrier", dt.with_views("""
, r as (select Reporting_Airline, count(*) as n
        from (select distinct Reporting_Airline, Origin, Dest from routes) d group by 1)
select r.Reporting_Airline, r.n, c.name from r left join carriers c on r.Reporting_Airline = c.carrier
""", routes=dt.BRAND_ROUTE_SQL, carriers=dt.CARRIERS_SQL))
def q_brand_routes_per_carrier(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return reports.routes_per_carrier(dt.brand_route_view(t), dt.carriers_view(t))


@register("cancellation_causes", _sql_f(f"""
, c as (select Reporting_Airline, CancellationCode, count(*) as n
        from flights where Cancelled = 1 group by 1, 2)
, p as (select Reporting_Airline, CancellationCode,
               n / sum(n) over (partition by Reporting_Airline) * 100 as Percent from c)
select s.name, p.Percent, {sql_case('p.CancellationCode', CANCELLATION_LABELS)} as TypeCause
from p left join carriers s on p.Reporting_Airline = s.carrier
""", carriers=dt.CARRIERS_SQL))
def q_cancellation_causes(spark, sf_dir):
    t, f = _flights(spark, sf_dir)
    return reports.cancellation_causes(f, dt.carriers_view(t))


def _cause_union(src: str) -> str:
    names = ["Carrier", "Weather", "NAS", "Security", "LateAircraft"]
    return "\nunion all\n".join(
        f"select Reporting_Airline, '{n}' as \"group\", c{i} / tot * 100 as value from {src}"
        for i, n in enumerate(names))


@register("delay_cause_share", _sql_f("""
, s as (select Reporting_Airline, sum(ArrDelay) as tot,
          sum(case when CarrierDelay > 0 then CarrierDelay end) as c0,
          sum(case when WeatherDelay > 0 then WeatherDelay end) as c1,
          sum(case when NASDelay > 0 then NASDelay end) as c2,
          sum(case when SecurityDelay > 0 then SecurityDelay end) as c3,
          sum(case when LateAircraftDelay > 0 then LateAircraftDelay end) as c4
        from flights where ArrDelay >= 15 group by 1)
""" + _cause_union("s")))
def q_delay_cause_share(spark, sf_dir):
    _, f = _flights(spark, sf_dir)
    return reports.delay_cause_share(f)


def _one_carrier_sql(name: str, code: str) -> str:
    return f"""{name} as (select '{code}' as Reporting_Airline, sum(ArrDelay) as tot,
          sum(case when CarrierDelay > 0 then CarrierDelay end) as c0,
          sum(case when WeatherDelay > 0 then WeatherDelay end) as c1,
          sum(case when NASDelay > 0 then NASDelay end) as c2,
          sum(case when SecurityDelay > 0 then SecurityDelay end) as c3,
          sum(case when LateAircraftDelay > 0 then LateAircraftDelay end) as c4
        from flights where ArrDelay >= 15 and Reporting_Airline = '{code}')"""


@register("one_carrier_delay_cause_share", _sql_f(
    f", {_one_carrier_sql('s', '3')}, {_one_carrier_sql('u', 'none')}\n" + _cause_union("s") + "\nunion all\n"
    + _cause_union("u")))
def q_one_carrier_delay_cause_share(spark, sf_dir):
    """One carrier, and one without a late flight (five rows with NULL)."""
    _, f = _flights(spark, sf_dir)
    return union_all(reports.delay_cause_share(f, "3"), reports.delay_cause_share(f, "none"))


# --- R9, R10 -----------------------------------------------------------------

@register("top_routes", _sql_f("""
, c as (select Origin, Dest, count(*) as n from flights group by 1, 2)
, t as (select * from (select *, rank() over (order by n desc) as rk from c where n is not null) r
        where rk <= 25)
, e as (select concat_ws('', cast(Origin as varchar), cast(Dest as varchar)) as RouteID, Origin as AirportID from t
        union all
        select concat_ws('', cast(Origin as varchar), cast(Dest as varchar)) as RouteID, Dest as AirportID from t)
select e.RouteID, a.longitude_deg, a.latitude_deg, a.name
from e left join airports a on e.AirportID = a.iata_code
""", airports=dt.AIRPORTS_SQL))
def q_top_routes(spark, sf_dir):
    t, f = _flights(spark, sf_dir)
    return reports.top_routes(f, dt.airports_view(t), k=25)


def _busiest_sql(k: int) -> str:
    return _sql_f(f"""
, o as (select Origin, count(*) as n_x from flights group by 1)
, d as (select Dest, count(*) as n_y from flights group by 1)
, j as (select coalesce(o.Origin, d.Dest) as Origin, n_x, n_y, n_x + n_y as nSum, (n_x + n_y) / 10000 as nTotal
        from o full join d on o.Origin = d.Dest)
, r as (select *, rank() over (order by nTotal desc) as rk from j where nTotal is not null)
select r.Origin, r.n_x, r.n_y, r.nSum, r.nTotal, a.name, a.longitude_deg, a.latitude_deg, a.timezone
from r left join airports a on r.Origin = a.iata_code where rk <= {k}
""", airports=dt.AIRPORTS_SQL)


@register("busiest_airports", _busiest_sql(25))
def q_busiest_airports(spark, sf_dir):
    t, f = _flights(spark, sf_dir)
    return reports.busiest_airports(f, dt.airports_view(t), k=25)


@register("busiest_airports_top10", _busiest_sql(10))
def q_busiest_airports_top10(spark, sf_dir):
    t, f = _flights(spark, sf_dir)
    return reports.busiest_airports(f, dt.airports_view(t), k=10)


# --- R3 and the time path T1-T5 ---------------------------------------------

@register("traffic_windows", """
select user_id as Airport, time_bucket(interval 12 days, ts, timestamp '1970-01-01') as window_start,
       count(*) as n, 'Departures' as Type
from events where event_type in ('click', 'signup') group by 1, 2
union all
select user_id as Airport, time_bucket(interval 12 days, ts, timestamp '1970-01-01') as window_start,
       count(*) as n, 'Arrivals' as Type
from events where event_type not in ('click', 'signup') or event_type is null group by 1, 2
""")
def q_traffic_windows(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return reports.event_traffic_windows(t["events"], days=12)


@register("hhmm_to_utc", dt.with_views("""
select ef.event_id,
       make_timestamp(ef.Year, ef.Month, ef.DayofMonth, ef.WheelsOff // 100, ef.WheelsOff % 100, 0)
         - to_hours(a.tz_offset_hours) as ActualDepDate,
       make_timestamp(ef.Year, ef.Month, ef.DayofMonth, ef.WheelsOff // 100, ef.WheelsOff % 100, 0)
         - to_hours(a.tz_offset_hours) + to_minutes(cast(floor(ef.AirTime) as bigint)) as ActualArrDate
from ef left join airports a on ef.Origin = a.iata_code
""", ef=dt.EVENT_FLIGHTS_SQL, airports=dt.AIRPORTS_SQL))
def q_hhmm_to_utc(spark, sf_dir):
    t = Tables(spark, sf_dir)
    timed = reports.flight_instants(dt.event_flights(t), dt.airports_view(t))
    return timed.select("event_id", "ActualDepDate", "ActualArrDate")


@register("missing_zones", dt.with_views("""
select cast(count_if(a.iata_code is null) as bigint) as dropped, count(*) as flights
from ef left join airports a on ef.Origin = a.iata_code
""", ef=dt.EVENT_FLIGHTS_SQL, airports=dt.AIRPORTS_SQL))
def q_missing_zones(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return reports.missing_zone_count(dt.event_flights(t), dt.airports_view(t))


_LEGS_SQL = """
, legs as (
  select ef.Origin as Airport,
         make_timestamp(ef.Year, ef.Month, ef.DayofMonth, ef.WheelsOff // 100, ef.WheelsOff % 100, 0)
           - to_hours(a.tz_offset_hours) as ts, 'Departures' as Type
  from ef left join airports a on ef.Origin = a.iata_code
  union all
  select ef.Dest as Airport,
         make_timestamp(ef.Year, ef.Month, ef.DayofMonth, ef.WheelsOff // 100, ef.WheelsOff % 100, 0)
           - to_hours(a.tz_offset_hours) + to_minutes(cast(floor(ef.AirTime) as bigint)) as ts,
         'Arrivals' as Type
  from ef left join airports a on ef.Origin = a.iata_code)
select Airport, time_bucket(interval 5 days, ts, timestamp '1970-01-01') as window_start, count(*) as n, Type
from legs where Airport is not null and ts is not null{only} group by Airport, Type, 2
"""


@register("airport_traffic_windows", dt.with_views(_LEGS_SQL.format(only=""), ef=dt.EVENT_FLIGHTS_SQL,
                                                   airports=dt.AIRPORTS_SQL))
def q_airport_traffic_windows(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return reports.traffic_windows(dt.event_flights(t), dt.airports_view(t), days=5)


@register("one_airport_traffic_windows", dt.with_views(_LEGS_SQL.format(only=" and Airport = '7'"),
                                                       ef=dt.EVENT_FLIGHTS_SQL, airports=dt.AIRPORTS_SQL))
def q_one_airport_traffic_windows(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return reports.traffic_windows(dt.event_flights(t), dt.airports_view(t), days=5, airport="7")


# --- Joins J1-J8 --------------------------------------------------------------

@register("lookup_left_join", _sql_f("""
, c as (select Origin, Dest, count(*) as n from flights group by 1, 2)
select c.Origin, c.Dest, c.n,
       o.name as name_x, o.longitude_deg as longitude_deg_x, o.latitude_deg as latitude_deg_x,
       o.timezone as timezone_x,
       d.name as name_y, d.longitude_deg as longitude_deg_y, d.latitude_deg as latitude_deg_y,
       d.timezone as timezone_y
from c left join airports o on c.Origin = o.iata_code left join airports d on c.Dest = d.iata_code
""", airports=dt.AIRPORTS_SQL))
def q_lookup_left_join(spark, sf_dir):
    t, f = _flights(spark, sf_dir)
    air = dt.airports_view(t)
    counts = frequency(f, "Origin", "Dest")
    return lookup(lookup(counts, air, "Origin", "iata_code"), air, "Dest", "iata_code")


@register("full_join_counts", _sql_f("""
, o as (select Origin, count(*) as n from flights group by 1)
, d as (select Dest, count(*) as n from flights group by 1)
select coalesce(o.Origin, d.Dest) as Origin, o.n as n_x, d.n as n_y
from o full join d on o.Origin = d.Dest
"""))
def q_full_join_counts(spark, sf_dir):
    _, f = _flights(spark, sf_dir)
    return join_with_suffix(frequency(f, "Origin"), frequency(f, "Dest"), "Origin", "Dest", "full")


_HOT_EVENTS_SQL = """
select event_id, value, case when event_id % 3 = 0 then 7 when event_id % 7 = 1 then null else user_id end as user_id
from events
"""


@register("skewed_full_join", dt.with_views("""
select coalesce(ev.user_id, c.c_custkey) as user_id, ev.event_id, ev.value, c.c_nationkey, c.c_acctbal
from ev full join customer c on ev.user_id = c.c_custkey
""", ev=_HOT_EVENTS_SQL))
def q_skewed_full_join(spark, sf_dir):
    """J5, J6 on rows: events of which a third share one user and a tenth have none, full-joined to customers."""
    t = Tables(spark, sf_dir)
    user = (F.when(F.col("event_id") % 3 == 0, F.lit(7)).when(F.col("event_id") % 7 == 1, F.lit(None))
            .otherwise(F.col("user_id")).cast("bigint"))
    events = t["events"].select("event_id", "value", user.alias("user_id"))
    customers = t["customer"].select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_nationkey", "c_acctbal")
    return join_with_suffix(events, customers, "user_id", "c_custkey", "full", salted=True,
                            left_unique=["event_id"], right_unique=["user_id"])


# --- Filters and NULL handling F1-F6, N1, N2 -----------------------------------

_NULLED_LINEITEM = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus,
       nullif(l_tax, 0) as tax, nullif(l_discount, 0) as discount
from lineitem
"""


@register("filter_predicates", dt.with_views("""
select cast(count_if(l_returnflag = 'R') as bigint) as f1_equal,
       cast(count_if(l_returnflag = 'R' or l_linestatus = 'F') as bigint) as f2_either,
       cast(count_if(l_returnflag = 'R' and l_quantity >= 15) as bigint) as f3_both,
       cast(count_if(tax > 0) as bigint) as f4_positive,
       cast(count_if(l_quantity + tax * 100 + discount * 100 > 15) as bigint) as f5_sum,
       cast(count_if(l_linenumber = 1) as bigint) as f6_typed,
       sum(tax) as n2_sum, count(*) as n_rows
from li
""", li=_NULLED_LINEITEM))
def q_filter_predicates(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return predicate_counts(nulled_lineitem(t))


@register("drop_nulls", dt.with_views("""
select l_orderkey, l_linenumber, tax, discount from li where tax is not null and discount is not null
""", li=_NULLED_LINEITEM))
def q_drop_nulls(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return (nulled_lineitem(t).select("l_orderkey", "l_linenumber", "tax", "discount")
            .na.drop("any", subset=["tax", "discount"]))


def nulled_lineitem(t) -> DataFrame:
    """lineitem with NULLs: a zero tax or discount becomes NULL."""
    return t["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag",
        "l_linestatus", F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"))


# --- Projections P2-P6 ---------------------------------------------------------

@register("select_patterns", _sql_f("""
select ArrDelay, DepDelay, Distance, TaxiIn, TaxiOut from flights
"""))
def q_select_patterns(spark, sf_dir):
    _, f = _flights(spark, sf_dir)
    names = feature_columns(f)
    return select_matching(f, names=names)


@register("drop_patterns", _sql_f("""
select l_orderkey, l_linenumber, Reporting_Airline, Origin, Dest, Year, Month, DayofMonth, Distance, CancellationCode
from flights
"""))
def q_drop_patterns(spark, sf_dir):
    _, f = _flights(spark, sf_dir)
    return drop_matching(f, ends_with=("Delay",), starts_with=("Taxi",)).drop("Cancelled")


@register("union_by_name", _sql_f("""
select Reporting_Airline, null as Origin, count(*) as n from flights group by 1
union all
select null as Reporting_Airline, Origin, count(*) as n from flights group by 2
"""))
def q_union_by_name(spark, sf_dir):
    _, f = _flights(spark, sf_dir)
    return union_all(frequency(f, "Reporting_Airline"), frequency(f, "Origin"))


# --- Row-wise argmax, buckets, labels ------------------------------------------

@register("dominant_cause", _sql_f("""
, g as (select l_orderkey, l_linenumber, CarrierDelay, WeatherDelay, NASDelay, SecurityDelay,
               LateAircraftDelay,
               greatest(CarrierDelay, WeatherDelay, NASDelay, SecurityDelay, LateAircraftDelay) as m
        from flights
        where CarrierDelay + WeatherDelay + NASDelay + SecurityDelay + LateAircraftDelay > 15)
select l_orderkey, l_linenumber,
       case when CarrierDelay = m then 'Carrier' when WeatherDelay = m then 'Weather'
            when NASDelay = m then 'NAS' when SecurityDelay = m then 'Security'
            when LateAircraftDelay = m then 'LateAircraft' end as DelayCode
from g
"""))
def q_dominant_cause(spark, sf_dir):
    _, f = _flights(spark, sf_dir)
    return with_delay_code(f).select("l_orderkey", "l_linenumber", "DelayCode")


@register("bucketize", f"""
select event_id, value, {sql_bucketize('value')} as bucket from events
""")
def q_bucketize(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t["events"].select("event_id", "value", bucketize(F.col("value")).alias("bucket"))


@register("label_lookup", f"""
, c as (select o_orderkey, substr('ABCDX', cast(substr(o_orderpriority, 1, 1) as int), 1) as code
        from orders)
select o_orderkey, code, {sql_case('code', CANCELLATION_LABELS)} as label from c
""".replace(", c as", "with c as", 1))
def q_label_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    code = F.substring(F.lit("ABCDX"), F.substring("o_orderpriority", 1, 1).cast("int"), 1)
    return (t["orders"].select("o_orderkey", code.alias("code"))
            .withColumn("label", label_lookup(F.col("code"), CANCELLATION_LABELS)))


# --- Ranking, samples, splits ---------------------------------------------------

@register("running_total", """
with m as (select date_trunc('month', o_orderdate) as month, count(*) as n,
                  cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as cents
           from orders group by 1)
select month, n, cents, cast(sum(n) over (order by month) as bigint) as n_cum,
       cast(sum(cents) over (order by month) as bigint) as cents_cum
from m
""")
def q_running_total(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t["orders"].select(F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month"),
                           F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    per_month = o.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))
    return running_total(per_month, "month", ["n", "cents"], ["n_cum", "cents_cum"])


@register("top_k_ties", """
with c as (select o_custkey, count(*) as n from orders group by 1)
select o_custkey, n from (select *, rank() over (order by n desc) as rk from c) r where rk <= 25
""")
def q_top_k_ties(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return top_k_with_ties(frequency(t["orders"], "o_custkey"), "n", 25)


@register("stratified_sample", f"""
select event_id, event_type from (
  select event_id, event_type,
         row_number() over (partition by event_type order by {sql_hash_key('event_id')}, event_id) as rn
  from events) s
where rn <= 50
""")
def q_stratified_sample(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ev = t["events"].select("event_id", "event_type").withColumn("__key", hash_key(F.col("event_id")))
    return stratified_sample(ev, "event_type", 50, [F.col("__key"), F.col("event_id")]).drop("__key")


@register("hash_split", f"""
select o_orderkey, case when {sql_hash_key('o_orderkey')} < {fraction_threshold(0.7)}
                        then 'training' else 'testing' end as split
from orders
""")
def q_hash_split(spark, sf_dir):
    t = Tables(spark, sf_dir)
    train, test = hash_split(t["orders"].select("o_orderkey"), ["o_orderkey"], 0.7)
    return union_all(train.withColumn("split", F.lit("training")), test.withColumn("split", F.lit("testing")))


@register("on_time_label", _sql_f("""
select OnTime, DepDelay, Distance, TaxiIn, TaxiOut from (
  select case when ArrDelay > 15 then 0.0e0 when ArrDelay <= 15 then 1.0e0 end as OnTime,
         DepDelay, Distance, TaxiIn, TaxiOut from flights) s
where OnTime is not null and DepDelay is not null and Distance is not null
  and TaxiIn is not null and TaxiOut is not null
"""))
def q_on_time_label(spark, sf_dir):
    _, f = _flights(spark, sf_dir)
    return classification_set(f)


# --- Stored layout S2, S6 and partition functions D1, D2 --------------------------

@register("bucket_join", _sql_f("""
select o.o_orderpriority, count(*) as n, sum(f.ArrDelay) as delay, sum(cast(round(o.o_totalprice) as bigint)) as price
from flights f join orders o on f.l_orderkey = o.o_orderkey group by 1
""".replace("sum(cast(round(o.o_totalprice) as bigint))", "cast(sum(cast(round(o.o_totalprice) as bigint)) as bigint)")))
def q_bucket_join(spark, sf_dir):
    """F and orders lie in the same buckets of the order key: their join moves no row."""
    t, f = _flights(spark, sf_dir)
    orders = dt.stored_orders(t, _key(spark, sf_dir))
    joined = f.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ArrDelay").alias("delay"),
        F.sum(F.round("o_totalprice").cast("bigint")).alias("price"))


@register("partial_years", _sql_f("""
, y as (select cast(year(o_orderdate) as integer) as Year, count(*) as orders, count(distinct month(o_orderdate)) as months
        from orders group by 1)
select f.Year, y.months, count(*) as n, sum(f.DepDelay) as delay from flights f join y on f.Year = y.Year
where y.months < 12 group by 1, 2
"""))
def q_partial_years(spark, sf_dir):
    """Flights of the years that are not complete: the years found at run time prune the folders of F."""
    t, f = _flights(spark, sf_dir)
    years = (t["orders"].groupBy(F.year("o_orderdate").alias("Year"))
             .agg(F.count_distinct(F.month("o_orderdate")).alias("months")).where(F.col("months") < 12))
    return (f.join(F.broadcast(years), "Year").groupBy("Year", "months")  # one row per calendar year
            .agg(F.count(F.lit(1)).alias("n"), F.sum("DepDelay").alias("delay")))


@register("melted_causes", _sql_f("""
select l_orderkey, l_linenumber, "group", value from (
""" + "\nunion all\n".join(f"select l_orderkey, l_linenumber, '{c}' as \"group\", {c} as value from flights" for c in CAUSE_COLUMNS) + ") m"))
def q_melted_causes(spark, sf_dir):
    """The five cause columns as rows, by a partition function."""
    _, f = _flights(spark, sf_dir)
    ids = ["l_orderkey", "l_linenumber"]
    return map_partitions(f, melt_batch(ids, CAUSE_COLUMNS, "variable", "value"),
                          "l_orderkey bigint, l_linenumber int, group string, value double", columns=ids + CAUSE_COLUMNS,
                          names={"variable": "group"})


@register("dominant_cause_by_partition", _sql_f("""
select l_orderkey, l_linenumber, case greatest(CarrierDelay, WeatherDelay, NASDelay, SecurityDelay, LateAircraftDelay)
  when CarrierDelay then 'CarrierDelay' when WeatherDelay then 'WeatherDelay' when NASDelay then 'NASDelay'
  when SecurityDelay then 'SecurityDelay' when LateAircraftDelay then 'LateAircraftDelay' end as DelayCode
from flights
"""))
def q_dominant_cause_by_partition(spark, sf_dir):
    """The largest cause's name, by a partition function (C9 is the expression for it)."""
    _, f = _flights(spark, sf_dir)
    ids = ["l_orderkey", "l_linenumber"]
    causes = f.select(*ids, *[F.col(c).cast("double").alias(c) for c in CAUSE_COLUMNS])
    whole = map_partitions(causes, argmax_batch(CAUSE_COLUMNS, "DelayCode"),
                           "DelayCode string, l_orderkey bigint, l_linenumber int, " + ", ".join(f"{c} double" for c in CAUSE_COLUMNS))
    return whole.select(*ids, "DelayCode")


@register("csv_orders", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders
""")
def q_csv_orders(spark, sf_dir):
    """A table written as CSV to the shared folder and read back with explicit types, through its view."""
    t = Tables(spark, sf_dir)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/csv/orders-{uuid.uuid4().hex}"
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    t["orders"].select(*columns).write.options(**CSV_OPTIONS).csv(folder)
    types = {c: t["orders"].schema[c].dataType for c in columns}
    register_views({"orders_csv": read_csv_typed(spark, folder, types)}, prefix="ontime_")
    return spark.table("ontime_orders_csv")


# --- Statistics: correlation, scaling ----------------------------------------

_LI_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
               "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql(cols, src):
    pairs = [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i)]
    sel = ",\n".join(f"corr({x}, {y}) as r{i}" for i, (x, y) in enumerate(pairs))
    rows = "\nunion all\n".join(f"select '{x}' as x, '{y}' as y, round(r{i}, 6) as r from w"
                                for i, (x, y) in enumerate(pairs))
    nn = " and ".join(f"{c} is not null" for c in cols)
    return f", w as (select {sel} from {src} where {nn})\n{rows}"


@register("correlation_pairs", "with " + _corr_sql(_LI_NUMERIC, "lineitem")[2:])
def q_correlation_pairs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return correlation_pairs(t["lineitem"], _LI_NUMERIC)


_F_NUMERIC = ["Year", "Month", "DayofMonth", "ArrDelay", "DepDelay", "Distance", "TaxiIn", "TaxiOut", "Cancelled",
              "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"]


@register("correlation_matrix", _sql_f(_corr_sql(_F_NUMERIC, "flights")))
def q_correlation_matrix(spark, sf_dir):
    _, f = _flights(spark, sf_dir)
    return correlation_matrix(f.drop("l_orderkey", "l_linenumber"))


_SPARSE = ["ArrDelay", "DepDelay", "Distance", "DivTime"]


@register("sparse_correlation", _sql_f(_corr_sql(_SPARSE, "sparse"), sparse="""
select ArrDelay, DepDelay, Distance, nullif(TaxiIn, 0) as DivTime, cast(null as double) as Div2Time from flights
"""))
def q_sparse_correlation(spark, sf_dir):
    """R11 with named columns on a fact table with a sparse and an empty column."""
    _, f = _flights(spark, sf_dir)
    sparse = f.withColumns({"DivTime": F.nullif(F.col("TaxiIn"), F.lit(0.0)), "Div2Time": F.lit(None).cast("double")})
    return correlation_matrix(sparse, _SPARSE)


_SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _scale_sql(cols, src, keys):
    mm = ", ".join(f"min({c}) as mn{i}, max({c}) as mx{i}" for i, c in enumerate(cols))
    sc = ", ".join(f"case when mx{i} - mn{i} <> 0 then ({c} - mn{i}) / (mx{i} - mn{i}) * 1.0 + 0.0 "
                   f"else 0.5 end as {c}" for i, c in enumerate(cols))
    return f"b as (select {mm} from {src})\nselect {', '.join(keys)}, {sc} from {src}, b"


@register("min_max_scale", "with " + _scale_sql(_SCALE_COLS, "lineitem", ["l_orderkey", "l_linenumber"]))
def q_min_max_scale(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t["lineitem"].select("l_orderkey", "l_linenumber", *_SCALE_COLS)
    return min_max_scale(li, _SCALE_COLS)


_CLUSTER_FEATS = ["ArrDelay", "DepDelay", "Distance", "TaxiIn", "TaxiOut"]


@register("cluster_features", _sql_f("""
, g as (select l_orderkey, l_linenumber, ArrDelay, DepDelay, Distance, TaxiIn, TaxiOut,
               CarrierDelay, WeatherDelay, NASDelay, SecurityDelay, LateAircraftDelay,
               greatest(CarrierDelay, WeatherDelay, NASDelay, SecurityDelay, LateAircraftDelay) as m
        from flights
        where CarrierDelay + WeatherDelay + NASDelay + SecurityDelay + LateAircraftDelay > 15)
, k as (select l_orderkey, l_linenumber, ArrDelay, DepDelay, Distance, TaxiIn, TaxiOut,
       case when CarrierDelay = m then 'Carrier' when WeatherDelay = m then 'Weather'
            when NASDelay = m then 'NAS' when SecurityDelay = m then 'Security'
            when LateAircraftDelay = m then 'LateAircraft' end as DelayCode
        from g)
, """ + _scale_sql(_CLUSTER_FEATS, "k", ["l_orderkey", "l_linenumber", "DelayCode"])))
def q_cluster_features(spark, sf_dir):
    _, f = _flights(spark, sf_dir)
    return cluster_features(f, keys=("l_orderkey", "l_linenumber"))


# --- Evaluation: metrics, ROC, silhouette ---------------------------------------

_ON_TIME_SQL = """
select * from (
  select case when ArrDelay > 15 then 0.0e0 when ArrDelay <= 15 then 1.0e0 end as OnTime,
         DepDelay, Distance, TaxiIn, TaxiOut from flights) s
where OnTime is not null and DepDelay is not null and Distance is not null
  and TaxiIn is not null and TaxiOut is not null
"""


@register("confusion_metrics", _sql_f("""
, p as (select OnTime as l, case when DepDelay > 5 then 0.0 else 1.0 end as p from ot)
, cm as (select l, p, cast(count(*) as double) as n from p group by 1, 2)
, cls as (select l as c from cm union select p as c from cm)
, a as (select l as c, sum(n) as actual from cm group by 1)
, pp as (select p as c, sum(n) as predicted from cm group by 1)
, tp as (select l as c, sum(n) as tp from cm where l = p group by 1)
, st as (select cls.c, coalesce(actual, 0) as actual, coalesce(predicted, 0) as predicted,
                coalesce(tp, 0) as tp
         from cls left join a on cls.c = a.c left join pp on cls.c = pp.c left join tp on cls.c = tp.c)
, m as (select actual, tp, case when predicted = 0 then 0.0 else tp / predicted end as prec,
               case when actual = 0 then 0.0 else tp / actual end as rec from st)
, w as (select sum(case when prec + rec = 0 then 0.0 else 2 * prec * rec / (prec + rec) end * actual)
                 / sum(actual) as f1,
               sum(rec * actual) / sum(actual) as wr, sum(prec * actual) / sum(actual) as wp,
               sum(tp) / sum(actual) as acc from m)
select 'f1' as Metric, round(f1, 10) as Performance from w
union all select 'weightedRecall', round(wr, 10) from w
union all select 'weightedPrecision', round(wp, 10) from w
union all select 'accuracy', round(acc, 10) from w
""", ot=_ON_TIME_SQL))
def q_confusion_metrics(spark, sf_dir):
    _, f = _flights(spark, sf_dir)
    scored = classification_set(f).select(
        F.col("OnTime").alias("label"),
        F.when(F.col("DepDelay") > 5, 0.0).otherwise(1.0).alias("prediction"))
    return confusion_metrics(scored)


@register("roc_points", _sql_f("""
, s as (select (40.0 - DepDelay) + TaxiOut / 100.0 as score, OnTime as label from ot)
, g as (select score, sum(case when label = 1 then 1 else 0 end) as pos,
               sum(case when label = 1 then 0 else 1 end) as neg from s group by 1)
, c as (select score, sum(pos) over (order by score desc) as tp, sum(neg) over (order by score desc) as fp
        from g)
, t as (select sum(pos) as P, sum(neg) as N from g)
select round(fp / N, 10) as FPR, round(tp / P, 10) as TPR, score as threshold from c, t
union all select 0.0, 0.0, null
union all select 1.0, 1.0, null
""", ot=_ON_TIME_SQL))
def q_roc_points(spark, sf_dir):
    _, f = _flights(spark, sf_dir)
    scored = classification_set(f).select(
        ((F.lit(40.0) - F.col("DepDelay")) + F.col("TaxiOut") / 100.0).alias("score"),
        F.col("OnTime").alias("label"))
    return roc_points(scored)


@register("silhouette_given_labels", """
with p as (select vec_id, label, cast(embedding as double[]) as x from embeddings)
, d as (select a.vec_id, a.label as la, b.label as lb,
               list_sum(list_transform(range(1, len(a.x) + 1),
                                       lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i]))) as d
        from p a join p b on a.vec_id <> b.vec_id)
, m as (select vec_id, la, lb, avg(d) as md from d group by 1, 2, 3)
, s as (select vec_id, la, max(case when la = lb then md end) as a,
               min(case when la <> lb then md end) as b from m group by 1, 2)
, sz as (select label, count(*) as n from p group by 1)
select count(*) as n_points, count(distinct la) as n_clusters,
       round(avg(case when sz.n <= 1 then 0.0 when a < b then 1 - a / b
                      when a > b then b / a - 1 else 0.0 end), 9) as silhouette
from s join sz on s.la = sz.label
""")
def q_silhouette_given_labels(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return silhouette(t["embeddings"], "embedding", "label")


# --- Classification R12-R15 (fitted models: rows-only checks) ------------------

def _fitted_classifiers(spark, sf_dir):
    """Four fits, saved on shared storage under what they were fitted on; every report and session reads them."""
    _, f = _flights(spark, sf_dir)
    return stored_split_and_train(f, ModelStore(spark))


@register("classifier_comparison")
def q_classifier_comparison(spark, sf_dir):
    return classifier_comparison(*_fitted_classifiers(spark, sf_dir))


_PARTS_SQL = f"""
, cnt as (select {{cols}}, count(*) as copies from ot group by all)
, rws as (select *, unnest(generate_series(1, copies)) as i from cnt)
, parts as (select {{cols}}, ('0x' || substr(md5(concat_ws('|', {{texts}}, cast(i as varchar)) || '|42'), 1, 8))::bigint
              < {fraction_threshold(0.7)} as training from rws)
"""
_SPLIT_COLUMNS = ["OnTime", "DepDelay", "Distance", "TaxiIn", "TaxiOut"]
_PARTS_SQL = _PARTS_SQL.format(cols=", ".join(_SPLIT_COLUMNS), texts=", ".join(f"cast({c} as varchar)" for c in _SPLIT_COLUMNS))


def _score_rows(names) -> str:
    return "\nunion all\n".join(
        f"select '{n}' as feature, round(sum(OnTime * {x}), 2) as observed, true as solved from parts where training"
        for n, x in names)


@register("logistic_score_equations", _sql_f(_PARTS_SQL + _score_rows(
    [("(constant)", "1.0e0"), *[(f, f) for f in FEATURES]]), ot=_ON_TIME_SQL))
def q_logistic_score_equations(spark, sf_dir):
    """ML7, R12: sum of y * x per feature over the training part, and whether the model's sum of p * x equals it."""
    _, f = _flights(spark, sf_dir)
    models, _ = _fitted_classifiers(spark, sf_dir)
    train, _ = hash_split(classification_set(f))
    return certificates.score_equations(models["Logistic"], train, "OnTime", FEATURES).select(
        "feature", F.round("observed", 2).alias("observed"), "solved")


def _gini_sql(feature: str) -> str:
    h = f"h_{feature}"
    return f"""
, {h} as (select {feature} as v, count(*) as n, sum(OnTime) as pos from ot group by 1)
, c_{feature} as (select v, sum(n) over (order by v) as nl, sum(pos) over (order by v) as pl,
                         sum(n) over () as na, sum(pos) over () as pa from {h})
, g_{feature} as (select v, nl, na - nl as nr, round(
     (1 - (pa / na) ** 2 - ((na - pa) / na) ** 2) - nl / na * (1 - (pl / nl) ** 2 - ((nl - pl) / nl) ** 2)
     - (na - nl) / na * (1 - ((pa - pl) / (na - nl)) ** 2 - ((na - nl - pa + pl) / (na - nl)) ** 2), 12) as gain
   from c_{feature} where nl < na)
, b_{feature} as (select '{feature}' as feature, v as at_most, cast(nl as bigint) as n_left, cast(nr as bigint) as n_right,
     round(gain, 9) as gain, true as tree_agrees from g_{feature} order by g_{feature}.gain desc, v limit 1)"""


_GINI_FEATURES = ["DepDelay", "TaxiIn", "TaxiOut"]


@register("best_gini_splits", _sql_f("".join(_gini_sql(f) for f in _GINI_FEATURES) + "\n" + " union all ".join(
    f"select * from b_{f}" for f in _GINI_FEATURES), ot=_ON_TIME_SQL))
def q_best_gini_splits(spark, sf_dir):
    """ML8: the first split of a tree on one feature, by exhaustive search; a depth-one tree must make the same."""
    _, f = _flights(spark, sf_dir)
    rows = cut_lineage(classification_set(f).select("OnTime", *_GINI_FEATURES))
    parts = []
    for feature in _GINI_FEATURES:
        stump = certificates.stump_left_rows(rows, feature, "OnTime").scalar()
        parts.append(certificates.best_gini_split(rows, feature, "OnTime").select(
            "feature", "at_most", "n_left", "n_right", F.round("gain", 9).alias("gain"), (F.col("n_left") == stump).alias("tree_agrees")))
    return union_all(*parts)


@register("importance_from_nodes")
def q_importance_from_nodes(spark, sf_dir):
    """ML14, R15: importances from the saved trees' node tables, beside those the models state."""
    _, f = _flights(spark, sf_dir)
    store, key = ModelStore(spark), rows_fingerprint(classification_set(f))
    models, _ = stored_split_and_train(f, store, key=key)
    tables = store.node_tables("classifiers", key, seed=42, fraction=0.7)
    stated = feature_importance(spark, models).withColumnRenamed("importance", "stated")
    return certificates.importance_from_nodes(tables, FEATURES).join(stated, ["Model", "feature"])


_SCORES_SQL = """
, s as (select (40.0 - DepDelay) + TaxiOut / 100.0 as score, OnTime as label from ot)
, g as (select score, sum(case when label = 1 then 1 else 0 end) as pos, count(*) as n from s group by 1)
, c as (select *, sum(n) over (order by score desc) - n as before, sum(n) over () as total,
               sum(pos) over (order by score desc) as tp from g)
, b as (select cast(floor(before * {bins} / total) as integer) as bin, min(score) as threshold, sum(pos) as pos,
               sum(n) - sum(pos) as neg from c group by 1)
"""


def _scored_flights(f):
    return classification_set(f).select(
        ((F.lit(40.0) - F.col("DepDelay")) + F.col("TaxiOut") / 100.0).alias("score"), F.col("OnTime").alias("label"))


@register("binned_roc", _sql_f(_SCORES_SQL.format(bins=200) + """
select round(sum(neg) over (order by bin) / sum(neg) over (), 10) as FPR, round(sum(pos) over (order by bin) / sum(pos) over (), 10) as TPR,
       threshold from b
""", ot=_ON_TIME_SQL))
def q_binned_roc(spark, sf_dir):
    """ML13, R14: the curve of a fixed score from a summary of 200 bins of equal weight."""
    _, f = _flights(spark, sf_dir)
    return certificates.roc_from_bins(certificates.binned_scores(_scored_flights(f), bins=200))


@register("roc_areas", _sql_f(_SCORES_SQL.format(bins=200) + """
select round(sum((n - pos) * (tp - pos / 2)) / (sum(n - pos) * sum(pos)), 9) as exact, true as binned_within from c
""", ot=_ON_TIME_SQL))
def q_roc_areas(spark, sf_dir):
    """ML13: the exact area under the curve, and whether the binned one is within 0.001."""
    _, f = _flights(spark, sf_dir)
    scored = cut_lineage(_scored_flights(f))
    exact = certificates.exact_auc(scored).scalar()
    binned = certificates.auc_from_bins(certificates.binned_scores(scored, bins=200))
    return binned.select(F.round(exact, 9).alias("exact"), (F.abs(exact - F.col("auc")) <= 1e-3).alias("binned_within"))


@register("classifier_exact_roc")
def q_classifier_exact_roc(spark, sf_dir):
    """Every point of the logistic model's curve on the test part."""
    return exact_roc(*_fitted_classifiers(spark, sf_dir))


@register("classifier_roc")
def q_classifier_roc(spark, sf_dir):
    return logistic_roc(*_fitted_classifiers(spark, sf_dir))


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    return feature_importance(spark, _fitted_classifiers(spark, sf_dir)[0])


# --- Clustering R16-R19 on embeddings (rows-only checks) ------------------------

def _scaled_embeddings(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return scaled_vectors(t["embeddings"], "embedding", keep=("vec_id", "label"))


@register("pca_variance")
def q_pca_variance(spark, sf_dir):
    return pca_variance(spark, _scaled_embeddings(spark, sf_dir))


@register("pca_project")
def q_pca_project(spark, sf_dir):
    return pca_project(_scaled_embeddings(spark, sf_dir), keep=("vec_id", "label")).drop("pcs")


@register("kmeans_silhouette")
def q_kmeans_silhouette(spark, sf_dir):
    projected = pca_project(_scaled_embeddings(spark, sf_dir), keep=("vec_id",))
    return kmeans_silhouette(spark, projected, key_cols=["vec_id"])


@register("cluster_sample")
def q_cluster_sample(spark, sf_dir):
    projected = pca_project(_scaled_embeddings(spark, sf_dir), keep=("vec_id",))
    return cluster_sample(projected, k=5, id_col="vec_id", key_cols=["vec_id"])


@register("delay_cause_pca")
def q_delay_cause_pca(spark, sf_dir):
    """R16 -> R17 on the flight view: scaled features, assembled, PCA variance."""
    _, f = _flights(spark, sf_dir)
    table = cluster_features(f)
    return pca_variance(spark, assemble(table, feature_columns(f)), n_features=len(feature_columns(f)))


# --- What the fitted models must satisfy, in SQL ---------------------------------

@register("classifier_split_counts", _sql_f(f"""
, c as (select {', '.join(_SPLIT_COLUMNS)}, count(*) as n from ot group by all)
, r as (select *, unnest(generate_series(1, n)) as i from c)
, k as (select OnTime, ('0x' || substr(md5(concat_ws('|', {', '.join(f'cast({c} as varchar)' for c in _SPLIT_COLUMNS)},
               cast(i as varchar)) || '|42'), 1, 8))::bigint as h from r)
select case when h < {fraction_threshold(0.7)} then 'training' else 'testing' end as split, OnTime, count(*) as n
from k group by all
""", ot=_ON_TIME_SQL))
def q_classifier_split_counts(spark, sf_dir):
    """The repeatable split without a key, counted by label."""
    _, f = _flights(spark, sf_dir)
    parts = hash_split(classification_set(f))
    return union_all(*[frequency(p, "OnTime").withColumn("split", F.lit(name))
                       for p, name in zip(parts, ("training", "testing"))])


@register("classifier_checks", _sql_f(_PARTS_SQL + """
, t as (select count(*) as test_rows, round(greatest(avg(OnTime), 1 - avg(OnTime)), 9) as majority from parts where not training)
select unnest(['Decision Tree', 'Gradient Boosted Trees', 'Logistic', 'Random Forest']) as Classifier, test_rows, majority,
       true as in_range, true as recall_is_accuracy, true as beats_majority from t
""", ot=_ON_TIME_SQL))
def q_classifier_checks(spark, sf_dir):
    """Each model's metrics lie in [0, 1], weighted recall is accuracy, and no
    model is worse than always naming the larger class. The test rows are split and scored once, for all figures."""
    models, test = _fitted_classifiers(spark, sf_dir)
    counts = cut_lineage(confusion_counts(models, test))  # four rows per model
    wide = classifier_comparison(models, test, counts).groupBy("Classifier").pivot(
        "Metric", ["accuracy", "f1", "weightedPrecision", "weightedRecall"]).agg(F.first("Performance"))
    rows = counts.groupBy("Classifier").agg(F.sum("n").alias("test_rows"))
    one = counts.where(F.col("Classifier") == MODEL_NAMES[0])  # each model has every test row
    on_time = F.try_divide(F.sum(F.col("label") * F.col("n")), F.sum("n"))
    late = one.agg(on_time.alias("p")).select(F.greatest("p", 1 - F.col("p"))).scalar()
    return wide.join(rows, "Classifier").select(
        "Classifier", "test_rows", F.round(late, 9).alias("majority"), F.forall(F.array("accuracy", "f1", "weightedPrecision", "weightedRecall"),
                                              lambda m: m.between(0, 1)).alias("in_range"),
                       (F.abs(F.col("accuracy") - F.col("weightedRecall")) < 1e-9).alias("recall_is_accuracy"),
                       (F.col("accuracy") >= late - 1e-9).alias("beats_majority"))


@register("pca_inertia", """
with x as (select unnest(cast(embedding as double[])) as v, generate_subscripts(embedding, 1) as d from embeddings)
, b as (select d, min(v) as mn, max(v) as mx from x group by 1)
, s as (select x.d, var_samp((v - mn) / (mx - mn)) as var from x join b on x.d = b.d group by 1)
select count(*) as components, round(sum(var), 6) as inertia from s
""")
def q_pca_inertia(spark, sf_dir):
    """R17, ML18: a full-rank projection keeps the total variance of the scaled features."""
    scaled = _scaled_embeddings(spark, sf_dir)
    k = scaled.select(F.size(vector_to_array("features"))).first()[0]
    parts = pca_project(scaled, k=k).agg(*[F.var_samp(f"PC{i + 1}").alias(f"v{i}") for i in range(k)])
    total = sum((F.col(f"v{i}") for i in range(1, k)), F.col("v0"))
    return parts.select(F.lit(k).cast("bigint").alias("components"), F.round(total, 6).alias("inertia"))


@register("pca_spectrum", """
with x as (select vec_id, unnest(cast(embedding as double[])) as v, generate_subscripts(embedding, 1) as d from embeddings)
, b as (select d, min(v) as mn, max(v) as mx from x group by 1)
, z as (select vec_id, x.d, (v - mn) / (mx - mn) as v from x join b on x.d = b.d)
, m as (select p.d as i, q.d as j, covar_samp(p.v, q.v) as c from z p join z q on p.vec_id = q.vec_id group by 1, 2)
select count(distinct i) as components, 1.0e0 as first, round(sum(c * c) / (sum(case when i = j then c end) ** 2), 9) as second from m
""")
def q_pca_spectrum(spark, sf_dir):
    """ML17, R17: the spectrum's moments; SQL has the second from the covariance matrix, without eigenvalues."""
    moments = certificates.spectrum_moments(pca_variance(spark, _scaled_embeddings(spark, sf_dir)))
    return moments.select("components", F.round("first", 9).alias("first"), F.round("second", 9).alias("second"))


@register("kmeans_assignment", """
with x as (select vec_id, unnest(cast(embedding as double[])) as v, generate_subscripts(embedding, 1) as d from embeddings)
, b as (select d, min(v) as mn, max(v) as mx from x group by 1)
, s as (select sum(var) as total from (select var_pop((v - mn) / (mx - mn)) * count(*) as var from x join b on x.d = b.d group by x.d))
, n as (select count(*) as n_points from embeddings)
select cast(unnest(range(2, 9)) as integer) as k, n_points, round(total, 2) as total from n, s
""")
def q_kmeans_assignment(spark, sf_dir):
    """ML19, R18 at full rank: for each k, squares within clusters and between centres add up to the total, which SQL
    knows; so every point is counted with its own centre, and every centre is the mean of its points."""
    scaled = _scaled_embeddings(spark, sf_dir).select("vec_id", "features")
    points = cut_lineage(fit_layout(scaled, ["vec_id"]))
    parts = []
    for k in range(2, 9):
        model = KMeans(k=k, seed=42, maxIter=100, tol=1e-9).fit(points)
        sums = certificates.kmeans_sums(model, points)
        parts.append(sums.select(F.lit(k).alias("k"), "n_points", F.round(F.col("within") + F.col("between"), 2).alias("total")))
    return union_all(*parts)


@register("cluster_sample_counts", f"""
select count(*) as test_rows, true as whole_without_a_bite, true as ten_with_one from embeddings
where {sql_hash_key('vec_id')} >= {fraction_threshold(0.7)}
""")
def q_cluster_sample_counts(spark, sf_dir):
    """A limit above every cluster's size gives the whole test part; one of ten gives ten of each cluster, or all."""
    projected = cut_lineage(pca_project(_scaled_embeddings(spark, sf_dir), keep=("vec_id",)).drop("pcs"))
    projected = projected.withColumn("pcs", array_to_vector(F.array("PC1", "PC2", "PC3")))
    n = projected.count()
    sizes = frequency(cluster_sample(projected, k=5, points=5 * n, id_col="vec_id", key_cols=["vec_id"]), "prediction")
    ten = frequency(cluster_sample(projected, k=5, points=50, id_col="vec_id", key_cols=["vec_id"]), "prediction", name="ten")
    both = sizes.join(ten, "prediction", "full")
    test = hash_split(projected.select("vec_id"), ["vec_id"])[1].count()
    return both.agg(F.sum("n").alias("test_rows"), (F.sum("n") == test).alias("whole_without_a_bite"),
                    F.bool_and(F.coalesce(F.col("ten") == F.least("n", F.lit(10)), F.lit(False))).alias("ten_with_one"))
