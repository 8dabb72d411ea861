"""Physical-plan properties the reports rely on at scale."""

import contextlib
import io

from __spark_entry__ import queries
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_no_python_in_relational_reports(spark):
    q = queries()
    for name in ("arrival_delay_buckets", "cancellation_causes", "delay_cause_share", "routes_per_carrier",
                 "traffic_windows", "hhmm_to_utc", "dominant_cause", "roc_points", "silhouette_given_labels"):
        text = plan_of(q[name](spark, SF_SMALL))
        assert "EvalPython" not in text and "PythonUDF" not in text, name


def test_partial_aggregation_and_broadcast_lookup(spark):
    text = plan_of(queries()["arrival_delay_buckets"](spark, SF_SMALL))
    assert "partial_count" in text
    assert "BroadcastHashJoin" in text


def test_scan_pruning_and_pushdown(spark):
    text = plan_of(queries()["traffic_windows"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text
    text = plan_of(queries()["carrier_codes"](spark, SF_SMALL))
    assert "l_extendedprice" not in text and "l_quantity" not in text  # one column of the fact view
    text = plan_of(queries()["cancellation_causes"](spark, SF_SMALL))
    assert "l_quantity" not in text  # its filter is on a computed column of F, so only pruning reaches the scan


def test_top_k_has_no_single_partition_window(spark):
    text = plan_of(queries()["top_k_ties"](spark, SF_SMALL))
    assert "Window " not in text.replace("WindowGroupLimit", "")
    assert "TakeOrderedAndProject" in text and "Scan ExistingRDD" not in text  # nothing was checkpointed
    assert text.count("Exchange hashpartitioning") <= 2


def test_sample_limits_groups_before_the_shuffle(spark):
    text = plan_of(queries()["stratified_sample"](spark, SF_SMALL))
    assert text.count("WindowGroupLimit") >= 2  # partial (before exchange) and final


def test_busiest_airports_scans_the_fact_once(spark):
    from ontime.sources import driver_tables as dt
    from ontime.sources.readers import load_tables
    from ontime.plans.reports import airport_counts
    t = load_tables(spark, SF_SMALL, ["lineitem", "orders", "customer", "supplier", "nation"])
    text = plan_of(airport_counts(dt.flight_view(t)))
    assert text.count("Location: ") == 4  # lineitem, orders, customer, supplier: each read once
    assert text.count("[partial_sum(") == 1  # one map-side aggregate for both sides
