"""Every registered query on sf0.001: oracle SQL in DuckDB gives the same rows."""

import datetime as _dt
import math
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ontime.plans.catalog import ORACLE, QUERIES
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6g}")
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


# DuckDB type name -> Spark simpleString
DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["name", "Percent", "ArrDelayBucketMapped"]
    assert df.count() > 0


def test_rows_only_queries_have_a_sql_companion():
    """Fitted models have no SQL; each kind has a query of what it must satisfy."""
    companions = {"classifier_split_counts", "classifier_checks", "pca_inertia", "kmeans_assignment", "cluster_sample_counts"}
    assert companions <= set(ORACLE) and set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(oracle_sql()[name])
    want = _canon([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
    rel = duck.sql(oracle_sql()[name])
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)} == spark_types


def test_ml_outputs_invariants(spark):
    q = queries()
    pca = q["pca_variance"](spark, SF_SMALL).orderBy("NPC").collect()
    vals = [r.PCValue for r in pca]
    assert all(a >= b - 1e-9 for a, b in zip(vals, vals[1:]))
    assert pca[-1].PCCum == pytest.approx(100.0, abs=1e-6)
    sil = q["kmeans_silhouette"](spark, SF_SMALL).collect()
    assert [r.NumberCluster for r in sil] == list(range(2, 9))
    assert all(-1.0 <= r.Silhouette <= 1.0 for r in sil)
    sample = q["cluster_sample"](spark, SF_SMALL)
    assert max(r["count"] for r in sample.groupBy("prediction").count().collect()) <= 1000
    metrics = q["classifier_comparison"](spark, SF_SMALL).collect()
    assert len(metrics) == 16 and all(0.0 <= r.Performance <= 1.0 for r in metrics)
    roc = q["classifier_roc"](spark, SF_SMALL).collect()
    assert (roc[0].FPR, roc[0].TPR) == (0.0, 0.0) and (roc[-1].FPR, roc[-1].TPR) == (1.0, 1.0)
    imp = q["feature_importance"](spark, SF_SMALL).collect()
    assert len(imp) == 12


def test_classifier_checks_read_the_test_rows_once(spark):
    """Three passes over the split and scored rows made this query; all its figures come from one confusion matrix."""
    from tests.test_store import plan_of
    checks = queries()["classifier_checks"](spark, SF_SMALL)
    text = plan_of(checks)
    assert "parquet" not in text and "Generate explode" not in text
    rows = checks.collect()
    assert len(rows) == 4 and len({(r.test_rows, r.majority) for r in rows}) == 1
    assert all(r.in_range and r.recall_is_accuracy for r in rows)
