"""Summarise the physical plan of every registered query (writes PLANS.md).

Usage: python tools/plan_digest.py [sf_dir] > PLANS.md

Counts come from ``explain("formatted")`` after the query has run once
(adaptive plans are final then): shuffles, broadcasts, windows, scans and
any Python evaluation. A checkpointed input shows as ``Scan ExistingRDD``.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from ontime.plans.catalog import QUERIES  # noqa: E402
from ontime.session import session_builder  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _depth(line: str) -> int:
    m = re.search(r"[A-Za-z]", line)
    return m.start() if m else -1


def tree_part(text: str) -> str:
    """Operator tree lines of the query itself: stops at the per-node
    details and leaves out the plan that built a cached input (the fact
    view is built once per session, not per query)."""
    lines, cached_at = [], None
    for line in text.splitlines():
        if re.match(r"^\(\d+\) ", line):
            break
        if cached_at is not None:
            if _depth(line) > cached_at:
                continue
            cached_at = None
        lines.append(line)
        if "InMemoryRelation" in line:
            cached_at = _depth(line)
    return "\n".join(lines)


def digest(text: str) -> dict:
    tree = tree_part(text)
    subq = text.count("Subquery:")
    return {
        "shuffles": len(re.findall(r"\bExchange \(\d+\)", tree)),
        "broadcasts": len(re.findall(r"BroadcastExchange", tree)),
        "windows": len(re.findall(r"\bWindow \(\d+\)", tree)),
        "group_limits": len(re.findall(r"WindowGroupLimit", tree)),
        "scans": len(re.findall(r"\bScan parquet", tree)),
        "columns": sum(s.count(":") for s in re.findall(r"ReadSchema: struct<([^>]*)>", text)),
        "filters": len(re.findall(r"PushedFilters: \[[^\]]*(?!IsNotNull)(?:EqualTo|In|GreaterThan|LessThan)", text)),
        "subqueries": subq,
        "python": "yes" if re.search(r"EvalPython|PythonUDF|MapInPandas|MapInArrow|FlatMapGroupsInPandas", text) else "no",
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session_builder("local[8]", options={"spark.sql.shuffle.partitions": "8"}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_digest.py` on `{sf_dir}` (local[8]). Counts are for the query's own")
    print("plan; model fitting (classifiers, PCA, k-means) runs as separate Spark ML jobs before it.")
    print("The fact view is lazy, so its joins are counted in every query that reads it. `columns` is the number")
    print("of columns in the ReadSchema of all scans, `value filters` the scans with a pushed filter on a value.\n")
    print("| query | scans | columns | value filters | shuffles | broadcasts | windows | group limits | scalar subqueries | Python |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        d = digest(plan_text(df))
        print(f"| {name} | {d['scans']} | {d['columns']} | {d['filters']} | {d['shuffles']} | {d['broadcasts']} | {d['windows']} | "
              f"{d['group_limits']} | {d['subqueries']} | {d['python']} |")


if __name__ == "__main__":
    main()
