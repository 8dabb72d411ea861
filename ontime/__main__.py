"""Run one report over flight CSV files from the command line.

    python -m ontime --flights flights.csv --carriers airlines.csv \
        --airports airports.csv --report top_routes --k 25 [--out dir] [--show 20]

Without ``--out`` the first rows are printed; with it the whole report is
written as Parquet (the report itself is computed on the cluster).
"""

from __future__ import annotations

import argparse
import inspect

from ontime.plans.dashboard import FlightReports
from ontime.session import session_builder
from ontime.sources import load_flight_sources

REPORTS = [name for name, fn in inspect.getmembers(FlightReports, inspect.isfunction)
           if not name.startswith("_") and name != "close"]


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="ontime")
    ap.add_argument("--flights", required=True)
    ap.add_argument("--carriers", required=True)
    ap.add_argument("--airports", required=True)
    ap.add_argument("--report", required=True, choices=REPORTS)
    ap.add_argument("--column", help="attribute_distribution: column name")
    ap.add_argument("--airport", help="traffic_windows: one airport code")
    ap.add_argument("--carrier", help="delay_cause_share: one carrier code")
    ap.add_argument("--columns", help="correlation and clustering reports: comma-separated column names")
    ap.add_argument("--days", type=int, default=12)
    ap.add_argument("--k", type=int, default=None)
    ap.add_argument("--out")
    ap.add_argument("--show", type=int, default=20)
    ap.add_argument("--master")
    args = ap.parse_args(argv)

    spark = session_builder(args.master).getOrCreate()
    flights, carriers, airports = load_flight_sources(spark, args.flights, args.carriers, args.airports)
    columns = [c for c in (args.columns or "").split(",") if c]
    reports = FlightReports(spark, flights, carriers, airports, columns=columns or None)
    method = getattr(reports, args.report)
    kwargs = {}
    params = inspect.signature(method).parameters
    for name, value in (("column", args.column), ("airport", args.airport), ("carrier", args.carrier),
                        ("days", args.days), ("k", args.k)):
        if name in params and value is not None:
            kwargs[name] = value
    df = method(**kwargs)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.show, truncate=False)
    reports.close()


if __name__ == "__main__":
    main()
