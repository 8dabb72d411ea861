"""Code-to-label lookups (C7, C8) and the label tables of the reports."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cancellation code labels (no late-aircraft class).
CANCELLATION_LABELS = {"A": "Carrier", "B": "Weather", "C": "NAS", "D": "Security"}

# Arrival-delay bucket index -> label.
DELAY_BUCKET_LABELS = {
    0.0: "Advance",
    1.0: "0 to 5 minutes",
    2.0: "5 to 15 minutes",
    3.0: "15 to 30 minutes",
    4.0: "30 to 60 minutes",
    5.0: "Above an hour",
}

# Delay-cause names, in report order.
CAUSE_NAMES = ["Carrier", "Weather", "NAS", "Security", "LateAircraft"]


def label_lookup(code: Column, mapping: dict) -> Column:
    """Map literal lookup: NULL for a missing or NULL key (never raises)."""
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(lookup, code)


def sql_case(expr: str, mapping: dict) -> str:
    """The same lookup as a SQL CASE (for oracle text)."""
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else repr(float(v))
    arms = " ".join(f"when {lit(k)} then {lit(v)}" for k, v in mapping.items())
    return f"case {expr} {arms} end"
