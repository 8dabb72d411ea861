"""Bucketize (ML3, C17) as a CASE expression that stays in generated code.

Half-open ranges [a, b); the last range also holds +inf; NULL in, NULL out.
Equal to ``pyspark.ml.feature.Bucketizer`` with the same splits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Arrival-delay splits in minutes.
DELAY_SPLITS = [-math.inf, 0.0, 5.0, 15.0, 30.0, 60.0, math.inf]


def bucketize(value: Column, splits=DELAY_SPLITS) -> Column:
    """Bucket index as DOUBLE (like Bucketizer)."""
    inner = splits[1:-1]
    expr = None
    for i, edge in enumerate(inner):
        cond = value < F.lit(edge)
        expr = F.when(cond, F.lit(float(i))) if expr is None else expr.when(cond, F.lit(float(i)))
    last = float(len(splits) - 2)
    if expr is None:
        return F.when(value.isNotNull(), F.lit(0.0))
    hi = splits[-1]
    lo = splits[0]
    in_range = value.isNotNull() & (value <= F.lit(hi)) & (value >= F.lit(lo))
    return F.when(in_range, expr.otherwise(F.lit(last)))


def sql_bucketize(expr: str, splits=DELAY_SPLITS) -> str:
    inner = splits[1:-1]
    arms = " ".join(f"when {expr} < {e!r} then {float(i)!r}e0" for i, e in enumerate(inner))
    return f"case when {expr} is null then null {arms} else {float(len(splits) - 2)!r}e0 end"
