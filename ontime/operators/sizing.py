"""Size checks in front of every broadcast.

A side is only broadcast after a bounded probe proves that it has at most
``max_rows`` rows and ``max_bytes`` bytes; otherwise the planner keeps its
shuffle join (AQE may still switch to a broadcast at run time from real
statistics).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side we hint as broadcast: a few hundred thousand dimension rows of ordinary width.
DEFAULT_MAX_BROADCAST_ROWS = 200_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def fits(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has <= max_rows rows of <= max_bytes in all (as text, 8 bytes a value at least).

    ``take`` scans partitions incrementally (one, then a few more, ...) and
    stops as soon as max_rows + 1 rows are found, so a huge table costs about
    as much as a small one; of each row only its size comes back.
    """
    width = F.lit(0)
    for c in df.columns:
        width = width + F.greatest(F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)), F.lit(8))
    sizes = df.select(width.alias("x")).take(max_rows + 1)
    return len(sizes) <= max_rows and sum(r.x for r in sizes) <= max_bytes


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has <= max_rows rows."""
    return len(df.select(F.lit(0).cast("tinyint").alias("x")).take(max_rows + 1)) <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when its size is proven small, else ``df`` unchanged."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df
