"""Tumbling time-window counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling_count(df: DataFrame, ts_col: str, days: int, group_cols=(), tag: str | None = None,
                   tag_name: str = "Type", name: str = "n") -> DataFrame:
    """Rows per ``days``-wide window, windows aligned to 1970-01-01 00:00.

    Rows with a NULL instant fall in no window. The window struct is
    flattened to its start (one row per window).
    """
    group_cols = list(group_cols)
    out = (df.where(F.col(ts_col).isNotNull())
           .groupBy(*group_cols, F.window(ts_col, f"{int(days)} days").alias("__w"))
           .agg(F.count(F.lit(1)).alias(name))
           .select(*group_cols, F.col("__w.start").cast("timestamp_ntz").alias("window_start"), name))
    if tag is not None:
        out = out.withColumn(tag_name, F.lit(tag))
    return out
