"""Group counts, distinct tuples, conditional sums and shares.

All of them are hash aggregates with a map-side partial step, so a hot
key is combined inside each task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def frequency(df: DataFrame, *cols: str, name: str = "n") -> DataFrame:
    """count(cols): one row per value (NULL is a value), with its row count (A1-A4)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def distinct_tuple_count(df: DataFrame, group_cols, tuple_cols, name: str = "n") -> DataFrame:
    """Distinct (tuple_cols) per group, NULL tuples included (A5).

    Not ``countDistinct``: that one skips tuples holding a NULL.
    """
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    return (df.select(*group_cols, *tuple_cols).distinct()
            .groupBy(*group_cols).agg(F.count(F.lit(1)).alias(name)))


def conditional_sums(df: DataFrame, cols, predicate=lambda c: c > 0, group_cols=(), plain=None) -> DataFrame:
    """sum(c) over rows where predicate(c) holds, for every c in one pass.

    ``plain`` ({column: name}) adds plain sums to the same pass. An empty
    selection gives NULL, as ``sum`` over no rows does.
    """
    aggs = [F.sum(F.when(predicate(F.col(c)), F.col(c))).alias(c) for c in cols]
    aggs += [F.sum(c).alias(name) for c, name in (plain or {}).items()]
    return df.groupBy(*group_cols).agg(*aggs)


def percent_of_group(df: DataFrame, group_cols, n_col: str = "n", name: str = "Percent",
                     total_name: str | None = None) -> DataFrame:
    """100 * n / (sum of n in its group) on already aggregated rows.

    The window runs over the aggregated rows only (a handful per group).
    A NULL group key forms one group here; a SQL full join would split it.
    """
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    total = F.sum(n_col).over(Window.partitionBy(*group_cols))
    out = df.withColumn(name, F.col(n_col) / total * 100)
    if total_name:
        out = out.withColumn(total_name, total)
    return out


def share_of(part: Column, whole: Column) -> Column:
    """(part / whole) * 100; NULL when whole is 0 or NULL (A10)."""
    return F.try_divide(part, whole) * 100


def unpivot(df: DataFrame, ids, value_cols, names=None, var_name: str = "group",
            value_name: str = "value") -> DataFrame:
    """Wide -> long rows with a label column."""
    names = names or list(value_cols)
    renamed = df.select(*ids, *[F.col(c).alias(n) for c, n in zip(value_cols, names)])
    return renamed.unpivot(list(ids), list(names), var_name, value_name)
