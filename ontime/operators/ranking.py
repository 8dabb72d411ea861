"""Top-k with ties (K1, W2), per-group samples (K3) and running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.session import cut_lineage


def top_k_with_ties(df: DataFrame, order_col: str, k: int) -> DataFrame:
    """Rows whose ``rank() over (order by order_col desc)`` is <= k.

    Same rows as the rank filter, computed without a one-partition window:
    the k-th largest value is found with a bounded top-k (k rows per task),
    then every partition filters ``value >= threshold`` in parallel, so even
    a table where every row ties is never gathered into one task. Ties at
    the border are all kept; NULL values are never ranked. The threshold and
    the filter read the same aggregate: its exchange is reused.
    """
    if k <= 0:
        return df.limit(0)
    threshold = (df.where(F.col(order_col).isNotNull())
                 .select(order_col).orderBy(F.desc(order_col)).limit(k)
                 .agg(F.min(order_col)))
    return df.where(F.col(order_col) >= threshold.scalar())


def stratified_sample(df: DataFrame, by, n: int, order_key: Column) -> DataFrame:
    """At most ``n`` rows per group, chosen by a repeatable key (K3).

    ``row_number() <= n`` lets Catalyst put a partial group limit before the
    shuffle, so a hot group sends at most n rows per task.
    """
    by = [by] if isinstance(by, str) else list(by)
    w = Window.partitionBy(*by).orderBy(order_key)
    return (df.withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") <= n).drop("__rn"))


def numbered_rows(df: DataFrame, name: str = "__copy", copies_per_block: int = 100_000) -> DataFrame:
    """Every row with its occurrence number (from 1) among equal rows.

    Equal rows are counted with a map-side step and written out again in
    blocks of at most ``copies_per_block``. The blocks are dealt over
    ``spark.sql.shuffle.partitions`` first: counted rows may be so small that
    adaptive execution puts all into a few tasks, which would then write out
    and process all copies. The numbers do not depend on the layout.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    step = F.lit(copies_per_block).cast("bigint")
    blocks = counted.withColumn("__first", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n"), step)))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.repartition(partitions, *[F.col(f"`{c}`") for c in df.columns], "__first")
    copies = F.sequence(F.col("__first"), F.least(F.col("__n"), F.col("__first") + step - 1))
    return dealt.withColumn(name, F.explode(copies)).drop("__n", "__first")


def running_total(df: DataFrame, order_col: str, value_cols, out_cols=None, keys_per_bucket: int = 500_000,
                  descending: bool = False) -> DataFrame:
    """Running sum of ``value_cols`` over distinct ``order_col`` values.

    Rows are first summed per order value (so each value is one row and a
    hot value cannot swamp a task). The values are then range-partitioned
    into buckets of about ``keys_per_bucket``, as many as their number asks
    for; each bucket gets a local running sum in parallel, and the bucket
    totals (one row each) give it its offset. Any orderable column works; a
    NULL value is one more row and comes last. The per-value sums with their
    bucket are checkpointed, so all branches see the same ranges.
    """
    value_cols = [value_cols] if isinstance(value_cols, str) else list(value_cols)
    out_cols = out_cols or [f"{c}_cum" for c in value_cols]
    order = F.desc_nulls_last(order_col) if descending else F.asc_nulls_last(order_col)
    per_key = cut_lineage(df.groupBy(order_col).agg(*[F.sum(c).alias(c) for c in value_cols]))
    buckets = max(1, -(-per_key.count() // keys_per_bucket))
    bounded = cut_lineage(per_key.repartitionByRange(buckets, order).withColumn("__b", F.spark_partition_id()))
    totals = bounded.groupBy("__b").agg(*[F.sum(c).alias(f"__t{i}") for i, c in enumerate(value_cols)])
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__b", *[F.coalesce(F.sum(f"__t{i}").over(before), F.lit(0)).alias(f"__o{i}")
                                     for i in range(len(value_cols))])
    local = Window.partitionBy("__b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = bounded.select(order_col, *value_cols, "__b",
                            *[F.sum(c).over(local).alias(f"__l{i}") for i, c in enumerate(value_cols)])
    return (summed.join(offsets, "__b")
            .select(order_col, *value_cols,
                    *[(F.col(f"__l{i}") + F.col(f"__o{i}")).alias(o) for i, o in enumerate(out_cols)]))
