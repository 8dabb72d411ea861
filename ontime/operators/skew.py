"""Equi-joins that stay balanced when a few keys hold most rows.

AQE splits a skewed partition of an inner or left join, but not of a full outer
join, where one task gets all rows of a frequent key, and all NULL keys. Here
the frequent keys are measured first. Rows of such a key are dealt over cells
(i, j): a left row draws i and is copied to every j, a right row draws j and is
copied to every i, so that each pair of rows meets in exactly one cell, and the
number of cells follows from the measured rows of both sides. A cell may be
empty on one side; the other side's row there is no unmatched row if its key has
rows on both sides, so such rows are dropped. A key of one side alone is dealt
without copies, and its rows come out once.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.operators.ranking import numbered_rows

FULL = ("full", "outer", "full_outer", "fullouter")
KINDS = ("inner", "left", "left_outer", "leftouter", "right", "right_outer", "rightouter", *FULL)


def key_counts(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows of every key, NULL keys included, combined map-side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def frequent_keys(left: DataFrame, right: DataFrame, keys: list[str], share: float) -> tuple[DataFrame, int, int] | None:
    """Keys with more than ``share`` of the rows of a side: (keys, left rows, right rows of each), and both totals.

    At most 1 / share keys of either side can be frequent, whatever the table holds.
    """
    counts = (key_counts(left, keys, "__n").select(*keys, F.col("__n").alias("__l"), F.lit(0).cast("bigint").alias("__r"))
              .unionAll(key_counts(right, keys, "__n").select(*keys, F.lit(0).cast("bigint"), F.col("__n")))
              .groupBy(*keys).agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r")))
    totals = counts.agg(F.coalesce(F.sum("__l"), F.lit(0)).alias("l"), F.coalesce(F.sum("__r"), F.lit(0)).alias("r")).first()
    hot = counts.where((F.col("__l") > F.lit(share * totals["l"])) | (F.col("__r") > F.lit(share * totals["r"])))
    rows = hot.collect()
    if not rows:
        return None
    return left.sparkSession.createDataFrame(rows, hot.schema), totals["l"], totals["r"]


def _pieces(rows: Column, per_piece: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(rows / F.lit(per_piece))).cast("int")


def _dealt(df: DataFrame, keys, hot: DataFrame, own: str, other: str, unique_by) -> DataFrame:
    """Rows with their cell (__i, __j) and whether their key has rows on both sides.

    A row's draw depends on its values (and on its number among equal rows), never on
    its place in a partition, so that a task that runs again deals alike.
    """
    mine, theirs = ("__i", "__j") if own == "__sl" else ("__j", "__i")
    tagged = df.join(F.broadcast(hot), reduce(and_, [df[k].eqNullSafe(hot[f"__h{n}"]) for n, k in enumerate(keys)]), "left") \
        .drop(*[f"__h{n}" for n in range(len(keys))])
    draw = F.pmod(F.xxhash64(*(unique_by or df.columns)), F.coalesce(F.col(own), F.lit(1))).cast("int")
    if unique_by:
        cells = tagged.withColumn(mine, draw)
    else:  # equal rows of a frequent key draw apart by their number
        spread = numbered_rows(tagged.where(F.col(own) > 1), "__copy")
        apart = F.pmod(F.xxhash64(*df.columns, "__copy"), F.col(own)).cast("int")
        rest = tagged.where(F.coalesce(F.col(own), F.lit(1)) == 1)
        cells = spread.withColumn(mine, apart).drop("__copy").unionByName(rest.withColumn(mine, F.lit(0)))
    copies = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
    return cells.withColumn(theirs, F.explode(copies)).withColumn("__met", F.coalesce("__met", F.lit(False))) \
        .select(*df.columns, "__i", "__j", "__met")


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "full", share: float | None = None,
                pieces_per_partition: int = 8, left_unique=None, right_unique=None) -> DataFrame:
    """Join on the common columns ``keys``; the key columns come out once, coalesced.

    SQL equality: NULL keys match nothing. ``share``: a key above this share of
    either side's rows is dealt over cells (default: one shuffle partition's
    part). A cell holds about a ``pieces_per_partition``-th of a partition.
    ``left_unique`` / ``right_unique`` name columns that tell a side's rows
    apart; without them, rows of frequent keys are numbered among their equals.
    Non-key columns of both sides must differ in name.
    """
    if how not in KINDS:
        raise ValueError(f"salted_join does {', '.join(KINDS)}, not {how}")
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = frequent_keys(left, right, keys, share or 1 / max(2, partitions))
    if found is None:
        return left.join(right, keys, how)
    counts, n_left, n_right = found
    per_piece = max(1, (n_left + n_right) // (partitions * pieces_per_partition))
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    hot = counts.select(
        *[F.col(k).alias(f"__h{n}") for n, k in enumerate(keys)],
        _pieces(F.col("__l"), per_piece).alias("__sl"), _pieces(F.col("__r"), per_piece).alias("__sr"),
        ((F.col("__l") > 0) & (F.col("__r") > 0) & ~some_null).alias("__met"))
    # a NULL key meets no row: each side is dealt on its own, without copies
    hot_left = hot.withColumn("__sr", F.when(F.col("__met"), F.col("__sr")).otherwise(1))
    hot_right = hot.withColumn("__sl", F.when(F.col("__met"), F.col("__sl")).otherwise(1))
    a = _dealt(left, keys, hot_left, "__sl", "__sr", left_unique).withColumn("__in_left", F.lit(True))
    b = _dealt(right, keys, hot_right, "__sr", "__sl", right_unique).withColumn("__in_right", F.lit(True)) \
        .withColumnRenamed("__met", "__met_right")
    joined = a.join(b, [*keys, "__i", "__j"], how)
    artefact = F.coalesce("__met", "__met_right") & (F.col("__in_left").isNull() | F.col("__in_right").isNull())
    return joined.where(~artefact).drop("__i", "__j", "__met", "__met_right", "__in_left", "__in_right")
