"""Repeatable train/test split (ML1) and fit layout shared by the ML plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions.keys import fraction_threshold, hash_key
from ontime.operators.ranking import numbered_rows


def split_label(key_cols, fraction: float = 0.7, seed: int = 42) -> Column:
    """'training' for ~fraction of keys (by md5 of key and seed), else 'testing'."""
    key_cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    return F.when(hash_key([F.col(c) for c in key_cols], seed) < F.lit(fraction_threshold(fraction)),
                  F.lit("training")).otherwise(F.lit("testing"))


def hash_split(df: DataFrame, key_cols=None, fraction: float = 0.7, seed: int = 42):
    """(training, testing), about ``fraction`` of the rows in training.

    Each row goes by md5 of its key and the seed (:func:`split_label`), so the
    split does not depend on partitioning and is the same in any engine.
    Without a unique key, the whole row and its occurrence number are the key.
    """
    keyed = df if key_cols else numbered_rows(df)
    label = split_label(key_cols or keyed.columns, fraction, seed)
    train, test = keyed.where(label == "training"), keyed.where(label == "testing")
    return (train, test) if key_cols else (train.drop("__copy"), test.drop("__copy"))


def labelled_rows(df: DataFrame, fraction: float = 0.7, seed: int = 42) -> DataFrame:
    """Every row with ``training``, its part in :func:`hash_split` without a key, for both parts in one pass."""
    keyed = numbered_rows(df)
    return keyed.withColumn("training", split_label(keyed.columns, fraction, seed) == "training").drop("__copy")


# Rows in one partition of a fit input; beyond MOST_PARTITIONS they grow, up to 5 million. A fit runs hundreds of jobs,
# and each task of each job answers the driver, so the partitions must not grow with the rows.
ROWS_PER_PARTITION = 50_000
MOST_PARTITIONS = 96


def fit_partitions(rows: int) -> int:
    """Number of partitions of a fit input: a function of its size alone."""
    return max(1, min(-(-rows // ROWS_PER_PARTITION), max(MOST_PARTITIONS, rows // 5_000_000)))


def fit_layout(df: DataFrame, key_cols, partitions: int | None = None) -> DataFrame:
    """Rows dealt by a hash of their values and sorted within each partition.

    Bagging and random starts draw per partition and in row order, so a fit
    on this layout gives the same model whatever the input's layout was.
    """
    key_cols = list(key_cols)
    n = partitions or fit_partitions(df.count())
    return df.repartition(n, *key_cols).sortWithinPartitions(*key_cols)
