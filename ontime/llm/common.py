"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import shutil
import tempfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import ontime

WORD_SQL = r"[^\x20\x09-\x0D]+"  # the words of every contract; bytes.split() splits the same way


_shipped: set[str] = set()


# Texts are long, so the Arrow batches of a task are bounded by bytes, well below Spark's default.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m")


def prepare(spark: SparkSession) -> None:
    """Send this package to the executors (once per application, as ``--py-files`` would)
    and bound Arrow batches, unless the session already sets another bound."""
    name, default, ours = BATCH_BYTES
    if spark.conf.get(name) == default:
        spark.conf.set(name, ours)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(ontime.__file__)))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="ontime-pkg-"), "ontime_package"), "zip",
                                      root, "ontime")
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def utf8(col: str | Column) -> Column:
    """Text as UTF-8 bytes (NULL stays NULL), so that Arrow hands it to Python undecoded."""
    return (F.col(col) if isinstance(col, str) else col).cast("binary")


def row_key(id_col: str, text_col: str) -> list[Column]:
    """A 96-bit content key (_k1, _k2) of a row; rows equal in id and text share it."""
    return [F.xxhash64(F.col(id_col), F.col(text_col)).alias("_k1"),
            F.hash(F.col(text_col), F.col(id_col)).alias("_k2")]


def with_row(df: DataFrame, *more: Column) -> DataFrame:
    """The whole row as the struct ``_row`` beside ``more``, so that no column name can clash."""
    return df.select(F.struct("*").alias("_row"), *more)


def row_with(df: DataFrame, names: list[str], results: str) -> DataFrame:
    """``_row.*`` and the fields of the struct ``results``; a result replaces an input column of its name."""
    new = [f.name for f in df.schema[results].dataType.fields]
    return df.select(*(F.col("_row").getField(c).alias(c) for c in names if c not in new), f"{results}.*")


def learnable(id_col: Column | str) -> Column:
    """True unless crc32(id as text) mod 3 is 1 (the held-out rows); a NULL id is held out."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def held_out(id_col: Column | str) -> Column:
    return ~learnable(id_col)


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """At most ``n`` distinct rows, the smallest by a seeded hash of the whole row: the same rows on any layout.

    A histogram of the distinct rows over the hash's upper 16 bits gives the cut that
    holds the first ``n`` of them (all, if there are no more), so that tasks do not
    each send ``n`` rows to be merged. Rows that share a key are told apart by their values.
    """
    h = F.xxhash64(F.lit(42), *[F.col(f"`{c}`") for c in df.columns])
    upper = F.shiftright(h, 48)
    counts = sorted(tuple(r) for r in df.select(h.alias("h")).distinct().groupBy(F.shiftright("h", 48).alias("b")).count().collect())
    held = 0
    for bucket, count in counts:
        held += count
        if held >= n:
            df = df.where(upper <= bucket)
            break
    return df.dropDuplicates().orderBy(h, F.col(key)).limit(n)


def windows_of(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out
