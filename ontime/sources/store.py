"""Tables written once to shared storage: partitioned, bucketed, sorted.

The dashboard prepared its fact table once and then only read it. Here a prepared
table is written under the shared folder of the session, in a layout that later
queries use without moving rows: folders per partition value, so that filters
and joins on it prune files (also at run time); files per bucket of a key that
spreads evenly, so that tables bucketed alike join without an exchange; rows
sorted in each file, so that row groups can be skipped.

A table is known by the fingerprint of what it was made from (the names, sizes
and times of the source files, and a version text). A second session finds it by
that and only reads. An attempt writes to a folder of its own, and a manifest
that names the folder is written last: an attempt that died leaves no manifest,
and of two attempts at a time both are whole and one is taken.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.session import checkpoint_dir


@dataclass(frozen=True)
class Layout:
    """How a stored table lies on disk. ``bucket_by`` should spread evenly: a hot value would fill one bucket."""
    bucket_by: tuple[str, ...]
    buckets: int
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()


def buckets_for(rows: int, rows_per_bucket: int = 4_000_000, least: int = 4) -> int:
    """A power of two, so that tables of different size can still share bucket borders."""
    n = least
    while n * rows_per_bucket < rows:
        n *= 2
    return n


def fingerprint(spark: SparkSession, paths: list[str], version: str) -> str:
    """32 hex digits over name, size and time of every file below the paths; the contents are not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
             .select("path", "length", "modificationTime"))
    key = F.xxhash64("path", "length", "modificationTime")
    seen = files.agg(F.count(F.lit(1)), F.sum(F.pmod(key, F.lit(1 << 31))), F.bit_xor(key)).first()
    return hashlib.md5(f"{version}|{tuple(seen)}".encode()).hexdigest()


def _manifest(spark: SparkSession, folder: str) -> dict | None:
    try:
        rows = spark.read.schema("path string, layout string, columns string").json(f"{folder}/manifest").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return min((r.asDict() for r in rows), key=lambda r: r["path"], default=None)


def _write(df: DataFrame, folder: str, layout: Layout, dealt: bool = False) -> None:
    spark, path = df.sparkSession, f"{folder}/data-{uuid.uuid4().hex}"
    table = f"ontime_write_{uuid.uuid4().hex}"
    # all rows of one file go to one task, so that a cell of the layout is one file
    bucket = F.pmod(F.hash(*layout.bucket_by), F.lit(layout.buckets))
    rows = df if dealt else df.repartition(*layout.partition_by, bucket)
    writer = rows.write.format("parquet").option("path", path)
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    writer = writer.bucketBy(layout.buckets, *layout.bucket_by)
    if layout.sort_by:
        writer = writer.sortBy(*layout.sort_by)
    writer.saveAsTable(table)
    spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
    known = [(path, json.dumps(asdict(layout)), df.schema.json())]
    spark.createDataFrame(known, "path string, layout string, columns string").coalesce(1).write.mode("append").json(f"{folder}/manifest")


def _names(columns) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def open_stored(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """A stored table under ``name`` in this session's catalog, or None if none was finished."""
    found = _manifest(spark, folder)
    if found is None:
        return None
    schema = T.StructType.fromJson(json.loads(found["columns"]))
    layout = Layout(**json.loads(found["layout"]))
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parts = f"PARTITIONED BY ({_names(layout.partition_by)})" if layout.partition_by else ""
        order = f"SORTED BY ({_names(layout.sort_by)})" if layout.sort_by else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parts} CLUSTERED BY ({_names(layout.bucket_by)}) "
                  f"{order} INTO {layout.buckets} BUCKETS LOCATION '{found['path']}'")
        if layout.partition_by:
            spark.catalog.recoverPartitions(name)
    return spark.table(name).select(*schema.fieldNames())


def stored(spark: SparkSession, name: str, key: str, make, layout: Layout, dealt: bool = False) -> DataFrame:
    """The stored table of this name and key; ``make()`` gives its rows if no session wrote it before.

    ``dealt``: each of their partitions has rows of one bucket, so they are not moved again.
    """
    folder, table = f"{checkpoint_dir(spark).rstrip('/')}/stored/{name}-{key}", f"ontime_{name}_{key}"
    df = open_stored(spark, folder, table)
    if df is None:
        _write(make(), folder, layout, dealt)
        df = open_stored(spark, folder, table)
    return df
