"""Sources: CSV (the reference's format) and Parquet (the driver's format).

S2-S6: scan, name as a view, cache the fact table, leave dimensions lazy.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.sources.schemas import (
    AIRPORT_COLUMN_TYPES,
    CARRIER_COLUMN_TYPES,
    FLIGHT_COLUMN_TYPES,
    schema_for_header,
)

CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": "\\", "mode": "PERMISSIVE"}

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """A headed CSV with every column as text, in header order."""
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    return spark.read.options(**CSV_OPTIONS).schema(schema_for_header(header, {})).csv(path)


def _typed(name: str, dtype: T.DataType) -> Column:
    """Text to its documented type; whole numbers may be written with decimals ('1530.00')."""
    if isinstance(dtype, T.StringType):
        return F.col(name)
    if isinstance(dtype, T.IntegerType):
        number = F.col(name).try_cast("double")
        return F.when(number == F.floor(number), number.try_cast("int"))
    return F.col(name).try_cast(dtype)


def typed_columns(text: DataFrame, known_types: dict) -> DataFrame:
    """Known columns of a text table in their types; others stay text."""
    return text.select(*[_typed(c, known_types[c]).alias(c) if c in known_types else F.col(c) for c in text.columns])


def unreadable_counts(text: DataFrame, known_types: dict) -> DataFrame:
    """(column, n): non-empty values of a text table that do not fit their type and read as NULL."""
    known = [c for c in text.columns if c in known_types and not isinstance(known_types[c], T.StringType)]
    if not known:
        return text.sparkSession.createDataFrame([], "column string, n bigint")
    lost = text.agg(*[F.count_if((F.trim(F.col(c)) != "") & _typed(c, known_types[c]).isNull()).alias(c) for c in known])
    return lost.unpivot([], known, "column", "n")


def read_csv_typed(spark: SparkSession, path: str, known_types: dict) -> DataFrame:
    """Read a headed CSV with explicit types.

    Only the header line is read to learn the column order (no inference
    pass over the data); known columns get their documented type. A value
    that does not fit its type is NULL; :func:`unreadable_counts` counts them.
    """
    return typed_columns(read_csv_text(spark, path), known_types)


def read_flights_csv(spark: SparkSession, path: str) -> DataFrame:
    return with_flight_date(read_csv_typed(spark, path, FLIGHT_COLUMN_TYPES))


def read_carriers_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_typed(spark, path, CARRIER_COLUMN_TYPES)


def read_airports_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_typed(spark, path, AIRPORT_COLUMN_TYPES)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (Parquet: column pruning and filter push-down at the scan)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_tables(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> dict[str, DataFrame]:
    return {name: read_table(spark, sf_dir, name) for name in names}


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Expose each source under a SQL name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def cache_fact(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """The fact table is cached (spills to disk, never recomputed per report)."""
    return df.persist(level)


def load_flight_sources(spark: SparkSession, flights_path: str, carriers_path: str,
                        airports_path: str, cache: bool = True, views: bool = True):
    """S2-S6 together: the three sources of the dashboard."""
    flights = read_flights_csv(spark, flights_path)
    if cache:
        flights = cache_fact(flights)
    carriers = read_carriers_csv(spark, carriers_path)
    airports = read_airports_csv(spark, airports_path)
    if views:
        register_views({"flights": flights, "carriers": carriers, "airports": airports})
    return flights, carriers, airports


def with_flight_date(df: DataFrame) -> DataFrame:
    """Fill Year/Month/DayofMonth from FlightDate when a file only has the date."""
    if "FlightDate" in df.columns and "Year" not in df.columns:
        df = df.withColumns({"Year": F.year("FlightDate"), "Month": F.month("FlightDate"),
                             "DayofMonth": F.dayofmonth("FlightDate")})
    return df
