"""R3 as a Structured Streaming query: take-off / landing counts per
tumbling window, updated as flight records arrive.

Same legs as the batch report; the airport zones are a static table joined
to the stream. A watermark bounds the window state: a window is final once
event time has passed its end plus the allowed lateness.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ontime.functions.timefns import utc_instant, utc_wall_clock
from ontime.plans.reports import traffic_legs
from ontime.session import checkpoint_dir
from ontime.sources.readers import CSV_OPTIONS, typed_columns, with_flight_date
from ontime.sources.schemas import FLIGHTS_SCHEMA, schema_for_header


def read_flight_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema=FLIGHTS_SCHEMA,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Flight files landing in ``path`` as a stream (explicit schema, no inference).

    CSV files are read by header name: the column order is that of the files
    already there, and a file with another header is an error.
    """
    reader = spark.readStream.format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt != "csv":
        return reader.schema(schema).load(path)
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    text = reader.options(**CSV_OPTIONS).option("enforceSchema", "false").schema(schema_for_header(header, {})).load(path)
    return with_flight_date(typed_columns(text, {f.name: f.dataType for f in schema.fields}))


def streaming_traffic_windows(flights: DataFrame, airports: DataFrame, days: int = 12,
                              allowed_lateness: str = "2 days", airport=None) -> DataFrame:
    """Windowed counts (Airport, Type, window_start, window_end, n) over a stream.

    Window bounds are UTC wall clocks (timestamp_ntz), as in the batch
    report, whatever the session time zone."""
    zone = flights.sparkSession.conf.get("spark.sql.session.timeZone")
    legs = traffic_legs(flights, airports, airport).withColumn("ts", utc_instant(F.col("ts")))
    return (legs.withWatermark("ts", allowed_lateness)
            .groupBy("Airport", "Type", F.window("ts", f"{int(days)} days").alias("w"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("Airport", "Type", utc_wall_clock(F.col("w.start"), zone).alias("window_start"),
                    utc_wall_clock(F.col("w.end"), zone).alias("window_end"), "n"))


def start_traffic_stream(counts: DataFrame, query_name: str, sink_path: str | None = None,
                         output_mode: str = "append", available_now: bool = False,
                         checkpoint_location: str | None = None, memory_table: bool = False) -> StreamingQuery:
    """Run the windowed counts into Parquet (append: finished windows only).

    ``memory_table`` collects them in a driver table named ``query_name``
    instead; that is for tests, since it grows with every window.

    Progress and window state live under the shared checkpoint folder, so a
    restarted query resumes where it stopped.
    """
    if not sink_path and not memory_table:
        raise ValueError("name a sink_path, or ask for a memory_table")
    spark = counts.sparkSession
    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/streams/{query_name}"
    writer = counts.writeStream.queryName(query_name).outputMode(output_mode) \
        .option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    if sink_path:
        return writer.format("parquet").option("path", sink_path).start()
    return writer.format("memory").start()
