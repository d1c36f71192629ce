"""Table readers and writers (batch and streaming), airport dimension, views.

The table format is a parameter: ``parquet`` by default, ``delta`` where the
Delta jar is on the classpath. Nothing here reads a table through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contrail import constants as K


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    reader = spark.read.format(fmt)
    if merge_schema and fmt == "parquet":
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def read_table_stream(spark: SparkSession, path: str, schema: StructType | None = None,
                      fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """A table folder as an unbounded source (file sources need a schema)."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


#: event-time column -> the partition column made from it
DATES = {"event_timestamp": "event_date", "window_start": "window_date"}


def dated(df: DataFrame) -> DataFrame:
    """Add the date that Silver, Silver_ML (``event_date``) and Gold (``window_date``) tables are partitioned by."""
    for ts, date in DATES.items():
        if ts in df.columns:
            return df.withColumn(date, F.to_date(ts))
    raise ValueError(f"no event time among {df.columns}")


def write_dated(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    """A table partitioned by date. ``overwrite`` replaces the dates that ``df`` has and no others (backfills).

    Rows are dealt by date in partitions of even size (a busy date is split, quiet ones share a task)."""
    out = dated(df)
    date = out.columns[-1]
    (out.hint("rebalance", date).write.format(fmt).mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(date).save(path))


def between(df: DataFrame, ts: str, since=None, until=None) -> DataFrame:
    """Rows with since <= ``ts`` < until; where the table has the date partition, only its dates are read."""
    date = DATES[ts]
    if since is not None:
        df = df.filter(F.col(ts) >= F.lit(since))
        df = df.filter(F.col(date) >= F.to_date(F.lit(since))) if date in df.columns else df
    if until is not None:
        df = df.filter(F.col(ts) < F.lit(until))
        df = df.filter(F.col(date) <= F.to_date(F.lit(until))) if date in df.columns else df
    return df.drop(date)


def write_table(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet",
                partition_by: list[str] | None = None, merge_schema: bool = False) -> None:
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if merge_schema and fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    writer.save(path)


def write_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 output_mode: str = "append", trigger: Mapping | None = None,
                 query_name: str | None = None, merge_schema: bool = False,
                 partition_by: list[str] | None = None):
    """Start an append stream into a table folder with its own checkpoint."""
    w = df.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", checkpoint)
    if merge_schema:
        w = w.option("mergeSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start(path)


def read_airport_csv(spark: SparkSession, path: str) -> DataFrame:
    """Airport CSV with a header; columns are matched by header name (the file
    has more columns than used, in its own order) and stay strings until cast
    (no schema inference pass)."""
    return spark.read.option("header", "true").option("inferSchema", "false").csv(path)


def airports_dim(csv_rows: DataFrame, types=K.AIRPORT_TYPES) -> DataFrame:
    """Large and medium airports with typed coordinates.

    The type filter runs before the projection (it reads a column the
    projection drops); malformed coordinates become NULL instead of failing.
    """
    return csv_rows.filter(F.col("type").isin(*types)).select(
        F.col("ident").alias("airport_icao"),
        F.col("name").alias("airport_name"),
        F.col("iso_country").alias("airport_country"),
        F.col("latitude_deg").try_cast("double").alias("airport_lat"),
        F.col("longitude_deg").try_cast("double").alias("airport_lon"),
    )


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    return airports_dim(read_airport_csv(spark, path))


def flatten_window(df: DataFrame, column: str = "window") -> DataFrame:
    """``window{start,end}`` struct -> ``window_start``, ``window_end``."""
    if column not in df.columns:
        return df
    rest = [c for c in df.columns if c != column]
    return df.select(F.col(f"{column}.start").alias("window_start"),
                     F.col(f"{column}.end").alias("window_end"), *rest)


def read_gold(spark: SparkSession, path: str, fmt: str = "parquet", since=None, until=None) -> DataFrame:
    """A Gold table for serving: through its own listing (not a fixed number of
    files), optionally only windows that start in [since, until) — of a table written by date,
    only those dates' files are opened."""
    return between(flatten_window(read_table(spark, path, fmt)), "window_start", since, until)


def read_silver(spark: SparkSession, path: str, fmt: str = "parquet", since=None, until=None) -> DataFrame:
    """Silver or Silver_ML rows, optionally only those with since <= event_timestamp < until."""
    return between(read_table(spark, path, fmt), "event_timestamp", since, until)
