"""Bronze -> Silver: the same code runs on batch and streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail import schemas
from contrail.functions import epoch_to_timestamp, in_clean_ranges, to_kmh


def to_silver(bronze: DataFrame) -> DataFrame:
    """Drop rows without id or position; event time, km/h, altitude; 10 columns."""
    return (
        bronze.filter(F.col("icao24").isNotNull())
        .filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .select(
            epoch_to_timestamp("time").alias("event_timestamp"),
            "icao24", "callsign", "origin_country", "longitude", "latitude",
            to_kmh("velocity").alias("velocity_kmh"),
            F.col("baro_altitude").alias("altitude_meters"),
            "on_ground", "category",
        )
    )


def clean_ranges(silver: DataFrame) -> DataFrame:
    """Keep identified rows inside the inclusive altitude / speed ranges."""
    return silver.filter(F.col("icao24").isNotNull()).filter(in_clean_ranges())


def silver_columns(df: DataFrame) -> DataFrame:
    return df.select(*schemas.SILVER_COLUMNS)
