"""Declared schemas of every layer (all fields nullable)."""

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, FloatType, IntegerType, LongType,
    StringType, StructField, StructType, TimestampType,
)

# Positional layout of one state vector inside a poll payload.
# Index 12 is not carried; index 17 is optional.
STATE_VECTOR_FIELDS = (
    (0, "icao24"), (1, "callsign"), (2, "origin_country"), (3, "time_position"),
    (4, "last_contact"), (5, "longitude"), (6, "latitude"), (7, "baro_altitude"),
    (8, "on_ground"), (9, "velocity"), (10, "true_track"), (11, "vertical_rate"),
    (13, "geo_altitude"), (14, "squawk"), (15, "spi"), (16, "position_source"),
    (17, "category"),
)

WIRE = StructType([
    StructField("time", LongType()),
    StructField("icao24", StringType()),
    StructField("callsign", StringType()),
    StructField("origin_country", StringType()),
    StructField("time_position", LongType()),
    StructField("last_contact", LongType()),
    StructField("longitude", FloatType()),
    StructField("latitude", FloatType()),
    StructField("baro_altitude", FloatType()),
    StructField("on_ground", BooleanType()),
    StructField("velocity", FloatType()),
    StructField("true_track", FloatType()),
    StructField("vertical_rate", FloatType()),
    StructField("geo_altitude", FloatType()),
    StructField("squawk", StringType()),
    StructField("spi", BooleanType()),
    StructField("position_source", IntegerType()),
    StructField("category", IntegerType()),
])

PAYLOAD = StructType([
    StructField("time", LongType()),
    StructField("states", ArrayType(ArrayType(StringType()))),
])

SILVER = StructType([
    StructField("event_timestamp", TimestampType()),
    StructField("icao24", StringType()),
    StructField("callsign", StringType()),
    StructField("origin_country", StringType()),
    StructField("longitude", FloatType()),
    StructField("latitude", FloatType()),
    StructField("velocity_kmh", DoubleType()),
    StructField("altitude_meters", FloatType()),
    StructField("on_ground", BooleanType()),
    StructField("category", IntegerType()),
])
SILVER_COLUMNS = tuple(f.name for f in SILVER.fields)

FEATURE_EXTRA = StructType([
    StructField("prev_altitude", FloatType()),
    StructField("prev_velocity", DoubleType()),
    StructField("altitude_change", FloatType()),
    StructField("velocity_change", DoubleType()),
    StructField("observation_rank", IntegerType()),
    StructField("airport_icao", StringType()),
    StructField("airport_name", StringType()),
    StructField("airport_country", StringType()),
    StructField("rolling_avg_altitude", DoubleType()),
    StructField("rolling_std_altitude", DoubleType()),
    StructField("rolling_avg_velocity", DoubleType()),
    StructField("flight_phase", StringType()),
])
SILVER_ML = StructType(SILVER.fields + FEATURE_EXTRA.fields)
SILVER_ML_COLUMNS = tuple(f.name for f in SILVER_ML.fields)

# Airport CSV: header row, every column read as a string.
AIRPORT_CSV = StructType([
    StructField("ident", StringType()),
    StructField("type", StringType()),
    StructField("name", StringType()),
    StructField("iso_country", StringType()),
    StructField("latitude_deg", StringType()),
    StructField("longitude_deg", StringType()),
])

AIRPORTS = StructType([
    StructField("airport_icao", StringType()),
    StructField("airport_name", StringType()),
    StructField("airport_country", StringType()),
    StructField("airport_lat", DoubleType()),
    StructField("airport_lon", DoubleType()),
])

PHASE_STATS_COLUMNS = (
    "window_start", "window_end", "flight_phase", "flight_count", "avg_altitude", "avg_velocity",
)
COUNTRY_STATS_COLUMNS = (
    "window_start", "window_end", "origin_country", "flight_count", "avg_altitude",
    "avg_velocity", "ground_count", "airborne_count",
)
COUNTRY_ANOMALY_COLUMNS = (
    "window_start", "window_end", "origin_country", "total_observations",
    "altitude_anomalies", "velocity_anomalies", "anomaly_rate", "max_altitude",
    "min_altitude", "max_velocity", "avg_altitude", "avg_velocity",
    "stddev_altitude", "stddev_velocity",
)
