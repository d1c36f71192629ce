"""Flight observations derived from the shared test tables.

The test tables are a TPC-H-like star schema plus an ``events`` table; this
module maps them onto the flight data model so every query reads them (and
grows with them). The same mapping is written in DuckDB SQL in
``contrail.plans.oracle`` so each Spark result has an independent check.

events -> wire records (bronze):

=================  ====================================================
time               whole seconds of ``ts`` since the epoch (UTC)
icao24             ``user_id`` as text
callsign           'CS' || user_id
origin_country     nation name of ``user_id % 25``
longitude          (event_id*37 % 1440)*0.25 - 180, NULL if event_id % 97 = 0
latitude           (event_id*53 % 720)*0.25 - 90, NULL if event_id % 89 = 0
baro_altitude      k*160 - 600 with k = props.k, NULL if k = 50
velocity           value (m/s)
on_ground          event_type = 'error'
category           event_id % 8
=================  ====================================================

The NULL positions and altitudes exercise the not-null filters; they are
values, not row filters. supplier -> airport CSV rows (strings): ident =
s_name, type by account balance (> 6000 large, > 2000 medium, else small),
quarter-degree coordinates, so planar distances are exact in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail import schemas
from contrail.sources.tables import airports_dim



def _epoch_ntz() -> F.Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _quarter(expr: str, null_when: str) -> F.Column:
    return F.when(F.expr(null_when), F.lit(None)).otherwise(F.expr(expr)).cast("float")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire/bronze records, one per event."""
    ev = table(spark, sf_dir, "events")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # read as a generated column: filters on the altitude that come down here would each parse the text again
    ev = ev.select("*", F.explode(F.array(F.get_json_object("props", "$.k").cast("int"))).alias("k")).drop("props")
    k = F.col("k")
    alt = F.when(k == 50, F.lit(None)).otherwise(k * 160 - 600).cast("float")
    secs = F.timestamp_diff("SECOND", _epoch_ntz(), F.col("ts")).cast("long")
    joined = ev.join(nation, (F.col("user_id") % 25) == F.col("n_nationkey"), "left")
    return joined.select(
        secs.alias("time"),
        F.col("user_id").cast("string").alias("icao24"),
        F.concat(F.lit("CS"), F.col("user_id").cast("string")).alias("callsign"),
        F.col("n_name").alias("origin_country"),
        secs.alias("time_position"),
        secs.alias("last_contact"),
        _quarter("(event_id * 37 % 1440) * 0.25 - 180", "event_id % 97 = 0").alias("longitude"),
        _quarter("(event_id * 53 % 720) * 0.25 - 90", "event_id % 89 = 0").alias("latitude"),
        alt.alias("baro_altitude"),
        (F.col("event_type") == "error").alias("on_ground"),
        F.col("value").cast("float").alias("velocity"),
        F.expr("event_id * 7 % 360").cast("float").alias("true_track"),
        F.when(F.col("event_type") == "view", F.lit(None)).otherwise(F.col("value") - 250).cast("float")
        .alias("vertical_rate"),
        (alt + F.lit(25)).cast("float").alias("geo_altitude"),
        F.lpad((F.col("user_id") % 7777).cast("string"), 4, "0").alias("squawk"),
        (F.col("event_id") % 2 == 0).alias("spi"),
        (F.col("event_id") % 4).cast("int").alias("position_source"),
        (F.col("event_id") % 8).cast("int").alias("category"),
    ).select([F.col(f.name).cast(f.dataType) for f in schemas.WIRE.fields])


def airport_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport dimension rows shaped like the airport CSV (all strings)."""
    sup = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    kind = (F.when(F.col("s_acctbal") > 6000, "large_airport")
            .when(F.col("s_acctbal") > 2000, "medium_airport").otherwise("small_airport"))
    return sup.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_name").alias("ident"),
        kind.alias("type"),
        F.concat(F.col("s_name"), F.lit(" Field")).alias("name"),
        F.col("n_name").alias("iso_country"),
        F.expr("(s_suppkey * 29 % 720) * 0.25 - 90").cast("string").alias("latitude_deg"),
        F.expr("(s_suppkey * 71 % 1440) * 0.25 - 180").cast("string").alias("longitude_deg"),
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return airports_dim(airport_csv_rows(spark, sf_dir))
