"""Gold: event-time window aggregates. One function per table, usable on a
batch DataFrame (watermark is then a no-op) or a streaming one (append mode:
a window is emitted once the watermark passes its end, late rows are dropped).

All aggregates are algebraic (count, sum, min, max, avg, stddev), so Spark
plans partial aggregation before the shuffle on (window, key): a country or
phase holding a large share of the rows sends one partial row per task, not
its rows. A sliding window expands each row into ``window / slide`` copies
before that partial aggregation.

``weight`` names a column that says how many rows a row stands for (see ``features.Counted``): the
tables are those of all these rows, the work is that of the rows that are there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail import constants as K
from contrail.functions import altitude_anomaly, velocity_anomaly

TS = "event_timestamp"


def _watermarked(df: DataFrame, watermark: str | None, ts: str) -> DataFrame:
    return df.withWatermark(ts, watermark) if watermark else df


def _flat(window_col: str = "window"):
    return [F.col(f"{window_col}.start").alias("window_start"), F.col(f"{window_col}.end").alias("window_end")]


def _count(weight: str | None, when: Column | None = None) -> Column:
    if weight is None:
        return F.count(F.lit(1)) if when is None else F.count_if(when)
    return F.sum(weight) if when is None else F.coalesce(F.sum(F.when(when, F.col(weight))), F.lit(0).cast("long"))


def _sums(column: str, weight: str) -> tuple[Column, Column]:
    """(values that are there, double; rows that have one)"""
    x = F.col(column).cast("double")
    return x, F.sum(F.when(x.isNotNull(), F.col(weight))).cast("double")


def _mean(column: str, weight: str | None) -> Column:
    if weight is None:
        return F.avg(column)
    x, n = _sums(column, weight)
    return F.sum(F.col(weight) * x) / n


def _deviation(column: str, weight: str | None) -> Column:
    """Sample standard deviation, NULL for one row; 0 for equal values, whatever their sums are rounded to."""
    if weight is None:
        return F.stddev(column)
    x, n = _sums(column, weight)
    total, squares = F.sum(F.col(weight) * x), F.sum(F.col(weight) * x * x)
    variance = F.greatest(squares - total * total / n, F.lit(0.0)) / (n - 1)
    return F.when(n > 1, F.when(F.min(x) == F.max(x), F.lit(0.0)).otherwise(F.sqrt(variance)))


def phase_stats(df: DataFrame, window: str = K.PHASE_WINDOW, watermark: str | None = K.PHASE_WATERMARK,
                ts: str = TS, weight: str | None = None) -> DataFrame:
    """Per tumbling window and flight phase: count, mean altitude, mean speed."""
    agg = _watermarked(df, watermark, ts).groupBy(F.window(ts, window).alias("window"), "flight_phase").agg(
        _count(weight).alias("flight_count"),
        _mean("altitude_meters", weight).alias("avg_altitude"),
        _mean("velocity_kmh", weight).alias("avg_velocity"),
    )
    return agg.select(*_flat(), "flight_phase", "flight_count", "avg_altitude", "avg_velocity")


def country_stats(df: DataFrame, window: str = K.PHASE_WINDOW, watermark: str | None = K.PHASE_WATERMARK,
                  ts: str = TS, weight: str | None = None) -> DataFrame:
    """Per tumbling window and country: count, means, ground / airborne counts."""
    agg = _watermarked(df, watermark, ts).groupBy(F.window(ts, window).alias("window"), "origin_country").agg(
        _count(weight).alias("flight_count"),
        _mean("altitude_meters", weight).alias("avg_altitude"),
        _mean("velocity_kmh", weight).alias("avg_velocity"),
        _count(weight, F.col("on_ground")).alias("ground_count"),
        _count(weight, ~F.col("on_ground")).alias("airborne_count"),
    )
    return agg.select(*_flat(), "origin_country", "flight_count", "avg_altitude", "avg_velocity",
                      "ground_count", "airborne_count")


def country_anomalies(df: DataFrame, window: str = K.ANOMALY_WINDOW, slide: str = K.ANOMALY_SLIDE,
                      watermark: str | None = K.ANOMALY_WATERMARK, ts: str = TS, weight: str | None = None) -> DataFrame:
    """Per sliding window and country: anomaly counts and rate, extremes,
    means and sample standard deviations. A row anomalous in altitude and
    speed counts twice in the rate, so the rate lies in [0, 2]."""
    flagged = (df.withColumn("is_altitude_anomaly", altitude_anomaly())
               .withColumn("is_velocity_anomaly", velocity_anomaly()))
    agg = _watermarked(flagged, watermark, ts).groupBy(
        F.window(ts, window, slide).alias("window"), "origin_country").agg(
        _count(weight).alias("total_observations"),
        _count(weight, F.col("is_altitude_anomaly") == 1).alias("altitude_anomalies"),
        _count(weight, F.col("is_velocity_anomaly") == 1).alias("velocity_anomalies"),
        F.max("altitude_meters").alias("max_altitude"),
        F.min("altitude_meters").alias("min_altitude"),
        F.max("velocity_kmh").alias("max_velocity"),
        _mean("altitude_meters", weight).alias("avg_altitude"),
        _mean("velocity_kmh", weight).alias("avg_velocity"),
        _deviation("altitude_meters", weight).alias("stddev_altitude"),
        _deviation("velocity_kmh", weight).alias("stddev_velocity"),
    )
    rate = (F.col("altitude_anomalies") + F.col("velocity_anomalies")) / F.col("total_observations")
    return agg.select(*_flat(), "origin_country", "total_observations", "altitude_anomalies",
                      "velocity_anomalies", rate.alias("anomaly_rate"), "max_altitude", "min_altitude",
                      "max_velocity", "avg_altitude", "avg_velocity", "stddev_altitude", "stddev_velocity")
