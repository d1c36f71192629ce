"""Dashboard data products computed from the Gold tables with Spark.

Each function returns a small DataFrame (KPIs, totals, alerts, heatmap)
computed where the Gold data lives; nothing is pulled to the driver to be
aggregated. The ``weighted`` switches give count-weighted means instead of
the plain mean of per-window means.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail import constants as K
from contrail.functions import hour_minute, percent_text
from contrail.session import materialize


def _mean(values: str, weights: str | None) -> F.Column:
    if weights is None:
        return F.avg(values)
    return F.sum(F.col(values) * F.col(weights)) / F.sum(F.when(F.col(values).isNotNull(), F.col(weights)))


def kpis(phase_stats: DataFrame, anomalies: DataFrame, weighted: bool = False) -> DataFrame:
    """One row: observations summed over windows, mean altitude, mean speed,
    mean anomaly rate in percent; 0 for an empty input."""
    w = "flight_count" if weighted else None
    wa = "total_observations" if weighted else None
    rate = anomalies.agg(F.coalesce(_mean("anomaly_rate", wa) * 100, F.lit(0.0))).scalar()
    empty = F.count(F.lit(1)) == 0
    return phase_stats.agg(
        F.coalesce(F.sum("flight_count"), F.lit(0)).cast("long").alias("total_flights"),
        F.when(empty, F.lit(0.0)).otherwise(_mean("avg_altitude", w)).alias("avg_altitude"),
        F.when(empty, F.lit(0.0)).otherwise(_mean("avg_velocity", w)).alias("avg_velocity"),
    ).withColumn("anomaly_rate_pct", rate)


def phase_totals(phase_stats: DataFrame, weighted: bool = False) -> DataFrame:
    """Per phase: summed count, mean altitude and speed over its windows."""
    w = "flight_count" if weighted else None
    return phase_stats.groupBy("flight_phase").agg(
        F.sum("flight_count").alias("flight_count"),
        _mean("avg_altitude", w).alias("avg_altitude"),
        _mean("avg_velocity", w).alias("avg_velocity"),
    )


def phase_timeline(phase_stats: DataFrame) -> DataFrame:
    return phase_stats.select("window_start", "flight_phase", "flight_count").orderBy(
        "window_start", "flight_phase")


def latest_windows(phase_stats: DataFrame, n: int = K.LATEST_LIMIT) -> DataFrame:
    return phase_stats.orderBy(F.col("window_start").desc(), F.col("flight_phase").asc()).limit(n)


def worst_anomaly_windows(anomalies: DataFrame, n: int = K.LATEST_LIMIT) -> DataFrame:
    return (anomalies.filter(F.col("anomaly_rate") > 0)
            .orderBy(F.col("anomaly_rate").desc(), F.col("window_start").desc(), F.col("origin_country").asc())
            .limit(n))


def latest_anomaly_by_country(anomalies: DataFrame, n: int = K.TOP_COUNTRIES_ALERTS) -> DataFrame:
    """Each country's most recent window, then the n highest rates.

    ``max_by`` is a partial aggregate, so a busy country is not gathered in
    one task."""
    cols = [c for c in anomalies.columns if c != "origin_country"]
    latest = anomalies.groupBy("origin_country").agg(
        F.max_by(F.struct(*cols), "window_start").alias("_l")).select("origin_country", "_l.*")
    return latest.orderBy(F.col("anomaly_rate").desc(), F.col("origin_country").asc()).limit(n)


def recent_alerts(anomalies: DataFrame, threshold: float = K.ALERT_RATE, n: int = K.LATEST_LIMIT) -> DataFrame:
    """Latest n windows whose rate exceeds ``threshold``; rate as percent text."""
    return (anomalies.filter(F.col("anomaly_rate") > threshold)
            .orderBy(F.col("window_start").desc(), F.col("origin_country").asc())
            .limit(n)
            .select("origin_country", percent_text("anomaly_rate").alias("anomaly_rate"),
                    "altitude_anomalies", "velocity_anomalies"))


def phase_share(phase_stats: DataFrame) -> DataFrame:
    """Per phase: summed count and its percentage of all observations (the phase chart, from Gold)."""
    totals = phase_stats.groupBy("flight_phase").agg(F.sum("flight_count").cast("long").alias("flight_count"))
    every = F.sum("flight_count").over(Window.partitionBy(F.lit(0)))  # a row per phase
    return totals.withColumn("share_pct", F.round(F.col("flight_count") * F.lit(100.0) / every, 4))


def _heat_cells(anomalies: DataFrame) -> DataFrame:
    """(origin_country, hour, sum and count of rates): at most 1440 rows per country, written once and read by all that follows."""
    return materialize(anomalies.groupBy("origin_country", hour_minute("window_start").alias("hour")).agg(
        F.sum("anomaly_rate").alias("_s"), F.count("anomaly_rate").alias("_n")), "heatmap")


def _hottest(cells: DataFrame, n: int) -> DataFrame:
    mean = F.sum("_s") / F.sum("_n")
    return (cells.filter(F.col("origin_country").isNotNull()).groupBy("origin_country").agg(mean.alias("_m"))
            .orderBy(F.col("_m").desc(), F.col("origin_country").asc()).limit(n))


def anomaly_heatmap(anomalies: DataFrame, n: int = K.TOP_COUNTRIES_HEATMAP) -> DataFrame:
    """Mean rate per (country, HH:MM of window start) for the n countries with
    the highest mean rate, long form; every HH:MM present anywhere appears for
    each of those countries (0 where the country has no window).

    The anomalies are read once. The HH:MM set is at most 1440 values and the country list n rows, so
    both travel as bounded arrays; no join of unbounded sides."""
    cells = _heat_cells(anomalies)
    hours = cells.agg(F.sort_array(F.collect_set("hour"))).scalar()
    grid = _hottest(cells, n).select("origin_country", F.explode(hours).alias("hour"))
    return grid.join(cells, ["origin_country", "hour"], "left").select(
        "origin_country", "hour", F.coalesce(F.col("_s") / F.col("_n"), F.lit(0.0)).alias("anomaly_rate"))


def anomaly_heatmap_wide(anomalies: DataFrame, n: int = K.TOP_COUNTRIES_HEATMAP, hours: Sequence[str] | None = None) -> DataFrame:
    """The heatmap as a matrix: a row per country, a column per HH:MM (``hours``; default: all that occur, at
    most 1440, in order), 0 where the country has no window."""
    cells = _heat_cells(anomalies)
    if hours is None:
        hours = [r["hour"] for r in cells.select("hour").distinct().orderBy("hour").collect()]  # at most 1440
    top = _hottest(cells, n).select("origin_country")
    wide = cells.join(top, "origin_country").groupBy("origin_country").pivot("hour", list(hours)).agg(F.sum("_s") / F.sum("_n"))
    return wide.na.fill(0.0)
