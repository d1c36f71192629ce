"""Column expressions of the flight domain. All are native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contrail import constants as K


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_to_timestamp(seconds) -> Column:
    """Unix seconds -> TIMESTAMP, without a round trip through zone text; NULL outside years 1-9999
    (a value in other units must not stop a stream)."""
    s = _c(seconds)
    return F.when(s.between(-62_135_596_800, 253_402_300_799), F.timestamp_seconds(s))


def to_kmh(metres_per_second) -> Column:
    """m/s -> km/h rounded HALF_UP to 2 decimals."""
    return F.round(_c(metres_per_second) * F.lit(K.KMH_PER_MS), 2)


def flight_phase(on_ground="on_ground", change="altitude_change", altitude="altitude_meters") -> Column:
    """Phase label; the first matching rule wins and NULL inputs fall through."""
    g, d, a = _c(on_ground), _c(change), _c(altitude)
    return (
        F.when(g == F.lit(True), K.PHASE_GROUND)
        .when((d > K.TAKEOFF_MIN_CHANGE) & (a < K.TAKEOFF_MAX_ALTITUDE), K.PHASE_TAKEOFF)
        .when(d > K.CLIMB_MIN_CHANGE, K.PHASE_CLIMB)
        .when(d.between(-K.CRUISE_MAX_ABS_CHANGE, K.CRUISE_MAX_ABS_CHANGE) & (a > K.CRUISE_MIN_ALTITUDE),
              K.PHASE_CRUISE)
        .when(d < K.DESCENT_MAX_CHANGE, K.PHASE_DESCENT)
        .otherwise(K.PHASE_TRANSITION)
    )


def altitude_bucket(altitude="altitude_meters") -> Column:
    a = _c(altitude)
    expr = F.when(a.isNull(), K.ALTITUDE_BUCKET_NULL)
    for upper, label in K.ALTITUDE_BUCKETS:
        expr = expr.when(a < upper, label)
    return expr.otherwise(K.ALTITUDE_BUCKET_TOP)


def altitude_anomaly(altitude="altitude_meters") -> Column:
    """1 when outside the altitude limits, else 0 (NULL -> 0)."""
    a = _c(altitude)
    return F.when((a > K.ANOMALY_ALTITUDE_MAX) | (a < K.ANOMALY_ALTITUDE_MIN), 1).otherwise(0)


def velocity_anomaly(velocity="velocity_kmh") -> Column:
    v = _c(velocity)
    return F.when((v > K.ANOMALY_SPEED_MAX) | (v < K.ANOMALY_SPEED_MIN), 1).otherwise(0)


def planar_distance(lat1, lon1, lat2, lon2) -> Column:
    """Euclidean distance in degrees (no great circle, no wrap)."""
    dlat = _c(lat1) - _c(lat2)
    dlon = _c(lon1) - _c(lon2)
    return F.sqrt(dlat * dlat + dlon * dlon)


def in_clean_ranges(altitude="altitude_meters", velocity="velocity_kmh") -> Column:
    return (_c(altitude).between(K.CLEAN_ALTITUDE_MIN, K.CLEAN_ALTITUDE_MAX)
            & _c(velocity).between(K.CLEAN_SPEED_MIN, K.CLEAN_SPEED_MAX))


def percent_text(rate) -> Column:
    """0.125 -> '12.5%' (rate x 100, 1 decimal)."""
    return F.format_string("%.1f%%", F.round(_c(rate) * 100, 1))


def hour_minute(ts) -> Column:
    return F.date_format(_c(ts), "HH:mm")


def row_score(df, seed: int) -> Column:
    """First 8 hex digits of the MD5 of (seed, aircraft, time, airport if there): uniform, the same in any engine."""
    parts = [F.lit(str(seed)), F.col("icao24"), F.unix_micros("event_timestamp").cast("string")]
    if "airport_icao" in df.columns:
        parts.append(F.col("airport_icao"))
    return F.substring(F.md5(F.concat_ws("|", *(F.coalesce(p, F.lit("")) for p in parts)).cast("binary")), 1, 8)
