"""DuckDB SQL for every registered query (the independent correctness check).

Written straight from the semantics, the naive way (window per aircraft,
cross join for the nearest airport), on the views ``events``, ``nation`` and
``supplier``. Column names and rounding match ``contrail.plans.registry``.
"""

from __future__ import annotations

# ---------------------------------------------------------------- base CTEs

BRONZE = """
bronze AS (
  SELECT
    CAST(floor(epoch(e.ts)) AS BIGINT) AS time,
    CAST(e.user_id AS VARCHAR) AS icao24,
    'CS' || CAST(e.user_id AS VARCHAR) AS callsign,
    n.n_name AS origin_country,
    CAST(floor(epoch(e.ts)) AS BIGINT) AS time_position,
    CAST(floor(epoch(e.ts)) AS BIGINT) AS last_contact,
    CAST(CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE (e.event_id * 37 % 1440) * 0.25 - 180 END AS FLOAT) AS longitude,
    CAST(CASE WHEN e.event_id % 89 = 0 THEN NULL ELSE (e.event_id * 53 % 720) * 0.25 - 90 END AS FLOAT) AS latitude,
    CAST(CASE WHEN CAST(e.props->>'$.k' AS INTEGER) = 50 THEN NULL
              ELSE CAST(e.props->>'$.k' AS INTEGER) * 160 - 600 END AS FLOAT) AS baro_altitude,
    e.event_type = 'error' AS on_ground,
    CAST(e.value AS FLOAT) AS velocity,
    CAST(e.event_id * 7 % 360 AS FLOAT) AS true_track,
    CAST(CASE WHEN e.event_type = 'view' THEN NULL ELSE e.value - 250 END AS FLOAT) AS vertical_rate,
    CAST(CASE WHEN CAST(e.props->>'$.k' AS INTEGER) = 50 THEN NULL
              ELSE CAST(CAST(CAST(e.props->>'$.k' AS INTEGER) * 160 - 600 AS FLOAT) + 25 AS FLOAT) END AS FLOAT) AS geo_altitude,
    lpad(CAST(e.user_id % 7777 AS VARCHAR), 4, '0') AS squawk,
    e.event_id % 2 = 0 AS spi,
    CAST(e.event_id % 4 AS INTEGER) AS position_source,
    CAST(e.event_id % 8 AS INTEGER) AS category
  FROM events e LEFT JOIN nation n ON e.user_id % 25 = n.n_nationkey
)"""

SILVER = """
silver AS (
  SELECT make_timestamp(time * 1000000) AS event_timestamp, icao24, callsign, origin_country,
         longitude, latitude, round(CAST(velocity AS DOUBLE) * CAST(3.6 AS DOUBLE), 2) AS velocity_kmh,
         baro_altitude AS altitude_meters, on_ground, category
  FROM bronze
  WHERE icao24 IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
)"""

CLEAN = """
clean AS (
  SELECT * FROM silver
  WHERE icao24 IS NOT NULL AND altitude_meters BETWEEN -500 AND 15000 AND velocity_kmh BETWEEN 0 AND 1200
)"""

TEMPORAL = """
temporal AS (
  SELECT *,
    lag(altitude_meters) OVER w AS prev_altitude,
    lag(velocity_kmh) OVER w AS prev_velocity,
    altitude_meters - lag(altitude_meters) OVER w AS altitude_change,
    velocity_kmh - lag(velocity_kmh) OVER w AS velocity_change,
    CAST(row_number() OVER w AS INTEGER) AS observation_rank
  FROM clean
  WINDOW w AS (PARTITION BY icao24 ORDER BY event_timestamp NULLS FIRST, callsign NULLS FIRST, origin_country NULLS FIRST,
    longitude NULLS FIRST, latitude NULLS FIRST, velocity_kmh NULLS FIRST, altitude_meters NULLS FIRST,
    on_ground NULLS FIRST, category NULLS FIRST)
)"""

AIRPORTS = """
airports AS (
  SELECT s.s_name AS airport_icao, s.s_name || ' Field' AS airport_name, n.n_name AS airport_country,
         CAST((s.s_suppkey * 29 % 720) * 0.25 - 90 AS DOUBLE) AS airport_lat,
         CAST((s.s_suppkey * 71 % 1440) * 0.25 - 180 AS DOUBLE) AS airport_lon
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  WHERE s.s_acctbal > 2000
)"""

CLOSEST = """
closest_all AS (
  SELECT t.*, a.airport_icao, a.airport_name, a.airport_country,
    sqrt((CAST(t.latitude AS DOUBLE) - a.airport_lat) * (CAST(t.latitude AS DOUBLE) - a.airport_lat)
       + (CAST(t.longitude AS DOUBLE) - a.airport_lon) * (CAST(t.longitude AS DOUBLE) - a.airport_lon)) AS dist
  FROM temporal t CROSS JOIN airports a
  WHERE t.on_ground
),
closest AS (
  SELECT * EXCLUDE (dist, min_dist) FROM (
    SELECT *, min(dist) OVER (PARTITION BY icao24, event_timestamp) AS min_dist FROM closest_all)
  WHERE dist = min_dist
)"""

ENRICHED = """
enriched AS (
  SELECT * FROM closest
  UNION ALL BY NAME
  SELECT *, CAST(NULL AS VARCHAR) AS airport_icao, CAST(NULL AS VARCHAR) AS airport_name,
         CAST(NULL AS VARCHAR) AS airport_country
  FROM temporal WHERE NOT on_ground
)"""

ROLLING = """
rolling AS (
  SELECT *,
    avg(altitude_meters) OVER r AS rolling_avg_altitude,
    stddev_samp(altitude_meters) OVER r AS rolling_std_altitude,
    avg(velocity_kmh) OVER r AS rolling_avg_velocity
  FROM enriched
  WINDOW r AS (PARTITION BY icao24 ORDER BY event_timestamp NULLS FIRST, callsign NULLS FIRST, origin_country NULLS FIRST,
    longitude NULLS FIRST, latitude NULLS FIRST, velocity_kmh NULLS FIRST, altitude_meters NULLS FIRST,
    on_ground NULLS FIRST, category NULLS FIRST, airport_icao NULLS FIRST
               ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)
)"""

PHASE_CASE = """CASE
      WHEN on_ground THEN 'GROUND'
      WHEN altitude_change > 50 AND altitude_meters < 3000 THEN 'TAKEOFF'
      WHEN altitude_change > 20 THEN 'CLIMB'
      WHEN altitude_change BETWEEN -20 AND 20 AND altitude_meters > 8000 THEN 'CRUISE'
      WHEN altitude_change < -20 THEN 'DESCENT'
      ELSE 'TRANSITION' END"""

FEATURES = f"""
features AS (
  SELECT event_timestamp, icao24, callsign, origin_country, longitude, latitude, velocity_kmh,
         altitude_meters, on_ground, category, prev_altitude, prev_velocity, altitude_change,
         velocity_change, observation_rank, airport_icao, airport_name, airport_country,
         rolling_avg_altitude, rolling_std_altitude, rolling_avg_velocity,
         {PHASE_CASE} AS flight_phase
  FROM rolling
)"""

_CHAIN = {
    "bronze": [BRONZE],
    "silver": [BRONZE, SILVER],
    "clean": [BRONZE, SILVER, CLEAN],
    "temporal": [BRONZE, SILVER, CLEAN, TEMPORAL],
    "closest": [BRONZE, SILVER, CLEAN, TEMPORAL, AIRPORTS, CLOSEST],
    "features": [BRONZE, SILVER, CLEAN, TEMPORAL, AIRPORTS, CLOSEST, ENRICHED, ROLLING, FEATURES],
}


def with_ctes(level: str, *extra: str) -> str:
    parts = list(_CHAIN[level]) + [e.strip("\n") for e in extra]
    return "WITH " + ",".join(parts) + "\n"


def q(level: str, body: str, *extra: str) -> str:
    return with_ctes(level, *extra) + body


# ------------------------------------------------------------- gold CTEs

MINUTE_US = 60_000_000
HOUR_US = 60 * MINUTE_US


def _ts(us_expr: str) -> str:
    return f"make_timestamp(CAST({us_expr} AS BIGINT))"


def phase_stats_cte(width_us: int = MINUTE_US, name: str = "phase_stats") -> str:
    return f"""
{name} AS (
  SELECT {_ts('ws')} AS window_start, {_ts(f'ws + {width_us}')} AS window_end, flight_phase,
         count(*) AS flight_count, avg(altitude_meters) AS avg_altitude, avg(velocity_kmh) AS avg_velocity
  FROM (SELECT *, CAST(floor(epoch_us(event_timestamp) / {width_us}.0) AS BIGINT) * {width_us} AS ws FROM features)
  GROUP BY ws, flight_phase
)"""


def country_stats_cte(width_us: int = MINUTE_US, name: str = "country_stats") -> str:
    return f"""
{name} AS (
  SELECT {_ts('ws')} AS window_start, {_ts(f'ws + {width_us}')} AS window_end, origin_country,
         count(*) AS flight_count, avg(altitude_meters) AS avg_altitude, avg(velocity_kmh) AS avg_velocity,
         count(*) FILTER (WHERE on_ground) AS ground_count,
         count(*) FILTER (WHERE NOT on_ground) AS airborne_count
  FROM (SELECT *, CAST(floor(epoch_us(event_timestamp) / {width_us}.0) AS BIGINT) * {width_us} AS ws FROM features)
  GROUP BY ws, origin_country
)"""


def anomalies_cte(width_us: int = 5 * MINUTE_US, slide_us: int = MINUTE_US, name: str = "anomalies") -> str:
    n = width_us // slide_us
    return f"""
{name} AS (
  SELECT window_start, window_end, origin_country, total_observations, altitude_anomalies, velocity_anomalies,
         (altitude_anomalies + velocity_anomalies) / total_observations AS anomaly_rate,
         max_altitude, min_altitude, max_velocity, avg_altitude, avg_velocity, stddev_altitude, stddev_velocity
  FROM (
    SELECT {_ts('ws')} AS window_start, {_ts(f'ws + {width_us}')} AS window_end, origin_country,
      count(*) AS total_observations,
      count(CASE WHEN altitude_meters > 12000 OR altitude_meters < -100 THEN 1 END) AS altitude_anomalies,
      count(CASE WHEN velocity_kmh > 1000 OR velocity_kmh < 0 THEN 1 END) AS velocity_anomalies,
      max(altitude_meters) AS max_altitude, min(altitude_meters) AS min_altitude,
      max(velocity_kmh) AS max_velocity, avg(altitude_meters) AS avg_altitude, avg(velocity_kmh) AS avg_velocity,
      stddev_samp(altitude_meters) AS stddev_altitude, stddev_samp(velocity_kmh) AS stddev_velocity
    FROM (SELECT f.*, (CAST(floor(epoch_us(f.event_timestamp) / {slide_us}.0) AS BIGINT) - r.k) * {slide_us} AS ws
          FROM features f CROSS JOIN range(0, {n}) AS r(k))
    WHERE epoch_us(event_timestamp) >= ws AND epoch_us(event_timestamp) < ws + {width_us}
    GROUP BY ws, origin_country)
)"""


def rounded(cols: str, names: tuple[str, ...], digits: int = 6) -> str:
    """``SELECT * EXCLUDE (...), round(c, 6) AS c, ...`` over ``cols``."""
    ex = ", ".join(names)
    rs = ", ".join(f"round({c}, {digits}) AS {c}" for c in names)
    return f"SELECT * EXCLUDE ({ex}), {rs} FROM {cols}"
