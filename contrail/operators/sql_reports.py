"""Count-and-mean reports as SQL text over a view, for users who keep their reports as SQL.

The statements are generated: :func:`report` writes one from a grouping expression, the columns to
average and an optional top-k, and :func:`case_of_bounds` writes the bucket expression from the
same bounds that ``functions.altitude_bucket`` uses, so limits live in ``constants`` alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from contrail import constants as K
from contrail.operators.features import ORDER

VIEW = "flights"


def case_of_bounds(column: str, bounds: Sequence[tuple[int, str]], above: str, unknown: str) -> str:
    """SQL label of the first bound that ``column`` is below."""
    arms = " ".join(f"WHEN {column} < {bound} THEN '{label}'" for bound, label in bounds)
    return f"CASE WHEN {column} IS NULL THEN '{unknown}' {arms} ELSE '{above}' END"


def report(by: str, name: str, count: str = "count", means: Mapping[str, str] | None = None, known_only: bool = False,
           top: int | None = None, view: str = VIEW, digits: int = 2) -> str:
    """Rows per value of ``by`` (called ``name``) with means of columns (output name -> column).

    ``known_only`` leaves NULL groups out; ``top`` keeps the largest groups, ties by name.
    """
    outputs = [f"{by} AS {name}", f"count(*) AS {count}"]
    outputs += [f"round(avg({column}), {digits}) AS {out}" for out, column in (means or {}).items()]
    text = f"SELECT {', '.join(outputs)} FROM {view}"
    if known_only:
        text += f" WHERE {by} IS NOT NULL"
    text += " GROUP BY 1"
    return text if top is None else f"{text} ORDER BY {count} DESC, {name} LIMIT {top}"


def evolution(view: str = VIEW, preceding: int = K.ROLLING_PRECEDING, top: int | None = K.EVOLUTION_LIMIT) -> str:
    """Each observation with the change since the aircraft's last one, its rolling mean and the speed's rank in the country.

    Windows of one aircraft or country: for tables where none of these is large; ``reports.flight_evolution`` cuts them up."""
    order = ", ".join(f"{c} NULLS FIRST" for c in ORDER)
    text = f"""SELECT icao24, callsign, origin_country, event_timestamp, altitude_meters,
  lag(altitude_meters) OVER seen AS prev_altitude,
  altitude_meters - lag(altitude_meters) OVER seen AS altitude_change,
  round(avg(altitude_meters) OVER (PARTITION BY icao24 ORDER BY {order} ROWS BETWEEN {preceding} PRECEDING AND CURRENT ROW), 2) AS rolling_avg_altitude,
  CAST(rank() OVER (PARTITION BY origin_country ORDER BY velocity_kmh DESC NULLS LAST) AS BIGINT) AS velocity_rank_in_country
FROM {view} WHERE icao24 IS NOT NULL AND altitude_meters IS NOT NULL
WINDOW seen AS (PARTITION BY icao24 ORDER BY {order}) ORDER BY icao24, {order}"""
    return text if top is None else f"{text} LIMIT {top}"


def statements(view: str = VIEW, top: int = K.TOP_COUNTRIES_REPORT) -> dict[str, str]:
    """Name -> SQL of the reports over ``view``."""
    bucket = case_of_bounds("altitude_meters", K.ALTITUDE_BUCKETS, K.ALTITUDE_BUCKET_TOP, K.ALTITUDE_BUCKET_NULL)
    speed = {"avg_velocity": "velocity_kmh"}
    return {
        "altitude_distribution": report(bucket, "altitude_range", view=view),
        "country_stats_top": report("origin_country", "origin_country", "nb_observations",
                                    {"avg_altitude": "altitude_meters"} | speed, known_only=True, top=top, view=view),
        "flight_evolution": evolution(view),
        "ground_vs_air": report("on_ground", "on_ground", means=speed, view=view),
    }


STATEMENTS = statements()


def register(spark: SparkSession, silver: DataFrame, view: str = VIEW) -> None:
    silver.createOrReplaceTempView(view)


def run(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(STATEMENTS[name])
