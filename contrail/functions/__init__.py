"""Column expressions (native Spark, no UDFs)."""

from contrail.functions.flight import (  # noqa: F401
    altitude_anomaly,
    altitude_bucket,
    epoch_to_timestamp,
    flight_phase,
    hour_minute,
    in_clean_ranges,
    percent_text,
    planar_distance,
    row_score,
    to_kmh,
    velocity_anomaly,
)
