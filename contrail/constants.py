"""Domain constants.

FIXED VALUES — these must stay equal to the behaviour this engine
reproduces, otherwise results differ. Listed plainly, in natural order.
"""

# Unit conversion: metres per second -> kilometres per hour.
KMH_PER_MS = 3.6

# Cleaning ranges (inclusive bounds).
CLEAN_ALTITUDE_MIN = -500
CLEAN_ALTITUDE_MAX = 15000
CLEAN_SPEED_MIN = 0
CLEAN_SPEED_MAX = 1200

# Flight-phase labels and thresholds (first matching rule wins).
PHASE_GROUND = "GROUND"
PHASE_TAKEOFF = "TAKEOFF"
PHASE_CLIMB = "CLIMB"
PHASE_CRUISE = "CRUISE"
PHASE_DESCENT = "DESCENT"
PHASE_TRANSITION = "TRANSITION"
PHASES = (PHASE_GROUND, PHASE_TAKEOFF, PHASE_CLIMB, PHASE_CRUISE, PHASE_DESCENT, PHASE_TRANSITION)
TAKEOFF_MIN_CHANGE = 50
TAKEOFF_MAX_ALTITUDE = 3000
CLIMB_MIN_CHANGE = 20
CRUISE_MAX_ABS_CHANGE = 20
CRUISE_MIN_ALTITUDE = 8000
DESCENT_MAX_CHANGE = -20

# Altitude buckets of the exploration report.
ALTITUDE_BUCKETS = (
    (1000, "0-1000m"),
    (5000, "1000-5000m"),
    (10000, "5000-10000m"),
)
ALTITUDE_BUCKET_TOP = "10000m+"
ALTITUDE_BUCKET_NULL = "NULL"

# Anomaly limits (strict comparisons).
ANOMALY_ALTITUDE_MAX = 12000
ANOMALY_ALTITUDE_MIN = -100
ANOMALY_SPEED_MAX = 1000
ANOMALY_SPEED_MIN = 0

# Rolling frame: 5 preceding rows plus the current one.
ROLLING_PRECEDING = 5

# Airport types kept from the airport dimension.
AIRPORT_TYPES = ("large_airport", "medium_airport")

# Gold windows.
PHASE_WINDOW = "1 minute"
PHASE_WATERMARK = "2 minutes"
ANOMALY_WINDOW = "5 minutes"
ANOMALY_SLIDE = "1 minute"
ANOMALY_WATERMARK = "6 minutes"

# Dashboard.
ALERT_RATE = 0.1
TOP_COUNTRIES_ALERTS = 10
TOP_COUNTRIES_HEATMAP = 15
LATEST_LIMIT = 10

# Exploration.
TOP_COUNTRIES_REPORT = 10
TOP_COUNTRIES_SPEED = 15
TOP_AIRPORTS = 10
EVOLUTION_LIMIT = 20
HISTOGRAM_BINS = 50
SAMPLE_FRACTION = 0.1
SAMPLE_SEED = 42

# Classifier.
FEATURE_COLUMNS = (
    "altitude_meters", "velocity_kmh", "altitude_change", "velocity_change",
    "rolling_avg_altitude", "rolling_std_altitude", "rolling_avg_velocity",
)
RF_TREES = 100
RF_DEPTH = 10
RF_SEED = 42
TRAIN_FRACTION = 0.8
TEST_FRACTION = 0.2
SPLIT_SEED = 42
