"""Data contracts of the trip engine.

Column names, sentinels, thresholds and the raw schema below are fixed values:
they must equal the reference system's for results to match.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must match the reference behaviour exactly)
# ---------------------------------------------------------------------------
PICKUP = "lpep_pickup_datetime"
DROPOFF = "lpep_dropoff_datetime"

MODEL_INPUT_COLUMNS = [
    "VendorID",
    "lpep_pickup_datetime",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "trip_type",
]

LEAKAGE_AND_PAYMENT_COLUMNS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "payment_type",
    "congestion_surcharge",
    "cbd_congestion_fee",
    "ehail_fee",
    "store_and_fwd_flag",
    "RatecodeID",
]

# cleaning bounds: 0 < trip_distance <= 100, 0 < duration <= 300 minutes, fare >= 0
MAX_TRIP_DISTANCE = 100.0
MAX_DURATION_MINUTES = 300.0

# chronological split fractions: train [0, 0.6), validation [0.6, 0.8), test [0.8, 1];
# a cut is int(n * fraction) in double precision (for very large n this can be one below n*6//10)
TRAIN_FRACTION = 0.6
VALIDATION_END_FRACTION = 0.8
SPLIT_NAMES = ("train", "val", "test")

EARTH_RADIUS_MILES = 3958.8

FEATURE_MISSING = "__missing__"      # sentinel in features and segments
MONITOR_MISSING = "__MISSING__"      # sentinel in monitoring frames
UNKNOWN_BOROUGH = "Unknown"          # segment borough for unknown zones

WEEKEND_DAYS = [5, 6]                # Monday = 0
RUSH_HOURS = [7, 8, 9, 16, 17, 18]

DEFAULT_PASSENGER_COUNT = 1.0
DEFAULT_TRIP_TYPE = 1.0
DEFAULT_DISTANCE = 1.0

BASE_FEATURES = [
    "passenger_count",
    "pickup_month",
    "day_of_month",
    "estimated_distance_miles",
    "same_borough",
    "hour_sin",
    "hour_cos",
    "day_sin",
    "day_cos",
    "is_weekend",
    "is_rush_hour",
    "PU_zone_frequency",
    "DO_zone_frequency",
    "route_frequency",
]

CATEGORICAL_FEATURE_COLUMNS = ["VendorID", "trip_type", "PU_Borough", "DO_Borough"]

INPUT_MONITORING_COLUMNS = [
    "VendorID",
    "PULocationID",
    "DOLocationID",
    "trip_type",
    "pickup_hour",
    "pickup_day_of_week",
    "passenger_count",
    "lpep_pickup_datetime",
]
CATEGORICAL_MONITORING_COLUMNS = [
    "VendorID",
    "PULocationID",
    "DOLocationID",
    "trip_type",
    "pickup_hour",
    "pickup_day_of_week",
]
DRIFT_MONITORING_COLUMNS = [c for c in INPUT_MONITORING_COLUMNS if c != PICKUP]

SEGMENT_COLUMNS = ["pickup_hour", "PU_Borough", "trip_type"]
SEGMENT_MIN_ROWS = 100

DRIFT_WARNING_SHARE = 0.30
RANDOM_SEED = 42

# champion training parameters of the reference (XGBoost names)
CHAMPION_PARAMS = {
    "max_depth": 8,
    "learning_rate": 0.020673687141394805,
    "min_child_weight": 15,
    "subsample": 0.9413549242801476,
    "colsample_bytree": 0.6849356442713105,
    "gamma": 0.5454749016213019,
    "n_estimators": 550,
    "reg_alpha": 0.0005415244119402539,
    "reg_lambda": 1.2439367209907215,
}

# tuning search space (name -> (low, high, kind)); kind: int, float, logfloat, step50
SEARCH_SPACE = {
    "max_depth": (4, 9, "int"),
    "learning_rate": (0.02, 0.10, "logfloat"),
    "min_child_weight": (3, 15, "int"),
    "subsample": (0.65, 1.0, "float"),
    "colsample_bytree": (0.60, 1.0, "float"),
    "gamma": (0.0, 3.0, "float"),
    "reg_alpha": (1e-4, 1.0, "logfloat"),
    "reg_lambda": (0.5, 10.0, "logfloat"),
    "n_estimators": (250, 800, "step50"),
}

LINEAGE_REQUIRED_TAGS = (
    "data.train.path",
    "data.train.sha256",
    "data.validation.path",
    "data.validation.sha256",
)

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------
RAW_TRIP = T.StructType(
    [
        T.StructField("VendorID", T.LongType()),
        T.StructField(PICKUP, T.TimestampNTZType()),
        T.StructField(DROPOFF, T.TimestampNTZType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("trip_type", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("payment_type", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("cbd_congestion_fee", T.DoubleType()),
        T.StructField("ehail_fee", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("RatecodeID", T.DoubleType()),
    ]
)

ZONE = T.StructType(
    [
        T.StructField("LocationID", T.LongType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

# request fields arrive as strings so lax numeric forms ("2", 2.0) can be validated, not nulled
TRIP_REQUEST_FIELDS = T.StructType(
    [
        T.StructField("VendorID", T.StringType()),
        T.StructField(PICKUP, T.StringType()),
        T.StructField("PULocationID", T.StringType()),
        T.StructField("DOLocationID", T.StringType()),
        T.StructField("passenger_count", T.StringType()),
        T.StructField("trip_type", T.StringType()),
    ]
)
TRIP_REQUEST = T.StructType([T.StructField("trips", T.ArrayType(TRIP_REQUEST_FIELDS))])
