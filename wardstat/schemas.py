"""Schemas, vocabularies and rule tables.

Everything here is declared once and shared by sources, operators and
tests. Column lists are explicit so that no operator discovers columns by
name suffix at run time.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source data product's definitions for
# results to agree; they are stated as-is, in their natural order.
# ---------------------------------------------------------------------------

# Measure code (as delivered in `measure_name`) -> short prefix.
MEASURE_CODES: dict[str, str] = {
    "READM-30-AMI-HRRP": "ami",
    "READM-30-CABG-HRRP": "cabg",
    "READM-30-COPD-HRRP": "copd",
    "READM-30-HF-HRRP": "hf",
    "READM-30-HIP-KNEE-HRRP": "hip_knee",
    "READM-30-PN-HRRP": "pn",
}

# Raw numeric column -> metric suffix in the wide table.
METRIC_SUFFIX: dict[str, str] = {
    "excess_readmission_ratio": "excess_ratio",
    "predicted_readmission_rate": "predicted_rate",
    "expected_readmission_rate": "expected_rate",
    "number_of_discharges": "discharges",
}

# Serving-side state vocabulary: 0 = AK ... 53 = WY.
STATES: list[str] = [
    "AK", "AL", "AR", "AZ", "CA", "CO", "CT", "DC", "DE", "FL", "GA", "GU", "HI", "IA",
    "ID", "IL", "IN", "KS", "KY", "LA", "MA", "MD", "ME", "MI", "MN", "MO", "MS", "MT",
    "NC", "ND", "NE", "NH", "NJ", "NM", "NV", "NY", "OH", "OK", "OR", "PA", "PR", "RI",
    "SC", "SD", "TN", "TX", "UT", "VA", "VI", "VT", "WA", "WI", "WV", "WY",
]

# Label: mean excess ratio strictly above this value is high risk.
EXCESS_RATIO_THRESHOLD = 1.0

# Risk tiers on the model probability: >= HIGH high, >= MEDIUM medium, else low.
TIER_HIGH = 0.65
TIER_MEDIUM = 0.40
TIERS = ["low", "medium", "high"]

# Feature-table range checks (inclusive bounds).
FEATURE_RANGE_RULES: dict[str, tuple[float, float]] = {
    "mean_excess_ratio": (0.1, 3.0),
    "max_excess_ratio": (0.1, 3.0),
    "mean_predicted_rate": (0.0, 50.0),
    "n_valid_measures": (1.0, 6.0),
}

# Feature-table key columns that must be null-free.
FEATURE_KEY_COLUMNS = [
    "facility_id", "state_encoded", "mean_excess_ratio",
    "n_valid_measures", "high_readmission_risk",
]

# Request bounds by metric suffix (inclusive; None = unbounded).
REQUEST_BOUNDS: dict[str, tuple[float | None, float | None]] = {
    "excess_ratio": (0.0, 5.0),
    "predicted_rate": (0.0, 100.0),
    "expected_rate": (0.0, 100.0),
    "discharges": (0.0, None),
}
STATE_MAX_LENGTH = 2

# Columns removed before training: identifiers, raw state, label and the
# aggregates that encode the label directly.
TARGET = "high_readmission_risk"
DROP_COLUMNS = [
    "facility_id", "facility_name", "state", TARGET,
    "mean_excess_ratio", "max_excess_ratio", "min_excess_ratio",
    "n_measures_over_threshold",
]

# Seeds and split sizes.
RANDOM_STATE = 42
TEST_FRACTION = 0.2
N_FOLDS = 5
PAGE_SIZE = 500
HISTORY_MAX = 1000

# ---------------------------------------------------------------------------
# Derived column lists
# ---------------------------------------------------------------------------

MEASURES: list[str] = list(MEASURE_CODES.values())
METRICS: list[str] = list(METRIC_SUFFIX.values())
RAW_NUMERIC: list[str] = list(METRIC_SUFFIX.keys())
ID_COLUMNS = ["facility_id", "facility_name", "state"]

# Wide order is metric-major (the pivot's order); serving order is measure-major.
WIDE_MEASURE_COLUMNS: list[str] = [f"{m}_{s}" for s in METRICS for m in MEASURES]
MEASURE_FEATURES: list[str] = [f"{m}_{s}" for m in MEASURES for s in METRICS]


def measure_columns(suffix: str) -> list[str]:
    return [f"{m}_{suffix}" for m in MEASURES]


EXCESS_COLUMNS = measure_columns("excess_ratio")
PREDICTED_COLUMNS = measure_columns("predicted_rate")
EXPECTED_COLUMNS = measure_columns("expected_rate")
DISCHARGE_COLUMNS = measure_columns("discharges")

AGGREGATE_FEATURES = [
    "mean_excess_ratio", "max_excess_ratio", "min_excess_ratio",
    "n_measures_over_threshold", "n_valid_measures",
    "mean_predicted_rate", "total_discharges",
]
SERVING_FEATURES: list[str] = MEASURE_FEATURES + AGGREGATE_FEATURES + ["state_encoded"]
REQUEST_COLUMNS: list[str] = ID_COLUMNS + MEASURE_FEATURES
FEATURE_TABLE_COLUMNS: list[str] = (
    ID_COLUMNS + WIDE_MEASURE_COLUMNS + AGGREGATE_FEATURES + ["state_encoded", TARGET]
)
MODEL_FEATURES: list[str] = [c for c in FEATURE_TABLE_COLUMNS if c not in DROP_COLUMNS]

# Display names of the measures for feature descriptions (our own wording,
# not a value that results depend on).
MEASURE_LABELS: dict[str, str] = {
    "ami": "heart attack (AMI)",
    "cabg": "bypass surgery (CABG)",
    "copd": "COPD",
    "hf": "heart failure",
    "hip_knee": "hip/knee replacement",
    "pn": "pneumonia",
}

# ---------------------------------------------------------------------------
# Struct types
# ---------------------------------------------------------------------------

RAW_FIELDS = [
    "facility_id", "facility_name", "state", "measure_name",
    "number_of_discharges", "footnote", "excess_readmission_ratio",
    "predicted_readmission_rate", "expected_readmission_rate",
    "number_of_readmissions", "start_date", "end_date",
]
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_FIELDS])

PAGE_SCHEMA = T.StructType([
    T.StructField("offset", T.LongType(), True),
    T.StructField("count", T.LongType(), True),
    T.StructField("results", T.ArrayType(RAW_SCHEMA), True),
])

REQUEST_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in ID_COLUMNS]
    + [T.StructField(c, T.DoubleType(), True) for c in MEASURE_FEATURES]
)

LOG_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("facility_id", T.StringType(), True),
    T.StructField("facility_name", T.StringType(), True),
    T.StructField("state", T.StringType(), True),
    T.StructField("input_features", T.StringType(), False),
    T.StructField("risk_score", T.DoubleType(), False),
    T.StructField("risk_level", T.StringType(), False),
    T.StructField("model_version", T.StringType(), False),
])
