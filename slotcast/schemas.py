"""Table schemas and keys."""

from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _struct(spec: str) -> T.StructType:
    """A schema from ``name TYPE, ...``; unlike ``fromDDL`` it needs no session."""
    pairs = [field.split() for field in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


LANDING = _struct(
    "wait_time_id BIGINT, wait_time BIGINT, ts_utc TIMESTAMP_NTZ, at_id BIGINT, "
    "ride_name STRING, tp_id BIGINT, park_name STRING"
)
BRONZE = _struct(
    "wait_time_id BIGINT, wait_time BIGINT, ts_utc TIMESTAMP_NTZ, at_id BIGINT, "
    "ride_name STRING, tp_id BIGINT, park_name STRING, _ingested_at TIMESTAMP"
)
SILVER = _struct(
    "park_name STRING, ride_key STRING, ride_name STRING, ts_local TIMESTAMP_NTZ, "
    "ts_utc TIMESTAMP_NTZ, wait_time DOUBLE"
)
KPIS = _struct(
    "model STRING, kpi_name STRING, kpi_value DOUBLE, is_serving BOOLEAN, trained_at STRING, "
    "run_id STRING, run_status STRING, generated_at TIMESTAMP_NTZ, model_trained_at STRING"
)
PREDICTIONS = _struct(
    "row_kind STRING, park_name STRING, ride_key STRING, ride_name STRING, "
    "ts_local TIMESTAMP_NTZ, ts_utc TIMESTAMP_NTZ, predicted_wait_min DOUBLE, "
    "lower_bound DOUBLE, upper_bound DOUBLE, actual_wait_min DOUBLE, error_min DOUBLE, "
    "model_name STRING, run_id STRING, run_status STRING, generated_at TIMESTAMP_NTZ, "
    "model_trained_at STRING"
)
CHECK = _struct(
    "check_id STRING, table_name STRING, observed DOUBLE, threshold DOUBLE, "
    "passed BOOLEAN, message STRING"
)

#: Folder that a bronze row is stored in.
ID_RANGE = "id_range"

PROVENANCE = ["run_id", "run_status", "generated_at", "model_trained_at"]
LANDING_COLUMNS = LANDING.fieldNames()
BRONZE_COLUMNS = BRONZE.fieldNames()
SILVER_COLUMNS = SILVER.fieldNames()
KPI_CORE = [c for c in KPIS.fieldNames() if c not in PROVENANCE]
PREDICTION_CORE = [c for c in PREDICTIONS.fieldNames() if c not in PROVENANCE]

SLOT_KEY = ["park_name", "ride_key", "ts_local"]
UNIT_KEY = ["park_name", "ride_key"]
KPI_KEY = ["model", "kpi_name"]
PREDICTION_KEY = ["row_kind", "model_name", "park_name", "ride_key", "ts_local"]

KPI_REQUIRED = ["model", "kpi_name", "is_serving"]
PREDICTION_REQUIRED = [
    "row_kind", "park_name", "ride_key", "ts_local", "ts_utc", "predicted_wait_min", "model_name",
]
