"""Column names and table types shared by the sources, operators and plans."""

from pyspark.sql import types as T

TS = "date_time"
VALUE = "ac_power"

_double, _int, _text = T.DoubleType(), T.IntegerType(), T.StringType()
_ts, _day, _flag, _long = T.TimestampNTZType(), T.DateType(), T.BooleanType(), T.LongType()


def _table(*fields: tuple[str, T.DataType], required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name not in required) for name, kind in fields])


GENERATION = _table(
    ("date_time", _text), ("plant_id", _int), ("source_key", _text),
    ("dc_power", _double), ("ac_power", _double),
    ("daily_yield", _double), ("total_yield", _double),
)

WEATHER = _table(
    ("date_time", _text), ("plant_id", _int), ("source_key", _text),
    ("ambient_temperature", _double), ("module_temperature", _double), ("irradiation", _double),
)

PREDICTIONS = _table(
    ("prediction_date", _day), ("model_name", _text), ("forecast_24h", T.ArrayType(_double)),
    ("peak_power", _double), ("peak_hour", _int), ("total_energy", _double),
    ("daylight_energy", _double), ("features_count", _int), ("prediction_timestamp", _ts),
    ("created_at", _ts),
    required=("prediction_date", "model_name", "forecast_24h", "peak_power", "peak_hour",
              "total_energy", "daylight_energy", "features_count", "prediction_timestamp"),
)
PREDICTION_KEY = ("prediction_date", "model_name", "prediction_timestamp")

MODEL_PERFORMANCE = _table(
    ("timestamp", _ts), ("model_name", _text), ("model_version", _text),
    ("metric_name", _text), ("metric_value", _double), ("metadata", _text),
    required=("model_name", "metric_name", "metric_value"),
)

DRIFT_LOG = _table(
    ("timestamp", _ts), ("dataset_name", _text), ("feature_name", _text),
    ("drift_score", _double), ("drift_detected", _flag),
    required=("dataset_name", "feature_name", "drift_score"),
)

# One row per (model, version); the statistics themselves live in long tables.
REFERENCE_DATA = _table(
    ("timestamp", _ts), ("model_name", _text), ("model_version", _text),
    ("training_samples", _long), ("feature_count", _int), ("target_horizons", _int),
    ("collection_timestamp", _ts),
    required=("model_name", "training_samples", "feature_count", "target_horizons"),
)
REFERENCE_KEY = ("model_name", "model_version")

SCALER_PARAMS = _table(
    ("feature", _text), ("mean", _double), ("std", _double),
    ("min", _double), ("max", _double), ("ord", _int),
)
