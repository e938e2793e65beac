"""Canonical schemas, names and field orders shared by batch and stream code."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for identical results:
# the five sensor names (also the file names without ``.csv``), the wide-row
# column order, the model feature order, the prediction-message field order,
# the search-document field order, the two movement labels and the text time
# format.
# ---------------------------------------------------------------------------
SENSORS = ("co2", "humidity", "light", "pir", "temperature")
WIDE_COLUMNS = ("event_ts_min", "ts_min_bignt", "room", "co2", "light", "temp", "humidity", "pir")
READING_COLUMNS = ("co2", "light", "temp", "humidity", "pir")
FEATURES = ("co2", "light", "temp", "humidity")
PREDICTION_FIELDS = (
    "event_ts_min", "room", "co2", "light", "temp", "humidity", "prediction", "confidence",
)
DOCUMENT_FIELDS = (
    "event_ts_min", "co2", "humidity", "light", "temperature", "room", "pir", "if_movement",
)
MOVEMENT = "movement"
NO_MOVEMENT = "no_movement"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# end of fixed values

# In the wide row the temperature sensor is called ``temp``; every other
# sensor keeps its name.
WIDE_NAME = {s: ("temp" if s == "temperature" else s) for s in SENSORS}

KEY = ("room", "ts_min_bignt")

# One headerless CSV per (room, sensor): two nullable text fields.
RAW_FILE_SCHEMA = T.StructType([
    T.StructField("ts_min_bignt", T.StringType(), True),
    T.StructField("sensor_value", T.StringType(), True),
])

# The wide reading. Times are epoch seconds; the text time is kept
# for the delimited interchange format.
_TYPES = {"event_ts_min": T.StringType(), "room": T.StringType(), "ts_min_bignt": T.LongType()}


def _fields(names) -> T.StructType:
    """Texts and epoch seconds by name; every other field is a double."""
    return T.StructType([T.StructField(n, _TYPES.get(n, T.DoubleType()), True) for n in names])


WIDE_SCHEMA = _fields(WIDE_COLUMNS)

# JSON payload with the same eight names. Doubles, not floats: through
# float 24.06 turns into 24.059999465942383 and training and scoring would
# disagree.
JSON_PAYLOAD_SCHEMA = WIDE_SCHEMA

# Prediction message.
PREDICTION_SCHEMA = _fields(PREDICTION_FIELDS)

# Topic-like message: what a broker source delivers, reduced to what we use.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])

