"""Table schemas and fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

READINGS = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("building_id", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("meter_reading", T.DoubleType()),
    T.StructField("anomaly", T.IntegerType()),
    T.StructField("primary_use", T.StringType()),
    T.StructField("site_id", T.IntegerType()),
    T.StructField("square_feet", T.DoubleType()),
    T.StructField("floor_count", T.DoubleType()),
    T.StructField("year_built", T.IntegerType()),
    T.StructField("air_temperature", T.DoubleType()),
    T.StructField("wind_speed", T.DoubleType()),
    T.StructField("cloud_coverage", T.DoubleType()),
    T.StructField("dew_temperature", T.DoubleType()),
    T.StructField("sea_level_pressure", T.DoubleType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("weekday", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])

ANOMALIES = T.StructType([
    T.StructField("building_id", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("meter_reading", T.DoubleType()),
    T.StructField("anomaly_score", T.DoubleType()),
    T.StructField("detection_method", T.StringType()),
    T.StructField("details", T.StringType()),
    T.StructField("detected_at", T.TimestampType()),
])

MODEL_PERFORMANCE = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("model", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

STREAM_STATS = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

THRESHOLDS = T.StructType([
    T.StructField("parameter", T.StringType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("std", T.DoubleType()),
    T.StructField("min", T.DoubleType()),
    T.StructField("max", T.DoubleType()),
    T.StructField("q1", T.DoubleType()),
    T.StructField("q3", T.DoubleType()),
])

# The four stored tables and their columns.
TABLES = {
    "meter_readings": READINGS,
    "anomalies": ANOMALIES,
    "model_performance": MODEL_PERFORMANCE,
    "stream_stats": STREAM_STATS,
}

# Model inputs, in the order the model expects them.
FEATURES = [
    "meter_reading", "air_temperature", "wind_speed", "hour", "weekday", "month",
    "square_feet", "floor_count", "cloud_coverage", "dew_temperature",
    "sea_level_pressure",
]

# Thresholds used for a parameter nothing could be computed for
# (parameter, mean, std, min, max, q1, q3).
DEFAULT_THRESHOLDS = [
    ("meter_reading", 150.0, 100.0, 0.0, 500.0, 50.0, 250.0),
    ("air_temperature", 20.0, 10.0, -10.0, 50.0, 15.0, 25.0),
    ("wind_speed", 5.0, 3.0, 0.0, 15.0, 2.0, 8.0),
    ("hour", 12.0, 7.0, 0.0, 23.0, 6.0, 18.0),
    ("weekday", 3.0, 2.0, 0.0, 6.0, 1.0, 5.0),
    ("month", 6.0, 3.0, 1.0, 12.0, 3.0, 9.0),
    ("square_feet", 50000.0, 50000.0, 1000.0, 200000.0, 20000.0, 80000.0),
    ("floor_count", 3.0, 2.0, 1.0, 10.0, 1.0, 5.0),
    ("cloud_coverage", 4.0, 3.0, 0.0, 9.0, 2.0, 7.0),
    ("dew_temperature", 15.0, 8.0, -5.0, 30.0, 10.0, 20.0),
    ("sea_level_pressure", 1013.0, 10.0, 990.0, 1040.0, 1008.0, 1018.0),
]

# Labels of the five temperature bins, coldest first.
TEMPERATURE_LABELS = ["Very Cold", "Cold", "Moderate", "Warm", "Hot"]

# Size classes by floor area, right-closed upper edges.
SIZE_CLASSES = [
    ("Small", 10000.0), ("Medium", 50000.0), ("Large", 100000.0),
    ("Very Large", float("inf")),
]

# Day names, Monday first.
WEEKDAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

# Building types offered for classification.
PRIMARY_USES = [
    "Office", "Education", "Retail", "Healthcare", "Lodging/residential",
    "Entertainment/public assembly", "Public services", "Warehouse/storage",
    "Food sales and service", "Religious worship", "Manufacturing/industrial",
    "Other",
]
