"""Schemas and fixed names shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

READING_SCHEMA = T.StructType(
    [
        T.StructField("udi", T.IntegerType()),
        T.StructField("failure_type", T.StringType()),
        T.StructField("target", T.IntegerType()),
        T.StructField("process_temperature", T.DoubleType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("rotational_speed", T.IntegerType()),
        T.StructField("air_temperature", T.DoubleType()),
        T.StructField("tool_wear", T.IntegerType()),
        T.StructField("torque", T.DoubleType()),
        T.StructField("type", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("day_of_week", T.StringType()),
        T.StructField("failure_type_id", T.DoubleType()),
        T.StructField("manufacturer", T.StringType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("type_id", T.IntegerType()),
    ]
)
READING_COLUMNS = READING_SCHEMA.names

TELEMETRY_SCHEMA = T.StructType(
    [
        T.StructField("machine_id", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("vibration", T.DoubleType()),
        T.StructField("runtime_hours", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("location", T.StringType()),
        T.StructField("operator_id", T.StringType()),
        T.StructField("power_consumption_kw", T.DoubleType()),
        T.StructField("last_maintenance_date", T.LongType()),
    ]
)

# Header of the raw record files and the column each one becomes.
CSV_COLUMNS = {
    "UDI": "udi",
    "Product ID": "product_id",
    "Type": "type",
    "Air temperature [K]": "air_temperature",
    "Process temperature [K]": "process_temperature",
    "Rotational speed [rpm]": "rotational_speed",
    "Torque [Nm]": "torque",
    "Tool wear [min]": "tool_wear",
    "Target": "target",
    "Failure Type": "failure_type",
}

# Text a message carries when its source record lacks the field.
ABSENT_DEFAULTS = {"failure_type": "Unknown", "product_id": "Unknown", "type": "Unknown"}

RAW_COLUMNS = list(CSV_COLUMNS.values())
RAW_CSV_SCHEMA = T.StructType(
    [T.StructField(name, READING_SCHEMA[col].dataType) for name, col in CSV_COLUMNS.items()]
)
RAW_SCHEMA = T.StructType([READING_SCHEMA[c] for c in RAW_COLUMNS])
MESSAGE_SCHEMA = T.StructType([T.StructField("id", T.StringType()), *RAW_SCHEMA.fields])

NUMERIC_FEATURES = [
    "air_temperature",
    "process_temperature",
    "rotational_speed",
    "torque",
    "tool_wear",
]
MODEL_COLUMNS = ["type", *NUMERIC_FEATURES, "failure_type"]
