"""Explicit schemas of the data model; nothing is ever inferred."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

# seq breaks ties between readings with equal time.
READINGS = StructType(
    [
        StructField("seq", LongType()),
        StructField("time", LongType()),
        StructField("i", IntegerType()),
        StructField("j", IntegerType()),
        StructField("gen", DoubleType()),
    ]
)

# The JSON-lines record format: field names as the text generator prints
# them; `timestamp` is a double because it may be printed as `1e+06`.
JSON_READING = StructType(
    [
        StructField("x", IntegerType()),
        StructField("y", IntegerType()),
        StructField("timestamp", DoubleType()),
        StructField("gen", DoubleType()),
    ]
)

# Documented field names accepted as aliases of the JSON ones.
JSON_RENAMES = {"gridX": "x", "gridY": "y", "time": "timestamp"}
