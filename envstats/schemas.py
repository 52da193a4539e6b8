"""Declared schemas (STR-1, FIXTURES A1-A5).  Inference is opt-in only."""

from __future__ import annotations

from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)

from envstats import constants as C

# the measures come first in the list of screened columns, up to the score
_OBS_MEASURES = C.OUTLIER_COLUMNS[:C.OUTLIER_COLUMNS.index("score")]

OBS = StructType(
    [StructField("fips", LongType(), True), StructField("date", DateType(), True)]
    + [StructField(c, DoubleType(), True) for c in _OBS_MEASURES]
    + [StructField("score", DoubleType(), True)]
)

_SOIL_NUMERIC = (
    ["lat", "lon", "elevation"] + [f"slope{i}" for i in range(1, 9)]
    + ["aspectN", "aspectE", "aspectS", "aspectW", "aspectUnknown"]
    + list(C.LAND_USE_COLUMNS) + [f"SQ{i}" for i in range(1, 8)]
)
SOIL = StructType([StructField("fips", LongType(), True)]
                  + [StructField(c, DoubleType(), True) for c in _SOIL_NUMERIC])

GEO = StructType([
    StructField("fips", LongType(), True),
    StructField("State_Code", IntegerType(), True),
    StructField("State_or_Territory", StringType(), True),
    StructField("State_Abbreviation", StringType(), True),
    StructField("County", IntegerType(), True),
    StructField("County_Name", StringType(), True),
])

# Stream input: every field nullable, text key and text date, positional order.
_STREAM_TEXT = ("fips", "State_or_Territory", "County_Name", "date")
STREAM = StructType([StructField(c, StringType() if c in _STREAM_TEXT else DoubleType(), True)
                     for c in C.STREAM_COLUMNS])
