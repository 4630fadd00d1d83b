"""Declared schemas (the reference parsed dynamic JSON; Spark wants types)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

COMMON = T.StructType([T.StructField(n, S) for n in ("mid", "uid", "ar", "ch", "vc")])

# App log line. `start` is kept as raw JSON text (an object, "", null or absent).
APP_LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("start", S),
    T.StructField("ts", T.LongType()),
    T.StructField("_corrupt_record", S),
])

# Change envelope: every row value is a string or null.
CDC_ENVELOPE = T.StructType([
    T.StructField("table", S),
    T.StructField("type", S),
    T.StructField("isDdl", T.BooleanType()),
    T.StructField("es", T.LongType()),
    T.StructField("ts", T.LongType()),
    T.StructField("data", T.ArrayType(T.MapType(S, S))),
    T.StructField("_corrupt_record", S),
])

# Kafka source record shape (after CAST(key/value AS STRING)).
RECORD = T.StructType([
    T.StructField("key", S),
    T.StructField("value", S),
    T.StructField("topic", S),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

MONEY = T.DecimalType(16, 2)
