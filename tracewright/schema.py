"""Span data model: one fixed StructType, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: core annotation and tag names of the span model ---------
CLIENT_SEND = "cs"
CLIENT_RECV = "cr"
SERVER_RECV = "sr"
SERVER_SEND = "ss"
SERVER_ADDR = "sa"
CLIENT_ADDR = "ca"
CORE_ANNOTATIONS = (CLIENT_SEND, CLIENT_RECV, SERVER_RECV, SERVER_SEND)

# --- fixed values: Finagle markers the adjusters look for ------------------
FINAGLE_VERSION_KEY_PART = "finagle.version"
FINAGLE_FLUSH = "finagle.flush"
HIT_OR_MISS = ("Hit", "Miss")

ERROR_KEY = "error"

# Trace key columns. Shuffles use the numeric pair; the hex key is for output.
TRACE_COLS = ("trace_id_high", "trace_id")
SPAN_KEY_COLS = ("trace_id_high", "trace_id", "id")

ENDPOINT = T.StructType(
    [
        T.StructField("service_name", T.StringType(), True),
        T.StructField("ipv4", T.StringType(), True),
        T.StructField("port", T.IntegerType(), True),
    ]
)

ANNOTATION = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), True),
        T.StructField("value", T.StringType(), True),
        T.StructField("endpoint", ENDPOINT, True),
    ]
)

BINARY_ANNOTATION = T.StructType(
    [
        T.StructField("key", T.StringType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("type", T.StringType(), True),
        T.StructField("endpoint", ENDPOINT, True),
    ]
)

SPAN_SCHEMA = T.StructType(
    [
        T.StructField("trace_id_high", T.LongType(), False),
        T.StructField("trace_id", T.LongType(), False),
        T.StructField("id", T.LongType(), False),
        T.StructField("parent_id", T.LongType(), True),
        T.StructField("name", T.StringType(), False),
        T.StructField("timestamp", T.LongType(), True),
        T.StructField("duration", T.LongType(), True),
        T.StructField("annotations", T.ArrayType(ANNOTATION, True), False),
        T.StructField("binary_annotations", T.ArrayType(BINARY_ANNOTATION, True), False),
    ]
)

SPAN_COLUMNS = tuple(f.name for f in SPAN_SCHEMA.fields)

MESSAGE_SCHEMA = T.StructType([T.StructField("value", T.BinaryType(), True)])

DEAD_LETTER_SCHEMA = T.StructType(
    [
        T.StructField("value", T.BinaryType(), True),
        T.StructField("reason", T.StringType(), False),
    ]
)
