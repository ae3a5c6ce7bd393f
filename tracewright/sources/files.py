"""File sources (S4-S5): message and span tables from files, batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracewright.schema import MESSAGE_SCHEMA, SPAN_COLUMNS, SPAN_SCHEMA

#: Bytes of a message file that only one task can read.
ROW_GROUP = 4 << 20


def read_messages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Message table (``value`` BINARY) from parquet/orc, or raw files.

    ``fmt="binaryFile"`` reads every file as one message (its content).
    """
    if fmt == "binaryFile":
        return spark.read.format("binaryFile").load(path).selectExpr("content AS value")
    return spark.read.format(fmt).schema(MESSAGE_SCHEMA).load(path)


def _stream_reader(spark: SparkSession, max_files_per_trigger: int | None):
    reader = spark.readStream
    return reader if max_files_per_trigger is None else reader.option("maxFilesPerTrigger", max_files_per_trigger)


def message_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """A directory of message files as a stream; with one file per trigger
    each file is one micro-batch (the queue-of-batches test source), and
    without a limit a micro-batch is all that is there."""
    reader = _stream_reader(spark, max_files_per_trigger)
    if fmt == "binaryFile":
        return reader.format("binaryFile").load(path).selectExpr("content AS value")
    return reader.format(fmt).schema(MESSAGE_SCHEMA).load(path)


def write_messages(messages: DataFrame, path: str) -> None:
    """Message files whose parts are small, so that one that is a micro-batch on its own is read by all cores, not by one task."""
    messages.write.mode("overwrite").option("parquet.block.size", ROW_GROUP).parquet(path)


def read_spans(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """An already-decoded span table; the schema is declared, not inferred."""
    return spark.read.format(fmt).schema(SPAN_SCHEMA).load(path).select(*SPAN_COLUMNS)


def span_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    return (
        _stream_reader(spark, max_files_per_trigger)
        .format(fmt)
        .schema(SPAN_SCHEMA)
        .load(path)
        .select(*SPAN_COLUMNS)
    )
