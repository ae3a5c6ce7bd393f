"""Fixture tables derived from the driver's tables, written once per session.

In production spans and messages sit in storage and every operator reads
them; the fixture mirrors that. The span table and the message table are
derived from ``events`` by Spark, written to the shared folder named by
``spark.checkpoint.dir`` (a lineage cut that survives executor loss, unlike
``localCheckpoint``) and read back by each query. The derivation spreads a
single-file ``events`` scan over the cluster's cores (see
``spread_small_input``), so the written table has that many files.
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import DataFrame, SparkSession

from tracewright.schema import MESSAGE_SCHEMA, SPAN_SCHEMA
from tracewright.session import scratch_path
from tracewright.sources.events import half_spans_from_spans, spans_table
from tracewright.sources.messages import fixture_messages_from_spans

_lock = threading.RLock()
_written: dict[tuple, str] = {}


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    src = os.path.join(sf_dir, "events.parquet")
    mtime = os.path.getmtime(src) if os.path.exists(src) else 0.0
    return (spark.sparkContext.applicationId, os.path.abspath(sf_dir), mtime, name)


def materialize(spark: SparkSession, sf_dir: str, name: str, build, schema) -> DataFrame:
    key = _key(spark, sf_dir, name)
    with _lock:
        path = _written.get(key)
        if path is None:
            path = scratch_path(spark, f"fixture-{name}")
            build().write.mode("overwrite").parquet(path)
            _written[key] = path
    return spark.read.schema(schema).parquet(path)


def stored_spans(spark: SparkSession, sf_dir: str, split_halves: bool = False) -> DataFrame:
    if split_halves:
        return materialize(
            spark, sf_dir, "half_spans", lambda: half_spans_from_spans(stored_spans(spark, sf_dir)), SPAN_SCHEMA
        )
    return materialize(spark, sf_dir, "spans", lambda: spans_table(spark, sf_dir), SPAN_SCHEMA)


def stored_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("key", T.BinaryType(), True), *MESSAGE_SCHEMA.fields])
    return materialize(
        spark, sf_dir, "messages", lambda: fixture_messages_from_spans(stored_spans(spark, sf_dir)), schema
    )
