"""Storage layout of several related tables, written by the batch under one commit.

``spans`` holds the spans with their trace keys; ``annotations`` one row for each
annotation and text tag; ``names`` and ``marks`` are the indexes by which traces
are found: the service and span names of a trace, and its annotations and tags,
each with the span's time and duration. A record of the ledger names the folders
of a batch; readers see the four tables of a batch or none, and a replayed batch
is left as it is.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions.ids import trace_key
from tracewright.session import stored
from tracewright.sources.shared import Records

TABLES = ("spans", "annotations", "names", "marks")


def _services() -> Column:
    """All service names of a span."""
    both = F.concat(F.col("annotations.endpoint.service_name"), F.col("binary_annotations.endpoint.service_name"))
    return F.array_distinct(F.array_compact(both))


def tables_of(spans: DataFrame) -> dict[str, DataFrame]:
    """The four tables of ``spans``; indexes are reduced before they move."""
    keyed = spans.withColumn("trace_key", trace_key())
    text = F.coalesce(F.col("e.type"), F.lit("STRING")) == "STRING"
    annotations = keyed.select("trace_key", "id", F.explode("annotations").alias("e")).select(
        "trace_key", "id", F.col("e.timestamp").alias("at"), F.col("e.value").alias("key"), F.lit(None).cast("string").alias("value"), F.col("e.endpoint.service_name").alias("service")
    )
    tags = keyed.select("trace_key", "id", "timestamp", F.explode("binary_annotations").alias("e")).where(text).select(
        "trace_key", "id", F.col("timestamp").alias("at"), F.col("e.key").alias("key"), F.col("e.value").cast("string").alias("value"), F.col("e.endpoint.service_name").alias("service")
    )
    marks = keyed.select("trace_key", "timestamp", "duration", F.explode(_services()).alias("service"), "annotations", "binary_annotations")
    of_annotation = marks.select("trace_key", "timestamp", "duration", "service", F.explode("annotations.value").alias("key")).withColumn("value", F.lit(None).cast("string"))
    of_tag = marks.select("trace_key", "timestamp", "duration", "service", F.explode("binary_annotations").alias("e")).where(text)
    of_tag = of_tag.select("trace_key", "timestamp", "duration", "service", F.col("e.key").alias("key"), F.col("e.value").cast("string").alias("value"))
    reduced = [F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), F.max("duration").alias("longest")]
    names = keyed.select("trace_key", "name", "timestamp", "duration", F.explode(_services()).alias("service"))
    return {
        "spans": keyed,
        "annotations": annotations.unionByName(tags),
        "names": names.groupBy("service", "name", "trace_key").agg(*reduced),
        "marks": of_annotation.unionByName(of_tag).groupBy("service", "key", "value", "trace_key").agg(*reduced),
    }


def write_layout(spans: DataFrame, root: str, batch_id: int) -> bool:
    """Writes the tables of a batch and commits them together; false if the batch is there already."""
    records = Records(f"{root.rstrip('/')}/commits")
    if records.get(f"batch-{batch_id}") is not None:
        return False
    spans = stored(spans, "layout-batch")  # read for each table
    folders = {name: f"{root.rstrip('/')}/{name}/batch-{batch_id}-{uuid.uuid4().hex[:12]}" for name in TABLES}
    for name, table in tables_of(spans).items():
        # indexes are looked up by service, so files hold few services each
        table = table.repartitionByRange("service", "trace_key").sortWithinPartitions("service") if name in ("names", "marks") else table
        table.write.parquet(folders[name])
    return records.add(f"batch-{batch_id}", folders) == folders


def read_layout(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The committed rows of one of the tables."""
    folders = [c[name] for c in Records(f"{root.rstrip('/')}/commits").all().values()]
    if not folders:
        raise FileNotFoundError(f"nothing is committed below {root}")
    return spark.read.parquet(*folders)


def find_traces(
    spark: SparkSession,
    root: str,
    service: str,
    name: str | None = None,
    marks: dict[str, str | None] | None = None,
    start: int | None = None,
    end: int | None = None,
    min_duration: int | None = None,
) -> DataFrame:
    """Keys of the traces that the index tables know to fit, as ``trace_key``.

    A trace fits if a span of ``service`` has ``name``, and for each of ``marks`` one of its spans has that annotation
    (value None) or text tag; the spans counted lie from ``start`` to ``end``, the longest of them takes ``min_duration``.
    """

    def fitting(table: DataFrame, here: Column) -> DataFrame:
        rows = table.where((F.col("service") == service) & here)
        if start is not None:
            rows = rows.where(F.col("last") >= start)
        if end is not None:
            rows = rows.where(F.col("first") <= end)
        if min_duration is not None:
            rows = rows.where(F.col("longest") >= min_duration)
        return rows.select("trace_key").distinct()

    found = fitting(read_layout(spark, root, "names"), F.col("name") == name if name is not None else F.lit(True))
    for key, value in (marks or {}).items():
        same = F.col("value").isNull() if value is None else F.col("value") == value
        found = found.join(fitting(read_layout(spark, root, "marks"), (F.col("key") == key) & same), "trace_key", "left_semi")
    return found


def spans_of(spark: SparkSession, root: str, traces: DataFrame) -> DataFrame:
    """The whole spans of the traces found."""
    return read_layout(spark, root, "spans").join(traces, "trace_key", "left_semi").drop("trace_key")
