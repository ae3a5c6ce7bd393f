"""Exactly-once writes to sinks that can only append.

A micro-batch is staged as a table first; staging gives each row a key, which
holds from then on. The batch is then published: rows whose keys the sink does
not have yet are appended. A ledger record says for each batch where it is
staged, and another that it is published. Whatever ends an attempt, the next one
goes on from the ledger: a staged batch is not computed anew, rows that are in
the sink are not appended again, and a published batch is left alone.

The sink's table needs the columns ``batch_id`` and ``row_key`` beside those of
the spans, and must be readable through Spark.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.session import scratch_path
from tracewright.sources.shared import Records

KEYS = ("batch_id", "row_key")


@dataclass(frozen=True)
class Written:
    """``rows`` of the batch, and how many of them this call has appended."""

    rows: int
    appended: int


class Ledger:
    """Records of the batches of one sink; ``path`` is a folder that outlives the job."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.records = Records(f"{self.path}/batches")

    def staged(self, spark: SparkSession, df: DataFrame, batch_id: int) -> tuple[DataFrame, int]:
        """The batch as it was first staged, with its keys, and its number of rows."""
        record = self.records.get(f"{batch_id}.staged")
        if record is None:
            path = f"{self.path}/staged/{scratch_path(spark, f'batch-{batch_id}').rpartition('/')[2]}"
            keyed = df.withColumns({"batch_id": F.lit(batch_id).cast("long"), "row_key": F.monotonically_increasing_id()})
            keyed.write.parquet(path)
            rows = spark.read.parquet(path).count()
            record = self.records.add(f"{batch_id}.staged", {"path": path, "rows": rows})
        schema = df.schema.add("batch_id", "long").add("row_key", "long") if "batch_id" not in df.columns else df.schema
        return spark.read.schema(schema).parquet(record["path"]), record["rows"]

    def write_once(self, df: DataFrame, batch_id: int, append: Callable[[DataFrame], None], read: Callable[[], DataFrame]) -> Written:
        """Appends ``df`` as ``batch_id`` unless, or as far as, it is in the sink already."""
        done = self.records.get(f"{batch_id}.published")
        if done is not None:
            return Written(done["rows"], 0)
        staged, rows = self.staged(df.sparkSession, df, batch_id)
        there = read().where(F.col("batch_id") == batch_id).select("row_key")
        held = there.count()
        if not held:
            append(staged)
        elif held < rows:
            append(staged.join(there, "row_key", "left_anti").select(*staged.columns))
        self.records.add(f"{batch_id}.published", {"rows": rows})
        return Written(rows, rows - held)
