"""Sinks / consumers (C1-C8): write span DataFrames to any Spark data source.

The reference makes one blocking storage call per trace; here every write is
a bulk, partition-parallel DataFrame write. Failed writes are retried a
bounded number of times and then go to a dead-letter table -- never dropped
silently. Row counts come from ``DataFrame.observe`` during the write itself,
not from an extra pass.

File sinks are idempotent per micro-batch, and so is a store of own connections
(``streaming.connections``), which commits a batch by its name. Other backends
append; with a ``ledger`` folder a batch is staged first and only rows that the
backend does not have yet are appended (``streaming.ledger``). Without one, a
retry or a replayed batch may write rows twice unless the backend's own options
make writes by key (``es.mapping.id``, a primary key).
"""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tracewright.schema import SPAN_SCHEMA
from tracewright.sources.messages import span_json_struct
from tracewright.streaming import connections
from tracewright.streaming.ledger import Ledger

log = logging.getLogger(__name__)

# Backend name -> Spark data source. Third-party formats need their jar on the
# classpath; an unknown backend is refused up front.
BACKENDS = {
    "parquet": "parquet",
    "orc": "orc",
    "json": "json",
    "jdbc": "jdbc",
    "console": "console",
    "elasticsearch": "org.elasticsearch.spark.sql",
    "cassandra": "org.apache.spark.sql.cassandra",
    "connections": connections.FORMAT,
}
FILE_BACKENDS = {"parquet", "orc", "json"}


class SinkCheckError(RuntimeError):
    pass


@dataclass(frozen=True)
class SinkConfig:
    kind: str = "parquet"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    mode: str = "append"
    partition_by: tuple[str, ...] = ()
    max_attempts: int = 3
    retry_wait_s: float = 0.5
    ledger: str | None = None  # folder of the batches' records, for backends that can only append

    def __post_init__(self):
        if self.kind not in BACKENDS:
            raise ValueError(f"unsupported sink {self.kind!r}; expected one of {sorted(BACKENDS)}")
        if self.kind in FILE_BACKENDS and not self.path:
            raise ValueError(f"sink {self.kind!r} needs a path")
        if self.kind == "connections" and "store" not in self.options:
            raise ValueError("a sink of own connections needs the option store, as module:Class")

    @property
    def format(self) -> str:
        return BACKENDS[self.kind]


def _writer(df: DataFrame, sink: SinkConfig, mode: str):
    w = df.write.format(sink.format).mode(mode).options(**sink.options)
    if sink.partition_by:
        w = w.partitionBy(*sink.partition_by)
    return w


def check_sink(spark: SparkSession, sink: SinkConfig) -> None:
    """Fail fast before a job starts.

    File sinks get a probe write of an empty span table next to the data;
    JDBC gets a metadata read; other backends a probe of their format.
    """
    try:
        if sink.kind in FILE_BACKENDS:
            empty = spark.createDataFrame([], SPAN_SCHEMA).drop(*sink.partition_by)
            probe = f"{sink.path.rstrip('/')}/_sink_check"
            empty.write.format(sink.format).mode("overwrite").options(**sink.options).save(probe)
            _delete(spark, probe)
        elif sink.kind == "connections":
            connections.register(spark)
            connections.store_of(sink.options).check()
        elif sink.kind == "jdbc":
            spark.read.format("jdbc").options(**sink.options).option("query", "SELECT 1").load().schema
        elif sink.kind != "console":
            spark.read.format(sink.format).options(**sink.options).load().schema
    except Exception as exc:  # noqa: BLE001
        raise SinkCheckError(f"sink {sink.kind} is not usable: {exc}") from exc


def write_spans(
    df: DataFrame,
    sink: SinkConfig,
    batch_id: int | None = None,
    dead_letters: SinkConfig | None = None,
    known_non_empty: bool = False,
    rows_for_dead_letters: DataFrame | None = None,
) -> int:
    """Write ``df``; return the number of rows written.

    * empty input: nothing is written (C3); where rows were expected and none
      came (``known_non_empty``), an empty batch folder is taken away again;
    * file sinks with a ``batch_id`` write to ``<path>/batch_id=<n>`` in
      overwrite mode, so a replayed micro-batch replaces its own output
      (idempotent restart); a store of own connections commits the batch by its
      number; with a ``ledger`` only rows that the sink does not have are appended;
    * ``known_non_empty`` skips the emptiness probe when the caller already
      counted the input;
    * on failure: up to ``max_attempts`` tries, then the spans go to
      ``dead_letters`` as JSON messages, which the decoder reads, with the error
      as reason (C4); ``rows_for_dead_letters`` are diverted instead where
      ``df``'s own plan may be what fails.
    """
    if not known_non_empty and df.isEmpty():
        log.debug("nothing to write")
        return 0
    spark = df.sparkSession
    path, mode, options = sink.path, sink.mode, dict(sink.options)
    if sink.kind in FILE_BACKENDS and batch_id is not None and not sink.ledger:
        path, mode = f"{sink.path.rstrip('/')}/batch_id={batch_id}", "overwrite"
    if sink.kind == "connections":
        connections.register(spark)
        if batch_id is not None and not sink.ledger:
            options["commit"] = f"batch-{batch_id}"

    def write(rows: DataFrame) -> None:
        w = _writer(rows, replace(sink, options=options), mode)
        w.save(path) if path else w.save()

    last: Exception | None = None
    for attempt in range(1, sink.max_attempts + 1):
        try:
            if sink.ledger and batch_id is not None:
                return Ledger(sink.ledger).write_once(df, batch_id, write, lambda: _readable(spark, sink, df)).appended
            # an observation keeps the first result it gets, so each attempt has its own
            obs = Observation(f"written_{batch_id if batch_id is not None else 'batch'}_{attempt}_{time.monotonic_ns()}")
            write(df.observe(obs, F.count(F.lit(1)).alias("n")))
            n = obs.get["n"]
            if not n and path and mode == "overwrite":
                _delete(spark, path)
            log.debug("%d rows are in the sink", n)
            return n
        except Exception as exc:  # noqa: BLE001
            last = exc
            log.warning("write attempt %d/%d failed: %s", attempt, sink.max_attempts, exc)
            time.sleep(sink.retry_wait_s * attempt)
    if dead_letters is None:
        raise RuntimeError(f"write failed and no dead-letter sink is configured: {last}") from last
    reason = f"write_failed: {last}"
    lost = df if rows_for_dead_letters is None else rows_for_dead_letters
    message = F.concat(F.lit("["), F.to_json(span_json_struct()), F.lit("]")).cast("binary")
    write_dead_letters(lost.select(message.alias("value"), F.lit(reason).alias("reason")), dead_letters, batch_id, kind="write_failed")
    log.warning("batch %s went to the dead letters: %s", batch_id, reason)
    return 0


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _readable(spark: SparkSession, sink: SinkConfig, df: DataFrame) -> DataFrame:
    """What an appending sink holds, for the ledger; a sink that holds nothing yet is an empty table."""
    keys = "batch_id long, row_key long"
    if sink.kind == "connections":
        return connections.store_of(sink.options).read(spark, keys)
    try:
        reader = spark.read.format(sink.format).options(**sink.options)
        return reader.load(sink.path) if sink.path else reader.load()
    except AnalysisException:
        return spark.createDataFrame([], keys)


def write_dead_letters(dl: DataFrame, sink: SinkConfig, batch_id: int | None = None, kind: str = "malformed") -> None:
    """Each kind of a batch has a folder of its own, so one never replaces the other."""
    path, mode = sink.path, "append"
    if sink.kind in FILE_BACKENDS and batch_id is not None:
        path, mode = f"{sink.path.rstrip('/')}/batch_id={batch_id}/kind={kind}", "overwrite"
    w = _writer(dl, sink, mode)
    w.save(path) if path else w.save()


def read_dead_letters(spark: SparkSession, sink: SinkConfig, kind: str | None = None) -> DataFrame:
    """Dead letters as messages ``(value, reason)``, of one kind or all; those of failed writes decode to the spans lost."""
    found = spark.read.format(sink.format).options(**sink.options).load(sink.path)
    return (found if kind is None else found.where(F.col("kind") == kind)).select("value", "reason")


def read_sink(spark: SparkSession, sink: SinkConfig) -> DataFrame:
    """Read back what a file sink holds (partition columns of the batches dropped)."""
    return spark.read.format(sink.format).options(**sink.options).load(sink.path).drop("batch_id", "kind")
