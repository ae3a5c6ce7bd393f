"""The streaming job (J1-J6, G1-G2, C1): messages -> decode -> filter ->
adjusters -> sink, once per micro-batch, through Structured Streaming.

Per trigger the batch is decoded once in a single pass (the per-message
result is persisted for the two writes: spans and dead letters), span-local
adjusters run as one fused projection, and whole-trace adjusters group
*within the batch* -- the reference's semantics: a trace split over two
batches gives two groups.
The checkpoint location makes restarts resume from committed offsets, and
per-batch overwrite of ``batch_id=<n>`` makes a replayed batch idempotent.
"""

from __future__ import annotations

import functools
import logging
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracewright.operators.adjust import Adjuster, chain
from tracewright.operators.decode import Decoded, decode_messages
from tracewright.session import scratch_path
from tracewright.streaming.live import LiveOperator
from tracewright.streaming.sinks import FILE_BACKENDS, SinkConfig, check_sink, write_dead_letters, write_spans

log = logging.getLogger(__name__)

DEFAULT_BATCH_INTERVAL_MS = 10_000


@dataclass
class JobConfig:
    """Everything a job needs; plain values only (serializable intent)."""

    source: Callable[[SparkSession], DataFrame]  # returns a streaming DataFrame with ``value``
    sink: SinkConfig
    adjusters: Sequence[Adjuster] = ()
    dead_letter_sink: SinkConfig | None = None
    span_filter: Callable[[], Column] | None = None  # F1, before any grouping
    batch_interval_ms: int = DEFAULT_BATCH_INTERVAL_MS  # G2
    checkpoint_location: str | None = None
    available_now: bool = False  # drain what is there, then stop (tests, backfills)
    fail_fast: bool = True  # C7
    log_level: str = "INFO"  # J6
    live: Sequence[LiveOperator] = ()  # reports and other operators across batches, each given the adjusted batch
    conf: dict[str, str] = field(default_factory=dict)  # J2: merged, never replacing defaults


def process_batch(
    batch: DataFrame,
    batch_id: int,
    adjusters: Sequence[Adjuster],
    sink: SinkConfig,
    dead_letter_sink: SinkConfig | None = None,
    span_filter: Callable[[], Column] | None = None,
    live: Sequence[LiveOperator] = (),
) -> int:
    """One micro-batch (C1): decode, filter, adjust, write. Returns spans written.

    ``live`` operators get every batch, also one without spans, as their tables go on from batch to batch.
    """
    return process_decoded(_per_message(batch), batch_id, adjusters, sink, dead_letter_sink, span_filter, live)


def _per_message(messages: DataFrame) -> DataFrame:
    """Messages decoded in one pass, for both writes; the payload is kept of malformed ones only."""
    decoded = decode_messages(messages).per_message
    return decoded.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))


def process_decoded(
    decoded: DataFrame,
    batch_id: int,
    adjusters: Sequence[Adjuster],
    sink: SinkConfig,
    dead_letter_sink: SinkConfig | None = None,
    span_filter: Callable[[], Column] | None = None,
    live: Sequence[LiveOperator] = (),
) -> int:
    """What :func:`process_batch` does, from a micro-batch of decoded messages on.

    While one job decodes and counts, the spans' plan is made; dead letters are written beside the spans.
    """
    per_message = decoded.persist(StorageLevel.MEMORY_AND_DISK)
    beside = _beside(decoded.sparkSession)
    try:
        d = Decoded.from_per_message(per_message)
        with ThreadPoolExecutor(1) as other:
            counting = other.submit(beside(_counts), per_message)
            spans = d.spans if span_filter is None else d.spans.filter(span_filter())
            adjusted = chain(list(adjusters))(spans)
            n_spans, n_dead = counting.result()
            dead = functools.partial(write_dead_letters, sink=dead_letter_sink, batch_id=batch_id)
            writing = other.submit(beside(dead), d.dead_letters) if n_dead > 0 and _lies_apart(dead_letter_sink, sink) else None
            n = 0
            if n_spans > 0:
                n = _write_adjusted(spans, adjusted, list(adjusters), sink, batch_id, dead_letter_sink)
            if live:
                adjusted = adjusted.persist(StorageLevel.MEMORY_AND_DISK)
                for operator in live:
                    operator(adjusted, batch_id)
                adjusted.unpersist()
            if writing is not None:
                writing.result()
            elif n_dead > 0 and dead_letter_sink is not None:
                dead(d.dead_letters)
            elif n_dead > 0:
                log.warning("batch %d: %d malformed messages dropped, no dead-letter sink is set", batch_id, n_dead)
        return n
    finally:
        per_message.unpersist()


def _counts(per_message: DataFrame) -> tuple[int, int]:
    """Spans and dead letters (C3: skip empty writes); the one job that counts them also fills the cache.

    They are observed, as an aggregate would add a shuffle, with two more jobs, to each micro-batch.
    """
    seen = Observation(f"decoded_{time.monotonic_ns()}")
    spans = F.coalesce(F.sum(F.size(F.coalesce("spans", F.array()))), F.lit(0))
    per_message.observe(seen, spans.alias("spans"), F.count("reason").alias("dead")).write.format("noop").mode("overwrite").save()
    return seen.get["spans"], seen.get["dead"]


def _beside(spark: SparkSession) -> Callable[[Callable], Callable]:
    """Makes a function run in another thread as in this one, with the job group that a stopping query cancels."""
    inherit = inheritable_thread_target(spark)
    return inherit if callable(inherit) else lambda f: f  # where threads of Python and the JVM are not paired


def _lies_apart(dead_letters: SinkConfig | None, sink: SinkConfig) -> bool:
    """Whether dead letters may be written before the spans are: a batch that is replayed after a failure replaces its own folder of them."""
    return dead_letters is not None and dead_letters.kind in FILE_BACKENDS and dead_letters.path != sink.path


def _write_adjusted(
    spans: DataFrame, adjusted: DataFrame, adjusters: list[Adjuster], sink: SinkConfig, batch_id: int, dead_letter_sink: SinkConfig | None
) -> int:
    """Writes the adjusted batch; adjusters whose plans fail at run time are left out of it.

    Adjusters made by ``conditional`` and ``python_adjuster`` isolate single spans themselves; this is for any others.
    """
    write = functools.partial(write_spans, sink=sink, batch_id=batch_id, known_non_empty=True, rows_for_dead_letters=spans)
    try:
        return write(adjusted)
    except RuntimeError:
        kept = _runnable(spans, adjusters)
        if len(kept) == len(adjusters) and dead_letter_sink is None:
            raise
    return write(chain(kept)(spans), dead_letters=dead_letter_sink)


def _runnable(spans: DataFrame, adjusters: list[Adjuster]) -> list[Adjuster]:
    """The adjusters that run over ``spans``, each after those before it."""
    kept: list[Adjuster] = []
    for adjuster in adjusters:
        try:
            chain([*kept, adjuster])(spans).write.format("noop").mode("overwrite").save()
            kept.append(adjuster)
        except Exception as exc:  # noqa: BLE001 - isolation is the point
            log.warning("adjuster %r was left out of the batch: %s", adjuster, str(exc)[:500])
    return kept


def run_job(spark: SparkSession, config: JobConfig) -> StreamingQuery:
    """Build and start the query (idempotent per config: one query each)."""
    logging.getLogger("tracewright").setLevel(config.log_level.upper())
    for k, v in config.conf.items():
        spark.conf.set(k, v)
    if config.fail_fast:
        check_sink(spark, config.sink)
        if config.dead_letter_sink is not None:
            check_sink(spark, config.dead_letter_sink)
    ckpt = config.checkpoint_location
    if not ckpt and config.sink.kind != "console":
        # with a fresh checkpoint batch numbers begin at 0 again, and batches of an earlier run would be replaced
        raise ValueError("a job with a sink that lasts needs checkpoint_location")
    ckpt = ckpt or scratch_path(spark, "job-checkpoint")
    adjusters = list(config.adjusters)

    def consume(decoded: DataFrame, batch_id: int) -> None:
        process_decoded(decoded, batch_id, adjusters, config.sink, config.dead_letter_sink, config.span_filter, config.live)

    # decoding stands in the stream's own plan, which is analysed once and not for each batch
    writer = _per_message(config.source(spark)).writeStream.foreachBatch(consume).option("checkpointLocation", ckpt)
    if config.available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{int(config.batch_interval_ms)} milliseconds")
    return writer.start()


def run_to_completion(spark: SparkSession, config: JobConfig) -> StreamingQuery:
    """Start with ``availableNow`` and block until the backlog, whatever its size, is drained."""
    config.available_now = True
    q = run_job(spark, config)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


class StreamingJob:
    """``start`` is idempotent (a second call returns the running job),
    ``await_termination`` blocks while started, ``close`` stops the query.
    Usable as a context manager."""

    def __init__(self, spark: SparkSession, config: JobConfig):
        self.spark = spark
        self.config = config
        self.query: StreamingQuery | None = None

    def start(self) -> "StreamingJob":
        if self.query is None:
            self.query = run_job(self.spark, self.config)
        return self

    def await_termination(self, timeout_s: float | None = None) -> bool | None:
        if self.query is None:
            return None
        return self.query.awaitTermination(timeout_s) if timeout_s is not None else self.query.awaitTermination()

    def close(self) -> None:
        if self.query is not None and self.query.isActive:
            self.query.stop()

    def __enter__(self) -> "StreamingJob":
        return self.start()

    def __exit__(self, *exc) -> None:
        self.close()
