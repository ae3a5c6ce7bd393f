"""Operators over a live stream that go across micro-batches.

What an operator knows after batch ``n`` is a table of its own, written before
the batch counts as done, and batch ``n`` starts from the table of batch
``n - 1``. A batch that is replayed finds the same table and writes the same
results again, so a restart adds and loses nothing. State is a table like any
other: a trace that holds a third of all spans is rows in many partitions, never
one value. What grows without end (counts) is kept as a log whose older parts
are merged; what waits for more spans leaves after a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tracewright.functions.ids import trace_key
from tracewright.functions.spans import has_error_tag, span_service
from tracewright.operators.report import latency_counts, latency_of, merged_counts
from tracewright.schema import SPAN_SCHEMA, TRACE_COLS
from tracewright.session import held, remove, stored
from tracewright.sources.shared import Records

#: An operator takes the spans of a micro-batch and its number; numbers have no gaps.
LiveOperator = Callable[[DataFrame, int], None]

TRACE_TYPE = T.StructType([SPAN_SCHEMA[c] for c in TRACE_COLS])


class BatchTables:
    """Tables with one version for each micro-batch, below a folder that outlives the job."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str, batch: int) -> str:
        return f"{self.root}/{name}/batch_id={batch}"

    def write(self, name: str, df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(self.path(name, batch))

    def before(self, name: str, schema: T.StructType | str, batch: int) -> DataFrame:
        """The version that the batch before left; an empty table for the first."""
        if batch == 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(name, batch - 1))

    def all(self, name: str, schema: T.StructType | str, upto: int) -> DataFrame:
        """The rows of all versions up to batch ``upto``, with their ``batch_id``."""
        if upto < 0:
            return self.spark.createDataFrame([], schema).withColumn("batch_id", F.lit(0))
        found = self.spark.read.option("basePath", f"{self.root}/{name}").schema(schema).parquet(f"{self.root}/{name}")
        return found.where(F.col("batch_id") <= upto)

    def forget(self, name: str, batch: int) -> None:
        """Takes away the version before the one that a replay of ``batch`` needs."""
        remove(self.spark, self.path(name, batch - 2))


class MergingLog:
    """Rows of all batches that may be merged, such as counts, read from few tables.

    Each batch adds a table; whenever ``STEP`` tables of a level are whole, they are merged to one of the next. The rows
    of ``n`` batches are read from less than ``STEP`` tables for each level, and levels grow with the logarithm of ``n``.
    """

    STEP = 16

    def __init__(self, tables: BatchTables, name: str, schema: str, merge: Callable[[DataFrame], DataFrame]):
        self.tables, self.name, self.schema, self.merge = tables, name, schema, merge

    def _path(self, level: int, number: int) -> str:
        return f"{self.tables.root}/{self.name}/level={level}/part={number}"

    def _read(self, paths: list[str]) -> DataFrame:
        spark = self.tables.spark
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def append(self, df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(self._path(0, batch))
        level, done = 0, batch + 1
        while done % self.STEP == 0:
            done //= self.STEP
            parts = [self._path(level, done * self.STEP - 1 - i) for i in range(self.STEP)]
            level += 1
            self.merge(self._read(parts)).write.mode("overwrite").parquet(self._path(level, done - 1))

    def read(self, batch: int) -> DataFrame:
        """Merged rows of all batches up to ``batch``."""
        paths, left, level = [], batch + 1, 0
        while left:
            whole = left // self.STEP * self.STEP
            paths += [self._path(level, i) for i in range(whole, left)]
            left, level = left // self.STEP, level + 1
        return self.merge(self._read(paths))


# -------------------------------------------------------------- reports -----
class LatencyReport:
    """C9 on a live stream: exact latency by service and time bucket, for the groups that a batch has touched.

    ``report`` has their new rows; :meth:`current` has the newest row of every group. Counts by duration are kept, so the
    percentiles are those of all spans so far.
    """

    COUNTS = "service string, bucket long, duration long, n long"
    REPORT = (
        "service string, bucket long, n_spans long, n_untimed long, sum_duration long, min_duration long,"
        " max_duration long, p50_duration long, p95_duration long"
    )

    def __init__(self, spark: SparkSession, root: str, bucket_micros: int):
        self.tables, self.bucket = BatchTables(spark, root), bucket_micros
        self.counts = MergingLog(self.tables, "counts", self.COUNTS, merged_counts)

    def __call__(self, spans: DataFrame, batch: int) -> None:
        self.counts.append(latency_counts(spans, self.bucket), batch)
        new = self.tables.spark.read.schema(self.COUNTS).parquet(self.counts._path(0, batch))
        touched = new.select("service", "bucket").distinct().alias("t")
        same = [F.col(f"c.{k}").eqNullSafe(F.col(f"t.{k}")) for k in ("service", "bucket")]
        counts = stored(self.counts.read(batch).alias("c").join(touched, same, "left_semi"), "live-counts")
        self.tables.write("report", latency_of(counts), batch)

    def current(self, upto: int) -> DataFrame:
        rows = self.tables.all("report", self.REPORT, upto)
        group = ["service", "bucket"]
        values = [c for c in rows.columns if c not in (*group, "batch_id")]
        newest = F.max_by(F.struct(*values), "batch_id").alias("newest")
        return rows.groupBy(*group).agg(newest).select(*group, "newest.*")


class LiveLinks:
    """C10 on a live stream: calls are counted when a call and its caller have both come, in whatever batches.

    Callers and calls that have not met wait for ``hold`` batches after their last span. A caller has the smallest
    service of the spans seen under its id.
    """

    PARENTS = "trace_id_high long, trace_id long, key long, svc string, seen int"
    CALLS = "trace_id_high long, trace_id long, key long, svc string, calls long, errs long, seen int"
    LINKS = "parent string, child string, call_count long, error_count long"

    def __init__(self, spark: SparkSession, root: str, hold: int = 360):
        self.tables, self.hold = BatchTables(spark, root), hold
        total = [F.sum(c).alias(c) for c in ("call_count", "error_count")]
        self.links = MergingLog(self.tables, "links", self.LINKS, lambda df: df.groupBy("parent", "child").agg(*total))

    def __call__(self, spans: DataFrame, batch: int) -> None:
        key = [*TRACE_COLS, "key"]
        seen = F.max("seen").alias("seen")
        here = spans.select(*TRACE_COLS, "id", "parent_id", span_service().alias("svc"), has_error_tag().cast("long").alias("errs"))
        here = here.withColumns({"seen": F.lit(batch), "calls": F.lit(1).cast("long")})
        own = here.withColumn("key", F.col("id")).select(*key, "svc", "seen")
        called = here.where(F.col("parent_id").isNotNull()).withColumn("key", F.col("parent_id")).select(*key, "svc", "calls", "errs", "seen")
        young = F.col("seen") > batch - self.hold
        parents = own.unionByName(self.tables.before("parents", self.PARENTS, batch)).groupBy(*key).agg(F.min("svc").alias("svc"), seen)
        self.tables.write("parents", parents.where(young).select(*key, "svc", "seen"), batch)
        known = self.tables.spark.read.schema(self.PARENTS).parquet(self.tables.path("parents", batch))
        known = known.select(*key, F.col("svc").alias("parent"), F.lit(True).alias("met"))
        calls = called.unionByName(self.tables.before("calls", self.CALLS, batch)).groupBy(*key, "svc")
        calls = calls.agg(F.sum("calls").alias("calls"), F.sum("errs").alias("errs"), seen)
        both = stored(calls.join(known, key, "left"), "live-calls")
        counts = [F.sum("calls").alias("call_count"), F.sum("errs").alias("error_count")]
        self.links.append(both.where("met").groupBy("parent", F.col("svc").alias("child")).agg(*counts), batch)
        waiting = both.where(F.col("met").isNull() & young).select(*key, "svc", "calls", "errs", "seen")
        self.tables.write("calls", waiting, batch)
        for name in ("parents", "calls"):
            self.tables.forget(name, batch)

    def current(self, upto: int) -> DataFrame:
        return self.links.read(upto)


# ------------------------------------------------------------- sessions -----
class LiveSessions:
    """G3 on a live stream: sessions of each trace, with every span accounted for.

    The watermark of a batch is the latest time that batches before it have seen, less ``delay``. A session is final once
    it ends by the next watermark. A span whose own session would have ended by the watermark of its batch is late and
    goes to ``late``; all others are in ``sessions`` or still in ``open``. Spans without a time are final at once.
    """

    BUCKETS = "trace_id_high long, trace_id long, _bucket long, _min long, _max long, _n long"
    SESSIONS = "trace_key string, session_start long, session_end long, n_spans long"

    def __init__(self, spark: SparkSession, root: str, gap_micros: int, delay_micros: int):
        self.tables, self.gap, self.delay = BatchTables(spark, root), gap_micros, delay_micros
        self.watermarks = Records(f"{self.tables.root}/watermarks")

    def _watermark(self, batch: int) -> int | None:
        """Of a batch: left by the one before it."""
        return None if batch == 0 else self.watermarks.get(str(batch - 1))["next"]

    def __call__(self, spans: DataFrame, batch: int) -> None:
        gap, mark = self.gap, self._watermark(batch)
        late = F.lit(False) if mark is None else F.coalesce(F.col("timestamp") <= mark - gap, F.lit(False))
        self.tables.write("late", spans.where(late), batch)
        number = F.expr(f"timestamp div {gap}L - if(timestamp < 0 and timestamp % {gap}L <> 0, 1, 0)")
        new = spans.where(~late).select(*TRACE_COLS, number.alias("_bucket"), F.col("timestamp").alias("_min"), F.col("timestamp").alias("_max"), F.lit(1).cast("long").alias("_n"))
        rows = new.unionByName(self.tables.before("open", self.BUCKETS, batch)).groupBy(*TRACE_COLS, "_bucket")
        rows = rows.agg(F.min("_min").alias("_min"), F.max("_max").alias("_max"), F.sum("_n").alias("_n"))
        order = Window.partitionBy(*TRACE_COLS).orderBy("_bucket")
        away = F.coalesce(F.try_subtract("_min", F.lag("_max").over(order)) >= gap, F.lit(True))
        rows = rows.withColumn("_new", F.when(away, 1).otherwise(0))
        rows = rows.withColumn("_sid", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        rows = rows.withColumn("_last", F.max("_max").over(Window.partitionBy(*TRACE_COLS, "_sid")))
        rows = stored(rows, "live-sessions")
        latest = spans.agg(F.max("timestamp")).first()[0]
        marks = [m for m in (mark, None if latest is None else latest - self.delay) if m is not None]
        after = max(marks) if marks else None
        final = F.col("_last").isNull() | (F.lit(False) if after is None else F.col("_last") <= after - gap)
        done = rows.where(final).groupBy(*TRACE_COLS, "_sid").agg(
            F.min("_min").alias("session_start"), F.try_add(F.max("_max"), F.lit(gap).cast("long")).alias("session_end"), F.sum("_n").alias("n_spans")
        )
        self.tables.write("sessions", done.select(trace_key().alias("trace_key"), "session_start", "session_end", "n_spans"), batch)
        self.tables.write("open", rows.where(~final).select(*TRACE_COLS, "_bucket", "_min", "_max", "_n"), batch)
        self.tables.forget("open", batch)
        self.watermarks.add(str(batch), {"next": after})


# ------------------------------------------------------------- sampling -----
class TailSampler:
    """A16 on a live stream: whole traces are kept or dropped, also if their spans come in several batches.

    A trace is kept once a span fits ``keep``: what was held of it and what still comes goes to ``kept``. A trace without
    such a span is held for ``hold`` batches after its last span and then dropped; ``dropped`` counts its spans.
    """

    HELD = T.StructType([*SPAN_SCHEMA.fields, T.StructField("arrived", T.IntegerType())])
    TRACES = "trace_id_high long, trace_id long, seen int"

    def __init__(self, spark: SparkSession, root: str, keep: Callable[[], Column], hold: int = 30):
        self.tables, self.keep, self.hold = BatchTables(spark, root), keep, hold

    def __call__(self, spans: DataFrame, batch: int) -> None:
        trace, tables = list(TRACE_COLS), self.tables
        new = spans.withColumn("arrived", F.lit(batch))
        fits = F.coalesce(self.keep(), F.lit(False))
        here = new.groupBy(*trace).agg(F.max(fits).alias("fits"), F.lit(batch).alias("seen"))
        known = tables.before("traces", self.TRACES, batch).withColumn("fits", F.lit(True))
        decided = here.unionByName(known).groupBy(*trace).agg(F.max("fits").alias("fits"), F.max("seen").alias("seen"))
        young = F.col("seen") > batch - self.hold
        tables.write("traces", decided.where(F.col("fits") & young).select(*trace, "seen"), batch)
        kept = tables.spark.read.schema(self.TRACES).parquet(tables.path("traces", batch)).select(*trace)
        waiting = stored(new.unionByName(tables.before("held", self.HELD, batch)), "live-held")
        tables.write("kept", waiting.join(kept, trace, "left_semi").drop("arrived"), batch)
        rest = waiting.join(kept, trace, "left_anti")
        last = rest.groupBy(*trace).agg(F.max("arrived").alias("last"), F.count(F.lit(1)).alias("n_spans"))
        last = stored(last.withColumn("old", F.col("last") <= batch - self.hold), "live-last")
        tables.write("dropped", last.where("old").select(*trace, "n_spans"), batch)
        tables.write("held", rest.join(last.where("not old").select(*trace), trace, "left_semi"), batch)
        for name in ("traces", "held"):
            tables.forget(name, batch)


# ------------------------------------------------------------------ run -----
def run_live(spans: DataFrame, operators: Sequence[LiveOperator], checkpoint: str, available_now: bool = False, interval_ms: int = 10_000) -> StreamingQuery:
    """Starts a query that gives each micro-batch of a stream of spans to all ``operators``, which read it while they run."""

    def consume(batch: DataFrame, number: int) -> None:
        with held(batch, "live-batch") as stored_batch:
            for operator in operators:
                operator(stored_batch, number)

    writer = spans.writeStream.foreachBatch(consume).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{interval_ms} milliseconds")
    return writer.start()
