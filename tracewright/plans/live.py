"""Named queries of sinks and of live streams; they join those of the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.functions.spans import has_error_tag
from tracewright.operators import adjust as A
from tracewright.operators import decode as D
from tracewright.operators.flat import flat_spans
from tracewright.operators.whole_trace import TraceAdjuster, trace_adjuster
from tracewright.plans import oracle as O
from tracewright.plans.catalog import DAY, EVER, ORACLE, SAMPLE_MIN_DURATION, SESSION_GAP, _spans, query
from tracewright.schema import SPAN_COLUMNS, SPAN_SCHEMA
from tracewright.session import scratch_path
from tracewright.sources.files import span_stream
from tracewright.sources.fixtures import stored_messages
from tracewright.sources.framed import segment_stream, write_segments
from tracewright.sources.shared import Records
from tracewright.streaming import connections, layouts
from tracewright.streaming.job import JobConfig, StreamingJob, process_batch
from tracewright.streaming.live import LatencyReport, LiveLinks, LiveSessions, TailSampler, run_live
from tracewright.streaming.sinks import SinkConfig, check_sink, read_dead_letters, read_sink, write_spans

FILE_STORE = "tracewright.streaming.connections:FileStore"
HALFWAY_STORE = "tracewright.streaming.connections:HalfwayStore"


# ---------------------------------------------------------------- sinks -----
@query("sink_custom", O.with_spans() + O.flat_select("spans"))
def sink_custom(spark, sf_dir):
    """Spans written through connections of user code, one a task, and committed together."""
    sink = SinkConfig("connections", options={"store": FILE_STORE, "path": scratch_path(spark, "store")})
    check_sink(spark, sink)
    write_spans(_spans(spark, sf_dir), sink, batch_id=0)
    write_spans(_spans(spark, sf_dir), sink, batch_id=0)  # a batch that is replayed
    return flat_spans(connections.read_store(spark, sink.options["path"], SPAN_SCHEMA))


@query("sink_replay", O.with_spans() + "SELECT *, 1 AS n_written FROM (" + O.flat_select("spans") + ")")
def sink_replay(spark, sf_dir):
    """C2 + C4: a sink that can only append fails half-way and the batch is replayed; each span is in it once."""
    root = scratch_path(spark, "replay")
    options = {"store": HALFWAY_STORE, "path": f"{root}/store", "mended": f"{root}/marks/mended.json"}
    sink = SinkConfig("connections", options=options, ledger=f"{root}/ledger", max_attempts=1)
    batch = _spans(spark, sf_dir).repartition(8)
    try:
        write_spans(batch, sink, batch_id=0)
        raise AssertionError("the first attempt was to fail")
    except RuntimeError:
        Records(f"{root}/marks").add("mended", {})
    write_spans(batch, sink, batch_id=0)
    again = write_spans(batch, sink, batch_id=0)  # rows that a third attempt appends: none
    held = connections.store_of(options).read(spark, SPAN_SCHEMA)
    copies = held.groupBy("trace_id_high", "trace_id", "id").agg((F.count(F.lit(1)) + again).cast("int").alias("n_written"))
    return flat_spans(held).join(copies, ["trace_id_high", "trace_id", "id"])


_DECODED = "(SELECT * FROM spans WHERE (_user_id + _day) % 20 NOT IN (0, 1, 2))"


@query("dead_letter_replay", O.with_spans("adj AS (" + O.backfill_select(_DECODED, O.FINAGLE_PRED) + ")") + O.flat_select("adj"))
def dead_letter_replay(spark, sf_dir):
    """C4: spans of a failed write lie among the dead letters as messages; the same job reads them and writes them elsewhere."""
    root = scratch_path(spark, "dead-replay")
    dead, good = SinkConfig("parquet", f"{root}/dead"), SinkConfig("parquet", f"{root}/spans")
    # no driver answers this address, so each write fails at once
    failing = SinkConfig("jdbc", options={"url": "jdbc:none:", "dbtable": "spans"}, max_attempts=1)
    chain = [A.finagle_adjuster()]
    process_batch(stored_messages(spark, sf_dir).select("value"), 0, chain, failing, dead)
    process_batch(read_dead_letters(spark, dead, "write_failed").select("value"), 0, chain, good)
    return flat_spans(spark.read.schema(SPAN_SCHEMA).parquet(good.path).select(*SPAN_COLUMNS))


LOOKUP_SERVICE, LOOKUP_NAME, LOOKUP_MIN = "svc-2", "click", 20_000


@query(
    "layout_lookup",
    O.with_spans(
        f"""fit AS (SELECT * FROM spans WHERE len(list_filter(list_concat(list_transform(annotations, lambda a: a.endpoint.service_name),
    list_transform(binary_annotations, lambda t: t.endpoint.service_name)), lambda s: s = '{LOOKUP_SERVICE}')) > 0)""",
        f"""named AS (SELECT trace_id_high, trace_id FROM fit WHERE name = '{LOOKUP_NAME}' GROUP BY ALL HAVING max(duration) >= {LOOKUP_MIN})""",
        """hit AS (SELECT trace_id_high, trace_id FROM fit WHERE len(list_filter(binary_annotations,
    lambda t: t.type = 'STRING' AND t.key = 'key' AND t.value = 'Hit')) > 0 GROUP BY ALL HAVING max(duration) >= """
        + f"{LOOKUP_MIN})",
        "found AS (SELECT * FROM named INTERSECT SELECT * FROM hit)",
        "whole AS (SELECT spans.* FROM spans SEMI JOIN found USING (trace_id_high, trace_id))",
    )
    + O.flat_select("whole"),
)
def layout_lookup(spark, sf_dir):
    """Spans written as related tables in two batches; traces are found by the index tables and read whole."""
    root = scratch_path(spark, "layout")
    spans = _spans(spark, sf_dir)
    half = F.col("trace_id") % 2 == 0
    layouts.write_layout(spans.where(half), root, 0)
    layouts.write_layout(spans.where(~half), root, 1)
    layouts.write_layout(spans.where(~half), root, 1)  # a batch that is replayed
    traces = layouts.find_traces(spark, root, LOOKUP_SERVICE, LOOKUP_NAME, {"key": "Hit"}, min_duration=LOOKUP_MIN)
    return flat_spans(layouts.spans_of(spark, root, traces).select(*SPAN_COLUMNS))


# -------------------------------------------------------------- sources -----
@query("framed_stream", O.with_spans("adj AS (" + O.backfill_select(_DECODED, O.FINAGLE_PRED) + ")") + O.flat_select("adj"))
def framed_stream(spark, sf_dir):
    """S1 + S5 + C1: message segments as a stream in micro-batches of limited size, stopped and started again, new segments coming."""
    root = scratch_path(spark, "framed")
    messages = stored_messages(spark, sf_dir).select("value")
    first = F.pmod(F.xxhash64("value"), F.lit(3)) > 0
    sink = SinkConfig("parquet", f"{root}/out")

    def job():
        source = lambda s: segment_stream(s, f"{root}/in", 4 << 20, f"{root}/progress")
        cfg = JobConfig(source, sink, [A.finagle_adjuster()], SinkConfig("parquet", f"{root}/dead"), batch_interval_ms=0, checkpoint_location=f"{root}/checkpoint")
        with StreamingJob(spark, cfg) as running:
            running.query.processAllAvailable()

    write_segments(messages.where(first), f"{root}/in", 1 << 20)
    job()
    write_segments(messages.where(~first), f"{root}/in", 1 << 20)
    job()
    job()  # nothing new
    return flat_spans(read_sink(spark, sink).select(*SPAN_COLUMNS))


# ------------------------------------------------------------ adjusters -----
def _raising(df):
    """A column adjuster: doubles durations and raises an error for spans whose id is divisible by 50."""
    number = F.when(F.col("id") % 50 == 0, F.lit("x")).otherwise(F.lit("2")).cast("bigint")
    updates = lambda: {"duration": F.try_multiply(F.col("duration"), number), "name": F.concat(F.upper("name"), number.cast("string"))}
    return A.conditional(F.lit(True), updates)(df)


@query(
    "column_adjuster_failure",
    O.with_spans(
        "a1 AS (" + O.backfill_select("spans", O.FINAGLE_PRED) + ")",
        "a2 AS (SELECT * REPLACE (CASE WHEN id % 50 = 0 THEN duration ELSE duration * 2 END AS duration,"
        " CASE WHEN id % 50 = 0 THEN name ELSE upper(name) || '2' END AS name) FROM a1)",
        "a3 AS (" + O.issue343_select("a2") + ")",
    )
    + O.flat_select("a3"),
)
def column_adjuster_failure(spark, sf_dir):
    """A column adjuster that raises for one span in fifty leaves just those as they were; the chain goes on."""
    return flat_spans(A.chain([A.finagle_adjuster(), _raising, A.issue343_adjuster()])(_spans(spark, sf_dir)))


def _trace_facts(spans):
    """Number of spans, smallest id of a root, first start and last end of a slice."""
    import pyarrow.compute as pc

    ends = pc.max(pc.add(spans["timestamp"], spans["duration"])).as_py()
    roots = spans.filter(pc.is_null(spans["parent_id"]))
    ids = (spans["trace_id_high"][0].as_py(), spans["trace_id"][0].as_py())
    return ids, spans.num_rows, pc.min(roots["id"]).as_py(), pc.min(spans["timestamp"]).as_py(), ends


def _merge_facts(a, b):
    def of(pick, x, y):
        there = [v for v in (x, y) if v is not None]
        return pick(there) if there else None

    return a[0], a[1] + b[1], of(min, a[2], b[2]), of(min, a[3], b[3]), of(max, a[4], b[4])


def _adjust_slice(spans, facts):
    """In traces of more than two spans: no span named "view", and every other is named after the number of spans."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if facts[1] <= 2:
        return spans
    spans = spans.filter(pc.not_equal(spans["name"], "view"))
    names = pc.binary_join_element_wise(spans["name"], pa.scalar(str(facts[1])), "/")
    return spans.set_column(spans.schema.get_field_index("name"), spans.schema.field("name"), names)


def _summary_span(facts):
    """One span that covers the trace, if its times are known."""
    (high, low), n, root, first, last = facts
    if n <= 2 or first is None or last is None:
        return []
    return [
        {
            "trace_id_high": high, "trace_id": low, "id": -1, "parent_id": root, "name": "summary", "timestamp": first,
            "duration": last - first, "annotations": [], "binary_annotations": [],
        }
    ]


#: The trace that a third of all spans are moved to.
HOT_TRACE = 7


@query(
    "trace_adjust",
    O.with_spans(
        f"hot AS (SELECT * REPLACE (CASE WHEN id % 3 = 0 THEN 0 ELSE trace_id_high END AS trace_id_high, CASE WHEN id % 3 = 0 THEN {HOT_TRACE} ELSE trace_id END AS trace_id) FROM spans)",
        """facts AS (SELECT trace_id_high, trace_id, count(*) AS n, min(CASE WHEN parent_id IS NULL THEN id END) AS root,
    min(timestamp) AS first, max(timestamp + duration) AS last FROM hot GROUP BY ALL)""",
        """out AS (
  SELECT h.trace_id_high, h.trace_id, h.id, h.parent_id, CASE WHEN f.n > 2 THEN h.name || '/' || f.n ELSE h.name END AS name,
    h.timestamp, h.duration, h.annotations, h.binary_annotations
  FROM hot h JOIN facts f USING (trace_id_high, trace_id) WHERE f.n <= 2 OR h.name <> 'view'
  UNION ALL
  SELECT trace_id_high, trace_id, -1, root, 'summary', first, last - first, [], []
  FROM facts WHERE n > 2 AND first IS NOT NULL AND last IS NOT NULL)""",
    )
    + O.flat_select("out"),
)
def trace_adjust(spark, sf_dir):
    """A4: user code that drops, rewrites and adds spans by the whole trace; one trace holds a third of all spans."""
    hot = F.col("id") % 3 == 0
    moved = {"trace_id_high": F.when(hot, F.lit(0)).otherwise(F.col("trace_id_high")), "trace_id": F.when(hot, F.lit(HOT_TRACE)).otherwise(F.col("trace_id"))}
    user = TraceAdjuster(_trace_facts, _merge_facts, _adjust_slice, _summary_span)
    return flat_spans(trace_adjuster(user, "summary")(_spans(spark, sf_dir).withColumns(moved)))


# --------------------------------------------------------- live streams -----
def _drain(spark, root: str, operators) -> None:
    """Runs live operators over the files that are new since the last time, as one batch."""
    q = run_live(span_stream(spark, f"{root}/in"), operators, f"{root}/checkpoint", available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _in_three_batches(spark, sf_dir, root: str, operator):
    """The span table through a stream in three batches by ``id % 3``, so that a trace is split over them; the last operator.

    Each third is written by as many tasks as read the table. The stream is stopped after each batch and started again
    with an operator that ``operator`` makes anew, so all that goes on from batch to batch is in its tables.
    """
    for k in range(3):
        _spans(spark, sf_dir).where(F.col("id") % 3 == k).write.mode("append").parquet(f"{root}/in")
        last = operator()
        _drain(spark, root, [last])
    return last


@query("live_latency", ORACLE["latency_overall"].replace(str(EVER), str(DAY)))
def live_latency(spark, sf_dir):
    """The latency report of a live stream after three batches, with a restart after each of them."""
    root = scratch_path(spark, "live-latency")
    return _in_three_batches(spark, sf_dir, root, lambda: LatencyReport(spark, f"{root}/state", DAY)).current(2)


@query("live_links", ORACLE["dependency_links"])
def live_links(spark, sf_dir):
    """Callers and calls of a live stream that come in different batches; the counts are those of the whole table."""
    root = scratch_path(spark, "live-links")
    return _in_three_batches(spark, sf_dir, root, lambda: LiveLinks(spark, f"{root}/state")).current(2)


@query("live_sampling", ORACLE["sample_traces"])
def live_sampling(spark, sf_dir):
    """Traces split over three batches are kept whole if a span of any batch is slow or has an error."""
    root = scratch_path(spark, "live-sampling")
    fits = lambda: (F.col("duration") >= SAMPLE_MIN_DURATION) | has_error_tag()
    sampler = _in_three_batches(spark, sf_dir, root, lambda: TailSampler(spark, f"{root}/state", fits))
    return flat_spans(sampler.tables.all("kept", SPAN_SCHEMA, 2).select(*SPAN_COLUMNS))


LIVE_DELAY = 5 * DAY


@query(
    "live_sessions",
    O.with_spans(
        "marks AS (SELECT id % 3 AS batch, max(timestamp) AS latest FROM spans GROUP BY 1)",
        f"x AS (SELECT spans.*, id % 3 AS batch, (SELECT max(latest) FROM marks WHERE marks.batch < id % 3) - {LIVE_DELAY} AS mark FROM spans)",
        f"y AS (SELECT batch, coalesce(timestamp + {SESSION_GAP} <= mark, FALSE) AS late FROM x)",
    )
    + """SELECT 'late' AS kind, CAST(batch AS INTEGER) AS batch_id, count(*) AS n_spans FROM y WHERE late GROUP BY ALL
UNION ALL SELECT 'in sessions', NULL, count(*) FROM y WHERE NOT late""",
)
def live_sessions(spark, sf_dir):
    """Sessions of a live stream behind a watermark; spans behind it lie apart, and every span is in one or the other."""
    root = scratch_path(spark, "live-sessions")
    sessions = _in_three_batches(spark, sf_dir, root, lambda: LiveSessions(spark, f"{root}/state", SESSION_GAP, LIVE_DELAY))
    tables = sessions.tables
    late = tables.all("late", SPAN_SCHEMA, 2).groupBy(F.lit("late").alias("kind"), "batch_id").agg(F.count(F.lit(1)).alias("n_spans"))
    still = tables.before("open", LiveSessions.BUCKETS, 3).select(F.col("_n").alias("n_spans"))
    final = tables.all("sessions", LiveSessions.SESSIONS, 2).select("n_spans")
    held = final.union(still).agg(F.sum("n_spans").alias("n_spans"))
    return late.unionByName(held.select(F.lit("in sessions").alias("kind"), F.lit(None).cast("int").alias("batch_id"), "n_spans"))
