"""Operators across micro-batches, whole-trace adjusters in user code, and isolation of what fails at run time."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import ann, df_of, rows, span, tag
from tracewright.functions.spans import has_error_tag
from tracewright.operators import adjust as A
from tracewright.operators.flat import flat_spans
from tracewright.operators.report import dependency_links, service_latency
from tracewright.operators.trace import sample_traces, trace_sessions
from tracewright.operators.whole_trace import TraceAdjuster, trace_adjuster
from tracewright.plans.live import _merge_facts, _raising, _trace_facts
from tracewright.schema import SPAN_COLUMNS, SPAN_SCHEMA
from tracewright.sources.files import span_stream
from tracewright.sources.fixtures import stored_spans
from tracewright.streaming.job import process_batch
from tracewright.streaming.live import BatchTables, LatencyReport, LiveLinks, LiveSessions, MergingLog, TailSampler, run_live
from tracewright.streaming.sinks import SinkConfig, read_sink

SF = "/root/testdata/sf0.001"


def batches(spans, n):
    return [spans.where(F.pmod("id", F.lit(n)) == k) for k in range(n)]


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 9])
def test_log_of_any_number_of_batches_is_merged(spark, tmp_dir, monkeypatch, n):
    monkeypatch.setattr(MergingLog, "STEP", 2)
    merge = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    log = MergingLog(BatchTables(spark, tmp_dir), "log", "k long, n long", merge)
    for b in range(n):
        for _ in range(2):  # each batch is replayed
            log.append(spark.createDataFrame([(0, 1), (b, 10)], "k long, n long"), b)
    want = {b: 10 for b in range(n)}
    want[0] += n
    assert {r.k: r.n for r in log.read(n - 1).collect()} == want


def test_live_report_and_links_equal_the_batch(spark, tmp_dir):
    spans = stored_spans(spark, SF)
    report, links = LatencyReport(spark, f"{tmp_dir}/r", 86_400_000_000), LiveLinks(spark, f"{tmp_dir}/l")
    for b, part in enumerate(batches(spans, 4)):
        for _ in range(1 + b % 2):  # some batches are replayed
            report(part, b)
            links(part, b)
    assert same(report.current(3), service_latency(spans))
    assert same(links.current(3), dependency_links(spans))


def test_calls_that_never_meet_leave_the_state(spark, tmp_dir):
    ep = {"service_name": "a", "ipv4": None, "port": None}
    links = LiveLinks(spark, tmp_dir, hold=2)
    child = df_of(spark, [span(id=2, parent_id=9, annotations=[ann(1, "sr", ep)])])
    none = df_of(spark, [])
    links(child, 0)
    links(none, 1)
    assert links.tables.before("calls", LiveLinks.CALLS, 2).count() == 1
    links(none, 2)
    assert links.tables.before("calls", LiveLinks.CALLS, 3).count() == 0
    assert links.tables.before("parents", LiveLinks.PARENTS, 3).count() == 0 and links.current(2).count() == 0


def test_live_sampling_equals_the_batch_and_drops_by_its_timer(spark, tmp_dir):
    spans = stored_spans(spark, SF)
    fits = lambda: (F.col("duration") >= 400_000) | has_error_tag()
    sampler = TailSampler(spark, tmp_dir, fits, hold=4)
    parts = batches(spans, 3)
    for b, part in enumerate(parts):
        sampler(part, b)
        sampler(part, b)  # replayed
    want = sample_traces(spans, 400_000)
    kept = sampler.tables.all("kept", SPAN_SCHEMA, 2).select(*SPAN_COLUMNS)
    assert same(flat_spans(kept), flat_spans(want))
    for b in range(3, 8):
        sampler(df_of(spark, []), b)
    dropped = sampler.tables.all("dropped", "n_spans long", 7).agg(F.sum("n_spans")).first()[0]
    assert dropped + kept.count() == spans.count()
    assert sampler.tables.before("held", TailSampler.HELD, 8).count() == 0


def test_live_sampling_of_a_late_decision(spark, tmp_dir):
    sampler = TailSampler(spark, tmp_dir, lambda: F.col("duration") > 10, hold=3)
    stream = [[span(id=1, duration=1), span(trace_id=2, id=5)], [span(id=2, duration=99)], [span(id=3)], [span(trace_id=2, id=6)]]
    for b, part in enumerate(stream):
        sampler(df_of(spark, part), b)
    kept = sampler.tables.all("kept", SPAN_SCHEMA, 3)
    assert sorted((r.batch_id, r.id) for r in kept.collect()) == [(1, 1), (1, 2), (2, 3)]
    assert sorted(r.id for r in sampler.tables.before("held", TailSampler.HELD, 4).collect()) == [5, 6]


def test_every_span_is_in_a_session_or_late(spark, tmp_dir):
    gap, hour = 1_800_000_000, 3_600_000_000
    spans = A.backfill_timestamp_duration(stored_spans(spark, SF))
    live = LiveSessions(spark, f"{tmp_dir}/a", gap, 10_000 * hour)  # nothing is late
    for b, part in enumerate(batches(spans, 3)):
        live(part, b)
        live(part, b)
    live(df_of(spark, [span(trace_id=99, id=1, timestamp=2**60)]), 3)  # time goes on, so all sessions end
    found = live.tables.all("sessions", LiveSessions.SESSIONS, 3).drop("batch_id")
    assert same(found, trace_sessions(spans, gap))
    assert live.tables.all("late", SPAN_SCHEMA, 3).count() == 0

    live = LiveSessions(spark, f"{tmp_dir}/b", 10, 100)
    stream = [[1000, None], [895, 889, 905, 2000], [1899, 1880]]
    for b, times in enumerate(stream):
        live(df_of(spark, [span(id=i, timestamp=t) for i, t in enumerate(times)]), b)
    late = sorted((r.batch_id, r.timestamp) for r in live.tables.all("late", SPAN_SCHEMA, 2).collect())
    assert late == [(1, 889), (2, 1880)]
    final = sorted((r.session_start or 0, r.session_end or 0, r.n_spans) for r in live.tables.all("sessions", LiveSessions.SESSIONS, 2).collect())
    still = live.tables.before("open", LiveSessions.BUCKETS, 3).agg(F.sum("_n")).first()[0]
    assert final[0] == (0, 0, 1) and sum(s[2] for s in final) + still + len(late) == sum(map(len, stream))


def test_job_gives_batches_to_live_operators(spark, tmp_dir):
    from tracewright.sources.messages import messages_table
    from tracewright.operators.decode import decode_messages

    messages = messages_table(spark, SF).select("value")
    report = LatencyReport(spark, f"{tmp_dir}/state", 86_400_000_000)
    sink, chain = SinkConfig("parquet", f"{tmp_dir}/out"), [A.finagle_adjuster()]
    process_batch(messages, 0, chain, sink, live=[report])
    process_batch(messages.limit(0), 1, chain, sink, live=[report])
    want = service_latency(A.chain(chain)(decode_messages(messages).spans))
    assert same(report.current(1), want)


# -- adjusters that fail at run time


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_column_adjuster_that_raises_leaves_single_spans(spark, parts):
    spans = stored_spans(spark, SF).repartition(parts)
    found = {r.id: (r.name, r.duration) for r in _raising(spans).collect()}
    for r in spans.collect():
        want = (r.name, r.duration) if r.id % 50 == 0 else (r.name.upper() + "2", r.duration and r.duration * 2)
        assert found[r.id] == want


def test_predicates_and_staged_columns_may_raise(spark):
    number = F.when(F.col("id") == 2, F.lit("x")).otherwise(F.lit("1")).cast("long")
    spans = df_of(spark, [span(id=i, duration=5) for i in range(1, 4)])
    update = lambda: {"name": F.lit("done")}
    names = lambda a: {r.id: r.name for r in a(spans).collect()}
    assert names(A.conditional(number == 1, update)) == {1: "done", 2: "", 3: "done"}
    staged = A.conditional(F.lit(True), lambda: {"name": F.concat(F.lit("n"), F.col("__n").cast("string"))}, lambda p: {"__n": number})
    assert names(staged) == {1: "n1", 2: "", 3: "n1"}
    assert staged(spans).columns == list(SPAN_COLUMNS)


def test_an_adjuster_that_cannot_run_is_left_out_of_the_batch(spark, tmp_dir):
    from tracewright.sources.messages import messages_table

    def broken(df):
        return df.withColumn("name", F.when(F.col("id") % 50 == 0, F.raise_error(F.lit("broken"))).otherwise(F.lit("new")).cast("string"))

    messages = messages_table(spark, SF).select("value")
    sinks = [SinkConfig("parquet", f"{tmp_dir}/{i}", max_attempts=1) for i in range(3)]
    n = process_batch(messages, 0, [A.finagle_adjuster(), broken, A.issue343_adjuster()], sinks[0], sinks[1])
    process_batch(messages, 0, [A.finagle_adjuster(), A.issue343_adjuster()], sinks[2])
    assert n > 0 and same(flat_spans(read_sink(spark, sinks[0])), flat_spans(read_sink(spark, sinks[2])))


# -- whole-trace adjusters


def test_whole_trace_adjuster_takes_slices_of_any_size(spark):
    import pyarrow as pa

    spans = df_of(spark, [span(trace_id=1, id=i) for i in range(400)] + [span(trace_id=t, id=1) for t in range(2, 50)])

    def check(part, facts):
        if part.num_rows > 64:
            raise AssertionError("a slice is larger than a batch")
        return part.set_column(4, part.schema.field(4), pa.array([str(facts[1])] * part.num_rows))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        out = trace_adjuster(TraceAdjuster(_trace_facts, _merge_facts, check))(spans.repartition(5))
        assert {(r.trace_id, r.id): r.name for r in out.collect()} == {(s["trace_id"], s["id"]): "400" if s["trace_id"] == 1 else "1" for s in rows(spans)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_user_code_that_raises_leaves_its_trace(spark):
    spans = df_of(spark, [span(trace_id=t, id=i) for t in range(1, 6) for i in range(1, 4)]).repartition(3)

    plain = span()

    def facts(part):
        if 1 in part["trace_id"].to_pylist():
            raise ValueError("no facts of this")
        return part["trace_id"][0].as_py(), part.num_rows

    def merge(a, b):
        if a[0] == 2:
            raise ValueError("cannot be merged")
        return a[0], a[1] + b[1]

    def adjust(part, f):
        if f[0] == 3:
            raise ValueError("cannot be adjusted")
        return part.slice(0, 0) if f[0] == 4 else part

    def finish(f):
        if f[0] == 3:
            return [{"nonsense": 1}]
        return [{**plain, "trace_id": f[0], "id": f[1] + 100, "name": "sum"}]

    out = trace_adjuster(TraceAdjuster(facts, merge, adjust, finish))(spans)
    found = sorted((r.trace_id, r.id) for r in out.collect())
    kept = [(t, i) for t in (1, 2, 3, 5) for i in range(1, 4)]
    merged = {(2, 101), (2, 102), (2, 103)}  # trace 2 needs no merge if its spans lie in one slice
    assert sorted(set(found) - merged) == sorted([*kept, (4, 103), (5, 103)])


def test_facts_of_no_spans(spark):
    adjuster = trace_adjuster(TraceAdjuster(_trace_facts, _merge_facts, lambda s, f: s, lambda f: []))
    assert adjuster(df_of(spark, [])).count() == 0
    tagged = df_of(spark, [span(id=1, tags=[tag("k", b"\xff\x00", kind="BYTES")])])
    assert rows(adjuster(tagged)) == rows(tagged)


def test_plans_read_spans_once(spark):
    """One scan each, and the backfill's fold is in the plan once."""
    spans = stored_spans(spark, SF)
    from tracewright.operators.report import latency_counts
    from tracewright.operators.trace import merge_by_id

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    for df in (merge_by_id(spans), trace_sessions(spans, 1000), dependency_links(spans)):
        assert plan(df).count("FileScan") == 1 and "Join" not in plan(df)
    counts = plan(latency_counts(A.backfill_timestamp_duration(spans)))
    assert counts.count("FileScan") == 1 and counts.count("aggregate(annotations") <= 2
    report = plan(service_latency(A.backfill_timestamp_duration(spans)))
    assert "aggregate(" not in report and report.count("FileScan") <= 3


def test_a_live_batch_is_written_and_read_by_many_tasks(spark, tmp_dir, monkeypatch):
    from tracewright.plans import live

    spans = df_of(spark, [span(id=i) for i in range(1, 61)]).repartition(4)
    monkeypatch.setattr(live, "_spans", lambda spark, sf_dir: spans)
    seen = {}

    def operator():
        made = len(made_in)
        made_in.append(made)
        return lambda batch, number: seen.update({number: (made, batch.rdd.getNumPartitions(), sorted(r.id for r in batch.select("id").collect()))})

    made_in = []
    live._in_three_batches(spark, "", tmp_dir, operator)
    assert made_in == [0, 1, 2]
    for k in range(3):
        made, tasks, ids = seen[k]
        assert made == k and tasks > 1 and ids == [i for i in range(1, 61) if i % 3 == k]


def test_a_live_batch_is_read_by_columns_and_not_from_memory(spark, tmp_dir):
    """A cached batch is read whole by as many tasks as there are cached partitions, however large they are."""
    df_of(spark, [span(id=i, name=f"n{i}") for i in range(1, 61)]).coalesce(1).write.parquet(f"{tmp_dir}/in")
    spark.catalog.clearCache()
    seen = []

    def operator(batch, number):
        ids = batch.select("id")
        plan = ids._jdf.queryExecution().executedPlan().toString()
        seen.append((number, sorted(r.id for r in ids.collect()), plan, len(spark.sparkContext._jsc.sc().getRDDStorageInfo()), batch.inputFiles()))

    def failing(batch, number):
        seen.append(batch.inputFiles())
        raise ValueError("no")

    run_live(span_stream(spark, f"{tmp_dir}/in"), [operator, operator], f"{tmp_dir}/checkpoint", available_now=True).awaitTermination()
    for number, ids, plan, cached, files in seen:
        assert number == 0 and ids == list(range(1, 61))
        assert cached == 0 and "InMemoryTableScan" not in plan and "ReadSchema: struct<id:bigint>" in plan
        assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)  # gone after the batch
    assert len(seen) == 2
    with pytest.raises(StreamingQueryException):
        run_live(span_stream(spark, f"{tmp_dir}/in"), [failing], f"{tmp_dir}/checkpoint-2", available_now=True).awaitTermination()
    assert seen[-1] and not any(os.path.exists(f.removeprefix("file://")) for f in seen[-1])
