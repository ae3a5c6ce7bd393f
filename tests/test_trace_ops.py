"""Whole-trace operators and reports."""

from pyspark.sql import functions as F

from helpers import ann, df_of, rows, span, tag
from tracewright.operators import report as R
from tracewright.operators import trace as T

WEB = {"service_name": "web", "ipv4": "127.0.0.1", "port": None}
APP = {"service_name": "app", "ipv4": "127.0.0.1", "port": 8080}
T0 = 1_000_000


def _halves():
    client = span(trace_id=10, id=10, name="", annotations=[ann(T0 + 50_000, "cs", WEB), ann(T0 + 300_000, "cr", WEB)])
    server = span(trace_id=10, id=10, name="get", annotations=[ann(T0 + 100_000, "sr", APP), ann(T0 + 250_000, "ss", APP)])
    return client, server


def test_merge_client_and_server_halves(spark):
    out = rows(T.merge_by_id(df_of(spark, list(_halves()))))
    assert len(out) == 1
    assert out[0]["name"] == "get"
    assert [a["value"] for a in out[0]["annotations"]] == ["cs", "sr", "ss", "cr"]


def test_merge_is_order_and_partition_independent(spark):
    c, s = _halves()
    a = rows(T.merge_by_id(df_of(spark, [c, s, s]).repartition(3)))
    b = rows(T.merge_by_id(df_of(spark, [s, c]).coalesce(1)))
    assert a == b


def test_merge_recovers_fixture(spark):
    from tracewright.operators.flat import flat_spans
    from tracewright.sources.events import spans_table

    whole = flat_spans(spans_table(spark, "/root/testdata/sf0.001"))
    merged = flat_spans(T.merge_by_id(spans_table(spark, "/root/testdata/sf0.001", split_halves=True)))
    assert merged.exceptAll(whole).count() == 0 and whole.exceptAll(merged).count() == 0


def test_group_traces_summary(spark):
    df = df_of(
        spark,
        [
            span(trace_id=1, id=1, timestamp=100, duration=50, annotations=[ann(100, "sr", WEB)]),
            span(trace_id=1, id=2, parent_id=1, timestamp=120, duration=10, annotations=[ann(120, "sr", APP)],
                 tags=[tag("error", "true")]),
            span(trace_id=1, id=1, high=5, timestamp=1, duration=1),
        ],
    )
    got = {r["trace_key"]: r for r in rows(T.group_traces(df))}
    assert set(got) == {"0000000000000001", "00000000000000050000000000000001"}
    r = got["0000000000000001"]
    assert (r["n_spans"], r["n_roots"], r["first_timestamp"], r["last_end"]) == (2, 1, 100, 150)
    assert (r["n_error_spans"], r["n_services"]) == (1, 2)


def test_sample_keeps_whole_traces(spark):
    df = df_of(
        spark,
        [
            span(trace_id=1, id=1, duration=10),
            span(trace_id=1, id=2, duration=900),
            span(trace_id=2, id=1, duration=10),
            span(trace_id=3, id=1, duration=10, tags=[tag("error", "boom")]),
            span(trace_id=3, id=2),
        ],
    )
    kept = sorted((r["trace_id"], r["id"]) for r in T.sample_traces(df, 500).collect())
    assert kept == [(1, 1), (1, 2), (3, 1), (3, 2)]


def test_sessions_split_at_gap_exactly(spark):
    ts = [0, 5, 9, 19, 40, 45]  # gap 10: [0,5,9] [19] [40,45]; 19-9 = 10 opens a new one
    df = df_of(spark, [span(trace_id=1, id=i + 1, timestamp=t) for i, t in enumerate(ts)])
    got = sorted((r["session_start"], r["session_end"], r["n_spans"]) for r in T.trace_sessions(df, 10).collect())
    assert got == [(0, 19, 3), (19, 29, 1), (40, 55, 2)]


def test_sessions_match_session_window_on_fixture(spark):
    """Bucketed sessions == Spark's own session_window on the same data."""
    from tracewright.sources.events import spans_table

    gap = 1_800_000_000
    df = spans_table(spark, "/root/testdata/sf0.01").filter("timestamp IS NOT NULL")
    ours = T.trace_sessions(df, gap)
    ref = (
        df.withColumn("_ts", F.timestamp_micros("timestamp"))
        .groupBy("trace_id_high", "trace_id", F.session_window("_ts", "30 minutes").alias("s"))
        .agg(F.count(F.lit(1)).alias("n_spans"))
        .select(
            T.trace_key().alias("trace_key"),
            F.unix_micros("s.start").alias("session_start"),
            F.unix_micros("s.end").alias("session_end"),
            "n_spans",
        )
    )
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_dependency_links(spark):
    df = df_of(
        spark,
        [
            span(trace_id=1, id=1, annotations=[ann(1, "sr", WEB)]),
            span(trace_id=1, id=2, parent_id=1, annotations=[ann(2, "sr", APP)], tags=[tag("error", "x")]),
            span(trace_id=1, id=3, parent_id=1, annotations=[ann(3, "sr", APP)]),
            span(trace_id=2, id=1, parent_id=99, annotations=[ann(3, "sr", APP)]),  # parent missing
        ],
    )
    got = [(r["parent"], r["child"], r["call_count"], r["error_count"]) for r in R.dependency_links(df).collect()]
    assert got == [("web", "app", 2, 1)]


def test_latency_percentiles_exact_for_small_groups(spark):
    df = df_of(spark, [span(trace_id=1, id=i, timestamp=i, duration=d, annotations=[ann(i, "sr", WEB)])
                       for i, d in enumerate([1, 2, 3, 4, 10], start=1)])
    r = R.service_latency(df).collect()[0]
    assert (r["n_spans"], r["p50_duration"], r["p95_duration"], r["max_duration"]) == (5, 3, 10, 10)


def test_fixture_sanity_values(spark):
    """Counts recorded in FIXTURES.md for sf0.01."""
    from tracewright.operators.adjust import is_finagle
    from tracewright.sources.events import spans_table

    df = spans_table(spark, "/root/testdata/sf0.01")
    assert df.count() == 10_000
    assert df.select("trace_id_high", "trace_id").distinct().count() == 4_006
    assert df.filter("parent_id IS NULL").count() == 4_006
    assert df.filter(is_finagle()).count() == 3_334


def test_trace_context_lets_span_adjusters_see_the_trace(spark):
    from tracewright.operators.adjust import conditional, prune

    df = df_of(
        spark,
        [
            span(trace_id=1, id=1, timestamp=10, duration=5),
            span(trace_id=1, id=2, parent_id=1, timestamp=12, duration=1, tags=[tag("error", "x")]),
            span(trace_id=2, id=1, timestamp=20, duration=1, tags=[tag("user.email", "a@b.c")]),
        ],
    )
    ctx = T.with_trace_context(df)
    got = {(r["trace_id"], r["id"]): (r["trace_span_count"], r["trace_has_error"], r["trace_root_id"], r["trace_end"])
           for r in ctx.collect()}
    assert got == {(1, 1): (2, True, 1, 15), (1, 2): (2, True, 1, 15), (2, 1): (1, False, 1, 21)}
    # e.g. keep tags only in failed traces
    out = conditional(~F.col("trace_has_error"), lambda: {"binary_annotations": F.array()})(ctx)
    assert {r["trace_id"]: len(r["binary_annotations"]) for r in out.filter("id = 1").collect()} == {1: 0, 2: 0}
    assert prune(tag_keys=["x"])(df).count() == 3


def test_half_spans_from_spans_equals_derivation_from_events(spark):
    from tracewright.sources.events import half_spans_from_spans, spans_table

    direct = flat_spans_of(spans_table(spark, "/root/testdata/sf0.01", split_halves=True))
    derived = flat_spans_of(half_spans_from_spans(spans_table(spark, "/root/testdata/sf0.01")))
    assert direct.count() == derived.count() == 12_000
    assert direct.exceptAll(derived).count() == 0 and derived.exceptAll(direct).count() == 0


def flat_spans_of(df):
    from tracewright.operators.flat import flat_spans

    return flat_spans(df)
