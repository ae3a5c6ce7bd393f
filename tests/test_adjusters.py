"""The reference's adjuster tests re-expressed as rows, plus properties."""

import pytest
from pyspark.sql import functions as F

from helpers import EP, ann, df_of, finagle_server_span, rows, span, tag
from tracewright.operators import adjust as A


def test_identity_adjuster_passes_everything(spark):
    spans = [span(id=i, name="get") for i in range(1, 4)]
    df = df_of(spark, spans)
    assert rows(A.identity(df)) == rows(df)


def test_chain_of_identities_is_identity(spark):
    df = df_of(spark, [finagle_server_span(), span(id=5)])
    assert rows(A.chain([A.identity, A.identity, A.identity])(df)) == rows(df)


def test_default_should_adjust_false_means_unchanged(spark):
    df = df_of(spark, [span(id=1), span(id=2, name="get")])
    out = A.conditional(F.lit(None).cast("boolean"), lambda: {"name": F.lit("changed")})(df)
    assert rows(out) == rows(df)


def test_finagle_adjuster_backfills_timestamp_and_duration(spark):
    out = rows(A.finagle_adjuster()(df_of(spark, [finagle_server_span()])))
    assert out[0]["timestamp"] == 1442493420635000
    assert out[0]["duration"] == 2045000


def test_finagle_adjuster_flag_off_is_identity(spark):
    df = df_of(spark, [finagle_server_span()])
    assert rows(A.finagle_adjuster(apply_timestamp_and_duration=False)(df)) == rows(df)


def test_finagle_adjuster_ignores_non_finagle_spans(spark):
    s = finagle_server_span()
    s["binary_annotations"] = [t for t in s["binary_annotations"] if "finagle" not in t["key"]]
    df = df_of(spark, [s])
    assert rows(A.finagle_adjuster()(df)) == rows(df)


def test_finagle_detection_is_substring_and_case_sensitive(spark):
    df = df_of(
        spark,
        [
            span(id=1, tags=[tag("srv/finagle.version", "6.28.0")]),
            span(id=2, tags=[tag("finagle.version", "6.28.0")]),
            span(id=3, tags=[tag("srv/Finagle.Version", "6.28.0")]),
            span(id=4),
        ],
    )
    got = {r["id"]: r["f"] for r in df.select("id", A.is_finagle().alias("f")).collect()}
    assert got == {1: True, 2: True, 3: False, 4: False}


def test_backfill_keeps_existing_values_and_open_spans(spark):
    df = df_of(
        spark,
        [
            span(id=1, timestamp=5, duration=7, annotations=[ann(10, "cs"), ann(20, "cr")]),
            span(id=2, annotations=[ann(10, "cs")]),  # open: no end
            span(id=3, annotations=[ann(30, "sr"), ann(25, "ss")]),  # end before start
            span(id=4, annotations=[ann(10, "cs"), ann(90, "cr"), ann(20, "sr"), ann(80, "ss")]),
            span(id=5, annotations=[ann(10, "finagle.flush")]),
        ],
    )
    got = {r["id"]: (r["timestamp"], r["duration"]) for r in rows(A.backfill_timestamp_duration(df))}
    assert got == {1: (5, 7), 2: (10, None), 3: (30, None), 4: (10, 80), 5: (None, None)}


def _flush_span(with_hit=True):
    tags = [tag("key", "Hit")] if with_hit else []
    return span(
        trace_id=1,
        id=2,
        name="my-span",
        annotations=[ann(1442493420635000, "sr"), ann(1442493422680000, "ss"), ann(1442493500000000, "finagle.flush")],
        tags=tags,
    )


def test_issue343_drops_flush_with_hit(spark):
    out = rows(A.issue343_adjuster()(df_of(spark, [_flush_span(True)])))
    assert [a["value"] for a in out[0]["annotations"]] == ["sr", "ss"]
    assert out[0]["timestamp"] is None  # timestamps untouched


def test_issue343_keeps_flush_without_hit_or_miss(spark):
    df = df_of(spark, [_flush_span(False)])
    assert rows(A.issue343_adjuster()(df)) == rows(df)


def test_issue343_checks_values_regardless_of_key(spark):
    s = _flush_span(False)
    s["binary_annotations"] = [tag("cache.result", "Miss")]
    out = rows(A.issue343_adjuster()(df_of(spark, [s])))
    assert "finagle.flush" not in [a["value"] for a in out[0]["annotations"]]


def test_issue343_is_idempotent(spark):
    df = df_of(spark, [_flush_span(True), _flush_span(False)])
    once = A.issue343_adjuster()(df)
    assert rows(A.issue343_adjuster()(once)) == rows(once)


def test_root_server_span_only_adjusted(spark):
    df = df_of(
        spark,
        [
            span(id=1, annotations=[ann(100, "sr"), ann(300, "ss")]),
            span(id=2, parent_id=1, annotations=[ann(150, "sr"), ann(250, "ss")]),
            span(id=3, parent_id=2, annotations=[ann(160, "cs"), ann(240, "cr")]),
        ],
    )
    got = {r["id"]: (r["timestamp"], r["duration"]) for r in rows(A.root_server_backfill()(df))}
    assert got == {1: (100, 200), 2: (None, None), 3: (None, None)}


def test_prune_rekey_normalize_scrub(spark):
    s = span(
        id=7,
        parent_id=3,
        annotations=[ann(1, "cs", {"service_name": " Web ", "ipv4": None, "port": None}), ann(2, "finagle.flush")],
        tags=[tag("user.email", "alice@example.com"), tag("http.path", "/a")],
    )
    df = df_of(spark, [s])
    pruned = rows(A.prune(tag_keys=["http.path"], annotation_values=["finagle.flush"])(df))[0]
    assert [t["key"] for t in pruned["binary_annotations"]] == ["user.email"]
    assert [a["value"] for a in pruned["annotations"]] == ["cs"]
    rk = rows(A.rekey(0xFF)(df))[0]
    assert (rk["id"], rk["parent_id"]) == (7 ^ 0xFF, 3 ^ 0xFF)
    assert rows(A.rekey(0xFF)(A.rekey(0xFF)(df))) == rows(df)
    norm = rows(A.normalize_services({"web": "frontend"})(df))[0]
    assert norm["annotations"][0]["endpoint"]["service_name"] == "frontend"
    scrubbed = rows(A.scrub()(df))[0]
    assert scrubbed["binary_annotations"][0]["value"] == b"***@example.com"
    hashed = rows(A.scrub(hash_keys=["user.email"])(df))[0]
    assert len(hashed["binary_annotations"][0]["value"]) == 64


def test_normalize_fills_missing_service(spark):
    s = span(id=1, annotations=[ann(1, "cs", {"service_name": "", "ipv4": None, "port": None})])
    out = rows(A.normalize_services()(df_of(spark, [s])))[0]
    assert out["annotations"][0]["endpoint"]["service_name"] == "unknown"


def test_failing_adjusters_are_skipped(spark):
    df = df_of(spark, [finagle_server_span()])

    def broken_plan(d):
        return d.select("no_such_column")

    def broken_python(batch):
        raise RuntimeError("boom")

    out = A.chain([broken_plan, A.python_adjuster(broken_python), A.finagle_adjuster()])(df)
    assert rows(out) == rows(A.finagle_adjuster()(df))


def test_adjusters_from_settings():
    assert A.adjusters_from_settings({}) == []
    assert len(A.adjusters_from_settings({"finagle.enabled": "true"})) == 1
    assert len(A.adjusters_from_settings({"finagle.enabled": True, "finagle.adjust-issue343": "true"})) == 2
    assert A.adjusters_from_settings({"finagle.adjust-issue343": True}) == []
    every = {"merge.enabled": True, "normalize.enabled": True, "prune.tag-keys": "a, b", "scrub.hash-keys": "c", "sample.min-duration": 5, "rekey.salt": 7}
    assert len(A.adjusters_from_settings(every)) == 6
    with pytest.raises(ValueError):
        A.adjusters_from_settings({"scrub.keys": "c"})


def test_span_local_chain_has_no_exchange(spark):
    from tracewright.sources.events import spans_table

    df = spans_table(spark, "/root/testdata/sf0.001")
    chained = A.chain([A.finagle_adjuster(), A.issue343_adjuster(), A.prune(tag_keys=["user.email"])])(df)
    plain = df.select("id")
    count_exchanges = lambda d: d._jdf.queryExecution().executedPlan().toString().count("Exchange")
    # only the fixture's own root aggregate may shuffle; the adjusters add none
    assert count_exchanges(chained) == count_exchanges(plain)


def test_alias_table_of_any_size(spark):
    df = df_of(spark, [finagle_server_span()])
    name = rows(df)[0]["annotations"][0]["endpoint"]["service_name"]
    aliases = {f"s{i}": f"t{i}" for i in range(50_000)} | {name.lower(): "found"}
    out = A.normalize_services(aliases)(df).selectExpr("annotations.endpoint.service_name AS s").first()["s"]
    assert set(out) == {"found"}


def test_extreme_times_do_not_stop_a_batch(spark):
    from tracewright.operators import report as R
    from tracewright.operators import trace as T

    df = df_of(spark, [finagle_server_span()])
    big = df.withColumns({"timestamp": F.lit(2**63 - 1), "duration": F.lit(2**63 - 1)})
    small = df.withColumns({"timestamp": F.lit(-(2**63)), "duration": F.lit(None).cast("bigint")})
    ann = "transform(annotations, a -> named_struct('timestamp', if(a.value = 'sr', -9000000000000000000L, 9000000000000000000L), 'value', a.value, 'endpoint', a.endpoint))"
    wide = df.withColumn("annotations", F.expr(ann))
    spans = big.union(big).union(small).union(wide)
    assert A.backfill_timestamp_duration(spans).count() == 4
    assert A.backfill_timestamp_duration(wide).first()["duration"] is None
    for report in (T.group_traces, R.spans_per_window, R.service_latency, lambda d: T.trace_sessions(d, 10**6), T.with_trace_context):
        assert len(report(spans).collect()) > 0


def test_failing_spans_do_not_depend_on_partitions(spark):
    from tracewright.plans.catalog import _fails_on_some
    from tracewright.sources.events import spans_table

    df = spans_table(spark, "/root/testdata/sf0.001")
    want = {r.id: (r.name if r.id % 50 == 0 else r.name.upper()) for r in df.select("id", "name").collect()}
    for parts in (1, 4, 64):
        got = A.python_adjuster(_fails_on_some)(df.repartition(parts)).select("id", "name").collect()
        assert {r.id: r.name for r in got} == want


def test_scrub_leaves_other_kinds_alone(spark):
    df = df_of(spark, [finagle_server_span()]).withColumn(
        "binary_annotations",
        F.expr("array(named_struct('key', 'k', 'value', X'ff406180', 'type', 'BYTES', 'endpoint', binary_annotations[0].endpoint))"),
    )
    assert bytes(A.scrub()(df).first()["binary_annotations"][0]["value"]) == b"\xff@a\x80"


def test_rekey_keeps_every_parent_link(spark):
    from tracewright.sources.events import spans_table

    df = spans_table(spark, "/root/testdata/sf0.001")
    rk = A.rekey(0x5DEECE66D)(df)
    keys = ["trace_id_high", "trace_id"]
    links = lambda d: d.alias("c").join(
        d.alias("p"), [F.col(f"c.{k}") == F.col(f"p.{k}") for k in keys] + [F.col("c.parent_id") == F.col("p.id")]
    ).count()
    assert links(rk) == links(df) == df.filter("parent_id IS NOT NULL").count()
    assert rk.select("id").distinct().count() == df.select("id").distinct().count()


def test_finagle_settings_flag_off_is_identity(spark):
    df = df_of(spark, [finagle_server_span()])
    adj = A.adjusters_from_settings({"finagle.enabled": "true", "finagle.apply-timestamp-and-duration": "false"})
    assert len(adj) == 1 and rows(adj[0](df)) == rows(df)
