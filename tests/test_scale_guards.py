"""Scale guards: plan shapes that must never appear, and results under skew
(one trace holding a third of the spans; one span copied many times)."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tracewright.operators import report as R
from tracewright.operators import trace as T
from tracewright.operators.flat import flat_spans
from tracewright.plans.catalog import QUERIES
from tracewright.sources.events import spans_table

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _plan(E.queries()[name](spark, SF)) for name in QUERIES}


def test_no_cross_products_or_nested_loop_joins(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_no_trace_materialised_as_one_value(plans):
    for name, plan in plans.items():
        if name != "merge_by_id":  # gathers what a merged span holds, after its elements were made distinct
            assert not re.search(r"collect_(list|set)\(", plan), name


def test_windows_only_over_aggregated_buckets(plans):
    for name, plan in plans.items():
        if "Window" in plan:
            assert name in ("trace_sessions", "service_latency", "latency_overall", "dependency_links"), name


def test_span_local_queries_do_not_shuffle(plans):
    local = ["scan_spans", "trace_key", "filter_spans", "filter_service", "detect_finagle", "backfill_duration",
             "finagle_adjust", "finagle_adjust_off", "issue343_adjust", "conditional_adjust", "adjuster_chain",
             "prune_tags", "rekey_spans", "normalize_service", "scrub_tags", "decode_json", "decode_thrift",
             "decode_spans"]
    for name in local:
        assert "Exchange" not in plans[name], name


@pytest.fixture(scope="module")
def hot(spark):
    """sf0.01 spans with every third span moved into one hot trace."""
    df = spans_table(spark, "/root/testdata/sf0.01")
    hot_trace = F.col("id") % 3 == 0
    return df.withColumns(
        {
            "trace_id_high": F.when(hot_trace, F.lit(0).cast("bigint")).otherwise(F.col("trace_id_high")),
            "trace_id": F.when(hot_trace, F.lit(42).cast("bigint")).otherwise(F.col("trace_id")),
        }
    ).cache()


def test_group_traces_with_hot_trace(spark, hot):
    n_hot = hot.filter("trace_id = 42 AND trace_id_high = 0").count()
    assert n_hot > hot.count() // 4
    got = T.group_traces(hot).filter(F.col("trace_key") == "000000000000002a").first()
    assert got["n_spans"] == n_hot


def test_sessions_with_hot_trace_match_session_window(spark, hot):
    gap = 600_000_000
    df = hot.filter("timestamp IS NOT NULL")
    ours = T.trace_sessions(df, gap)
    ref = (
        df.withColumn("_ts", F.timestamp_micros("timestamp"))
        .groupBy("trace_id_high", "trace_id", F.session_window("_ts", "10 minutes").alias("s"))
        .agg(F.count(F.lit(1)).alias("n_spans"))
        .select(T.trace_key().alias("trace_key"), F.unix_micros("s.start").alias("session_start"),
                F.unix_micros("s.end").alias("session_end"), "n_spans")
    )
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_merge_many_copies_of_one_span(spark):
    base = spans_table(spark, SF)
    one = base.orderBy("id").limit(1)
    copies = one.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("_k")
    merged = T.merge_by_id(copies.unionByName(base))
    assert merged.count() == base.count()
    assert flat_spans(merged).exceptAll(flat_spans(base)).count() == 0


def test_dependency_links_with_hot_parent(spark):
    base = spans_table(spark, SF)
    root = base.filter("parent_id IS NULL").orderBy("id").limit(1).select("trace_id_high", "trace_id", "id")
    r = root.first()
    # every other span of the table becomes a child of that one root
    kids = base.filter(F.col("id") != r["id"]).withColumns(
        {"trace_id_high": F.lit(r["trace_id_high"]), "trace_id": F.lit(r["trace_id"]), "parent_id": F.lit(r["id"])}
    )
    hot = kids.unionByName(base.filter(F.col("id") == r["id"]))
    links = R.dependency_links(hot)
    assert links.agg(F.sum("call_count")).first()[0] == kids.count()


def test_spread_small_input_only_touches_narrow_scans(spark, tmp_dir):
    from tracewright.sources.events import spread_small_input

    cores = spark.sparkContext.defaultParallelism
    narrow = spark.read.parquet(f"{SF}/events.parquet")
    assert narrow.rdd.getNumPartitions() < cores
    assert spread_small_input(narrow).rdd.getNumPartitions() == cores
    spark.range(0, 1000, numPartitions=cores * 2).write.parquet(f"{tmp_dir}/wide")
    wide = spark.read.parquet(f"{tmp_dir}/wide")
    assert spread_small_input(wide) is wide


def test_package_is_shipped_once_with_every_module(spark):
    import os
    import zipfile

    from tracewright import session

    app = spark.sparkContext.applicationId
    assert app in session._shipped  # build_session shipped it
    session.ship_package(spark)  # idempotent
    shipped = [f for f in spark.sparkContext._jsc.sc().listFiles().toList().mkString(",").split(",")
               if f.endswith("tracewright.zip")]
    assert len(shipped) == 1
    pkg = os.path.dirname(session.__file__)
    local = [os.path.join(dp, f) for dp, _, fs in os.walk(pkg) if "__pycache__" not in dp for f in fs if f.endswith(".py")]
    zpath = shipped[0].replace("file:", "")
    if os.path.exists(zpath):
        names = set(zipfile.ZipFile(zpath).namelist())
        assert {os.path.relpath(p, os.path.dirname(pkg)) for p in local} <= names
