"""Sinks, sources, configuration and the streaming job."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import df_of, finagle_server_span, rows, span
from tracewright.operators import adjust as A
from tracewright.operators.flat import flat_spans
from tracewright.sources.files import message_stream, read_spans
from tracewright.sources.kafka import KafkaSettings, resolve_servers
from tracewright.streaming.job import JobConfig, process_batch, run_to_completion
from tracewright.streaming.sinks import SinkCheckError, SinkConfig, check_sink, read_sink, write_spans


def _three(spark):
    return df_of(spark, [span(trace_id=1, id=1), span(trace_id=1, id=2, parent_id=1), span(trace_id=1, id=3, parent_id=2)])


def test_unknown_backend_refused():
    with pytest.raises(ValueError):
        SinkConfig("mongodb", "/tmp/x")
    with pytest.raises(ValueError):
        SinkConfig("parquet")  # file sinks need a path


def test_empty_trace_not_written(spark, tmp_dir):
    sink = SinkConfig("parquet", f"{tmp_dir}/out")
    assert write_spans(df_of(spark, []), sink) == 0
    assert not os.path.exists(sink.path)


def test_three_spans_written_and_read_back(spark, tmp_dir):
    sink = SinkConfig("parquet", f"{tmp_dir}/out")
    assert write_spans(_three(spark), sink) == 3
    assert sorted(r["id"] for r in read_spans(spark, sink.path).collect()) == [1, 2, 3]


def test_failing_sink_goes_to_dead_letters(spark, tmp_dir):
    # a file sitting where the sink directory should be makes every write fail
    blocker = f"{tmp_dir}/blocked"
    open(blocker, "w").close()
    sink = SinkConfig("parquet", f"{blocker}/spans", max_attempts=2, retry_wait_s=0)
    dead = SinkConfig("parquet", f"{tmp_dir}/dead")
    assert write_spans(_three(spark), sink, dead_letters=dead) == 0
    dl = spark.read.parquet(dead.path)
    assert dl.count() == 3
    assert all(r["reason"].startswith("write_failed") for r in dl.collect())


def test_fail_fast_check(spark, tmp_dir):
    check_sink(spark, SinkConfig("parquet", f"{tmp_dir}/ok"))
    blocker = f"{tmp_dir}/file"
    open(blocker, "w").close()
    with pytest.raises(SinkCheckError):
        check_sink(spark, SinkConfig("parquet", f"{blocker}/sub"))


def test_batch_replay_is_idempotent(spark, tmp_dir):
    sink = SinkConfig("parquet", f"{tmp_dir}/out")
    for _ in range(2):  # the same micro-batch delivered twice
        write_spans(_three(spark), sink, batch_id=0)
    assert read_sink(spark, sink).count() == 3


def test_kafka_settings():
    with pytest.raises(ValueError):
        KafkaSettings().options()
    opts = KafkaSettings(bootstrap_servers=["a:9092", " b:9092 "]).options()
    assert opts["kafka.bootstrap.servers"] == "a:9092,b:9092"
    assert opts["subscribe"] == "spans" and opts["kafka.group.id"] == "spans"
    calls = []
    assert resolve_servers(lambda: calls.append(1) or "k:1") == "k:1" and calls == [1]
    assert KafkaSettings(bootstrap_servers="k:1", topic="", group_id="").options()["subscribe"] == "spans"


def test_a_batch_is_three_jobs_of_the_group_that_stops_it(spark, tmp_dir):
    sc = spark.sparkContext
    msgs = spark.createDataFrame([(b'[{"traceId":"a","id":"b"}]',), (b"not spans",)], "value binary").repartition(2).localCheckpoint()
    sc.setJobGroup("one-batch", "a batch")
    try:
        n = process_batch(msgs, 0, [A.finagle_adjuster()], SinkConfig("parquet", f"{tmp_dir}/s"), SinkConfig("parquet", f"{tmp_dir}/d"))
    finally:
        sc._jsc.clearJobGroup()
    assert n == 1 and [r.reason for r in spark.read.parquet(f"{tmp_dir}/d").collect()] == ["bad_thrift"]
    jobs = sc.statusTracker().getJobIdsForGroup("one-batch")
    assert len(jobs) == 3  # one decodes and counts, one writes spans, one writes dead letters


def test_a_job_decodes_in_the_plan_of_its_stream(spark, tmp_dir, monkeypatch):
    from tracewright.streaming import job

    decoded = []
    monkeypatch.setattr(job, "decode_messages", lambda messages, f=job.decode_messages: decoded.append(messages.isStreaming) or f(messages))
    for k in range(3):
        spark.createDataFrame([(b'[{"traceId":"a","id":"%d"}]' % (k + 1),)], "value binary").write.mode("append").parquet(f"{tmp_dir}/in")
    cfg = JobConfig(source=lambda s: message_stream(s, f"{tmp_dir}/in", max_files_per_trigger=1), sink=SinkConfig("parquet", f"{tmp_dir}/out"), checkpoint_location=f"{tmp_dir}/ck")
    assert run_to_completion(spark, cfg).lastProgress["batchId"] >= 1
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 3 and decoded == [True]


def test_process_batch_decodes_adjusts_and_writes(spark, tmp_dir):
    from tracewright.sources.messages import span_json_struct

    spans = df_of(spark, [finagle_server_span()])
    good = spans.select(F.concat(F.lit("["), F.to_json(span_json_struct()), F.lit("]")).cast("binary").alias("value"))
    msgs = good.union(spark.createDataFrame([(b"not spans",), (b"",)], "value binary"))
    sink, dead = SinkConfig("parquet", f"{tmp_dir}/out"), SinkConfig("parquet", f"{tmp_dir}/dead")
    assert process_batch(msgs, 0, [A.finagle_adjuster()], sink, dead) == 1
    out = rows(read_sink(spark, sink))
    assert out[0]["duration"] == 2045000
    assert [r["reason"] for r in read_sink(spark, dead).collect()] == ["bad_thrift"]


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_dir):
    from tracewright.operators.decode import decode_messages
    from tracewright.sources.messages import messages_table

    msgs = messages_table(spark, "/root/testdata/sf0.001").select("value")
    msgs.repartition(3).write.parquet(f"{tmp_dir}/in")
    sink = SinkConfig("parquet", f"{tmp_dir}/out")
    cfg = dict(
        source=lambda s: message_stream(s, f"{tmp_dir}/in", max_files_per_trigger=1),
        sink=sink,
        adjusters=[A.finagle_adjuster(), A.issue343_adjuster()],
        checkpoint_location=f"{tmp_dir}/ckpt",
    )
    run_to_completion(spark, JobConfig(**cfg))
    streamed = flat_spans(read_sink(spark, sink))
    batch = flat_spans(A.chain(cfg["adjusters"])(decode_messages(spark.read.parquet(f"{tmp_dir}/in")).spans))
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0
    assert len([d for d in os.listdir(sink.path) if d.startswith("batch_id=")]) == 3
    run_to_completion(spark, JobConfig(**cfg))  # restart from the checkpoint: nothing new
    assert read_sink(spark, sink).count() == batch.count()


def test_session_window_stream_variant(spark, tmp_dir):
    from tracewright.operators.trace import trace_sessions_stream
    from tracewright.schema import SPAN_SCHEMA

    df_of(spark, [span(trace_id=1, id=i, timestamp=t) for i, t in enumerate([0, 5_000_000, 400_000_000_000], 1)]) \
        .write.parquet(f"{tmp_dir}/spans")
    stream = spark.readStream.schema(SPAN_SCHEMA).parquet(f"{tmp_dir}/spans")
    q = (
        trace_sessions_stream(stream, "1 minute", "1 minute")
        .writeStream.format("memory").queryName("tw_sessions").outputMode("append")
        .option("checkpointLocation", f"{tmp_dir}/ck").start()
    )
    q.processAllAvailable()
    q.stop()
    got = [tuple(r) for r in spark.sql("SELECT session_start, n_spans FROM tw_sessions").collect()]
    assert got == [(0, 2)]  # the last session stays open behind the watermark


def test_console_sink(spark, capsys):
    assert write_spans(_three(spark), SinkConfig("console")) == 3


def test_processing_time_trigger(spark, tmp_dir):
    from tracewright.streaming.job import run_job

    df_of(spark, []).select(F.lit(b"[]").alias("value")).limit(0).write.parquet(f"{tmp_dir}/in")
    sink = SinkConfig("parquet", f"{tmp_dir}/out")
    q = run_job(
        spark,
        JobConfig(
            source=lambda s: message_stream(s, f"{tmp_dir}/in"),
            sink=sink,
            batch_interval_ms=200,
            checkpoint_location=f"{tmp_dir}/ckpt",
        ),
    )
    try:
        q.processAllAvailable()
        assert q.isActive and q.lastProgress is not None
        assert q.lastProgress["sink"] is not None
    finally:
        q.stop()


def test_streaming_job_start_is_idempotent_and_close_stops(spark, tmp_dir):
    from tracewright.streaming.job import StreamingJob

    spark.createDataFrame([(b"[]",)], "value binary").write.parquet(f"{tmp_dir}/in")
    cfg = JobConfig(
        source=lambda s: message_stream(s, f"{tmp_dir}/in"),
        sink=SinkConfig("parquet", f"{tmp_dir}/out"),
        checkpoint_location=f"{tmp_dir}/ckpt",
    )
    job = StreamingJob(spark, cfg)
    assert job.await_termination(0.1) is None  # not started: returns at once
    with job.start() as j:
        first = j.query
        assert j.start().query is first
        first.processAllAvailable()
        assert first.isActive
    assert not first.isActive


def test_cli_properties_to_config():
    from tracewright.streaming.cli import config_from_properties, parse_properties

    props = parse_properties([
        "--source=files", "--files.path=/x", "--sink=parquet", "--sink.path=/out", "--sink.option.compression=zstd",
        "--conf.spark.sql.shuffle.partitions=64", "--finagle.enabled=true", "--finagle.adjust-issue343",
        "--batch-duration=2500", "--kafka.topic=", "--available-now", "--scrub.enabled", "--filter.services=a,b",
    ])
    assert "kafka.topic" not in props  # empty means unset
    conf, cfg = config_from_properties(props)
    assert conf == {"spark.sql.shuffle.partitions": "64"}
    assert cfg.sink.options == {"compression": "zstd"} and cfg.batch_interval_ms == 2500
    assert len(cfg.adjusters) == 3 and cfg.available_now and cfg.span_filter is not None
    with pytest.raises(ValueError):
        config_from_properties(parse_properties(["--source=kafka"]))  # servers required
    with pytest.raises(ValueError):
        config_from_properties(parse_properties(["--source=files", "--files.path=/x", "--sink=mongodb"]))


def test_cli_runs_a_files_job(spark, tmp_dir):
    from tracewright.sources.messages import messages_table
    from tracewright.streaming.cli import main

    messages_table(spark, "/root/testdata/sf0.001").select("value").write.parquet(f"{tmp_dir}/in")
    assert main([
        f"--files.path={tmp_dir}/in", "--source=files", f"--sink.path={tmp_dir}/out", f"--checkpoint={tmp_dir}/ck",
        f"--dead-letter.path={tmp_dir}/dead", "--available-now=true", "--finagle.enabled=true",
    ]) == 0
    assert spark.read.parquet(f"{tmp_dir}/out").count() > 0
    assert spark.read.parquet(f"{tmp_dir}/dead").count() > 0


def test_file_sources_and_trace_key(spark, tmp_dir):
    from tracewright.operators.trace import with_trace_key
    from tracewright.sources.files import read_messages, span_stream
    from tracewright.sources.messages import messages_table

    msgs = messages_table(spark, "/root/testdata/sf0.001").select("value")
    msgs.write.parquet(f"{tmp_dir}/msgs")
    assert read_messages(spark, f"{tmp_dir}/msgs").count() == msgs.count()
    os.makedirs(f"{tmp_dir}/raw")
    with open(f"{tmp_dir}/raw/one.bin", "wb") as f:
        f.write(b'[{"traceId":"000000000000000a","id":"000000000000000b","name":"get"}]')
    raw = read_messages(spark, f"{tmp_dir}/raw", fmt="binaryFile")
    from tracewright.operators.decode import decode_messages

    got = rows(decode_messages(raw).spans)
    assert [(r["trace_id"], r["id"], r["name"]) for r in got] == [(10, 11, "get")]

    _three(spark).write.parquet(f"{tmp_dir}/spans")
    q = (
        span_stream(spark, f"{tmp_dir}/spans").transform(with_trace_key)
        .writeStream.format("memory").queryName("tw_span_stream").option("checkpointLocation", f"{tmp_dir}/ck").start()
    )
    q.processAllAvailable()
    q.stop()
    keys = {r[0] for r in spark.sql("SELECT trace_key FROM tw_span_stream").collect()}
    assert keys == {"0000000000000001"}


def test_a_message_file_is_read_by_many_tasks(spark, tmp_dir):
    import uuid

    from tracewright.sources.files import write_messages

    rows = [((uuid.uuid4().bytes) * 64,) for _ in range(8)]
    n = 40_000
    messages = spark.createDataFrame(rows, "value binary").crossJoin(spark.range(n // 8)).select(F.concat("value", F.sha2(F.col("id").cast("string"), 512).cast("binary"), F.sha2(F.concat("value", F.col("id").cast("string")), 512).cast("binary")).alias("value"))
    write_messages(messages.coalesce(1), f"{tmp_dir}/in")
    found = spark.read.parquet(f"{tmp_dir}/in")
    assert len(found.inputFiles()) == 1
    sizes = [s for s in found.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect() if s]
    assert sum(sizes) == n and len(sizes) > 1
