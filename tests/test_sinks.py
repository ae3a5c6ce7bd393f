"""Own connections, the ledger of batches, storage layouts, and what a job never loses."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import df_of, span
from tracewright.operators.decode import decode_messages
from tracewright.operators.flat import flat_spans
from tracewright.schema import SPAN_SCHEMA
from tracewright.sources.files import message_stream, span_stream
from tracewright.sources.fixtures import stored_spans
from tracewright.sources.shared import Records
from tracewright.streaming import connections, layouts
from tracewright.streaming.job import JobConfig, process_batch, run_job
from tracewright.streaming.ledger import Ledger
from tracewright.streaming.sinks import SinkConfig, check_sink, read_dead_letters, read_sink, write_spans

FILE_STORE = "tracewright.streaming.connections:FileStore"
SF = "/root/testdata/sf0.001"


def store_sink(path, **more):
    return SinkConfig("connections", options={"store": FILE_STORE, "path": path, **more}, retry_wait_s=0)


def test_one_connection_a_task_and_one_commit_a_batch(spark, tmp_dir):
    sink = store_sink(f"{tmp_dir}/store")
    check_sink(spark, sink)
    spans = stored_spans(spark, SF).repartition(5)
    empty = df_of(spark, []).repartition(3)
    assert write_spans(spans.union(empty), sink, batch_id=7) == spans.count()
    for _ in range(2):
        write_spans(spans, sink, batch_id=7)  # replays
    (batch,) = connections.commits(f"{tmp_dir}/store").values()
    tasks = [f["task"] for f in batch["files"]]
    assert len(tasks) == len(set(tasks)) == 5  # tasks without rows opened none
    assert sum(f["rows"] for f in batch["files"]) == spans.count()
    found = connections.read_store(spark, f"{tmp_dir}/store", SPAN_SCHEMA)
    assert flat_spans(found).exceptAll(flat_spans(spans)).count() == 0 and found.count() == spans.count()
    assert len(os.listdir(f"{tmp_dir}/store/data")) == 5  # files of replays are gone


def test_failed_attempt_leaves_no_rows(spark, tmp_dir):
    bad = F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("name")).cast("string")
    spans = df_of(spark, [span(id=i) for i in range(1, 5)]).repartition(2).withColumn("name", bad)
    with pytest.raises(RuntimeError, match="broken"):
        write_spans(spans, SinkConfig("connections", options=store_sink(f"{tmp_dir}/s").options, max_attempts=1), batch_id=0, known_non_empty=True)
    assert connections.commits(f"{tmp_dir}/s") == {}
    assert connections.read_store(spark, f"{tmp_dir}/s", SPAN_SCHEMA).count() == 0


def test_stream_writes_through_connections(spark, tmp_dir):
    df_of(spark, [span(id=i) for i in range(1, 4)]).repartition(3).write.parquet(f"{tmp_dir}/in")
    connections.register(spark)

    def run():
        writer = span_stream(spark, f"{tmp_dir}/in", max_files_per_trigger=1).writeStream.format("connections")
        q = writer.options(store=FILE_STORE, path=f"{tmp_dir}/store").option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start()
        q.awaitTermination()

    run()
    run()  # nothing new
    assert len(connections.commits(f"{tmp_dir}/store")) >= 3
    assert connections.read_store(spark, f"{tmp_dir}/store", SPAN_SCHEMA).count() == 3


def test_connections_need_a_store():
    with pytest.raises(ValueError, match="store"):
        SinkConfig("connections")


def test_records_are_written_once(tmp_dir):
    records = Records(f"{tmp_dir}/r")
    assert records.get("a") is None and records.all() == {}
    assert records.add("a", {"n": 1}) == {"n": 1} == records.add("a", {"n": 2})
    assert records.all() == {"a": {"n": 1}}


def test_ledger_goes_on_where_an_attempt_ended(spark, tmp_dir):
    sink, out = Ledger(f"{tmp_dir}/ledger"), f"{tmp_dir}/out"
    batch = df_of(spark, [span(id=i) for i in range(1, 11)]).repartition(4)
    read = lambda: spark.read.parquet(out) if os.path.exists(out) else spark.createDataFrame([], "batch_id long, row_key long")

    def half(df):
        df.orderBy("row_key").limit(4).write.mode("append").parquet(out)
        raise OSError("gone")

    whole = lambda df: df.write.mode("append").parquet(out)
    with pytest.raises(OSError):
        sink.write_once(batch, 0, half, read)
    # what the source gives now does not matter: the batch is staged
    done = sink.write_once(df_of(spark, [span(id=99)]), 0, whole, read)
    assert (done.rows, done.appended) == (10, 6)
    # all rows are there, but the attempt ended before the record
    Records(f"{tmp_dir}/ledger/batches")
    os.remove(f"{tmp_dir}/ledger/batches/0.published.json")
    assert sink.write_once(batch, 0, half, read).appended == 0
    assert sink.write_once(batch, 0, half, read).appended == 0
    assert sorted(r.id for r in read().collect()) == list(range(1, 11))


def test_ledger_of_a_file_sink(spark, tmp_dir):
    sink = SinkConfig("parquet", f"{tmp_dir}/out", ledger=f"{tmp_dir}/ledger")
    spans = df_of(spark, [span(id=1), span(id=1)])  # equal rows are two rows
    assert [write_spans(spans, sink, batch_id=b) for b in (0, 0, 1)] == [2, 0, 2]
    assert spark.read.parquet(sink.path).count() == 4


def test_layout_tables_are_seen_together(spark, tmp_dir, monkeypatch):
    root, spans = f"{tmp_dir}/layout", stored_spans(spark, SF)
    with pytest.raises(FileNotFoundError):
        layouts.read_layout(spark, root, "spans")

    def broken(uri):
        raise OSError("ended before the commit")

    with monkeypatch.context() as m:
        m.setattr(layouts.Records, "add", lambda *a: broken(a))
        with pytest.raises(OSError):
            layouts.write_layout(spans, root, 0)
    with pytest.raises(FileNotFoundError):
        layouts.read_layout(spark, root, "names")
    assert layouts.write_layout(spans, root, 0) and not layouts.write_layout(spans, root, 0)
    assert layouts.read_layout(spark, root, "spans").count() == spans.count()
    marks = layouts.read_layout(spark, root, "annotations")
    texts = spans.select(F.explode("binary_annotations.type").alias("t")).where("t = 'STRING'").count()
    assert marks.count() == spans.select(F.explode("annotations")).count() + texts


def test_found_traces_are_those_of_the_span_table(spark, tmp_dir):
    spans, root = stored_spans(spark, SF), f"{tmp_dir}/layout"
    layouts.write_layout(spans, root, 0)
    some = spans.where("timestamp is not null").select(F.min("timestamp"), F.max("timestamp")).first()
    middle = (some[0] + some[1]) // 2
    found = layouts.find_traces(spark, root, "svc-1", marks={"cs": None, "key": "Miss"}, start=middle)
    of = lambda s: s.where(F.array_contains("annotations.endpoint.service_name", "svc-1"))
    late = of(spans)
    keys = lambda d: {tuple(r) for r in d.groupBy("trace_id_high", "trace_id").agg(F.max("timestamp").alias("l")).where(F.col("l") >= middle).select("trace_id_high", "trace_id").collect()}
    cs = keys(late.where(F.array_contains("annotations.value", "cs")))
    miss = keys(late.where(F.exists("binary_annotations", lambda b: (b["key"] == "key") & (b["value"].cast("string") == "Miss"))))
    want = keys(late) & cs & miss
    got = layouts.spans_of(spark, root, found)
    assert {tuple(r) for r in got.select("trace_id_high", "trace_id").collect()} == want and want
    assert got.count() == spans.join(spark.createDataFrame(list(want), "trace_id_high long, trace_id long"), ["trace_id_high", "trace_id"]).count()


def test_a_job_without_a_checkpoint_is_refused(spark, tmp_dir):
    spark.createDataFrame([(b"[]",)], "value binary").write.parquet(f"{tmp_dir}/in")
    with pytest.raises(ValueError, match="checkpoint_location"):
        run_job(spark, JobConfig(source=lambda s: message_stream(s, f"{tmp_dir}/in"), sink=SinkConfig("parquet", f"{tmp_dir}/out")))


def test_a_batch_filtered_to_nothing_is_not_written(spark, tmp_dir):
    from tracewright.sources.messages import messages_table

    sink = SinkConfig("parquet", f"{tmp_dir}/out")
    messages = messages_table(spark, SF).select("value")
    assert process_batch(messages, 0, [], sink, span_filter=lambda: F.lit(False)) == 0
    assert not os.path.exists(f"{sink.path}/batch_id=0")


def test_diverted_spans_decode_to_the_same_spans(spark, tmp_dir):
    spans = stored_spans(spark, SF)
    dead = SinkConfig("parquet", f"{tmp_dir}/dead")
    failing = SinkConfig("jdbc", options={"url": "jdbc:none:", "dbtable": "spans"}, max_attempts=1)
    assert write_spans(spans, failing, batch_id=0, dead_letters=dead) == 0
    again = decode_messages(read_dead_letters(spark, dead, "write_failed"))
    assert again.dead_letters.count() == 0
    assert flat_spans(again.spans).exceptAll(flat_spans(spans)).count() == 0 and again.spans.count() == spans.count()
    assert read_sink(spark, dead).count() == spans.count()
