"""Deterministic span table derived from the driver's ``events`` table.

This is the test-data source for every span query (the fixture contract in
FIXTURES.md section 2). Plan shape, whatever the size of ``events``:

* one partial/final aggregate for the trace root (``min(event_id)`` per
  ``(user_id, day)``) -- map-side combine, so a hot user costs nothing extra;
* one equi-join back on ``(user_id, day)``. The aggregated side has one row
  per key; AQE turns the join into a broadcast at runtime only when the
  materialised side is below the broadcast threshold, and otherwise splits
  skewed partitions of the event side (``skewJoin``);
* everything else is a narrow projection (array literals + ``filter``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.time import epoch_micros
from tracewright.schema import (
    CLIENT_RECV,
    CLIENT_SEND,
    FINAGLE_FLUSH,
    SERVER_RECV,
    SERVER_SEND,
    SPAN_COLUMNS,
)

MICROS_PER_DAY = 86_400_000_000

# --- fixed values of the fixture derivation --------------------------------
FIXTURE_IPV4 = "127.0.0.1"
FIXTURE_PORT = 9411
FLUSH_DELAY_MICROS = 80_000_000
FINAGLE_VERSION_TAG = ("srv/finagle.version", "6.28.0")
TRACE_ID_STRIDE = 100_000
MESSAGE_CHUNK = 64  # spans of one trace per message: ids in [k*64, (k+1)*64)


def _events_base(events: DataFrame) -> DataFrame:
    ts_type = events.schema["ts"].dataType
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        epoch_micros("ts", ts_type).alias("start"),
        F.round(F.col("value") * 1000).cast("bigint").alias("dur"),
    ).withColumn("day", F.expr(f"start div {MICROS_PER_DAY}"))


def _with_root(base: DataFrame) -> DataFrame:
    roots = base.groupBy("user_id", "day").agg(F.min("event_id").alias("root_event"))
    return base.join(roots, ["user_id", "day"], "inner")


def _ann(ts: Column, value: str, ep: Column) -> Column:
    return F.struct(ts.alias("timestamp"), F.lit(value).alias("value"), ep.alias("endpoint"))


#: A BYTES tag that is no text but holds what scrubbing looks for, and a DOUBLE tag of 0.5.
BINARY_TAG, HALF_TAG = b"\xff\xfe\x80\x01a@b", b"\x3f\xe0\x00\x00\x00\x00\x00\x00"


def _tag(key: str | Column, value: Column, ep: Column, kind: str = "STRING") -> Column:
    k = F.lit(key) if isinstance(key, str) else key
    return F.struct(
        k.alias("key"), value.cast("binary").alias("value"), F.lit(kind).alias("type"), ep.alias("endpoint")
    )


def _not_null(arr: Column) -> Column:
    return F.filter(arr, lambda x: x.isNotNull())


def spans_from_events(events: DataFrame, split_halves: bool = False, keep_fixture_cols: bool = False) -> DataFrame:
    """Span table from events: one span per event.

    ``split_halves=True`` emits every ``event_id % 5 = 0`` span as two rows of
    the same id (client half: name '', client annotations, timestamp and
    duration; server half: the name, server annotations and flush, no
    timestamp or duration); both halves carry all tags. ``merge_by_id`` on
    that table gives back the one-row-per-event table.
    """
    e = _with_root(_events_base(events))
    eid = F.col("event_id")
    start, dur = F.col("start"), F.col("dur")
    quarter = F.expr("dur div 4")

    service = F.concat(F.lit("svc-"), (F.col("user_id") % 3 + eid % 4).cast("string"))
    endpoint = F.struct(
        service.alias("service_name"),
        F.lit(FIXTURE_IPV4).alias("ipv4"),
        F.when(eid % 6 == 0, F.lit(None)).otherwise(F.lit(FIXTURE_PORT)).cast("int").alias("port"),
    )
    is_client = (eid % 5 == 0) | (eid % 2 == 0)
    is_server = (eid % 5 == 0) | (eid % 2 == 1)
    is_open = eid % 7 == 0
    no_times = eid % 3 == 0

    client_anns = _not_null(
        F.array(
            F.when(is_client, _ann(start, CLIENT_SEND, endpoint)),
            F.when(is_client & ~is_open, _ann(start + dur, CLIENT_RECV, endpoint)),
        )
    )
    server_anns = _not_null(
        F.array(
            F.when(is_server, _ann(start + quarter, SERVER_RECV, endpoint)),
            F.when(is_server & ~is_open, _ann(start + dur - quarter, SERVER_SEND, endpoint)),
            F.when(eid % 4 == 0, _ann(start + dur + F.lit(FLUSH_DELAY_MICROS), FINAGLE_FLUSH, endpoint)),
        )
    )
    tags = _not_null(
        F.array(
            F.when(no_times, _tag(FINAGLE_VERSION_TAG[0], F.lit(FINAGLE_VERSION_TAG[1]), endpoint)),
            F.when(eid % 8 == 0, _tag("key", F.lit("Hit"), endpoint)),
            F.when(eid % 16 == 4, _tag("key", F.lit("Miss"), endpoint)),
            F.when(F.col("event_type") == "error", _tag("error", F.lit("true"), endpoint)),
            _tag("user.email", F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@example.com")), endpoint),
            F.when(eid % 10 == 1, _tag("sa", F.lit(b"\x01"), endpoint, "BOOL")),
            F.when(eid % 12 == 5, _tag("blob", F.lit(BINARY_TAG), endpoint, "BYTES")),
            F.when(eid % 9 == 2, _tag("size", F.unhex(F.lpad(F.hex(dur), 16, "0")), endpoint, "I64")),
            F.when(eid % 11 == 3, _tag("ratio", F.lit(HALF_TAG), endpoint, "DOUBLE")),
        )
    )

    cols = {
        "trace_id_high": F.when(F.col("user_id") % 10 == 0, F.col("user_id")).otherwise(F.lit(0)).cast("bigint"),
        "trace_id": (F.col("user_id") * TRACE_ID_STRIDE + F.col("day")).cast("bigint"),
        "id": (eid + 1).cast("bigint"),
        "parent_id": F.when(eid == F.col("root_event"), F.lit(None)).otherwise(F.col("root_event") + 1).cast("bigint"),
        "name": F.col("event_type"),
        "timestamp": F.when(no_times, F.lit(None)).otherwise(start).cast("bigint"),
        "duration": F.when(no_times, F.lit(None)).otherwise(dur).cast("bigint"),
    }
    if not split_halves:
        cols["annotations"] = F.sort_array(F.concat(client_anns, server_anns))
        cols["binary_annotations"] = tags
        out = e.select(*[v.alias(k) for k, v in cols.items()], *_fixture_cols(keep_fixture_cols))
        return out

    role = F.explode(
        F.when(eid % 5 == 0, F.array(F.lit("client"), F.lit("server"))).otherwise(F.array(F.lit("whole")))
    ).alias("role")
    staged = e.select("*", client_anns.alias("_c"), server_anns.alias("_s"), tags.alias("_t"), role)
    r = F.col("role")
    split_cols = dict(cols)
    split_cols["name"] = F.when(r == "client", F.lit("")).otherwise(F.col("event_type"))
    split_cols["timestamp"] = F.when(r == "server", F.lit(None)).otherwise(cols["timestamp"]).cast("bigint")
    split_cols["duration"] = F.when(r == "server", F.lit(None)).otherwise(cols["duration"]).cast("bigint")
    split_cols["annotations"] = F.sort_array(
        F.when(r == "client", F.col("_c")).when(r == "server", F.col("_s")).otherwise(F.concat("_c", "_s"))
    )
    split_cols["binary_annotations"] = F.col("_t")
    return staged.select(*[v.alias(k) for k, v in split_cols.items()], *_fixture_cols(keep_fixture_cols))


def _fixture_cols(keep: bool) -> list[Column]:
    if not keep:
        return []
    return [F.col("user_id").alias("_user_id"), F.col("day").alias("_day")]


def spread_small_input(df: DataFrame) -> DataFrame:
    """Round-robin a scan that has fewer partitions than the cluster has
    cores (a single small file); a large input keeps its scan partitioning,
    so at scale this adds no shuffle.

    Call it on a bare file scan only: there the partition count comes from
    the file listing. On a plan with exchanges, ``rdd`` would make adaptive
    execution run the shuffle stages just to count partitions."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def spans_table(spark, sf_dir: str, split_halves: bool = False) -> DataFrame:
    events = spread_small_input(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return spans_from_events(events, split_halves=split_halves).select(*SPAN_COLUMNS)


CLIENT_VALUES = (CLIENT_SEND, CLIENT_RECV)


def half_spans_from_spans(spans: DataFrame) -> DataFrame:
    """The split-halves table from the one-row-per-event span table: every
    span with ``(id - 1) % 5 = 0`` becomes a client half (name '', client
    annotations, timestamp and duration) and a server half (the name, the other
    annotations, no timestamp or duration); both keep all tags. One narrow
    projection plus a two-way explode -- no aggregate or join."""
    split = (F.col("id") - 1) % 5 == 0
    role = F.explode(F.when(split, F.array(F.lit("client"), F.lit("server"))).otherwise(F.array(F.lit("whole"))))
    staged = spans.select("*", role.alias("role"))
    r = F.col("role")
    is_client_ann = lambda a: a["value"].isin(*CLIENT_VALUES)
    return staged.select(
        "trace_id_high",
        "trace_id",
        "id",
        "parent_id",
        F.when(r == "client", F.lit("")).otherwise(F.col("name")).alias("name"),
        F.when(r == "server", F.lit(None).cast("bigint")).otherwise(F.col("timestamp")).alias("timestamp"),
        F.when(r == "server", F.lit(None).cast("bigint")).otherwise(F.col("duration")).alias("duration"),
        F.when(r == "client", F.filter("annotations", is_client_ann))
        .when(r == "server", F.filter("annotations", lambda a: ~is_client_ann(a)))
        .otherwise(F.col("annotations"))
        .alias("annotations"),
        "binary_annotations",
    )
