"""Whole-trace operators. These are the only span operators that shuffle.

None of them materialises a trace as one value: a trace of any size is
reduced by partial (map-side) aggregation first, so a trace holding a third
of all spans costs one partial row per map task, not one giant task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.ids import trace_key
from tracewright.functions.spans import has_error_tag, span_service
from tracewright.schema import SPAN_COLUMNS, SPAN_KEY_COLS, TRACE_COLS


def with_trace_key(df: DataFrame) -> DataFrame:
    """add the hex key (output only; shuffles use the numeric pair)."""
    return df.withColumn("trace_key", trace_key())


def group_traces(df: DataFrame) -> DataFrame:
    """G1: spans grouped by trace id, one summary row per trace (F4: the
    numeric key is dropped for output, only the hex key remains).

    All aggregates are algebraic (count/min/max/sum) or a distinct count, so
    Spark combines map-side; the distinct count adds an exchange on (trace key,
    service) before the one on the trace key.
    """
    end = F.try_add("timestamp", "duration")
    return (
        df.select(*TRACE_COLS, "parent_id", "timestamp", "duration", span_service().alias("_svc"),
                  has_error_tag().cast("bigint").alias("_err"), end.alias("_end"))
        .groupBy(*TRACE_COLS)
        .agg(
            F.count(F.lit(1)).alias("n_spans"),
            F.count(F.when(F.col("parent_id").isNull(), F.lit(1))).alias("n_roots"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("_end").alias("last_end"),
            F.sum("_err").alias("n_error_spans"),
            F.countDistinct("_svc").alias("n_services"),
        )
        .select(trace_key().alias("trace_key"), "n_spans", "n_roots", "first_timestamp", "last_end",
                "n_error_spans", "n_services")
    )


def merge_by_id(df: DataFrame) -> DataFrame:
    """A10: halves / copies of one span id become one span (contract 2.10.2).

    One scan: a span gives a row for its scalars and one for each array element.
    Rows are first reduced on (span, element), so a span id with very many copies
    is spread over tasks and its copies collapse before they move; then what the
    merged span itself holds comes together.
    """
    kinds = {c: df.schema[c].dataType.elementType for c in ("annotations", "binary_annotations")}
    scalars = {c: F.col(c) for c in ("name", "parent_id", "timestamp", "duration")}

    def row(**there: Column) -> Column:
        none = {**{c: F.lit(None).cast(t) for c, t in kinds.items()}, **{c: F.lit(None).cast(df.schema[c].dataType) for c in scalars}}
        return F.struct(*[v.alias(c) for c, v in {**none, **there}.items()])

    def each(array: str) -> Column:
        return F.transform(F.coalesce(F.col(array), F.array().cast(df.schema[array].dataType)), lambda e: row(**{array: e}))

    rows = F.concat(F.array(row(**scalars)), *[each(c) for c in kinds])
    numbers = [F.max("parent_id").alias("parent_id"), F.min("timestamp").alias("timestamp"), F.max("duration").alias("duration")]
    elements = df.select(*SPAN_KEY_COLS, F.explode(rows).alias("e")).select(*SPAN_KEY_COLS, "e.*")
    # names are keys here, as a greatest text would have the elements sorted
    reduced = elements.groupBy(*SPAN_KEY_COLS, *kinds, "name").agg(*numbers)
    name = F.coalesce(F.max(F.when(F.col("name") != "", F.col("name"))), F.lit(""))
    gathered = reduced.groupBy(*SPAN_KEY_COLS).agg(name.alias("name"), *numbers, *[F.sort_array(F.collect_list(c)).alias(c) for c in kinds])
    return gathered.select(*SPAN_COLUMNS)


def sample_traces(df: DataFrame, min_duration: int, keep_errors: bool = True) -> DataFrame:
    """Keep every span of traces that are slow (any span duration >=
    ``min_duration``) or, with ``keep_errors``, that have an error tag.

    Decision per trace by partial aggregation; spans are then kept by a left
    semi join on the numeric key (no row of a kept trace is dropped, none
    sampled). The decision side has one row per trace; Spark broadcasts it if
    its estimated or measured size is under the threshold, and else splits
    skewed partitions of the span side.
    """
    slow = F.max("duration") >= F.lit(min_duration)
    cond = F.coalesce(slow, F.lit(False))
    if keep_errors:
        cond = cond | (F.max(has_error_tag().cast("int")) > 0)
    keep = df.groupBy(*TRACE_COLS).agg(cond.alias("_keep")).filter("_keep").select(*TRACE_COLS)
    return df.join(keep, list(TRACE_COLS), "left_semi")


def trace_sessions(df: DataFrame, gap_micros: int) -> DataFrame:
    """G3 (whole-trace variant): per trace, split spans into sessions where
    consecutive timestamps are ``gap_micros`` or more apart (same rule as
    ``session_window``: the session ends at last timestamp + gap, exclusive).

    Skew-safe in two levels: (1) partial aggregation into fixed buckets of
    width ``gap`` per trace -- spans in one bucket are < gap apart, so they
    always share a session; (2) a window over the *buckets* of a trace, whose
    count is bounded by the trace's time range / gap, not by its span count.
    Spans without a timestamp are one row a trace with null start and end.
    """
    g = F.lit(gap_micros).cast("bigint")
    bucket = F.expr(f"timestamp div {gap_micros}L - if(timestamp < 0 and timestamp % {gap_micros}L <> 0, 1, 0)")
    buckets = df.select(*TRACE_COLS, bucket.alias("_bucket"), F.col("timestamp").alias("_ts")).groupBy(*TRACE_COLS, "_bucket")
    return sessions_of(buckets.agg(F.min("_ts").alias("_min"), F.max("_ts").alias("_max"), F.count(F.lit(1)).alias("_n")), g)


def sessions_of(buckets: DataFrame, gap: Column) -> DataFrame:
    """Sessions of bucket rows ``(trace, _bucket, _min, _max, _n)``; a trace's row without bucket, its first, stands alone."""
    w = Window.partitionBy(*TRACE_COLS).orderBy("_bucket")
    prev = F.lag("_max").over(w)
    starts = buckets.withColumn("_new", F.when(F.coalesce(F.try_subtract("_min", prev) >= gap, F.lit(True)), 1).otherwise(0))
    sid = starts.withColumn("_sid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    sessions = sid.groupBy(*TRACE_COLS, "_sid").agg(
        F.min("_min").alias("session_start"),
        F.try_add(F.max("_max"), gap).alias("session_end"),
        F.sum("_n").alias("n_spans"),
    )
    return sessions.select(trace_key().alias("trace_key"), "session_start", "session_end", "n_spans")


def trace_sessions_stream(df: DataFrame, gap: str, watermark: str) -> DataFrame:
    """G3 streaming variant: ``session_window`` per trace behind a watermark.

    Late spans (older than the watermark) are dropped by Structured Streaming;
    that loss is the documented price of event-time sessions. The per-trigger
    grouping (G1) is the default; this operator is opt-in.
    """
    x = df.withColumn("_ts", F.timestamp_micros("timestamp")).withWatermark("_ts", watermark)
    return x.groupBy(*TRACE_COLS, F.session_window("_ts", gap).alias("session")).agg(
        F.count(F.lit(1)).alias("n_spans")
    ).select(
        trace_key().alias("trace_key"),
        F.unix_micros(F.col("session.start")).alias("session_start"),
        F.unix_micros(F.col("session.end")).alias("session_end"),
        "n_spans",
    )


def with_trace_context(df: DataFrame) -> DataFrame:
    """A4 without a grouped map: per-trace facts joined onto every span.

    Adds ``trace_span_count``, ``trace_start``, ``trace_end``,
    ``trace_has_error`` and ``trace_root_id`` (smallest id of a span without a
    parent). Any span-level adjuster can then act on the whole trace's state,
    e.g. ``conditional(F.col("trace_has_error"), ...)``. The facts come from a
    partially aggregated group-by; the join side has one row per trace (Spark
    broadcasts it if its estimated or measured size is under the threshold).
    """
    ctx = df.groupBy(*TRACE_COLS).agg(
        F.count(F.lit(1)).alias("trace_span_count"),
        F.min("timestamp").alias("trace_start"),
        F.max(F.try_add("timestamp", "duration")).alias("trace_end"),
        F.max(has_error_tag()).alias("trace_has_error"),
        F.min(F.when(F.col("parent_id").isNull(), F.col("id"))).alias("trace_root_id"),
    )
    return df.join(ctx, list(TRACE_COLS), "left")
