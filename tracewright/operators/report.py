"""Reports over spans: time windows, service latency, dependency links.

Every report is an aggregation with map-side combine before its exchange. Spans
without a time have a bucket of their own (null), and sums that do not fit into
64 bits are null instead of stopping the report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.spans import has_error_tag, span_service
from tracewright.schema import TRACE_COLS
from tracewright.session import stored


def floor_div(value: Column, width: Column) -> Column:
    """Bucket number of ``value``: integer division rounded down, which no value of 64 bits overflows."""
    whole = F.call_function("div", value, width)
    return whole - F.when((value < 0) & (value % width != 0), F.lit(1)).otherwise(F.lit(0))


def spans_per_window(df: DataFrame, width: str = "1 hour") -> DataFrame:
    """Span counts per (tumbling event-time window, service).

    Windows align to the epoch; the start is epoch micros. Spans without a
    timestamp are counted in the window null.
    """
    micros = F.expr(f"unix_micros(timestamp_micros(0L) + interval {width})")
    x = df.select(
        F.try_multiply(floor_div(F.col("timestamp"), micros), micros).alias("window_start"),
        span_service().alias("service"),
        has_error_tag().cast("bigint").alias("_err"),
        F.col("duration"),
    )
    return x.groupBy("window_start", "service").agg(
        F.count(F.lit(1)).alias("n_spans"),
        F.sum("_err").alias("n_errors"),
        F.try_sum("duration").alias("sum_duration"),
    )


#: Percentiles of the latency report, in hundredths.
LATENCY_PERCENTILES = {"p50_duration": 50, "p95_duration": 95}


def _coarse(value: Column) -> Column:
    """A rising step function of 64-bit numbers with at most 64 steps for each power of two."""
    size = F.when(value < 0, F.bitwise_not(value)).otherwise(value)
    shift = F.greatest(F.length(F.bin(size)) - 7, F.lit(0))
    step = F.call_function("shiftright", size, shift.cast("int")) + shift.cast("bigint") * 128
    return F.when(value < 0, F.bitwise_not(step)).otherwise(step)


def latency_counts(df: DataFrame, bucket_micros: int = 86_400_000_000) -> DataFrame:
    """Spans by service, time bucket and duration: ``service, bucket, duration, n``.

    Counts of several inputs add up to those of all of them (:func:`merged_counts`), so a stream can keep them by the batch.
    """
    x = df.select(
        span_service().alias("service"),
        floor_div(F.col("timestamp"), F.lit(bucket_micros).cast("bigint")).alias("bucket"),
        F.when(F.col("timestamp").isNotNull(), F.col("duration")).alias("duration"),
    )
    return x.groupBy("service", "bucket", "duration").agg(F.count(F.lit(1)).alias("n"))


def merged_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("service", "bucket", "duration").agg(F.sum("n").alias("n"))


def service_latency(df: DataFrame, bucket_micros: int = 86_400_000_000) -> DataFrame:
    """Per service and time bucket: count, sum/min/max duration, exact p50 and p95.

    The spans are read once; what is stored between is a row for each duration of a group.
    """
    return latency_of(stored(latency_counts(df, bucket_micros), "latency-counts"))


def latency_of(values: DataFrame) -> DataFrame:
    """The latency report of counts by duration (:func:`latency_counts`), which are read twice.

    A percentile is the smallest duration with at least that share of the
    bucket's spans at or below it. Counts by coarse step (a few thousand a group
    at most) tell which step holds each rank, and values are put in order within
    those steps only, so no task orders a whole group. Spans without timestamp or
    duration are counted in ``n_untimed`` of their bucket (null without timestamp).
    """
    group = ["service", "bucket"]
    values = values.withColumn("step", _coarse(F.col("duration")))
    steps = values.groupBy(*group, "step").agg(
        F.sum("n").alias("n"),
        F.try_sum(F.col("duration").cast("decimal(38,0)") * F.col("n")).alias("sum"),
        F.min("duration").alias("min"),
        F.max("duration").alias("max"),
    )
    # a row for each step of a group: few, so one window and one aggregate hold them
    known = F.col("step").isNotNull()
    timed = F.when(known, F.col("n"))
    whole = Window.partitionBy(*group)
    upto = whole.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = steps.withColumns({"last": F.sum(timed).over(upto), "all": F.sum(timed).over(whole)})
    percentiles = {}
    for name, share in LATENCY_PERCENTILES.items():
        rank = F.expr(f"(all * {share} + 99) div 100")
        here = known & (rank <= F.col("last")) & (rank > F.col("last") - F.col("n"))
        percentiles[f"{name}_step"] = F.max(F.when(here, F.col("step")))
        percentiles[f"{name}_rank"] = F.max(F.when(here, rank - (F.col("last") - F.col("n"))))
    total = ranked.groupBy(*group).agg(
        F.coalesce(F.sum(timed), F.lit(0)).alias("n_spans"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_untimed"),
        F.expr("try_cast(sum(sum) as bigint)").alias("sum_duration"),
        F.min("min").alias("min_duration"),
        F.max("max").alias("max_duration"),
        *[c.alias(k) for k, c in percentiles.items()],
    )
    same = lambda a, b, cols: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols]
    sought = [F.col(f"t.{k}_step") == F.col("v.step") for k in LATENCY_PERCENTILES]
    inside = values.alias("v").join(total.alias("t"), [*same("v", "t", group), sought[0] | sought[1]])
    order = Window.partitionBy("v.service", "v.bucket", "v.step").orderBy("v.duration")
    placed = inside.withColumn("last", F.sum("v.n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    at = lambda k: sought[list(LATENCY_PERCENTILES).index(k)] & (F.col(f"t.{k}_rank") <= F.col("last")) & (F.col(f"t.{k}_rank") > F.col("last") - F.col("v.n"))
    found = placed.groupBy(F.col("v.service").alias("service"), F.col("v.bucket").alias("bucket")).agg(
        *[F.max(F.when(at(k), F.col("v.duration"))).alias(k) for k in LATENCY_PERCENTILES]
    )
    kept = ["n_spans", "n_untimed", "sum_duration", "min_duration", "max_duration"]
    return (
        total.alias("t")
        .join(found.alias("f"), same("t", "f", group), "left")
        .select(*[f"t.{c}" for c in [*group, *kept]], *[f"f.{k}" for k in LATENCY_PERCENTILES])
    )


def dependency_links(df: DataFrame) -> DataFrame:
    """Parent service -> child service call and error counts.

    One scan: every span is a parent row under its own id and, if it has a
    parent, a child row under its parent's id. Rows are first reduced to one per
    (trace, id, child service), so a parent with a million children becomes a
    handful of rows; then each id's parent service meets its child rows.
    """
    s = df.select(
        *TRACE_COLS, "id", "parent_id", span_service().alias("svc"), has_error_tag().cast("bigint").alias("err")
    )
    none = F.lit(None).cast("bigint")
    own = F.struct(F.col("id").alias("key"), F.lit(True).alias("own"), F.col("svc").alias("svc"), none.alias("calls"), none.alias("errs"))
    called = F.struct(F.col("parent_id").alias("key"), F.lit(False).alias("own"), F.col("svc").alias("svc"), F.lit(1).cast("bigint").alias("calls"), F.col("err").alias("errs"))
    sides = F.when(F.col("parent_id").isNull(), F.array(own)).otherwise(F.array(own, called))
    rows = s.select(*TRACE_COLS, F.explode(sides).alias("e")).select(*TRACE_COLS, "e.*")
    reduced = rows.groupBy(*TRACE_COLS, "key", "own", "svc").agg(F.sum("calls").alias("calls"), F.sum("errs").alias("errs"))
    within = Window.partitionBy(*TRACE_COLS, "key")  # a few rows: the services under one span id
    met = reduced.withColumns(
        {"parent": F.min(F.when(F.col("own"), F.col("svc"))).over(within), "known": F.max("own").over(within)}
    )
    return (
        met.where(~F.col("own") & F.col("known"))
        .groupBy("parent", F.col("svc").alias("child"))
        .agg(F.sum("calls").alias("call_count"), F.sum("errs").alias("error_count"))
    )
