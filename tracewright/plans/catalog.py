"""Named query plans: each reads the driver's tables from ``sf_dir`` and returns
a DataFrame of flat scalar columns; ``ORACLE`` holds the matching DuckDB SQL.

Queries are grouped by the SURVEY section 2 operator they exercise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions.ids import trace_key
from tracewright.functions.spans import has_error_tag, of_services, span_service
from tracewright.operators import adjust as A
from tracewright.operators import decode as D
from tracewright.operators import report as R
from tracewright.operators import trace as T
from tracewright.operators.flat import flat_spans
from tracewright.plans import oracle as O
from tracewright.schema import SPAN_COLUMNS
from tracewright.session import scratch_path
from tracewright.sources.files import message_stream, read_spans, write_messages
from tracewright.sources.fixtures import stored_messages, stored_spans
from tracewright.streaming.job import JobConfig, process_batch, run_to_completion
from tracewright.streaming.sinks import SinkConfig, check_sink, read_sink, write_spans

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _spans(spark: SparkSession, sf_dir: str, split_halves: bool = False) -> DataFrame:
    """The span table derived from ``events`` (written once per session)."""
    return stored_spans(spark, sf_dir, split_halves=split_halves)


# ---------------------------------------------------------------- S5 / F ----
@query("scan_spans", O.with_spans() + O.flat_select("spans"))
def scan_spans(spark, sf_dir):
    """S5 + schema: the span table read from files, flat."""
    return flat_spans(_spans(spark, sf_dir))


@query(
    "trace_key",
    O.with_spans() + f"SELECT {O.TRACE_KEY_SQL} AS trace_key, id FROM spans",
)
def trace_key_q(spark, sf_dir):
    """key projection (lower-hex over both halves of the trace id)."""
    return _spans(spark, sf_dir).select(trace_key().alias("trace_key"), "id")


FILTER_MIN_DURATION = 100_000  # micros


@query(
    "filter_spans",
    O.with_spans() + O.flat_select(f"(SELECT * FROM spans WHERE duration >= {FILTER_MIN_DURATION} AND name <> 'view')"),
)
def filter_spans(spark, sf_dir):
    """span filter before any grouping (pushed into the scan where possible)."""
    df = _spans(spark, sf_dir)
    return flat_spans(df.filter((F.col("duration") >= FILTER_MIN_DURATION) & (F.col("name") != "view")))


SERVICES = ("svc-1", "svc-4")


@query(
    "filter_service",
    O.with_spans()
    + O.flat_select(
        "(SELECT * FROM spans WHERE len(list_filter(annotations, lambda a: a.endpoint.service_name IN ('svc-1', 'svc-4'))) > 0"
        " OR len(list_filter(binary_annotations, lambda t: t.endpoint.service_name IN ('svc-1', 'svc-4'))) > 0)"
    ),
)
def filter_service(spark, sf_dir):
    """spans of the given services (any annotation or tag endpoint)."""
    return flat_spans(_spans(spark, sf_dir).filter(of_services(SERVICES)))


# ------------------------------------------------------------- adjusters ----
@query(
    "detect_finagle",
    O.with_spans() + f"SELECT trace_id_high, trace_id, id, coalesce({O.FINAGLE_PRED}, FALSE) AS is_finagle FROM spans",
)
def detect_finagle(spark, sf_dir):
    """Finagle detection flag per span."""
    return _spans(spark, sf_dir).select("trace_id_high", "trace_id", "id", A.is_finagle().alias("is_finagle"))


@query("backfill_duration", O.with_spans("bf AS (" + O.backfill_select("spans") + ")") + O.flat_select("bf"))
def backfill_duration(spark, sf_dir):
    """A5 on every span."""
    return flat_spans(A.backfill_timestamp_duration(_spans(spark, sf_dir)))


@query(
    "finagle_adjust",
    O.with_spans("adj AS (" + O.backfill_select("spans", O.FINAGLE_PRED) + ")") + O.flat_select("adj"),
)
def finagle_adjust(spark, sf_dir):
    """Finagle adjuster, backfill on (default)."""
    return flat_spans(A.finagle_adjuster()(_spans(spark, sf_dir)))


@query("finagle_adjust_off", O.with_spans() + O.flat_select("spans"))
def finagle_adjust_off(spark, sf_dir):
    """A7 with applyTimestampAndDuration off: identity."""
    return flat_spans(A.finagle_adjuster(apply_timestamp_and_duration=False)(_spans(spark, sf_dir)))


@query("issue343_adjust", O.with_spans("adj AS (" + O.issue343_select("spans") + ")") + O.flat_select("adj"))
def issue343_adjust(spark, sf_dir):
    """Drop finagle.flush when a tag value is Hit or Miss."""
    return flat_spans(A.issue343_adjuster()(_spans(spark, sf_dir)))


ROOT_SERVER_PRED = "(len(list_filter(annotations, lambda a: a.value = 'sr')) > 0 AND parent_id IS NULL)"


@query(
    "conditional_adjust",
    O.with_spans("adj AS (" + O.backfill_select("spans", ROOT_SERVER_PRED) + ")") + O.flat_select("adj"),
)
def conditional_adjust(spark, sf_dir):
    """A2 + A9: backfill only root spans that have a server receive."""
    return flat_spans(A.root_server_backfill()(_spans(spark, sf_dir)))


PRUNE_TAG_KEYS = ("user.email",)


@query(
    "adjuster_chain",
    O.with_spans(
        "a1 AS (" + O.backfill_select("spans", O.FINAGLE_PRED) + ")",
        "a2 AS (" + O.issue343_select("a1") + ")",
        "a3 AS (SELECT * REPLACE (list_filter(binary_annotations, lambda t: t.key IS DISTINCT FROM 'user.email')"
        " AS binary_annotations) FROM a2)",
    )
    + O.flat_select("a3"),
)
def adjuster_chain(spark, sf_dir):
    """A1: Finagle -> Issue 343 -> prune, in list order, fused into one projection."""
    chain = A.chain([A.finagle_adjuster(), A.issue343_adjuster(), A.prune(tag_keys=PRUNE_TAG_KEYS)])
    return flat_spans(chain(_spans(spark, sf_dir)))


# ------------------------------------------------------- A12 - A15 ----------
PRUNE_ANNOTATIONS = ("finagle.flush",)


@query(
    "prune_tags",
    O.with_spans(
        "p AS (SELECT * REPLACE ("
        "list_filter(binary_annotations, lambda t: t.key IS DISTINCT FROM 'user.email') AS binary_annotations,"
        " list_filter(annotations, lambda a: a.value IS DISTINCT FROM 'finagle.flush') AS annotations) FROM spans)"
    )
    + O.flat_select("p"),
)
def prune_tags(spark, sf_dir):
    """Drop tags and annotations by deny list."""
    return flat_spans(A.prune(tag_keys=PRUNE_TAG_KEYS, annotation_values=PRUNE_ANNOTATIONS)(_spans(spark, sf_dir)))


REKEY_SALT = 0x5DEECE66D


@query(
    "rekey_spans",
    O.with_spans(
        f"r AS (SELECT * REPLACE (xor(id, {REKEY_SALT}) AS id, xor(parent_id, {REKEY_SALT}) AS parent_id) FROM spans)"
    )
    + O.flat_select("r"),
)
def rekey_spans(spark, sf_dir):
    """Consistent id rewrite (ids and parent ids)."""
    return flat_spans(A.rekey(REKEY_SALT)(_spans(spark, sf_dir)))


# fixed values: the alias table used by the normalize query
SERVICE_ALIASES = {"svc-0": "frontend", "svc-5": "billing"}


def _norm_sql(x: str) -> str:
    base = f"CASE WHEN {x} IS NULL OR trim({x}) = '' THEN 'unknown' ELSE lower(trim({x})) END"
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sorted(SERVICE_ALIASES.items()))
    return f"(CASE {base} {cases} ELSE {base} END)"


@query(
    "normalize_service",
    O.with_spans("n AS (" + O.endpoint_map_select("spans", _norm_sql) + ")") + O.flat_select("n"),
)
def normalize_service(spark, sf_dir):
    """Normalise and alias service names in every endpoint."""
    return flat_spans(A.normalize_services(SERVICE_ALIASES)(_spans(spark, sf_dir)))


@query(
    "scrub_tags",
    O.with_spans(
        "s AS (SELECT * REPLACE (list_transform(binary_annotations, lambda t: {'key': t.key,"
        " 'value': CASE WHEN t.type = 'STRING' THEN"
        " regexp_replace(t.value, '[A-Za-z0-9._%+-]+@', '***@', 'g') ELSE t.value END,"
        " 'type': t.type, 'endpoint': t.endpoint}) AS binary_annotations) FROM spans)"
    )
    + O.flat_select("s"),
)
def scrub_tags(spark, sf_dir):
    """Mask e-mail local parts in tag values."""
    return flat_spans(A.scrub()(_spans(spark, sf_dir)))


# ------------------------------------------------------- whole trace --------
@query(
    "group_traces",
    O.with_spans()
    + f"""
SELECT {O.TRACE_KEY_SQL} AS trace_key, count(*) AS n_spans,
  count(*) FILTER (WHERE parent_id IS NULL) AS n_roots,
  min(timestamp) AS first_timestamp, max(timestamp + duration) AS last_end,
  CAST(sum(CASE WHEN {O.ERR_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS n_error_spans,
  count(DISTINCT {O.SVC_SQL}) AS n_services
FROM spans GROUP BY trace_id_high, trace_id
""",
)
def group_traces_q(spark, sf_dir):
    """G1 + F4: spans grouped by trace, one summary row per trace."""
    return T.group_traces(_spans(spark, sf_dir))


@query(
    "merge_by_id",
    O.with_spans(
        """m AS (
  SELECT trace_id_high, trace_id, id, max(parent_id) AS parent_id,
    coalesce(max(CASE WHEN name <> '' THEN name END), '') AS name,
    min(timestamp) AS timestamp, max(duration) AS duration,
    list_distinct(flatten(list(annotations))) AS annotations,
    list_distinct(flatten(list(binary_annotations))) AS binary_annotations
  FROM half_spans GROUP BY trace_id_high, trace_id, id)"""
    )
    + O.flat_select("m"),
)
def merge_by_id_q(spark, sf_dir):
    """A4 + A10: client and server halves of a span merged into one."""
    return flat_spans(T.merge_by_id(_spans(spark, sf_dir, split_halves=True)))


SAMPLE_MIN_DURATION = 400_000


@query(
    "sample_traces",
    O.with_spans(
        f"""k AS (SELECT trace_id_high, trace_id FROM spans GROUP BY trace_id_high, trace_id
  HAVING coalesce(max(duration) >= {SAMPLE_MIN_DURATION}, FALSE) OR bool_or({O.ERR_SQL}))""",
        "s AS (SELECT spans.* FROM spans SEMI JOIN k USING (trace_id_high, trace_id))",
    )
    + O.flat_select("s"),
)
def sample_traces_q(spark, sf_dir):
    """Keep whole traces that are slow or failed."""
    return flat_spans(T.sample_traces(_spans(spark, sf_dir), SAMPLE_MIN_DURATION))


SESSION_GAP = 1_800_000_000  # 30 minutes


@query(
    "trace_sessions",
    O.with_spans(
        "bf AS (" + O.backfill_select("spans") + ")",
        """l AS (SELECT trace_id_high, trace_id, timestamp,
    lag(timestamp) OVER (PARTITION BY trace_id_high, trace_id ORDER BY timestamp) AS prev
  FROM bf WHERE timestamp IS NOT NULL)""",
        f"""g AS (SELECT *, sum(CASE WHEN prev IS NULL OR timestamp - prev >= {SESSION_GAP} THEN 1 ELSE 0 END)
    OVER (PARTITION BY trace_id_high, trace_id ORDER BY timestamp, prev ROWS UNBOUNDED PRECEDING) AS sid FROM l)""",
    )
    + f"""SELECT {O.TRACE_KEY_SQL} AS trace_key, min(timestamp) AS session_start,
  max(timestamp) + {SESSION_GAP} AS session_end, count(*) AS n_spans
FROM g GROUP BY trace_id_high, trace_id, sid""",
)
def trace_sessions_q(spark, sf_dir):
    """Per-trace sessions with a 30 minute gap (backfilled timestamps)."""
    return T.trace_sessions(A.backfill_timestamp_duration(_spans(spark, sf_dir)), SESSION_GAP)


# ------------------------------------------------------------ reports -------
HOUR = 3_600_000_000


@query(
    "spans_per_window",
    O.with_spans("bf AS (" + O.backfill_select("spans") + ")")
    + f"""SELECT timestamp - (timestamp % {HOUR}) AS window_start, {O.SVC_SQL} AS service,
  count(*) AS n_spans, CAST(sum(CASE WHEN {O.ERR_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS n_errors,
  CAST(sum(duration) AS BIGINT) AS sum_duration
FROM bf GROUP BY 1, 2""",
)
def spans_per_window_q(spark, sf_dir):
    """Spans per hour and service."""
    return R.spans_per_window(A.backfill_timestamp_duration(_spans(spark, sf_dir)), "1 hour")


DAY = 86_400_000_000


@query(
    "service_latency",
    O.with_spans("bf AS (" + O.backfill_select("spans") + ")")
    + f"""SELECT {O.SVC_SQL} AS service, timestamp // {DAY} AS bucket,
  count(*) FILTER (WHERE timestamp IS NOT NULL AND duration IS NOT NULL) AS n_spans,
  count(*) FILTER (WHERE timestamp IS NULL OR duration IS NULL) AS n_untimed,
  CAST(sum(duration) AS BIGINT) AS sum_duration, min(duration) AS min_duration, max(duration) AS max_duration,
  quantile_disc(duration, 0.5) AS p50_duration, quantile_disc(duration, 0.95) AS p95_duration
FROM bf GROUP BY 1, 2""",
)
def service_latency_q(spark, sf_dir):
    """Latency report per service and day."""
    return R.service_latency(A.backfill_timestamp_duration(_spans(spark, sf_dir)), DAY)


#: A bucket longer than the data, so that a group holds very many spans.
EVER = 100 * 366 * DAY


@query(
    "latency_overall",
    O.with_spans()
    + f"""SELECT {O.SVC_SQL} AS service, timestamp // {EVER} AS bucket,
  count(*) FILTER (WHERE timestamp IS NOT NULL AND duration IS NOT NULL) AS n_spans,
  count(*) FILTER (WHERE timestamp IS NULL OR duration IS NULL) AS n_untimed,
  CAST(sum(duration) AS BIGINT) AS sum_duration, min(duration) AS min_duration, max(duration) AS max_duration,
  quantile_disc(duration, 0.5) AS p50_duration, quantile_disc(duration, 0.95) AS p95_duration
FROM spans GROUP BY 1, 2""",
)
def latency_overall(spark, sf_dir):
    """Exact percentiles of large groups, and spans without a time in a bucket of their own."""
    return R.service_latency(_spans(spark, sf_dir), EVER)


@query(
    "untimed_windows",
    O.with_spans()
    + f"""SELECT timestamp - (timestamp % {HOUR}) AS window_start, {O.SVC_SQL} AS service,
  count(*) AS n_spans, CAST(sum(CASE WHEN {O.ERR_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS n_errors,
  CAST(sum(duration) AS BIGINT) AS sum_duration
FROM spans GROUP BY 1, 2""",
)
def untimed_windows(spark, sf_dir):
    """Spans per hour and service before backfill; a third of them have no time."""
    return R.spans_per_window(_spans(spark, sf_dir), "1 hour")


@query(
    "dependency_links",
    O.with_spans(
        f"x AS (SELECT trace_id_high, trace_id, id, parent_id, {O.SVC_SQL} AS svc, {O.ERR_SQL} AS err FROM spans)",
        "p AS (SELECT trace_id_high, trace_id, id, min(svc) AS svc FROM x GROUP BY 1, 2, 3)",
    )
    + """SELECT p.svc AS parent, c.svc AS child, count(*) AS call_count,
  CAST(sum(CASE WHEN c.err THEN 1 ELSE 0 END) AS BIGINT) AS error_count
FROM x c JOIN p ON c.trace_id_high = p.trace_id_high AND c.trace_id = p.trace_id AND c.parent_id = p.id
GROUP BY 1, 2""",
)
def dependency_links_q(spark, sf_dir):
    """Service dependency links (parent service -> child service)."""
    return R.dependency_links(_spans(spark, sf_dir))


# ------------------------------------------------------------- decode -------
def _decoded(spark, sf_dir, formats=None):
    msgs = stored_messages(spark, sf_dir)
    return D.decode_messages(msgs) if formats is None else D.decode_messages(msgs, formats)


@query(
    "message_format_counts",
    O.with_spans(O.MESSAGE_CTE)
    + """SELECT CASE WHEN rule = 1 THEN 'empty' WHEN rule IN (2, 4) THEN 'thrift' WHEN rule = 3 THEN 'thrift_list'
  ELSE 'json' END AS format, count(*) AS n_messages FROM msgs GROUP BY 1""",
)
def message_format_counts(spark, sf_dir):
    """K1 + K2: messages per detected format (empty payloads included)."""
    return D.format_counts(stored_messages(spark, sf_dir))


@query("decode_json", O.with_spans() + O.flat_select("(SELECT * FROM spans WHERE (_user_id + _day) % 20 >= 5)"))
def decode_json(spark, sf_dir):
    """K3: spans decoded from JSON list messages (cut messages dropped whole)."""
    return flat_spans(_decoded(spark, sf_dir, (D.FMT_JSON,)).spans)


@query("decode_thrift", O.with_spans() + O.flat_select("(SELECT * FROM spans WHERE (_user_id + _day) % 20 IN (3, 4))"))
def decode_thrift(spark, sf_dir):
    """K4 + K5: spans decoded from thrift lists and single thrift spans."""
    return flat_spans(_decoded(spark, sf_dir, (D.FMT_THRIFT_LIST, D.FMT_THRIFT)).spans)


@query(
    "decode_dead_letter",
    O.with_spans(O.MESSAGE_CTE)
    + """SELECT CASE WHEN rule = 0 THEN 'bad_json' ELSE 'bad_thrift' END AS reason, count(*) AS n_messages
FROM msgs WHERE rule IN (0, 2) GROUP BY 1""",
)
def decode_dead_letter(spark, sf_dir):
    """K6: malformed messages kept whole in a dead-letter table, by reason."""
    return _decoded(spark, sf_dir).dead_letters.groupBy("reason").agg(F.count(F.lit(1)).alias("n_messages"))


@query("decode_spans", O.with_spans() + O.flat_select("(SELECT * FROM spans WHERE (_user_id + _day) % 20 NOT IN (0, 1, 2))"))
def decode_spans(spark, sf_dir):
    """S1 + K1-K6: the whole decode job over every message format."""
    return flat_spans(_decoded(spark, sf_dir).spans)


# --------------------------------------------------- sinks and the job ------
@query("sink_roundtrip", O.with_spans() + O.flat_select("spans"))
def sink_roundtrip(spark, sf_dir):
    """C2 + C6 + S5: spans written to a parquet sink and read back."""
    sink = SinkConfig("parquet", scratch_path(spark, "sink"))
    check_sink(spark, sink)
    write_spans(_spans(spark, sf_dir), sink)
    return flat_spans(read_spans(spark, sink.path))


_CHAIN_SQL = (
    "a1 AS (" + O.backfill_select("(SELECT * FROM spans WHERE (_user_id + _day) % 20 NOT IN (0, 1, 2))", O.FINAGLE_PRED)
    + ")",
    "a2 AS (" + O.issue343_select("a1") + ")",
)


@query("stream_equals_batch", O.with_spans(*_CHAIN_SQL) + O.flat_select("a2"))
def stream_equals_batch(spark, sf_dir):
    """S4 + C1 + G2 + J1-J3: message files streamed one file per trigger
    through decode -> Finagle -> Issue 343 -> parquet sink; the sink then holds
    exactly what the batch job gives."""
    root = scratch_path(spark, "stream")
    write_messages(stored_messages(spark, sf_dir).select("value"), f"{root}/in")
    sink = SinkConfig("parquet", f"{root}/out")
    cfg = JobConfig(
        source=lambda s: message_stream(s, f"{root}/in", max_files_per_trigger=1),
        sink=sink,
        adjusters=[A.finagle_adjuster(), A.issue343_adjuster()],
        dead_letter_sink=SinkConfig("parquet", f"{root}/dead"),
        checkpoint_location=f"{root}/checkpoint",
    )
    run_to_completion(spark, cfg)
    return flat_spans(read_sink(spark, sink).select(*SPAN_COLUMNS))


def _fails_on_some(batch):
    """Renames spans to upper case, and raises if a span's id is divisible by 50."""
    import pyarrow as pa
    import pyarrow.compute as pc

    ids = batch.column("id").to_pylist()
    if any(i % 50 == 0 for i in ids):
        raise RuntimeError("adjuster failure (test)")
    at = batch.schema.get_field_index("name")
    columns = list(batch.columns)
    columns[at] = pc.utf8_upper(columns[at])
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


@query(
    "adjuster_failure",
    O.with_spans(
        "a1 AS (" + O.backfill_select("spans", O.FINAGLE_PRED) + ")",
        "a2 AS (SELECT * REPLACE (CASE WHEN id % 50 = 0 THEN name ELSE upper(name) END AS name) FROM a1)",
        "a3 AS (" + O.issue343_select("a2") + ")",
    )
    + O.flat_select("a3"),
)
def adjuster_failure(spark, sf_dir):
    """A Python adjuster that raises for some spans leaves just those as they were; the chain goes on."""
    chain = A.chain([A.finagle_adjuster(), A.python_adjuster(_fails_on_some), A.issue343_adjuster()])
    return flat_spans(chain(_spans(spark, sf_dir)))


@query(
    "trace_context",
    O.with_spans(
        f"""ctx AS (SELECT trace_id_high, trace_id, count(*) AS trace_span_count, min(timestamp) AS trace_start,
    max(timestamp + duration) AS trace_end, bool_or({O.ERR_SQL}) AS trace_has_error,
    min(CASE WHEN parent_id IS NULL THEN id END) AS trace_root_id
  FROM spans GROUP BY trace_id_high, trace_id)"""
    )
    + """SELECT s.trace_id_high, s.trace_id, s.id, c.trace_span_count, c.trace_start, c.trace_end, c.trace_has_error,
  c.trace_root_id
FROM spans s JOIN ctx c ON s.trace_id_high = c.trace_id_high AND s.trace_id = c.trace_id""",
)
def trace_context_q(spark, sf_dir):
    """A4: per-trace facts joined onto every span (whole-trace context without
    materialising a trace)."""
    return T.with_trace_context(_spans(spark, sf_dir)).select(
        "trace_id_high", "trace_id", "id", "trace_span_count", "trace_start", "trace_end", "trace_has_error",
        "trace_root_id",
    )


# ------------------------------------------- settings, extremes, failures ---
#: Settings of a chain of all adjusters that settings know but merging, which ``merge_by_id`` covers.
CHAIN_SETTINGS = {
    "finagle.enabled": "true",
    "finagle.adjust-issue343": "true",
    "normalize.aliases": ",".join(f"{k}:{v}" for k, v in SERVICE_ALIASES.items()),
    "prune.tag-keys": "error",
    "scrub.enabled": "true",
    "sample.min-duration": str(FILTER_MIN_DURATION),
    "sample.keep-errors": "false",
    "rekey.salt": str(REKEY_SALT),
}


@query(
    "configured_chain",
    O.with_spans(
        "a1 AS (" + O.backfill_select("spans", O.FINAGLE_PRED) + ")",
        "a2 AS (" + O.issue343_select("a1") + ")",
        "a3 AS (" + O.endpoint_map_select("a2", _norm_sql) + ")",
        "a4 AS (SELECT * REPLACE (list_transform(list_filter(binary_annotations, lambda t: t.key <> 'error'),"
        " lambda t: {'key': t.key, 'value': CASE WHEN t.type = 'STRING' THEN"
        " regexp_replace(t.value, '[A-Za-z0-9._%+-]+@', '***@', 'g') ELSE t.value END,"
        " 'type': t.type, 'endpoint': t.endpoint}) AS binary_annotations) FROM a3)",
        f"k AS (SELECT trace_id_high, trace_id FROM a4 GROUP BY ALL HAVING max(duration) >= {FILTER_MIN_DURATION})",
        f"""r AS (SELECT a4.* REPLACE (xor(id, {REKEY_SALT}) AS id, xor(parent_id, {REKEY_SALT}) AS parent_id)
  FROM a4 SEMI JOIN k USING (trace_id_high, trace_id))""",
    )
    + O.flat_select("r"),
)
def configured_chain(spark, sf_dir):
    """J5 + A1: the chain that settings describe: Finagle, Issue 343, normalize, prune, scrub, sample, re-key."""
    return flat_spans(A.chain(A.adjusters_from_settings(CHAIN_SETTINGS))(_spans(spark, sf_dir)))


#: A time so far from zero that a span from its negative to itself is longer than 64 bits hold.
FAR = 9_000_000_000_000_000_000


@query(
    "overflow_spans",
    O.with_spans(
        f"""x AS (SELECT * REPLACE (NULL AS timestamp, NULL AS duration, CASE WHEN id % 10 = 1 THEN list_transform(annotations,
    lambda a: {{'timestamp': CASE WHEN a.value IN ('cs', 'sr') THEN -{FAR} ELSE {FAR} END, 'value': a.value,
      'endpoint': a.endpoint}}) ELSE annotations END AS annotations) FROM spans)""",
        "a1 AS (" + O.backfill_select("x") + ")",
    )
    + O.flat_select("a1"),
)
def overflow_spans(spark, sf_dir):
    """A5 + A11: times at the ends of the 64-bit range; a duration that does not fit stays null, nothing fails."""
    far = F.when(F.col("id") % 10 == 1, F.lit(FAR))

    def moved(a):
        return a.withField("timestamp", F.coalesce(F.when(a["value"].isin("cs", "sr"), -far).otherwise(far), a["timestamp"]))

    none = F.lit(None).cast("bigint")
    extreme = _spans(spark, sf_dir).withColumns({"timestamp": none, "duration": none, "annotations": F.transform("annotations", moved)})
    return flat_spans(A.backfill_timestamp_duration(extreme))


@query(
    "write_failure",
    O.with_spans(O.MESSAGE_CTE)
    + """SELECT 'write_failed' AS reason, trace_id, id, CAST(1 AS BIGINT) AS n FROM spans
WHERE (_user_id + _day) % 20 NOT IN (0, 1, 2)
UNION ALL
SELECT CASE WHEN rule = 0 THEN 'bad_json' ELSE 'bad_thrift' END, NULL, NULL, count(*) FROM msgs WHERE rule IN (0, 2)
GROUP BY 1""",
)
def write_failure(spark, sf_dir):
    """C4 + K6: a sink that always fails and malformed messages in one batch; every span and message is found once."""
    dead = SinkConfig("parquet", scratch_path(spark, "dead"))
    # no driver answers this address, so each write fails at once
    failing = SinkConfig("jdbc", options={"url": "jdbc:none:", "dbtable": "spans"}, max_attempts=2, retry_wait_s=0)
    process_batch(stored_messages(spark, sf_dir).select("value"), 0, [A.finagle_adjuster()], failing, dead)
    found = read_sink(spark, dead)
    failed = F.col("reason").startswith("write_failed")
    lost = D.decode_messages(found.where(failed)).spans.select(F.lit("write_failed").alias("reason"), "trace_id", "id")
    none = F.lit(None).cast("bigint")
    rows = lost.unionByName(found.where(~failed).select("reason", none.alias("trace_id"), none.alias("id")))
    return rows.groupBy("reason", "trace_id", "id").agg(F.count(F.lit(1)).alias("n"))
