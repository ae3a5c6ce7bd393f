"""DuckDB SQL for the correctness gate.

Each entry re-derives the expected result straight from the driver's tables
(pre-registered views ``events`` etc.), independently of the Spark code path:
the span CTE below restates the fixture contract in plain SQL, and decode
queries are checked against the spans that were *encoded*, not re-decoded.
"""

from __future__ import annotations

# Span fixture contract (FIXTURES.md section 2) as SQL CTEs.
SPAN_CTES = """
ev AS (
  SELECT event_id, user_id, event_type,
         epoch_us(ts) AS start,
         CAST(round(value * 1000) AS BIGINT) AS dur
  FROM events
),
ev2 AS (SELECT *, start // 86400000000 AS day FROM ev),
roots AS (SELECT user_id, day, min(event_id) AS root_event FROM ev2 GROUP BY user_id, day),
b AS (
  SELECT e.*, r.root_event,
         {'service_name': 'svc-' || CAST(e.user_id % 3 + e.event_id % 4 AS VARCHAR),
          'ipv4': '127.0.0.1',
          'port': CAST(CASE WHEN e.event_id % 6 = 0 THEN NULL ELSE 9411 END AS INTEGER)} AS ep,
         (e.event_id % 5 = 0 OR e.event_id % 2 = 0) AS is_client,
         (e.event_id % 5 = 0 OR e.event_id % 2 = 1) AS is_server,
         (e.event_id % 7 = 0) AS is_open
  FROM ev2 e JOIN roots r ON e.user_id = r.user_id AND e.day = r.day
),
parts AS (
  SELECT *,
    list_filter([
      CASE WHEN is_client THEN {'timestamp': start, 'value': 'cs', 'endpoint': ep} END,
      CASE WHEN is_client AND NOT is_open THEN {'timestamp': start + dur, 'value': 'cr', 'endpoint': ep} END
    ], lambda x: x IS NOT NULL) AS c_anns,
    list_filter([
      CASE WHEN is_server THEN {'timestamp': start + dur // 4, 'value': 'sr', 'endpoint': ep} END,
      CASE WHEN is_server AND NOT is_open
           THEN {'timestamp': start + dur - dur // 4, 'value': 'ss', 'endpoint': ep} END,
      CASE WHEN event_id % 4 = 0
           THEN {'timestamp': start + dur + 80000000, 'value': 'finagle.flush', 'endpoint': ep} END
    ], lambda x: x IS NOT NULL) AS s_anns,
    list_filter([
      CASE WHEN event_id % 3 = 0 THEN {'key': 'srv/finagle.version', 'value': '6.28.0', 'type': 'STRING', 'endpoint': ep} END,
      CASE WHEN event_id % 8 = 0 THEN {'key': 'key', 'value': 'Hit', 'type': 'STRING', 'endpoint': ep} END,
      CASE WHEN event_id % 16 = 4 THEN {'key': 'key', 'value': 'Miss', 'type': 'STRING', 'endpoint': ep} END,
      CASE WHEN event_type = 'error' THEN {'key': 'error', 'value': 'true', 'type': 'STRING', 'endpoint': ep} END,
      {'key': 'user.email', 'value': 'u' || CAST(user_id AS VARCHAR) || '@example.com', 'type': 'STRING', 'endpoint': ep},
      CASE WHEN event_id % 10 = 1 THEN {'key': 'sa', 'value': '01', 'type': 'BOOL', 'endpoint': ep} END,
      CASE WHEN event_id % 12 = 5 THEN {'key': 'blob', 'value': 'fffe8001614062', 'type': 'BYTES', 'endpoint': ep} END,
      CASE WHEN event_id % 9 = 2
           THEN {'key': 'size', 'value': lower(lpad(hex(dur), 16, '0')), 'type': 'I64', 'endpoint': ep} END,
      CASE WHEN event_id % 11 = 3
           THEN {'key': 'ratio', 'value': '3fe0000000000000', 'type': 'DOUBLE', 'endpoint': ep} END
    ], lambda x: x IS NOT NULL) AS tags
  FROM b
),
spans AS (
  SELECT CASE WHEN user_id % 10 = 0 THEN user_id ELSE 0 END AS trace_id_high,
         user_id * 100000 + day AS trace_id,
         event_id + 1 AS id,
         CASE WHEN event_id = root_event THEN NULL ELSE root_event + 1 END AS parent_id,
         event_type AS name,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE start END AS timestamp,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE dur END AS duration,
         list_concat(c_anns, s_anns) AS annotations,
         tags AS binary_annotations,
         user_id AS _user_id, day AS _day
  FROM parts
),
halves AS (
  SELECT p.*, unnest(CASE WHEN event_id % 5 = 0 THEN ['client', 'server'] ELSE ['whole'] END) AS role
  FROM parts p
),
half_spans AS (
  SELECT CASE WHEN user_id % 10 = 0 THEN user_id ELSE 0 END AS trace_id_high,
         user_id * 100000 + day AS trace_id,
         event_id + 1 AS id,
         CASE WHEN event_id = root_event THEN NULL ELSE root_event + 1 END AS parent_id,
         CASE WHEN role = 'client' THEN '' ELSE event_type END AS name,
         CASE WHEN event_id % 3 = 0 OR role = 'server' THEN NULL ELSE start END AS timestamp,
         CASE WHEN event_id % 3 = 0 OR role = 'server' THEN NULL ELSE dur END AS duration,
         CASE WHEN role = 'client' THEN c_anns WHEN role = 'server' THEN s_anns
              ELSE list_concat(c_anns, s_anns) END AS annotations,
         tags AS binary_annotations
  FROM halves
)
"""


def flat_select(rel: str) -> str:
    """The flat scalar view (operators/flat.py) over relation ``rel``; values of tags that are no strings are hex here."""
    endpoint = lambda v: (
        f"coalesce({v}.endpoint.service_name, '') || ':' || coalesce({v}.endpoint.ipv4, '-') || ':'"
        f" || coalesce(CAST({v}.endpoint.port AS VARCHAR), '-')"
    )
    return f"""
SELECT trace_id_high, trace_id, id, parent_id, name, timestamp, duration,
  CAST(len(annotations) AS BIGINT) AS n_annotations,
  array_to_string(list_sort(list_transform(annotations, lambda a: concat_ws('@', a.value,
      CAST(a.timestamp AS VARCHAR), {endpoint('a')}))), ',')
    AS annotation_text,
  CAST(len(binary_annotations) AS BIGINT) AS n_tags,
  array_to_string(list_sort(list_transform(binary_annotations, lambda t: t.key || '='
      || CASE WHEN t.type = 'STRING' THEN '' ELSE t.type || ':' END || coalesce(t.value, '')
      || '@' || {endpoint('t')})), ',') AS tag_text
FROM {rel}
"""


def with_spans(*ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return "WITH " + SPAN_CTES + extra + "\n"


# A5 contract as SQL over relation ``rel`` (all columns kept, two replaced).
def backfill_select(rel: str, pred: str = "TRUE") -> str:
    return f"""
SELECT trace_id_high, trace_id, id, parent_id, name,
  CASE WHEN coalesce({pred}, FALSE) THEN coalesce(timestamp, st) ELSE timestamp END AS timestamp,
  CASE WHEN coalesce({pred}, FALSE) THEN coalesce(duration, CASE WHEN en > st THEN TRY_CAST(CAST(en AS HUGEINT) - CAST(st AS HUGEINT) AS BIGINT) END)
       ELSE duration END AS duration,
  annotations, binary_annotations
FROM (
  SELECT *,
    CASE WHEN cs IS NOT NULL THEN cs ELSE sr END AS st,
    CASE WHEN cs IS NOT NULL THEN cr ELSE ss END AS en
  FROM (
    SELECT *,
      list_min(list_transform(list_filter(annotations, lambda a: a.value = 'cs'), lambda a: a.timestamp)) AS cs,
      list_max(list_transform(list_filter(annotations, lambda a: a.value = 'cr'), lambda a: a.timestamp)) AS cr,
      list_min(list_transform(list_filter(annotations, lambda a: a.value = 'sr'), lambda a: a.timestamp)) AS sr,
      list_max(list_transform(list_filter(annotations, lambda a: a.value = 'ss'), lambda a: a.timestamp)) AS ss
    FROM {rel}
  )
)
"""


FINAGLE_PRED = "len(list_filter(binary_annotations, lambda t: contains(t.key, 'finagle.version'))) > 0"
FLUSH_PRED = (
    "(len(list_filter(annotations, lambda a: a.value = 'finagle.flush')) > 0"
    " AND len(list_filter(binary_annotations, lambda t: t.value IN ('Hit', 'Miss'))) > 0)"
)


def issue343_select(rel: str) -> str:
    return f"""
SELECT trace_id_high, trace_id, id, parent_id, name, timestamp, duration,
  CASE WHEN {FLUSH_PRED}
       THEN list_filter(annotations, lambda a: a.value IS DISTINCT FROM 'finagle.flush')
       ELSE annotations END AS annotations,
  binary_annotations
FROM {rel}
"""


TRACE_KEY_SQL = (
    "(CASE WHEN trace_id_high <> 0 THEN lower(lpad(hex(trace_id_high), 16, '0')) ELSE '' END"
    " || lower(lpad(hex(trace_id), 16, '0')))"
)


SVC_SQL = (
    "coalesce(list_min(list_transform(annotations, lambda a: a.endpoint.service_name)),"
    " list_min(list_transform(binary_annotations, lambda t: t.endpoint.service_name)))"
)
ERR_SQL = "(len(list_filter(binary_annotations, lambda t: t.key = 'error')) > 0)"


def endpoint_map_select(rel: str, fn) -> str:
    """Rewrite every endpoint service name of ``rel`` with SQL ``fn(x)``."""
    ep = lambda v: (
        f"CASE WHEN {v}.endpoint IS NULL THEN NULL ELSE {{'service_name': {fn(v + '.endpoint.service_name')},"
        f" 'ipv4': {v}.endpoint.ipv4, 'port': {v}.endpoint.port}} END"
    )
    return f"""
SELECT trace_id_high, trace_id, id, parent_id, name, timestamp, duration,
  list_transform(annotations, lambda a: {{'timestamp': a.timestamp, 'value': a.value, 'endpoint': {ep('a')}}})
    AS annotations,
  list_transform(binary_annotations, lambda t: {{'key': t.key, 'value': t.value,
    'type': t.type, 'endpoint': {ep('t')}}}) AS binary_annotations
FROM {rel}
"""


# Fixture messages (sources/messages.py): one row per message with its rule.
MESSAGE_CTE = """msgs AS (
  SELECT DISTINCT _user_id, _day, id // 64 AS chunk, (_user_id + _day) % 20 AS rule
  FROM spans WHERE (_user_id + _day) % 20 <> 4
  UNION ALL
  SELECT _user_id, _day, id AS chunk, 4 AS rule FROM spans WHERE (_user_id + _day) % 20 = 4
)"""
