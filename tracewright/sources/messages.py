"""Span messages: encode spans as the byte payloads a transport carries.

Encoders are pure Column expressions (JVM-side): JSON via ``to_json`` and
TBinaryProtocol via ``concat`` of big-endian fields built with ``hex``/
``unhex``. The fixture message table groups the spans of a trace into
messages of at most ``MESSAGE_CHUNK`` spans (ids ``[k*64, (k+1)*64)``), so a
message never grows with the trace: a hot trace becomes many messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.ids import hex16, trace_key
from tracewright.operators.thrift import ANNOTATION_TYPES
from tracewright.sources.events import MESSAGE_CHUNK, TRACE_ID_STRIDE, spans_from_events

# --- fixed values: thrift TBinaryProtocol type codes ------------------------
T_STOP, T_BOOL, T_I16, T_I32, T_I64, T_STRING, T_STRUCT, T_LIST = 0, 2, 6, 8, 10, 11, 12, 15


# ---------------------------------------------------------------- JSON ------
_JSON_EP = "struct<serviceName:string,ipv4:string,port:int>"
_JSON_ANNOTATIONS = f"array<struct<timestamp:bigint,value:string,endpoint:{_JSON_EP}>>"


def _json_tag(b: Column) -> Column:
    """A tag as JSON has it: BOOL bare, numbers bare, BYTES in base64; the type is left out where the value shows it."""
    kind, raw = F.coalesce(b["type"], F.lit("STRING")), F.hex(b["value"])
    sign = F.when(raw.rlike("^[89A-F]"), F.lit("F")).otherwise(F.lit("0"))
    whole = F.conv(F.lpad(raw, 16, sign), 16, -10).try_cast("bigint")
    double = F.try_reflect(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), F.coalesce(whole, F.lit(0).cast("bigint")))
    value = (
        F.when(kind == "STRING", b["value"].cast("string").cast("variant"))
        .when(kind == "BOOL", (b["value"] != F.lit(b"\x00")).cast("variant"))
        .when(kind == "BYTES", F.base64(b["value"]).cast("variant"))
        .when(kind == "DOUBLE", double.try_cast("double").cast("variant"))
        .otherwise(whole.cast("variant"))
    )
    return F.struct(
        b["key"].alias("key"),
        value.alias("value"),
        F.when(~kind.isin("STRING", "BOOL"), kind).alias("type"),
        b["endpoint"].cast(_JSON_EP).alias("endpoint"),
    )


def span_json_struct() -> Column:
    """Span in the v1 JSON layout (hex ids; null fields are omitted).

    Annotations are renamed by a positional cast (generated code) rather than
    a per-element lambda; tags need one, as each has its own kind.
    """
    return F.struct(
        trace_key().alias("traceId"),
        hex16("id").alias("id"),
        F.when(F.col("parent_id").isNotNull(), hex16("parent_id")).alias("parentId"),
        F.col("name").alias("name"),
        F.col("timestamp").alias("timestamp"),
        F.col("duration").alias("duration"),
        F.col("annotations").cast(_JSON_ANNOTATIONS).alias("annotations"),
        F.transform("binary_annotations", _json_tag).alias("binaryAnnotations"),
    )


# -------------------------------------------------------------- thrift ------
def _i64(c: Column) -> Column:
    return F.unhex(F.lpad(F.hex(c.cast("bigint")), 16, "0"))


def _i32(c: Column) -> Column:
    return F.unhex(F.lpad(F.hex(c.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))


def _i16(c: Column) -> Column:
    return F.unhex(F.lpad(F.hex(c.cast("bigint").bitwiseAND(F.lit(0xFFFF))), 4, "0"))


def _hdr(ttype: int, fid: int) -> Column:
    return F.lit(bytes([ttype, fid >> 8, fid & 0xFF]))


def _str(c: Column) -> Column:
    b = c.cast("binary")
    return F.concat(_i32(F.octet_length(b)), b)


def _opt(cond: Column, payload: Column) -> Column:
    return F.coalesce(F.when(cond, payload), F.lit(b""))


def _ipv4_int(c: Column) -> Column:
    p = F.split(c, r"\.")
    return (
        p.getItem(0).cast("bigint") * 16777216
        + p.getItem(1).cast("bigint") * 65536
        + p.getItem(2).cast("bigint") * 256
        + p.getItem(3).cast("bigint")
    )


def _endpoint_thrift(ep: Column) -> Column:
    return F.concat(
        _opt(ep["ipv4"].isNotNull(), F.concat(_hdr(T_I32, 1), _i32(_ipv4_int(ep["ipv4"])))),
        _opt(ep["port"].isNotNull(), F.concat(_hdr(T_I16, 2), _i16(ep["port"]))),
        _opt(ep["service_name"].isNotNull(), F.concat(_hdr(T_STRING, 3), _str(ep["service_name"]))),
        F.lit(bytes([T_STOP])),
    )


def _list(fid: int, arr: str, enc) -> Column:
    items = F.aggregate(F.transform(arr, enc), F.lit(b""), lambda acc, x: F.concat(acc, x))
    return F.concat(_hdr(T_LIST, fid), F.lit(bytes([T_STRUCT])), _i32(F.size(arr)), items)


def _type_code(kind: Column) -> Column:
    """Number of a tag's kind; no kind is STRING."""
    position = F.array_position(F.array(*[F.lit(t) for t in ANNOTATION_TYPES]), F.coalesce(kind, F.lit("STRING")))
    return position - 1


def span_thrift() -> Column:
    """One span as a TBinaryProtocol struct."""
    ann = lambda a: F.concat(
        _opt(a["timestamp"].isNotNull(), F.concat(_hdr(T_I64, 1), _i64(a["timestamp"]))),
        _opt(a["value"].isNotNull(), F.concat(_hdr(T_STRING, 2), _str(a["value"]))),
        _opt(a["endpoint"].isNotNull(), F.concat(_hdr(T_STRUCT, 3), _endpoint_thrift(a["endpoint"]))),
        F.lit(bytes([T_STOP])),
    )
    bann = lambda b: F.concat(
        _opt(b["key"].isNotNull(), F.concat(_hdr(T_STRING, 1), _str(b["key"]))),
        _opt(b["value"].isNotNull(), F.concat(_hdr(T_STRING, 2), _i32(F.octet_length(b["value"])), b["value"])),
        F.concat(_hdr(T_I32, 3), _i32(_type_code(b["type"]))),
        _opt(b["endpoint"].isNotNull(), F.concat(_hdr(T_STRUCT, 4), _endpoint_thrift(b["endpoint"]))),
        F.lit(bytes([T_STOP])),
    )
    c = F.col
    return F.concat(
        _hdr(T_I64, 1), _i64(c("trace_id")),
        _hdr(T_STRING, 3), _str(c("name")),
        _hdr(T_I64, 4), _i64(c("id")),
        _opt(c("parent_id").isNotNull(), F.concat(_hdr(T_I64, 5), _i64(c("parent_id")))),
        _list(6, "annotations", ann),
        _list(8, "binary_annotations", bann),
        _opt(c("timestamp").isNotNull(), F.concat(_hdr(T_I64, 10), _i64(c("timestamp")))),
        _opt(c("duration").isNotNull(), F.concat(_hdr(T_I64, 11), _i64(c("duration")))),
        _opt(c("trace_id_high") != 0, F.concat(_hdr(T_I64, 12), _i64(c("trace_id_high")))),
        F.lit(bytes([T_STOP])),
    )


def thrift_list(spans_arr: Column) -> Column:
    """A message holding a list of encoded spans (first byte = STRUCT)."""
    items = F.aggregate(spans_arr, F.lit(b""), lambda acc, x: F.concat(acc, x))
    return F.concat(F.lit(bytes([T_STRUCT])), _i32(F.size(spans_arr)), items)


# ------------------------------------------------- fixture message table ---
# Message rule by (user_id + day) % 20 (FIXTURES.md section 2, extended with
# the two thrift encodings):
#   0 JSON list with the last 5 characters cut off   -> dead letter bad_json
#   1 empty payload                                   -> zero spans, silently
#   2 the text "not spans"                            -> dead letter bad_thrift
#   3 thrift list of spans
#   4 one thrift span per message (historical encoding)
#   else intact JSON list
RULE_CUT, RULE_EMPTY, RULE_TEXT, RULE_THRIFT_LIST, RULE_THRIFT_SINGLE = 0, 1, 2, 3, 4


def fixture_messages(events: DataFrame) -> DataFrame:
    """The message table (``key``, ``value`` BINARY) derived from ``events``."""
    return fixture_messages_from_spans(spans_from_events(events))


def fixture_messages_from_spans(spans: DataFrame) -> DataFrame:
    """Message table from the fixture span table (user and day are recovered
    from ``trace_id = user_id * 100000 + day``)."""
    spans = spans.withColumns(
        {"_user_id": F.expr(f"trace_id div {TRACE_ID_STRIDE}"), "_day": F.col("trace_id") % TRACE_ID_STRIDE}
    )
    rule = (F.col("_user_id") + F.col("_day")) % 20
    staged = spans.select(
        rule.alias("_rule"),
        "_user_id",
        "_day",
        F.expr(f"id div {MESSAGE_CHUNK}").alias("_chunk"),
        trace_key().alias("_key"),
        "id",
        F.when(rule.isin(RULE_THRIFT_LIST, RULE_THRIFT_SINGLE), span_thrift()).alias("_thrift"),
        F.when(~rule.isin(RULE_THRIFT_LIST, RULE_THRIFT_SINGLE), F.to_json(span_json_struct())).alias("_json"),
    )
    single = staged.filter(F.col("_rule") == RULE_THRIFT_SINGLE).select(
        F.col("_key").cast("binary").alias("key"), F.col("_thrift").alias("value")
    )
    grouped = (
        staged.filter(F.col("_rule") != RULE_THRIFT_SINGLE)
        .groupBy("_user_id", "_day", "_chunk", "_rule", "_key")
        .agg(F.sort_array(F.collect_list(F.struct("id", "_json", "_thrift"))).alias("_s"))
    )
    json_text = F.concat(F.lit("["), F.array_join(F.transform("_s", lambda x: x["_json"]), ","), F.lit("]"))
    r = F.col("_rule")
    value = (
        F.when(r == RULE_CUT, F.expr("substring(_jt, 1, length(_jt) - 5)").cast("binary"))
        .when(r == RULE_EMPTY, F.lit(b""))
        .when(r == RULE_TEXT, F.lit("not spans").cast("binary"))
        .when(r == RULE_THRIFT_LIST, thrift_list(F.transform("_s", lambda x: x["_thrift"])))
        .otherwise(F.col("_jt").cast("binary"))
    )
    grouped = grouped.withColumn("_jt", json_text).select(F.col("_key").cast("binary").alias("key"), value.alias("value"))
    return grouped.unionByName(single)


def messages_table(spark, sf_dir: str) -> DataFrame:
    return fixture_messages(spark.read.parquet(f"{sf_dir}/events.parquet"))
