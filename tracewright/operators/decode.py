"""Decode job: message table (``value`` BINARY) -> span table + dead letters.

* K1 format detection and K2 empty payloads are column expressions.
* K3 JSON: ``from_json`` with every scalar read as a string, then validated
  with patterns / ``try_cast`` by a ``forall`` over the message's array, so a
  single bad field drops the *whole message* (K6), as the reference does.
  Numbers may be quoted but not padded; a name is text (or a number, or null).
  Bytes that are no UTF-8 become the replacement character, in both formats.
  No shuffle: a message is decoded within its row.
* K4/K5 thrift: an Arrow UDF in the same projection that reads all messages of a
  batch together; only thrift rows send their bytes (other rows send null). Failures become dead letters, never
  exceptions.

The message table is scanned once. Each message yields ``(value, spans
ARRAY<span>, reason)``; good messages are exploded into spans, bad ones
become ``(value, reason)``.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.operators import thrift_columns
from tracewright.schema import SPAN_COLUMNS, SPAN_SCHEMA
from tracewright.session import ship_package

FMT_EMPTY, FMT_JSON, FMT_THRIFT_LIST, FMT_THRIFT = "empty", "json", "thrift_list", "thrift"
BAD_JSON, BAD_THRIFT = "bad_json", "bad_thrift"


def message_format(value: str | Column = "value") -> Column:
    """K1/K2: first byte '[' -> json, 12 -> thrift list, else one thrift span."""
    v = F.col(value) if isinstance(value, str) else value
    first = F.substring(v, 1, 1)
    return (
        F.when(v.isNull() | (F.octet_length(v) == 0), F.lit(FMT_EMPTY))
        .when(first == F.lit(b"["), F.lit(FMT_JSON))
        .when(first == F.lit(bytes([12])), F.lit(FMT_THRIFT_LIST))
        .otherwise(F.lit(FMT_THRIFT))
    )


def format_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy(message_format().alias("format")).agg(F.count(F.lit(1)).alias("n_messages"))


# ---------------------------------------------------------------- JSON ------
_EP = "struct<serviceName:string,ipv4:string,port:string>"
JSON_SCHEMA = (
    "array<struct<traceId:string,id:string,parentId:string,name:variant,timestamp:string,duration:string,"
    f"annotations:array<struct<timestamp:string,value:string,endpoint:{_EP}>>,"
    f"binaryAnnotations:array<struct<key:string,value:variant,type:string,endpoint:{_EP}>>>>"
)


def _is_long(c: Column) -> Column:
    """A whole number of 64 bits, bare or quoted, with nothing around it."""
    return c.rlike("^-?[0-9]+$") & c.try_cast("bigint").isNotNull()


def _opt_long(c: Column) -> Column:
    return c.isNull() | _is_long(c)


def _ep_ok(ep: Column) -> Column:
    return ep.isNull() | ep["port"].isNull() | (ep["port"].rlike("^-?[0-9]+$") & ep["port"].try_cast("int").isNotNull())


def _tag_kind(b: Column) -> Column:
    """A bare ``true`` or ``false`` is a BOOL, anything else is a STRING unless its type says more."""
    return F.when(F.schema_of_variant(b["value"]) == "BOOLEAN", F.lit("BOOL")).otherwise(F.coalesce(b["type"], F.lit("STRING")))


def _low_bytes(c: Column, n: int) -> Column:
    """The last ``n`` bytes of a whole number, big-endian."""
    return F.unhex(F.right(F.lpad(F.hex(c.cast("bigint")), 16, "0"), F.lit(2 * n)))


def _double_bits(c: Column) -> Column:
    bits = F.try_reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.coalesce(c, F.lit(0.0)))
    return F.when(c.isNotNull(), bits.try_cast("bigint"))


def _tag_value(b: Column) -> Column:
    """A tag's value in the bytes that thrift has for its kind; null if the value does not fit the kind.

    Text and base64 must be quoted, I16 and I32 must not be, I64 and DOUBLE may be either.
    """
    form, text = F.schema_of_variant(b["value"]), F.try_variant_get(b["value"], "$", "string")
    kind, quoted = F.coalesce(b["type"], F.lit("STRING")), form == "STRING"
    return (
        F.when(quoted & (kind == "STRING"), text.cast("binary"))
        .when(form == "BOOLEAN", F.when(text == "true", F.lit(b"\x01")).otherwise(F.lit(b"\x00")))
        .when(quoted & (kind == "BYTES"), F.try_to_binary(text, F.lit("base64")))
        .when(~quoted & (kind == "I16"), _low_bytes(text.try_cast("smallint"), 2))
        .when(~quoted & (kind == "I32"), _low_bytes(text.try_cast("int"), 4))
        .when(kind == "I64", _low_bytes(text.try_cast("bigint"), 8))
        .when(kind == "DOUBLE", _low_bytes(_double_bits(text.try_cast("double")), 8))
    )


def _span_ok(s: Column) -> Column:
    """All of a span but its tags' values, which :func:`_tags_ok` sees once they are typed."""
    anns_ok = F.forall(
        F.coalesce(s["annotations"], F.array()),
        lambda a: a.isNotNull() & _is_long(a["timestamp"]) & a["value"].isNotNull() & _ep_ok(a["endpoint"]),
    )
    tags_ok = F.forall(
        F.coalesce(s["binaryAnnotations"], F.array()),
        lambda b: b.isNotNull() & b["key"].isNotNull() & _ep_ok(b["endpoint"]),
    )
    return F.coalesce(
        s.isNotNull()
        & s["traceId"].rlike("^[0-9a-f]{1,32}$")
        & s["id"].rlike("^[0-9a-f]{1,16}$")
        & (s["parentId"].isNull() | s["parentId"].rlike("^[0-9a-f]{1,16}$"))
        & (s["name"].isNull() | ~F.schema_of_variant(s["name"]).rlike("^(OBJECT|ARRAY|BOOLEAN)"))
        & _opt_long(s["timestamp"])
        & _opt_long(s["duration"])
        & anns_ok
        & tags_ok,
        F.lit(False),
    )


def _tags_ok(s: Column) -> Column:
    """Every tag of a typed span has a value: one that does not fit its kind is null."""
    return F.forall(s["binary_annotations"], lambda b: b["value"].isNotNull())


def _ep_typed(ep: Column) -> Column:
    return F.when(
        ep.isNotNull(),
        F.struct(
            ep["serviceName"].alias("service_name"),
            ep["ipv4"].alias("ipv4"),
            ep["port"].try_cast("int").alias("port"),
        ),
    )


def _hex_long(c: Column) -> Column:
    """Already-validated lower hex (1-16 digits) -> signed BIGINT."""
    return F.conv(c, 16, -10).cast("bigint")


def _span_typed(s: Column) -> Column:
    """Typed span from a validated JSON span (patterns were checked already)."""
    tid = s["traceId"]
    n = F.length(tid)
    high = F.when(n > 16, _hex_long(tid.substr(F.lit(1), n - 16))).otherwise(F.lit(0).cast("bigint"))
    low = F.when(n > 16, _hex_long(F.substring(tid, -16, 16))).otherwise(_hex_long(tid))
    return F.struct(
        high.alias("trace_id_high"),
        low.alias("trace_id"),
        _hex_long(s["id"]).alias("id"),
        _hex_long(s["parentId"]).alias("parent_id"),
        F.coalesce(F.try_variant_get(s["name"], "$", "string"), F.lit("")).alias("name"),
        s["timestamp"].try_cast("bigint").alias("timestamp"),
        s["duration"].try_cast("bigint").alias("duration"),
        F.transform(
            F.coalesce(s["annotations"], F.array()),
            lambda a: F.struct(
                a["timestamp"].try_cast("bigint").alias("timestamp"),
                a["value"].alias("value"),
                _ep_typed(a["endpoint"]).alias("endpoint"),
            ),
        ).alias("annotations"),
        F.transform(
            F.coalesce(s["binaryAnnotations"], F.array()),
            lambda b: F.struct(
                b["key"].alias("key"),
                _tag_value(b).alias("value"),
                _tag_kind(b).alias("type"),
                _ep_typed(b["endpoint"]).alias("endpoint"),
            ),
        ).alias("binary_annotations"),
    )


# -------------------------------------------------------------- thrift ------
_SPANS_TYPE = T.ArrayType(SPAN_SCHEMA, True)
_THRIFT_RESULT = T.StructType(
    [T.StructField("spans", _SPANS_TYPE, True), T.StructField("reason", T.StringType(), True)]
)


def _arrow_type(dt: T.DataType) -> pa.DataType:
    if isinstance(dt, T.StructType):
        return pa.struct([pa.field(f.name, _arrow_type(f.dataType), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return pa.list_(_arrow_type(dt.elementType))
    return {
        T.LongType: pa.int64(),
        T.IntegerType: pa.int32(),
        T.StringType: pa.string(),
        T.BinaryType: pa.binary(),
    }[type(dt)]


def _decode_thrift_array(values: pa.Array) -> pa.Array:
    """Arrow batch of payloads (null = not a thrift row) -> struct(spans, reason)."""
    return thrift_columns.decode(values, _arrow_type(_SPANS_TYPE).value_type, BAD_THRIFT)


_thrift_udf = F.arrow_udf(_decode_thrift_array, _THRIFT_RESULT)


# ------------------------------------------------------------- the job ------
def _explode_spans(per_message: DataFrame) -> DataFrame:
    """One row per span. ``explode`` would make Catalyst infer a
    ``size(spans) > 0`` filter and push it below the projection, evaluating
    the whole parse/validate/type expression twice; ``explode_outer`` plus a
    null check above the generator keeps it to one evaluation."""
    return (
        per_message.select(F.explode_outer("spans").alias("s"))
        .filter(F.col("s").isNotNull())
        .select(*[F.col(f"s.{c}").alias(c) for c in SPAN_COLUMNS])
    )


def _dead_of(per_message: DataFrame) -> DataFrame:
    """Rows with a reason. A filter on ``reason`` would be pushed below the
    projection and inline the parse; a generator output cannot be."""
    return per_message.select(
        "value", F.explode_outer(F.when(F.col("reason").isNotNull(), F.array("reason"))).alias("reason")
    ).filter(F.col("reason").isNotNull())


@dataclass(frozen=True)
class Decoded:
    """Lazy results of one decode: ``per_message`` rows are ``(value, spans
    ARRAY<span>, reason)``. Persist it (the streaming job does) when both
    outputs are written, so the decode runs once."""

    per_message: DataFrame

    @classmethod
    def from_per_message(cls, per_message: DataFrame) -> "Decoded":
        return cls(per_message)

    @property
    def spans(self) -> DataFrame:
        return _explode_spans(self.per_message)

    @property
    def dead_letters(self) -> DataFrame:
        return _dead_of(self.per_message)


def decode_messages(messages: DataFrame, formats: tuple[str, ...] = (FMT_JSON, FMT_THRIFT_LIST, FMT_THRIFT)) -> Decoded:
    """One pass over the message table: every row gets its format, JSON rows
    are parsed in the JVM, and only thrift rows' bytes reach the Arrow UDF
    (other rows send null). Empty payloads yield no spans and no dead letter
    (K2). ``formats`` restricts which formats are decoded (others vanish)."""
    sc = messages.sparkSession.sparkContext
    if FMT_THRIFT_LIST in formats or FMT_THRIFT in formats:
        ship_package(messages.sparkSession)
    cols, ok_col, typed, spans, reason = _decoding(sc.applicationId, tuple(formats))
    parsed = messages.select("value").withColumn("_fmt", message_format()).select(*cols)
    # staged, so that each message is checked and typed once
    parsed = parsed.withColumn("_ok", ok_col).withColumn("_s", typed)
    return Decoded(parsed.select("value", spans.alias("spans"), reason.alias("reason")))


@functools.lru_cache(maxsize=8)
def _decoding(app: str, formats: tuple[str, ...]) -> tuple[list[Column], Column, Column, Column, Column]:
    """The columns of :func:`decode_messages`, built once for an application ``app``: a stream decodes every micro-batch by them."""
    fmt = F.col("_fmt")
    is_json = fmt == FMT_JSON if FMT_JSON in formats else F.lit(False)
    thrift_fmts = [f for f in (FMT_THRIFT_LIST, FMT_THRIFT) if f in formats]
    is_thrift = fmt.isin(*thrift_fmts) if thrift_fmts else F.lit(False)

    text = F.expr("make_valid_utf8(cast(value as string))")
    # The parser stops after the first value. A text that is one value both as a field and as the only element of a
    # list has nothing behind that value: whatever would end one of them early is an error in the other.
    field = F.from_json(F.concat(F.lit('{"a":'), text, F.lit("}")), f"struct<a:{JSON_SCHEMA}>")["a"]
    alone = F.size(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")) == 1
    cols = [F.col("value"), fmt, F.when(is_json & alone, field).alias("_p")]
    if thrift_fmts:
        cols.append(_thrift_udf(F.when(is_thrift, F.col("value"))).alias("_t"))

    checked = is_json & F.coalesce(F.col("_p").isNotNull() & F.forall("_p", _span_ok), F.lit(False))
    typed = F.when(F.col("_ok"), F.transform("_p", _span_typed))
    ok = F.coalesce(F.forall("_s", _tags_ok), F.lit(False))
    spans = F.when(is_json & ok, F.col("_s"))
    reason = F.when(is_json & ~ok, F.lit(BAD_JSON))
    if thrift_fmts:
        spans = spans.when(is_thrift, F.col("_t.spans"))
        reason = reason.when(is_thrift, F.col("_t.reason"))
    return cols, checked, typed, spans, reason
