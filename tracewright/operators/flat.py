"""Flat scalar view of spans, for reports and engine-to-engine comparison.

Nested arrays are rendered as sorted, comma-joined strings so that a value
hash does not depend on array order or on how another engine prints structs.
``sort_array`` (generated code) is used rather than ``array_sort``, which
Spark rewrites into an interpreted comparator lambda.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _endpoint(ep: Column) -> Column:
    """``service:address:port``, a dash for an address or a port that is missing."""
    dash = F.lit("-")
    address, port = F.coalesce(ep["ipv4"], dash), F.coalesce(ep["port"].cast("string"), dash)
    return F.concat(F.coalesce(ep["service_name"], F.lit("")), F.lit(":"), address, F.lit(":"), port)


def _tag_text(b: Column) -> Column:
    """The text of a string tag; of other kinds the kind and the bytes in hex."""
    kind = F.coalesce(b["type"], F.lit("STRING"))
    text = F.when(kind == "STRING", b["value"].cast("string")).otherwise(F.concat(kind, F.lit(":"), F.lower(F.hex(b["value"]))))
    return F.coalesce(text, F.lit(""))


def annotation_text() -> Column:
    """``value@timestamp@endpoint`` per annotation, sorted, joined by ','."""
    return F.array_join(
        F.sort_array(
            F.transform(
                "annotations",
                lambda a: F.concat_ws(
                    "@",
                    a["value"],
                    a["timestamp"].cast("string"),
                    _endpoint(a["endpoint"]),
                ),
            )
        ),
        ",",
    )


def tag_text() -> Column:
    """``key=value@endpoint`` per tag, sorted, joined by ','."""
    return F.array_join(
        F.sort_array(
            F.transform(
                "binary_annotations",
                lambda b: F.concat(b["key"], F.lit("="), _tag_text(b), F.lit("@"), _endpoint(b["endpoint"])),
            )
        ),
        ",",
    )


FLAT_COLUMNS = (
    "trace_id_high",
    "trace_id",
    "id",
    "parent_id",
    "name",
    "timestamp",
    "duration",
    "n_annotations",
    "annotation_text",
    "n_tags",
    "tag_text",
)


def flat_spans(df: DataFrame) -> DataFrame:
    return df.select(
        "trace_id_high",
        "trace_id",
        "id",
        "parent_id",
        "name",
        "timestamp",
        "duration",
        F.size("annotations").cast("bigint").alias("n_annotations"),
        annotation_text().alias("annotation_text"),
        F.size("binary_annotations").cast("bigint").alias("n_tags"),
        tag_text().alias("tag_text"),
    )
