"""Predicates and accessors over the span arrays.

They read single fields of the arrays' structs (``annotations.value`` is an
array of values), so scans are pruned to those fields.

``exists`` over an array holding nulls, or over a null array, can be null, so
every predicate is wrapped in ``coalesce(..., false)``: a null predicate counts
as "do not adjust".
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewright.schema import ERROR_KEY


def _bool(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def has_annotation(value: str) -> Column:
    """Reads the values only, by a function of the leaf array."""
    return _bool(F.array_contains(F.col("annotations.value"), value))


def has_tag_key_containing(part: str) -> Column:
    """Any tag key containing ``part`` (case-sensitive substring)."""
    return _bool(F.exists(F.col("binary_annotations.key"), lambda k: F.instr(k, part) > 0))


def has_tag_value_in(values: Iterable[str]) -> Column:
    """Any tag whose value, read as UTF-8, equals one of ``values`` (key ignored)."""
    vals = [F.lit(v) for v in values]
    return _bool(F.exists(F.col("binary_annotations.value"), lambda v: v.cast("string").isin(*vals)))


def has_error_tag() -> Column:
    return _bool(F.array_contains(F.col("binary_annotations.key"), ERROR_KEY))


def span_service() -> Column:
    """Contract: the smallest non-null service name among annotation endpoints,
    else among tag endpoints, else null."""
    ann = F.array_min(F.col("annotations.endpoint.service_name"))
    tag = F.array_min(F.col("binary_annotations.endpoint.service_name"))
    return F.coalesce(ann, tag)


def of_services(services: Iterable[str]) -> Column:
    """any annotation or tag endpoint has one of the service names."""
    names = F.array(*[F.lit(s) for s in services])
    met = F.arrays_overlap(F.col("annotations.endpoint.service_name"), names)
    return _bool(met) | _bool(F.arrays_overlap(F.col("binary_annotations.endpoint.service_name"), names))
