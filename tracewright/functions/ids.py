"""Span and trace identifiers: lower-hex encode / decode as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hex16(c: str | Column) -> Column:
    """64-bit id as 16 lower-hex digits (two's complement for negatives)."""
    return F.lower(F.lpad(F.hex(_col(c)), 16, "0"))


def trace_key(high: str | Column = "trace_id_high", low: str | Column = "trace_id") -> Column:
    """Lower-hex trace key: 16 digits when the high half is 0, else 32.

    The same low half with and without a high half gives two different keys.
    """
    h = _col(high)
    return F.concat(F.when(h != 0, hex16(h)).otherwise(F.lit("")), hex16(low))
