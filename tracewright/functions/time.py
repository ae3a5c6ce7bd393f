"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_micros(c: str, dtype: T.DataType | None = None) -> Column:
    """Epoch microseconds of a timestamp column.

    ``timestamp_ntz`` is read as UTC wall time via ``timestampdiff`` (no
    dependence on ``spark.sql.session.timeZone``); ``timestamp`` is an instant
    already, so ``unix_micros`` is exact.
    """
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(c))
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{c}`)")
