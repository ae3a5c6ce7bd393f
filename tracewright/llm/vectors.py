"""Rows of embeddings: which take part, and their entries as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Quantised entries beyond this count as this, so that they stay longs.
MOST = 2**62


def finite(vec: str) -> Column:
    """Whether a vector is there, has entries, and all of them are finite numbers."""
    entry = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce((F.size(vec) > 0) & F.forall(F.col(vec), entry), F.lit(False))


def usable(df: DataFrame, id_col: str, vec_col: str, more: dict[str, Column] | None = None) -> DataFrame:
    """``(id long, vec, *more)`` of the rows that take part; ``vec`` keeps floats as they are, all else becomes doubles.

    Null vectors, empty ones, and those that hold a null or non-finite entry take no part, nor do vectors of another
    length than most rows have (of lengths as frequent as each other the greater counts). Other columns, whatever their
    names, are left out.
    """
    kind = "array<float>" if dict(df.dtypes)[vec_col] == "array<float>" else "array<double>"
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kind).alias("vec"), *[c.alias(n) for n, c in (more or {}).items()])
    rows = rows.where(finite("vec"))
    top = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size("vec") == (top["size"] if top else 0))


def quantised(vec: str, scale: int, shift: int = 0) -> Column:
    """``floor(scale * entry) + shift`` of each entry as a double, as longs."""
    whole = lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(MOST))), F.lit(float(-MOST)))) + shift
    return F.transform(F.col(vec), whole)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of equal length as the rows of an array of the entries' own type."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))
