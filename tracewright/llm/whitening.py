"""Embedding whitening with MLlib's block matrices.

Rows get an index without gaps, centred rows become blocks of a distributed
matrix, and the scatter is the product of its transpose and itself, added up
from many partial products. Only that scatter (dimension squared) and as many
eigenvectors come to the driver. A product with the whitening matrix projects
the rows, and the same steps over the projected rows measure how far their
covariance is from the identity.

Rows come as longs, so that count, sums and deviations are exact.

Defined cases: :func:`tracewright.llm.vectors.usable` tells which rows take
part. An empty table gives an empty result. Rows with repeated or null ids are
rows of their own. A component without variance (to double precision) has
``whitened`` null and is left out of ``identity_error``; without any variance
``explained`` and ``identity_error`` are null. A deviation over 63 bits is null.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window as W

from tracewright.llm.common import stored
from tracewright.llm.vectors import matrix

#: Rows of a block; the driver holds two numbers for each block.
BLOCK_ROWS = 2048
#: Blocks that one product of the scatter and one projection take; larger tables take several.
SCATTER_BLOCKS, PROJECT_BLOCKS = 16384, 512
#: Blocks that meet in one task of the scatter.
BLOCKS_A_SPLIT = 8
#: Partitions of the whitening matrix; MLlib deals the product's rows to their square root.
PROJECT_PARTS = 64

PLACE = T.StructType([T.StructField("row", T.LongType(), False), T.StructField("col", T.LongType(), False)])
BLOCKS = T.StructType(
    [
        T.StructField("place", PLACE, False),
        T.StructField("block", MatrixUDT(), False),
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("deviations", T.ArrayType(T.LongType())),
    ]
)
RESULT = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with an ``index`` from 0 without gaps, stored once; no window goes over rows."""
    placed = stored(rows.withColumn("__at", F.monotonically_increasing_id()), name)
    part, local = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit(2**33 - 1))
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    # a row for each task that wrote, so small at every size
    return placed.join(F.broadcast(starts), part == F.col("__part")).select((F.col("__first") + local).alias("index"), *rows.columns)


def block_table(rows: DataFrame, work: Callable[[np.ndarray], tuple[np.ndarray, list | None]], name: str) -> DataFrame:
    """Stored blocks of ``rows`` ``(index, id, x)``; ``work`` gives a block's values and deviations from its entries."""
    schema = to_arrow_schema(BLOCKS)

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("index")
        values, deviations = work(matrix(group["x"]))
        first = group["index"][0].as_py() // BLOCK_ROWS
        dense = {"type": 1, "numRows": values.shape[0], "numCols": values.shape[1], "colPtrs": None, "rowIndices": None, "values": values.ravel(), "isTransposed": True}
        row = ({"row": first, "col": 0}, dense, group["id"].to_pylist(), deviations)
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    keyed = rows.select("index", "id", "x", F.floor(F.col("index") / BLOCK_ROWS).alias("at"))
    return stored(keyed.groupBy("at").applyInArrow(build, BLOCKS), name)


def _slabs(blocks: DataFrame, rows: int, dim: int, width: int):
    """Block matrices of up to ``width`` blocks each, with the number of their first block and their blocks."""
    count = -(-rows // BLOCK_ROWS)
    for lo in range(0, count, width):
        hi = min(count, lo + width)
        part = blocks.where((F.col("place.row") >= lo) & (F.col("place.row") < hi))
        part = part.select(F.struct((F.col("place.row") - lo).alias("row"), "place.col").alias("place"), "block")
        yield lo, hi - lo, _block_matrix(part, BLOCK_ROWS, dim, min(rows, hi * BLOCK_ROWS) - lo * BLOCK_ROWS, dim)


def _block_matrix(blocks: DataFrame, rows_a_block: int, cols_a_block: int, rows: int, cols: int) -> BlockMatrix:
    made = callMLlibFunc("createBlockMatrix", blocks, rows_a_block, cols_a_block, rows, cols)
    return BlockMatrix(made, rows_a_block, cols_a_block)


def scatter(blocks: DataFrame, rows: int, dim: int) -> np.ndarray:
    """The product of the transposed matrix and the matrix: ``dim`` times ``dim`` numbers.

    The middle dimension is split, so that partial products form in many tasks and are added before and after a shuffle.
    """
    total = np.zeros((dim, dim))
    for _, count, part in _slabs(blocks, rows, dim, SCATTER_BLOCKS):
        splits = -(-count // BLOCKS_A_SPLIT)
        java = part.transpose()._java_matrix_wrapper.call("multiply", part._java_matrix_wrapper._java_model, splits)
        total += BlockMatrix(java, dim, dim).toLocalMatrix().toArray()
    return (total + total.T) / 2


def project(blocks: DataFrame, rows: int, weights: np.ndarray) -> DataFrame:
    """``index, z``: the matrix times ``weights``, row by row."""
    spark, (dim, width) = blocks.sparkSession, weights.shape
    row = [((0, 0), DenseMatrix(dim, width, weights.T.ravel()))]
    right = spark.createDataFrame(row, T.StructType(BLOCKS.fields[:2])).repartition(PROJECT_PARTS)
    right = _block_matrix(right, dim, width, dim, width)
    found = None
    for lo, _, part in _slabs(blocks, rows, dim, PROJECT_BLOCKS):
        made = part.multiply(right).toIndexedRowMatrix()
        frame = callMLlibFunc("getIndexedRows", made._java_matrix_wrapper._java_model)
        frame = frame.select((F.col("index") + lo * BLOCK_ROWS).alias("index"), vector_to_array("vector").alias("z"))
        found = frame if found is None else found.union(frame)
    return found


def _centring(n: int, sums: list[int]) -> Callable[[np.ndarray], tuple[np.ndarray, list]]:
    """Centred entries ``(n*x - S) / n`` of a block of longs, and each row's sum of ``(n*x - S)**2``, exactly."""

    def work(x: np.ndarray) -> tuple[np.ndarray, list]:
        most = n * int(np.abs(x).max()) + max(map(abs, sums))
        small = most < 2**62
        far = x * n - np.array(sums, np.int64) if small else x.astype(object) * n - np.array(sums, object)
        if small and x.shape[1] * int(np.abs(far).max()) ** 2 < 2**63:
            squares = (far * far).sum(1).tolist()
        else:
            squares = [int(v) for v in (far.astype(object) ** 2).sum(1)]
        return (far / n).astype(np.float64), [v if v < 2**63 else None for v in squares]

    return work


def whitened(rows: DataFrame, components: int = 8) -> DataFrame:
    """Rows ``(id, x array<bigint>)`` projected on their first components and scaled to unit variance.

    A row for each row and component: ``id, component`` (from 1, by falling variance), ``n``, ``deviation`` (the sum
    over dimensions of ``(n*x - S)**2``), ``whitened``, ``explained`` (the component's share of all variance) and
    ``identity_error``.
    """
    spark: SparkSession = rows.sparkSession
    rows = numbered(rows.select("id", "x"), "whitening-rows")
    totals = rows.select(F.posexplode("x").alias("at", "x")).groupBy("at")
    sums = totals.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("x").cast("decimal(20,0)")).alias("s")).orderBy("at").collect()
    if not sums:
        return spark.createDataFrame([], RESULT)
    n, dim = sums[0].n, len(sums)
    blocks = block_table(rows, _centring(n, [int(r.s) for r in sums]), "whitening-blocks")
    covariance = scatter(blocks, n, dim) / n
    trace = float(np.trace(covariance))
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    there = values > max(values[0], 0) * dim * np.finfo(float).eps
    weights = vectors * np.where(there, 1 / np.sqrt(np.where(there, values, 1)), 0)

    places = blocks.select("place.row", F.posexplode(F.arrays_zip("ids", "deviations")).alias("at", "of"))
    places = places.select((F.col("row") * BLOCK_ROWS + F.col("at")).alias("index"), F.col("of.ids").alias("id"), F.col("of.deviations").alias("deviation"))
    rows = stored(places.join(project(blocks, n, weights), "index").withColumnRenamed("z", "x"), "whitening-rows")
    error = _identity_error(rows, n, there)

    shares = F.array(*[F.lit(float(v) / trace if trace > 0 else None).cast("double") for v in values])
    known = F.array(*[F.lit(bool(v)) for v in there])
    found = rows.select("id", "deviation", F.posexplode("x").alias("at", "z"))
    return found.select(
        "id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.when(known[F.col("at")], F.col("z")).alias("whitened"),
        shares[F.col("at")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _identity_error(rows: DataFrame, n: int, there: np.ndarray) -> float | None:
    """Largest entry of the covariance of projected ``rows`` ``(index, id, x)`` minus the identity."""
    if not there.any():
        return None
    means = rows.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(len(there))]).first()
    means = np.array(means, float)
    blocks = block_table(rows, lambda z: (z - means, None), "whitening-projected")
    covariance = scatter(blocks, n, len(there)) / n
    return float(np.abs(covariance - np.eye(len(there)))[np.ix_(there, there)].max())
