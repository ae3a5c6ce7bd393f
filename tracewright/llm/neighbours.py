"""Approximate nearest neighbours by cross-polytope hashing.

Each table turns a unit vector by three rounds of random signs and a fast
Hadamard transform and files it under the nearest signed axis. A query probes
the axes nearest to its own turned vector in every table; all rows filed there
are candidates and are ranked by their exact Euclidean distance.

Every row is indexed. How many axes a query probes is learned from a bounded
sample (:class:`Settings`): the fewest at which the sampled queries find
``target`` of their true neighbours within the sample. Neighbours in the whole
table are nearer than those in a sample, and so found more often.

An axis with many rows or queries is split into pieces that meet pairwise, so a
task holds a bounded number of either. What a task emits is its best ``k`` for a
query, never its candidates. A query that finds fewer than ``k`` probes every
axis of one table, which is exact.

Defined cases: rows with a null id, an unusable vector
(:func:`tracewright.llm.vectors.usable`) or only zeros take no part. Rows of the
query's id are its own and no candidates. Repeated rows count one by one, as
queries too. Ties go to the smaller id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window as W

from tracewright.llm.common import shuffle_width, stored
from tracewright.llm.vectors import matrix


@dataclass(frozen=True)
class Settings:
    """``k`` neighbours from ``tables`` turned by ``seed``; the sample has ``sample_rows`` rows, ``sample_queries`` of them queries."""

    k: int = 10
    tables: int = 8
    seed: int = 20
    target: float = 0.97
    sample_rows: int = 16384
    sample_queries: int = 256


#: Rows and queries of a cell that one task holds; smaller pieces where tasks would else be uneven.
MOST, LEAST = 16384, 512
#: Distances that a task computes at once, and pairs that it measures exactly at once.
GRID, PAIRS = 2_000_000, 65536

INDEX = "id long, vec array<{}>, axes array<int>"
FOUND = "query long, query_id long, row long, vec_id long, score double"


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, whose length is a power of two, scaled to keep lengths."""
    rows, size = x.shape
    step = 1
    while step < size:
        x = x.reshape(rows, size // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(rows, size)
        step *= 2
    return x / np.sqrt(size)


def turned(x: np.ndarray, settings: Settings) -> Iterator[np.ndarray]:
    """For each table the unit vectors of ``x`` after its pseudo-rotation, padded to a power of two."""
    rows, dim = x.shape
    size = 1 << max(0, dim - 1).bit_length()
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    padded = np.zeros((rows, size))
    padded[:, :dim] = x
    signs = np.random.default_rng(settings.seed).choice([-1.0, 1.0], (settings.tables, 3, size))
    for of_table in signs:
        y = padded
        for s in of_table:
            y = hadamard(y * s)
        yield y


def axes(y: np.ndarray) -> np.ndarray:
    """Number of the nearest signed axis of each row: the coordinate, plus the dimension if it is negative."""
    at = np.abs(y).argmax(axis=1)
    return at + np.where(y[np.arange(len(y)), at] < 0, y.shape[1], 0)


def probe_order(y: np.ndarray) -> np.ndarray:
    """All signed axes of each row, nearest first."""
    return np.argsort(-np.concatenate([y, -y], axis=1), axis=1, kind="stable")


def nearest(q: np.ndarray, x: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The ``k`` rows of ``x`` nearest to each row of ``q``, ``own`` ids left out: query and row numbers, distances.

    A matrix product finds all rows that may be among them, then their distances are taken entry by entry.
    """
    squares = (x * x).sum(1)
    for lo in range(0, len(q), max(1, GRID // max(1, len(x)))):
        part = q[lo : lo + max(1, GRID // max(1, len(x)))]
        norms = (part * part).sum(1)
        about = squares + norms[:, None] - 2 * (part @ x.T)
        out = own[lo : lo + len(part), None] == ids
        about[out] = np.inf
        if len(x) > k:
            slack = (norms + squares.max()) * (1e-14 * x.shape[1])
            bound = np.partition(about, k - 1, axis=1)[:, k - 1] + slack
            line, row = np.nonzero((about <= bound[:, None]) & ~out)
        else:
            line, row = np.nonzero(~out)
        away = np.empty(len(line))
        for at in range(0, len(line), PAIRS):
            d = part[line[at : at + PAIRS]] - x[row[at : at + PAIRS]]
            away[at : at + PAIRS] = np.sqrt((d * d).sum(1))
        order = np.lexsort((ids[row], away, line))
        line, row, away = line[order], row[order], away[order]
        keep = np.arange(len(line)) - np.searchsorted(line, line) < k
        yield line[keep] + lo, row[keep], away[keep]


def probes_needed(sample: np.ndarray, settings: Settings) -> int:
    """The fewest axes a table at which the first rows of ``sample``, as queries, find ``target`` of their neighbours in it."""
    queries, k = min(len(sample), settings.sample_queries), settings.k
    every = 2 << max(0, sample.shape[1] - 1).bit_length()
    if len(sample) <= k:
        return every
    numbers = np.arange(len(sample))
    pairs = list(nearest(sample[:queries], sample, numbers[:queries], numbers, k))
    query, row = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
    best = np.full(len(query), every)
    for y in turned(sample, settings):
        place = np.argsort(probe_order(y[:queries]), axis=1)  # of each axis in each query's order
        best = np.minimum(best, place[query, axes(y)[row]])
    counts = np.bincount(best, minlength=every + 1).cumsum() / len(best)
    return int(np.argmax(counts >= settings.target)) + 1


def indexed(rows: DataFrame, settings: Settings) -> DataFrame:
    """Stored ``row, id, vec, axes``: all of ``rows`` ``(id, vec)`` with their axis in each table and a number of their own."""
    kind = rows.schema["vec"].dataType.elementType.simpleString()
    target = rows.sparkSession.createDataFrame([], INDEX.format(kind)).schema
    schema = to_arrow_schema(target)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = matrix(part.column("vec")).astype(np.float64)
                found = np.stack([axes(y) for y in turned(x, settings)], axis=1).astype(np.int32)
                offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * settings.tables)
                lists = pa.ListArray.from_arrays(offsets, found.ravel()).cast(schema.field("axes").type)
                yield pa.RecordBatch.from_arrays([part.column("id").cast(pa.int64()), part.column("vec").cast(schema.field("vec").type), lists], schema=schema)

    used = rows.where(F.col("id").isNotNull() & F.exists("vec", lambda v: v != 0)).select("id", "vec")
    return stored(used.mapInArrow(work, target).withColumn("row", F.monotonically_increasing_id()), "neighbour-index")


def _probing(queries: DataFrame, probes: int, settings: Settings) -> DataFrame:
    """``query, id, vec, cell``: a row for each cell that a query probes; ``probes`` of 0 means every cell of one table."""
    target = queries.sparkSession.createDataFrame([], INDEX.format("int").replace("vec array<int>, ", "")).schema
    schema = to_arrow_schema(target)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = matrix(part.column("vec")).astype(np.float64)
                orders = [probe_order(y) for y in turned(x, settings)]
                every = orders[0].shape[1]
                cells = np.concatenate([o[:, :probes] + t * every for t, o in enumerate(orders)] if probes else [orders[0]], axis=1)
                offsets = pa.array(np.arange(len(cells) + 1, dtype=np.int32) * cells.shape[1])
                lists = pa.ListArray.from_arrays(offsets, cells.ravel().astype(np.int32)).cast(schema.field("axes").type)
                yield pa.RecordBatch.from_arrays([part.column("row").cast(pa.int64()), lists], schema=schema)

    cells = queries.select("row", "vec").mapInArrow(work, target)
    return cells.select(F.col("id").alias("query"), F.explode("axes").alias("cell"))


def _search(index: DataFrame, queries: DataFrame, probes: int, every: int, settings: Settings) -> DataFrame:
    """Best rows ``FOUND`` of each query in each piece of the cells that it probes."""
    spark: SparkSession = index.sparkSession
    cells = stored(_probing(queries, probes, settings), "neighbour-probes")
    tables = settings.tables if probes else 1
    filed = F.posexplode(F.slice("axes", 1, tables)).alias("table", "axis")
    rows = index.select("row", filed).select("row", (F.col("table") * every + F.col("axis")).alias("cell"))
    # at most a row for each cell: tables times signed axes
    counts = {r.cell: r.n for r in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = {r.cell: r.n for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    both = sorted(counts.keys() & sizes.keys())
    if not both:
        return spark.createDataFrame([], FOUND)
    held = min(MOST, max(LEAST, sum(sizes.values()) // (2 * shuffle_width(spark))))
    cut = spark.createDataFrame([(c, -(-sizes[c] // held), -(-counts[c] // MOST)) for c in both], "cell int, slices int, chunks int")
    cut = F.broadcast(cut)
    own = lambda key, parts: F.pmod(F.xxhash64(key), F.col(parts)).cast("int")
    every_one = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    left = index.select("row", "id", "vec", filed).withColumn("cell", F.col("table") * every + F.col("axis"))
    left = left.join(cut, "cell").select("cell", own("row", "slices").alias("slice"), every_one("chunks").alias("chunk"), "row", "id", "vec")
    asking = queries.select(F.col("row").alias("query"), F.col("id").alias("query_id"), F.col("vec").alias("query_vec"))
    right = cells.join(asking, "query").join(cut, "cell")
    right = right.select("cell", every_one("slices").alias("slice"), own("query", "chunks").alias("chunk"), "query", "query_id", "query_vec")

    target = spark.createDataFrame([], FOUND).schema
    schema = to_arrow_schema(target)

    def meet(rows: pa.Table, asking: pa.Table) -> pa.Table:
        if not rows.num_rows or not asking.num_rows:
            return schema.empty_table()
        rows = rows.sort_by([("id", "ascending"), ("row", "ascending")])
        x, q = (matrix(c).astype(np.float64) for c in (rows["vec"], asking["query_vec"]))
        row, ids, query, own_ids = (c.to_numpy() for c in (rows["row"], rows["id"], asking["query"], asking["query_id"]))
        found = list(nearest(q, x, own_ids, ids, settings.k))
        line, at, away = (np.concatenate([f[i] for f in found]) for i in range(3))
        columns = (query[line], own_ids[line], row[at], ids[at], away)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    key = ["cell", "slice", "chunk"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, target)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of each query; a row found in several tables counts once."""
    order = W.partitionBy("query").orderBy("score", "vec_id", "row")
    return found.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k).distinct()


def neighbours(rows: DataFrame, is_query: Column, settings: Settings = Settings()) -> DataFrame:
    """The nearest of all ``rows`` ``(id, vec)`` to each row that ``is_query`` (of ``id``) holds for.

    ``query_id, rank`` (from 1), ``vec_id, score`` (Euclidean distance of the vectors as they are).
    """
    spark = rows.sparkSession
    index = indexed(rows, settings)
    chosen = index.orderBy(F.xxhash64("id", "row"), "row").limit(settings.sample_rows).select("vec")
    sample = matrix(chosen.toArrow()["vec"]).astype(np.float64)
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    every = 2 << max(0, sample.shape[1] - 1).bit_length()
    queries = index.where(F.coalesce(is_query, F.lit(False))).select("row", "id", "vec")
    probes = probes_needed(sample, settings)
    best = stored(_best(_search(index, queries, probes, every, settings), settings.k), "neighbours")
    full = best.groupBy("query").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= settings.k).select(F.col("query").alias("row"))
    short = stored(queries.join(full, "row", "left_anti"), "neighbour-queries")
    if short.limit(1).count():
        again = _best(_search(index, short, 0, every, settings), settings.k)
        best = best.join(short.select(F.col("row").alias("query")), "query", "left_anti").unionByName(again)
    return best.select("query_id", "rank", "vec_id", "score")
