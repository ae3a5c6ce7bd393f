"""Hard-negative mining with exact scores from products in a residue number system.

Vectors are whole numbers. Their residues modulo a few small primes, taken
nearest to zero, are multiplied as float32 matrices, where every sum stays below
2**24 and is exact; the Chinese remainder theorem gives the signed score back.
As many primes are taken as the greatest norm of the rows needs.

Anchors are a stated set. They are stored once, and each task streams them by
the batch past the blocks of rows that it holds; what it emits is bounded by the
anchors. The first pass finds each anchor's positives, the second the negatives
within each positive's score window.

Defined cases: rows with a null id, null label or unusable vector
(:func:`tracewright.llm.vectors.usable`) take no part. Rows of the anchor's id
are not other rows. Repeated rows count one by one, as anchors too. Ties go to
the smaller id. An anchor without positives, or a positive without negatives in
its window, gives no rows. An empty table gives an empty result. Scores that may
exceed 61 bits are refused with a ValueError.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window as W

from tracewright.llm.common import stored
from tracewright.llm.shared_files import listed, open_random
from tracewright.llm.vectors import matrix
from tracewright.session import scratch_path

#: Rows that a task holds, rows and anchors that are multiplied at once.
HELD, ROWS, ANCHORS = 65536, 8192, 256
#: Residues nearest to zero of primes below this fit sums of :func:`segment` entries in float32.
BELOW = 256


@dataclass(frozen=True)
class Settings:
    """``positives`` of each anchor, ``negatives`` of each positive, whose scores are ``low`` to ``high`` percent of its."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95


def primes(bound: int) -> list[int]:
    """Primes below 256, greatest first, at least three, whose product is over twice ``bound``."""
    found, product = [], 1
    for p in range(BELOW - 1, 2, -1):
        if all(p % q for q in range(2, int(p**0.5) + 1)):
            found.append(p)
            product *= p
            if product > 2 * bound + 1 and len(found) >= 3:
                return found
    raise ValueError("scores are too large")


def balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Residues modulo the odd ``p``, from -(p-1)/2 to (p-1)/2."""
    return (x + p // 2) % p - p // 2


def segment(p: int) -> int:
    """Entries whose products of residues modulo ``p`` add up to less than 2**24."""
    return (2**24 - 1) // (p // 2) ** 2


def residues(x: np.ndarray, moduli: list[int]) -> list[np.ndarray]:
    return [balanced(x, p).astype(np.float32) for p in moduli]


def scores(a: list[np.ndarray], b: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """Inner products of the rows behind two lists of residues, as longs."""
    value, product = None, 1
    for left, right, p in zip(a, b, moduli):
        total = None
        for at in range(0, left.shape[1], segment(p)):
            part = (left[:, at : at + segment(p)] @ right[:, at : at + segment(p)].T).astype(np.int64)
            total = part if total is None else total + part
        if value is None:
            value = balanced(total, p)
        else:
            digit = balanced((total - value) % p * pow(product, -1, p), p)
            value += digit * product
        product *= p
    return value


def first(found: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each line the first ``k`` allowed places by falling score, ties in order of place: line and place numbers."""
    least = np.iinfo(np.int64).min
    masked = np.where(allowed, found, least)
    if masked.shape[1] > k:
        bound = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
        line, place = np.nonzero((masked >= bound[:, None]) & allowed)
    else:
        line, place = np.nonzero(allowed)
    order = np.lexsort((place, -masked[line, place], line))
    line, place = line[order], place[order]
    keep = np.arange(len(line)) - np.searchsorted(line, line) < k
    return line[keep], place[keep]


def _anchor_batches(files: list[str]) -> Iterator[pa.RecordBatch]:
    for uri in files:
        with open_random(uri) as f:
            yield from pq.ParquetFile(f).iter_batches(batch_size=ANCHORS)


def _against(rows: DataFrame, anchors: DataFrame, schema: str, pick, moduli: list[int]) -> DataFrame:
    """``pick(batch, labels, ids, scores)`` of every anchor batch and block of rows, over all rows.

    ``rows`` are ``(id, label, x)``; ``pick`` yields columns of ``schema``. Anchors go through a stored table.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "anchors")
    anchors.write.parquet(path)
    files = [uri for uri, _ in listed(path, ".parquet")]
    target = spark.createDataFrame([], schema).schema
    names = to_arrow_schema(target)

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, HELD):
                held.append(batch.slice(at, HELD))
                size += held[-1].num_rows
                if size >= HELD:
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
        if size:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            block = block.sort_by("id")
            ids, labels, x = block["id"].to_numpy(), block["label"].to_numpy(), matrix(block["x"])
            parts = [(ids[at : at + ROWS], labels[at : at + ROWS], residues(x[at : at + ROWS], moduli)) for at in range(0, len(ids), ROWS)]
            for batch in _anchor_batches(files):
                own = residues(matrix(batch.column("x")), moduli)
                found = [[] for _ in names]
                for i, lab, b in parts:
                    for columns in pick(batch, lab, i, scores(own, b, moduli)):
                        for to, values in zip(found, columns):
                            to.append(values)
                if found[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(found, names)], schema=names)

    return rows.select("id", "label", "x").mapInArrow(run, target)


def hard_negatives(rows: DataFrame, is_anchor: Column, settings: Settings = Settings()) -> DataFrame:
    """Hard negatives of the anchors among ``rows`` ``(id, label, x array<bigint>)``.

    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each of an anchor's first
    positives (other rows of its label, by falling score) the first rows of other labels whose scores lie within the
    window, ranked from 1.
    """
    rows = rows.select("id", "label", "x").where(F.col("id").isNotNull() & F.col("label").isNotNull())
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v)
    bound = rows.agg(F.max(square)).first()[0] or 0.0
    if bound >= 2**61:
        raise ValueError(f"inner products of up to {bound:.3g} do not fit")
    moduli = primes(int(bound * (1 + 1e-9)) + 1)
    anchors = rows.where(F.coalesce(is_anchor, F.lit(False))).withColumn("anchor", F.monotonically_increasing_id())
    anchors = stored(anchors, "negative-anchors")  # their numbers hold from here on

    def positives(batch, labels, ids, found):
        other = (batch.column("label").to_numpy()[:, None] == labels) & (batch.column("id").to_numpy()[:, None] != ids)
        line, place = first(found, other, settings.positives)
        yield batch.column("anchor").to_numpy()[line], ids[place], found[line, place]

    near = _against(rows, anchors, "anchor long, positive_id long, positive_score long", positives, moduli)
    best = W.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= settings.positives)
    of = F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score")))  # at most ``positives`` entries
    windows = anchors.join(near.groupBy("anchor").agg(of.alias("of")), "anchor")
    windows = windows.select("anchor", "id", "label", "x", "of.place", "of.positive_id", "of.positive_score")

    def negatives(batch, labels, ids, found):
        other = batch.column("label").to_numpy()[:, None] != labels
        places, positive, wanted = (batch.column(c).to_pylist() for c in ("place", "positive_id", "positive_score"))
        own, anchor = batch.column("id").to_numpy(), batch.column("anchor").to_numpy()
        for j in range(settings.positives):
            lines = np.array([i for i, p in enumerate(places) if len(p) > j], dtype=np.int64)
            if not len(lines):
                break
            low = np.array([-(-settings.low * wanted[i][j] // 100) for i in lines])
            high = np.array([settings.high * wanted[i][j] // 100 for i in lines])
            part = found[lines]
            line, place = first(part, other[lines] & (part >= low[:, None]) & (part <= high[:, None]), settings.negatives)
            at = lines[line]
            of = lambda column, j=j, at=at: np.array([column[i][j] for i in at], dtype=np.int64)
            yield anchor[at], own[at], of(places), of(positive), of(wanted), ids[place], part[line, place]

    schema = "anchor long, anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_score long"
    far = _against(rows, windows, schema, negatives, moduli)
    hardest = W.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    far = far.withColumn("rank", F.row_number().over(hardest)).where(F.col("rank") <= settings.negatives)
    return far.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
