"""Helpers shared by the document operators: text rows, key ranges, ranks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, MutableSequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tracewright.session import scratch_path

#: Stands for a null key where keys are ordered: before every other.
NULL_KEY = -(2**63)


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exactly ``(doc_id bigint, text string)``; other columns, whatever their names, are left out."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


#: Bounds of a batch of rows between the JVM and a Python worker, in effect where the session names none.
BATCH_BOUNDS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "4194304"}


def bound_batches(spark: SparkSession) -> None:
    """Bounds batches by their bytes, so that long texts do not fill a worker; what the session sets itself stays."""
    for key, value in BATCH_BOUNDS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def shuffle_width(spark: SparkSession) -> int:
    """Partitions of a shuffle in this session."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: a lineage cut that outlives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(key: str, parts: int) -> Column:
    """crc32 of a key's decimal text modulo ``parts``: which fold a row belongs to (null key: null)."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def range_starts(df: DataFrame, key: str, parts: int) -> np.ndarray:
    """The first key of each of at most ``parts`` contiguous key ranges with about equal rows, ascending.

    Reads the key column only; ``parts`` numbers come to the driver.
    """
    keys = df.select(F.coalesce(F.col(key), F.lit(NULL_KEY)).alias("k")).repartitionByRange(parts, "k")
    firsts = keys.select(F.spark_partition_id().alias("p"), "k").groupBy("p").agg(F.min("k").alias("k")).collect()
    return np.array(sorted({r.k for r in firsts}), dtype=np.int64)


def range_of(starts: np.ndarray, key: str) -> Column:
    """Number of the range of :func:`range_starts` that holds ``key``, as an int column."""

    @F.pandas_udf(T.IntegerType())
    def place(k: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(np.searchsorted(starts, k.to_numpy(np.int64), "right") - 1, 0).astype(np.int32))

    return place(F.coalesce(F.col(key).cast("long"), F.lit(NULL_KEY)))


def ranked(df: DataFrame, group: list[str], chunk: str, order: list[str], name: str) -> DataFrame:
    """Adds ``name``: a rank without gaps from 0 within ``group``, rising with (``chunk``, ``order``).

    A group may hold most rows: windows run over (group, chunk) only, and a
    chunk's first rank is the sum of the counts of the chunks before it, so no
    task sees a whole group. ``chunk`` must be a function of the row's key, so a
    recomputed task gives the same ranks.
    """
    counts = df.groupBy(*group, chunk).agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(*group).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*group, chunk, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    within = W.partitionBy(*group, chunk).orderBy(*order)
    local = df.withColumn("__local", F.row_number().over(within) - 1)
    return (
        local.join(starts, [*group, chunk])
        .withColumn(name, F.col("__first") + F.col("__local"))
        .select(*df.columns, name)
    )


def in_arrow(df: DataFrame, schema: str | T.StructType, work: Callable[[Iterable[dict]], Iterator[tuple]], rows: int = 2000) -> DataFrame:
    """``mapInArrow`` over row dicts: ``work`` takes an iterable of row dicts and yields tuples of ``schema``.

    Rows stream in and out in batches, so a task holds what ``work`` keeps and no more.
    """
    target = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = [(f.name, _arrow_type(f.dataType)) for f in target.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def source() -> Iterator[dict]:
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    yield from batch.slice(at, 512).to_pylist()

        out: list[tuple] = []
        for row in work(source()):
            out.append(row)
            if len(out) >= rows:
                yield to_batch(out, arrow)
                out = []
        if out:
            yield to_batch(out, arrow)
        give_back()

    return df.mapInArrow(run, target)


def to_batch(rows: list[tuple], arrow: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, (_, t) in zip(columns, arrow)], names=[n for n, _ in arrow])


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def give_back() -> None:
    """Returns a worker's free memory to the machine; workers live on after their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


class WordTable:
    """Numbers for words, kept between batches and tasks of a Python worker, with bounded memory.

    ``learn(words)`` is called with words seen for the first time and must give
    values per word, which go to the end of ``values`` (a list, or an array of
    numbers); :meth:`lookup` gives the numbers of any words. At ``limit`` words
    the table starts anew, so results never depend on it.
    """

    def __init__(self, learn: Callable[[list[str]], Iterable], limit: int = 400_000, values: MutableSequence | None = None):
        self.learn, self.limit = learn, limit
        self.place: dict[str, int] = {}
        self.values: MutableSequence = [] if values is None else values

    def lookup(self, words: list[str]) -> list[int]:
        get = self.place.get
        found = [get(w) for w in words]
        if None in found:
            new = list(dict.fromkeys(w for w, i in zip(words, found) if i is None))
            if len(self.place) + len(new) > self.limit:
                self.place.clear()
                self.values.clear()
                new = list(dict.fromkeys(words))
            at = len(self.place)
            self.values.extend(self.learn(new))
            self.place.update(zip(new, range(at, at + len(new))))
            found = [self.place[w] for w in words]
        return found
