"""Sharding by jump consistent hashing: stable keys to shards without a ring table.

Law ``key``: a row's shard depends on its key and the number of shards only, so
when one shard is appended a row either stays or moves into the new shard, and
1/(n+1) of the rows move. Equal texts under different keys are separate rows.

Defined cases: a null key is a key of its own (all such rows share a shard); a
null text has no bytes, so size 1 and crc 0; repeated rows get the same shard
and a slot each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.llm.common import range_of, range_starts, ranked, shuffle_width

#: Multiplier of the 64-bit linear congruential generator of the published algorithm (fixed value).
_STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key, for all keys at once: each round draws the next jump of the keys still below ``shards``."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    state = keys.astype(np.uint64)
    landed = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    ahead = np.zeros(len(state), dtype=np.float64)
    while live.size:
        landed[live] = ahead[live].astype(np.int64)
        with np.errstate(over="ignore"):
            state[live] = state[live] * _STEP + np.uint64(1)
        draw = ((state[live] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        ahead[live] = np.floor((landed[live] + 1) * (2147483648.0 / draw))
        live = live[ahead[live] < shards]
    return landed.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard number of ``key`` (any type with an xxhash64), 0 to ``shards`` - 1."""

    @F.pandas_udf(T.IntegerType())
    def place(k: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(k.to_numpy(np.int64).view(np.uint64), shards))

    return place(F.xxhash64(key))


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Places every document: ``doc_id, size, text_crc32, shard, slot, grown_shard``.

    ``slot`` is the document's place in its shard by ascending id, without gaps
    from 0; ``grown_shard`` its shard if one were appended. Texts are read once
    and only their size and checksum leave the scan.
    """
    body = F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b""))
    thin = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    starts = range_starts(ids, "doc_id", 2 * shuffle_width(docs.sparkSession))
    placed = thin.withColumns(
        {
            "shard": shard_of(F.col("doc_id"), shards),
            "grown_shard": shard_of(F.col("doc_id"), shards + 1),
            "__range": range_of(starts, "doc_id"),
        }
    )
    return ranked(placed, ["shard"], "__range", ["doc_id", "text_crc32", "size"], "slot").drop("__range")


def write_shards(docs: DataFrame, path: str, shards: int = 16, files_per_shard: int = 1, id_col: str = "doc_id") -> None:
    """Writes ``docs`` under ``path/shard=n``; each shard is spread over ``files_per_shard`` tasks by its key."""
    spread = F.pmod(F.xxhash64(F.col(id_col), F.lit(1)), F.lit(files_per_shard))
    if "shard" in docs.columns:
        raise ValueError("documents have a column shard, which is the name of the folders")
    shard = shard_of(F.col(id_col).cast("long"), shards)
    rows = docs.select(F.struct("*").alias("row"), shard.alias("shard"), spread.alias("spread"))
    rows.repartition(shards * files_per_shard, "shard", "spread").select("row.*", "shard").write.partitionBy("shard").parquet(path)
