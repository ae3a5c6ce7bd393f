"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints: each word shingle's 64-bit hash votes on every bit; a bit is set
where more than half of the hashes have it. Two fingerprints link when at most
``max_bits`` bits differ.

Search: the 64 bits are cut into ``max_bits + spare`` blocks. A close pair
differs in at most ``max_bits`` blocks, so it agrees on at least ``spare`` whole
blocks; for each choice of ``spare`` blocks the fingerprints are joined on those
blocks' bits and verified by Hamming distance. Equal fingerprints are collapsed
first. Blocks with many fingerprints are cut into chunks, and each pair of
chunks is a task of its own that returns a spanning forest of its links instead
of the pairs; links, and so components, are complete.

Defined cases: a null or wordless text has fingerprint zero and links like any
other; fewer words than a shingle: the whole sequence is the one shingle;
repeated rows are one fingerprint; an empty table gives no rows; a null id takes
part in linking but never names a component unless all its members are null.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import in_arrow, stored
from tracewright.llm.components import component_labels

#: Fingerprints of one block that are compared within one task.
CHUNK = 4096


def simhash(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit fingerprint of a UTF-8 text."""
    words = text.lower().split() if text else []  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    hashes = np.fromiter(_shingle_hashes(words, shingle, seed), dtype=np.uint64)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    held = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(held, bitorder="little").view("<u8")[0])


def _shingle_hashes(words: list[bytes], shingle: int, seed: int) -> Iterator[int]:
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return iter([digest(b" ".join(words), seed)])
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends[: len(words) - shingle]]
    return (digest(line[a : b - 1], seed) for a, b in zip(starts, ends[shingle - 1 :]))


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` for every row; ``fp`` is the fingerprint as a signed long."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")
    )

    def work(source: Iterable[dict]) -> Iterator[tuple]:
        for r in source:
            yield r["doc_id"], _signed(simhash(r["text"], shingle))

    return in_arrow(rows, "doc_id long, fp long", work)


def block_masks(max_bits: int = 4, spare: int = 2) -> list[int]:
    """Masks of the block choices: every pair within ``max_bits`` agrees under at least one of them."""
    blocks = max_bits + spare
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(choice) for choice in combinations(masks, spare)]


def _signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def close_forest(values: np.ndarray, max_bits: int) -> Iterator[tuple[int, int]]:
    """Links that span the components of the graph of pairs within ``max_bits``; one link per joined value.

    Takes pivots from the component found so far and compares each with the
    values not yet reached, so a group of near copies costs about one pass.
    """
    rest = np.asarray(values, dtype=np.uint64)
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            pivot = frontier.pop()
            near = np.bitwise_count(rest ^ pivot) <= max_bits
            if near.any():
                for v in rest[near]:
                    yield int(pivot), int(v)
                    frontier.append(v)
                rest = rest[~near]


def links(fps: DataFrame, max_bits: int = 4, spare: int = 2, chunk: int = CHUNK) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that keep every component connected."""
    masks = F.array(*[F.lit(_signed(m)) for m in block_masks(max_bits, spare)])
    keyed = fps.select("fp", F.posexplode(masks).alias("t", "mask")).select("fp", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = keyed.join(sizes, ["t", "key"]).withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int"))
    part = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    tiled = held.withColumn("part", part).select(
        "fp",
        "t",
        "key",
        F.explode(
            F.when(F.col("chunks") == 1, F.array(F.lit(0)))
            .otherwise(F.expr("transform(sequence(0, chunks - 1), x -> least(x, part) * chunks + greatest(x, part))"))
        ).alias("tile"),
    )
    sorted_tiles = tiled.repartition("t", "key", "tile").sortWithinPartitions("t", "key", "tile")

    def work(source: Iterable[dict]) -> Iterator[tuple]:
        at, group = None, []
        for r in source:
            here = (r["t"], r["key"], r["tile"])
            if here != at:
                yield from _forest(group, max_bits)
                at, group = here, []
            group.append(r["fp"])
        yield from _forest(group, max_bits)

    return in_arrow(sorted_tiles, "a long, b long", work)


def _forest(group: list[int], max_bits: int) -> Iterator[tuple[int, int]]:
    if len(group) == 2:
        a, b = group
        if ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits:
            yield a, b
    elif group:
        values = np.array(group, dtype=np.int64).view(np.uint64)
        for a, b in close_forest(values, max_bits):
            yield _signed(a), _signed(b)


def near_duplicates(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, fp, component_id`` for every row; ``component_id`` is the smallest id reachable over links."""
    return rooted_prints(docs, shingle, max_bits, id_col, text_col).drop("root")


def rooted_prints(docs: DataFrame, shingle: int, max_bits: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`near_duplicates` with ``root``, a fingerprint that names the component; two components may have one smallest id."""
    prints = stored(fingerprints(docs, shingle, id_col, text_col), "simhash")
    firsts = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-firsts")
    labels = component_labels(links(firsts.select("fp"), max_bits))
    # Of each component the smallest first id; a fingerprint without links is its own component. Both sides of the join
    # are tables, so that Spark can split the partition of a component with very many fingerprints.
    rooted = firsts.join(labels, firsts.fp == labels.node, "left").select("fp", "first", F.coalesce("label", "fp").alias("root"))
    rooted = stored(rooted, "simhash-roots")
    smallest = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-components")
    return prints.join(rooted.join(smallest, "root").select("fp", "component_id", "root"), "fp").select("doc_id", "fp", "component_id", "root")


def hex_fingerprint(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id; all columns as they were.

    Rows that share an id are told apart by their fingerprint: of a component's fingerprints under
    its smallest id (null if it has no other) the smallest stays, and one of its equal rows.
    """
    found = stored(rooted_prints(docs, shingle, max_bits), "simhash-components")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp"))
    staying = found.groupBy("root").agg(first.alias("k")).select("k.doc_id", "k.fp")
    repeated = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    same_id = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
    if not repeated.take(1):
        return docs.alias("d").join(staying.alias("k"), same_id, "left_semi")

    @F.pandas_udf("long")
    def print_of(text: pd.Series) -> pd.Series:
        return pd.Series([_signed(simhash(t, shingle)) for t in text], dtype="int64")

    # columns of documents go as one value, so that none of them can clash
    marked = docs.select(F.struct("*").alias("row"), print_of(F.col("text").cast("string").cast("binary")).alias("fp"))
    same = F.col("d.row.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.fp") == F.col("k.fp"))
    kept = marked.alias("d").join(staying.alias("k"), same, "left_semi").withColumn("id", F.col("row.doc_id"))
    return kept.dropDuplicates(["id", "fp"]).select("row.*")
