"""Connected components of a link table, by alternating star contractions.

Each round, every node points its larger (then its smaller) neighbours at the
smallest node it knows, until every component is a star around its smallest node.
Links are reduced to forests within tasks before each round, so that few rounds are
left. Rounds grow with the logarithm of the longest path. A node with very many links is one aggregate and one join key,
both of which Spark splits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tracewright.llm.common import in_arrow, stored

#: Links that one task holds while it reduces its links to a forest.
FOREST_LINKS = 500_000


def local_forest(links: DataFrame) -> DataFrame:
    """The same components from fewer links: each task keeps, of runs of its links, a forest."""

    def work(source: Iterable[dict]) -> Iterator[tuple]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for r in source:
            a, b = root(r["a"]), root(r["b"])
            if a != b:
                parent[max(a, b)] = min(a, b)
            if len(parent) >= FOREST_LINKS:
                yield from ((x, root(x)) for x in list(parent) if root(x) != x)
                parent.clear()
        yield from ((x, root(x)) for x in list(parent) if root(x) != x)

    return in_arrow(links.select("a", "b"), "a long, b long", work)


def _noted(links: DataFrame) -> tuple[DataFrame, tuple]:
    """Links ``(a, b)`` in storage, their number and a sum over them, which tell two link tables apart; taken while they are written."""
    note = Observation()
    kept = stored(links.observe(note, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")), "links")
    return kept, (note.get["n"], note.get["sum"])


def component_labels(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of the links ``(a, b)``: the smallest node of its component."""
    edges = stored(local_forest(links).where("a <> b").distinct(), "links")
    while True:
        # the stored links lie in fewer partitions than they came from, so their forests are smaller
        edges, before = _noted(local_forest(edges))
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # tables on both sides of a join: Spark splits the partition of a node with very many links
        low = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "links")
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        down, after = _noted(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        least = stored(down.groupBy("a").agg(F.min("b").alias("m")), "links")
        # no node lies between two others, and none has two smaller ones: stars
        if after == before and least.count() == after[0]:
            break
        small = (
            down.join(least, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        edges = stored(small, "links")
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.union(edges.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
