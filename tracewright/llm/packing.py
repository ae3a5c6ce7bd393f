"""Best-fit packing by a grouping genetic algorithm over island populations.

A document's ids (with an end id) are cut into pieces of at most ``capacity``;
pieces are packed into as few sequences as can be found.

The genes are groups, that is sequences. Pieces of one length are alike, so an
individual is a table of *patterns* (the lengths that share a sequence) and how
many sequences have each, and its size depends on the capacity, not on the
number of documents:

* crossover injects well-filled patterns of one parent into the other, removes
  the sequences that would hold a piece twice, and best-fits the displaced
  pieces into what is left;
* mutation breaks up a share of the worst-filled sequences and best-fits again;
* each island (one Spark task) evolves its own population, and after every era
  the best individual of each island migrates to the next one.

The count of pieces by length is the whole state that islands need (at most
``capacity`` rows); pieces then get their place in the winning table by their
rank within their length, in parallel.

Defined cases: null text: the end id alone; a full piece is a sequence of its
own; repeated rows are pieces of their own; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import give_back, ranked, shuffle_width
from tracewright.llm.tokens import tokenizer, tokenizer_path

#: Lengths of a sequence's pieces, longest first.
Pattern = tuple[int, ...]
#: Sequences of each pattern.
Plan = dict[Pattern, int]


@dataclass(frozen=True)
class Settings:
    """Size of the search. An era is ``steps`` new individuals on each island, then elites migrate."""

    islands: int = 4
    eras: int = 4
    steps: int = 40
    population: int = 6
    inject: float = 0.5
    disturb: float = 0.1
    seed: int = 11


# --- pieces ------------------------------------------------------------------


def token_pieces(
    docs: DataFrame, capacity: int = 2048, tokenizer_file: str | None = None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, piece, start, length, ids`` of every document; ``ids`` is little-endian uint32."""
    model = tokenizer_file or tokenizer_path()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                ids, lengths = encoder.batch(some.column(1).to_pylist(), end_id)
                cuts = -(-lengths // capacity)  # pieces of each document
                of = np.repeat(np.arange(len(lengths)), cuts)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                length = np.minimum(capacity, lengths[of] - piece * capacity)
                edges = np.concatenate([[0], np.cumsum(length)]) * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0).take(pa.array(of)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(piece * capacity),
                        pa.array(length),
                        pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(ids.astype("<u4"))]),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )
        give_back()

    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


# --- the genetic algorithm ---------------------------------------------------


def sequences(plan: Plan) -> int:
    return sum(plan.values())


def fitness(plan: Plan, capacity: int) -> float:
    """Mean squared fill of the sequences: full and nearly empty ones are better than two half full ones."""
    n = sequences(plan)
    return sum(c * (sum(p) / capacity) ** 2 for p, c in plan.items()) / n if n else 1.0


class _Open:
    """Unfinished sequences by the room they have left, for best fit."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms: list[int] = []
        self.by_room: dict[int, Plan] = {}

    def add(self, pattern: Pattern, count: int) -> None:
        room = self.capacity - sum(pattern)
        here = self.by_room.get(room)
        if here is None:
            here = self.by_room[room] = {}
            bisect.insort(self.rooms, room)
        here[pattern] = here.get(pattern, 0) + count

    def fit(self, length: int, count: int) -> None:
        """Places ``count`` pieces, each time into the least room that holds one, many alike at once."""
        while count:
            at = bisect.bisect_left(self.rooms, length)
            if at == len(self.rooms):
                each = self.capacity // length
                whole, rest = divmod(count, each)
                if whole:
                    self.add((length,) * each, whole)
                if rest:
                    self.add((length,) * rest, 1)
                return
            room = self.rooms[at]
            here = self.by_room[room]
            pattern = next(iter(here))
            many = min(room // length, count)
            used = min(here[pattern], count // many)
            here[pattern] -= used
            if not here[pattern]:
                del here[pattern]
                if not here:
                    del self.by_room[room]
                    self.rooms.pop(at)
            self.add(tuple(sorted(pattern + (length,) * many, reverse=True)), used)
            count -= used * many

    def plan(self) -> Plan:
        found: Plan = {}
        for here in self.by_room.values():
            for p, c in here.items():
                found[p] = found.get(p, 0) + c
        return found


def best_fit(lengths: Counter, capacity: int, kept: Plan | None = None, order: Iterable[int] | None = None) -> Plan:
    """Best fit, longest first (or by ``order``), around the sequences ``kept``."""
    room = _Open(capacity)
    for p, c in (kept or {}).items():
        room.add(p, c)
    for length in order if order is not None else sorted(lengths, reverse=True):
        if lengths[length]:
            room.fit(length, lengths[length])
    return room.plan()


def _held(plan: Plan) -> Counter:
    found: Counter = Counter()
    for p, c in plan.items():
        for length in p:
            found[length] += c
    return found


def crossover(a: Plan, b: Plan, demand: Counter, capacity: int, share: float, rng: np.random.Generator) -> Plan:
    """Injects a share of ``b``'s best-filled patterns into ``a``."""
    best = sorted(b, key=lambda p: (-sum(p), p))
    chosen = [p for p in best[: max(1, int(len(best) * share))] if rng.random() < 0.7]
    child: Plan = {p: b[p] for p in chosen}
    left = demand - _held(child)
    # Duplicates: of a's sequences stay those whose pieces the injected ones left over.
    for p in sorted(a, key=lambda p: (-sum(p), p)):
        need = Counter(p)
        fits = min(left[length] // n for length, n in need.items())
        many = min(a[p], fits)
        if many > 0:
            child[p] = child.get(p, 0) + many
            for length, n in need.items():
                left[length] -= n * many
    return best_fit(+left, capacity, child)


def mutate(plan: Plan, capacity: int, share: float, rng: np.random.Generator) -> Plan:
    """Breaks up the worst-filled sequences and some others, then best-fits their pieces, longest first or nearly so."""
    kept: Plan = {}
    loose: Counter = Counter()
    for p, c in plan.items():
        waste = 1 - sum(p) / capacity
        broken = c if waste > 0.02 and rng.random() < 0.9 else int(c * rng.random()) if rng.random() < share else 0
        if broken < c:
            kept[p] = c - broken
        for length in p:
            loose[length] += broken
    noise = {length: length * (1 + 0.05 * rng.random()) for length in loose}
    return best_fit(+loose, capacity, kept, sorted(loose, key=noise.__getitem__, reverse=True))


def evolve(population: list[Plan], demand: Counter, capacity: int, s: Settings, seed: int) -> list[Plan]:
    """One era of one island: ``steps`` children replace the worst individuals."""
    rng = np.random.default_rng(seed)
    key = lambda p: (sequences(p), -fitness(p, capacity))
    people = sorted(population, key=key)
    floor = -(-sum(length * n for length, n in demand.items()) // capacity)
    while len(people) < s.population:
        people.append(mutate(people[0], capacity, 0.5, rng))
    for _ in range(s.steps):
        people.sort(key=key)
        if sequences(people[0]) == floor:
            break
        a, b = rng.choice(len(people), 2, replace=False)
        child = crossover(people[min(a, b)], people[max(a, b)], demand, capacity, s.inject, rng)
        people[-1] = mutate(child, capacity, s.disturb, rng) if rng.random() < 0.6 else child
    return sorted(people, key=key)


def _to_row(island: int, plan: Plan) -> dict:
    return {"island": island, "patterns": [list(p) for p in plan], "counts": list(plan.values())}


def _to_plan(patterns, counts) -> Plan:
    return {tuple(int(x) for x in p): int(c) for p, c in zip(patterns, counts)}


def _island_era(era: int, demand: Counter, capacity: int, s: Settings):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [part for part in parts if len(part)]
        for island, group in pd.concat(rows).groupby("island") if rows else ():
            start = [_to_plan(p, c) for p, c in zip(group["patterns"], group["counts"])]
            best = evolve(start, demand, capacity, s, s.seed + 1000 * era + int(island))[0]
            yield pd.DataFrame([_to_row(int(island), best)])

    return run


ISLANDS = "island int, patterns array<array<int>>, counts array<long>"


def island_table(spark, elites: dict[int, list[Plan]]) -> DataFrame:
    """The elites of each island, an island a partition: all islands have as many, so equal runs of rows are islands."""
    rows = [tuple(_to_row(i, p).values()) for i, group in sorted(elites.items()) for p in group]
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, len(elites)), ISLANDS)


def search(spark, demand: Counter, capacity: int, s: Settings = Settings()) -> Plan:
    """The best plan of all islands after all eras; eras end early once a plan needs no more sequences than the bound.

    What travels is plans: a plan has no more rows than patterns, a few for each
    length, whatever the number of pieces.
    """
    if not demand:
        return {}
    first = best_fit(demand, capacity)
    floor = -(-sum(length * n for length, n in demand.items()) // capacity)
    elites = {i: [first] for i in range(s.islands)}
    for era in range(s.eras):
        if era and min(sequences(p) for group in elites.values() for p in group) == floor:
            break
        found = island_table(spark, elites).mapInPandas(_island_era(era, demand, capacity, s), ISLANDS).collect()  # a plan for each island
        best = {r.island: _to_plan(r.patterns, r.counts) for r in found}
        elites = {i: [best[i], best[(i - 1) % s.islands]] for i in best}  # the neighbour's elite migrates here
    people = [p for group in elites.values() for p in group] + [first]
    return min(people, key=lambda p: (sequences(p), -fitness(p, capacity)))


# --- places ------------------------------------------------------------------


def _places(plan: Plan) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length its runs of places: first rank, first sequence, places in a sequence, offset of the first, by run."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: Counter = Counter()
    base = 0
    for p in sorted(plan, reverse=True):
        offset = 0
        for length, n in Counter(p).items():  # p is sorted, so equal lengths stand together
            runs.setdefault(length, []).append((ranks[length], base, n, offset))
            ranks[length] += n * plan[p]
            offset += n * length
        base += plan[p]
    return {length: tuple(np.array(c) for c in zip(*r)) for length, r in runs.items()}


def pack(pieces: DataFrame, capacity: int = 2048, settings: Settings = Settings()) -> DataFrame:
    """Adds ``sequence_id, offset`` to ``pieces`` (with ``doc_id, piece, length`` and any other columns)."""
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``capacity`` rows
    demand = Counter({int(r["length"]): int(r["n"]) for r in counts})
    plan = search(pieces.sparkSession, demand, capacity, settings)
    places = _places(plan)
    chunk = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shuffle_width(pieces.sparkSession)))
    order = [c for c, kind in pieces.dtypes if c not in ("length",) and not kind.startswith("map")]
    numbered = ranked(pieces.withColumn("__chunk", chunk), ["length"], "__chunk", order, "__rank").drop("__chunk")

    @F.pandas_udf("struct<sequence_id long, offset long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        lengths, ranks = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        out = np.zeros((2, len(ranks)), dtype=np.int64)
        for one in np.unique(lengths):
            rows = np.flatnonzero(lengths == one)
            first, base, many, offset = places[int(one)]
            run = np.searchsorted(first, ranks[rows], "right") - 1
            inside = ranks[rows] - first[run]
            out[0, rows] = base[run] + inside // many[run]
            out[1, rows] = offset[run] + inside % many[run] * one
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    placed = numbered.withColumn("__place", place("length", "__rank"))
    return placed.select(*pieces.columns, F.col("__place.sequence_id").alias("sequence_id"), F.col("__place.offset").alias("offset"))


def packed_sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of :func:`pack` over :func:`token_pieces`; a sequence holds at most ``capacity`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("h"))))
    joined = F.unhex(F.array_join(F.transform(parts, lambda p: p["h"]), ""))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"))
