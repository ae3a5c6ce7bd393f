"""Benchmark decontamination by the q-gram lemma.

An item of w characters that occurs in a document with at most e edits shares at
least w + 1 - q(e + 1) of its q-grams with it, all on diagonals (place in the
document minus place in the item) at most e apart. So shared q-grams are counted
in overlapping diagonal bands; bands that reach the bound are kept, and a banded
alignment decides whether the item is there within its edit budget. A place of
the document counts once for an item's band, however often its q-gram is in the
item, so repetitive texts cost as much as others.

Texts are compared by their lower-case letters and digits, every run of other
characters being one space. Every item is looked for whole if it is not longer
than ``window``, and by windows of half its length (at least ``part``, at most
``window`` characters) that lie so close that any quote of ``quote`` of the item
holds one; of items longer than twice ``window``, any quote of one and a half
windows. Items shorter than ``part / quote`` characters are looked for whole
only. Items are cut into blocks of bounded size by Spark; tasks read the blocks
from a stored table, one pass over the documents a block.

Defined cases: null and empty texts and items match nothing; an item of fewer
than ``shortest`` characters is looked for as it is, without edits; repeated rows
give a row each; an empty table on either side gives no rows; a null id is
carried through; of places with equally few edits the first is given; other
columns, whatever their names, are left out or (:func:`without_matches`) kept.
Texts of any length are searched whole, ``batch_chars`` or one text at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import give_back, in_arrow, stored
from tracewright.llm.shared_files import listed, open_random
from tracewright.session import scratch_path


@dataclass(frozen=True)
class Settings:
    """``rate`` edits a character are allowed; ``q`` below 1 / rate keeps the bound above zero."""

    q: int = 8
    rate: float = 0.06
    window: int = 512
    part: int = 60
    quote: float = 0.8
    shortest: int = 32
    #: Cells of alignment tables that are filled at once.
    cells: int = 500_000
    #: Places of shared q-grams that are counted at once.
    entries: int = 500_000
    #: Characters of items sent to tasks at once, and characters of documents worked on at once.
    block_chars: int = 4 << 20
    batch_chars: int = 1 << 20


_GAP = re.compile(r"(?:[^\w ]|_)+")
#: What each ASCII character is in plain form.
_ASCII = bytes(ord(chr(i).lower()) if chr(i).isascii() and chr(i).isalnum() else 32 for i in range(256))
_RUN = re.compile(r"[^\W_]+")
#: Multiplier of the rolling q-gram code.
_BASE = np.uint64(0x9E3779B97F4A7C15)


def plain(text: str | None) -> str:
    """Lower-case letters and digits, one space between runs."""
    if not text:
        return ""
    if text.isascii():
        return b" ".join(text.encode().translate(_ASCII).split()).decode()
    return " ".join(_GAP.sub(" ", text.lower()).split())


def places(text: str) -> np.ndarray:
    """For each character of ``plain(text)`` its place in ``text``; one more for the end."""
    found: list[int] = []
    for m in _RUN.finditer(text):
        if found:
            found.append(found[-1] + 1)
        for i in range(m.start(), m.end()):
            found += [i] * len(text[i].lower())
    found.append(found[-1] + 1 if found else 0)
    return np.array(found)


def windows(text: str, s: Settings) -> list[str]:
    """The parts that an item is looked for by; one that is not longer than ``window`` stands before them."""
    n = len(text)
    size = min(s.window, max(n // 2, s.part))
    step = min(int(s.quote * n), size + size // 2) - size
    if size >= n or step < 0:
        return [text] if n else []
    starts = [*range(0, n - size, max(1, step)), n - size]
    return [text][: n <= s.window] + [text[a : a + size] for a in starts]


def _codes(points: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit code of each q-gram: codes of twice as many characters are made from those of half as many."""
    n, code, size, weight = len(points) - q + 1, points, 1, _BASE
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        while q % (2 * size) == 0:
            code = code[:-size] * weight + code[size:]
            weight, size = weight * weight, 2 * size
        total = code[:n]
        for at in range(size, q, size):
            total = total * weight + code[at : at + n]
        return (total ^ (total >> np.uint64(29))) * _BASE


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


class Grams:
    """Q-grams of numbered pieces of text, and the bands of diagonals in which other texts share enough of them."""

    def __init__(self, points: list[np.ndarray], bound: np.ndarray, shift: np.ndarray, s: Settings):
        """A piece needs ``bound`` shared q-grams in a band of two steps of 2**``shift`` diagonals."""
        self.s, self.bound, self.shift = s, bound, shift
        codes = [_codes(p, s.q) for p in points]
        owner = np.repeat(np.arange(len(points)), [len(c) for c in codes])
        place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.empty(0, np.int64)
        flat = np.concatenate(codes) if codes else np.empty(0, np.uint64)
        order = np.lexsort((place, owner, flat))
        owner, place, flat = owner[order], place[order], flat[order]
        new = np.ones(len(flat), dtype=bool)
        new[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
        heads = np.flatnonzero(new)
        # an entry for each code of a piece, with its first and last place there
        self.owner, self.low = owner[heads], place[heads]
        self.high = place[np.append(heads[1:], len(flat)) - 1] if len(heads) else place[:0]
        self.codes, self.first = np.unique(flat[heads], return_index=True)
        self.stop = np.append(self.first[1:], len(heads))
        self.sieve = np.zeros(1 << 22, dtype=bool)
        self.sieve[(self.codes >> np.uint64(42)).astype(np.int64)] = True

    def bands(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces, first diagonals and ends of the bands that share enough q-grams with a run of characters, in order of pieces.

        A place counts for all bands between the diagonals of its q-gram's first and last place in the piece, so counts
        are sums over the ends of intervals.
        """
        none = np.empty(0, np.int64)
        at = np.flatnonzero(self.sieve[(codes >> np.uint64(42)).astype(np.int64)])
        if not len(self.codes) or not len(at):
            return none, none, none
        slot = np.searchsorted(self.codes, codes[at])
        same = self.codes[np.minimum(slot, len(self.codes) - 1)] == codes[at]
        at, slot = at[same], slot[same]
        many = self.stop[slot] - self.first[slot]
        found: list[tuple[np.ndarray, np.ndarray]] = []  # ends of intervals, and how much the count changes there
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(np.cumsum(many) // self.s.entries)) + 1):
            size = many[part]
            entry = np.repeat(self.first[slot[part]] - np.cumsum(size) + size, size) + np.arange(size.sum())
            where = np.repeat(at[part], size) + 2 * self.s.window  # so that no diagonal is negative
            owner = self.owner[entry]
            shift, base = self.shift[owner], owner << 40
            opens = base + ((where - self.high[entry]) >> shift)  # band ``b`` is numbered b + 1 and covers the steps b, b + 1
            closes = base + ((where - self.low[entry]) >> shift) + 2
            ends = np.sort(np.concatenate([opens * 2, closes * 2 + 1]))
            total = np.cumsum(1 - 2 * (ends & 1))
            ends >>= 1
            last = np.flatnonzero(np.append(ends[1:] != ends[:-1], True)[: len(ends)])
            found.append((ends[last], np.diff(total[last], prepend=0)))
        edge, change = found[0]
        if len(found) > 1:
            edge, turn = np.unique(np.concatenate([e for e, _ in found]), return_inverse=True)
            change = np.bincount(turn, np.concatenate([c for _, c in found]), len(edge)).astype(np.int64)
        if not len(edge):
            return none, none, none
        counts = np.cumsum(change)[:-1]
        run = np.flatnonzero((counts >= self.bound[edge[:-1] >> 40]) & (counts > 0))
        long = edge[run + 1] - edge[run]
        band = np.repeat(edge[run] - np.cumsum(long) + long, long) + np.arange(long.sum())
        who = band >> 40
        low = (((band & ((1 << 40) - 1)) - 1) << self.shift[who]) - 2 * self.s.window
        return who, low, low + (2 << self.shift[who])


class Index:
    """A block of items: their windows, and the q-grams of both.

    A text is first looked at by items: one that shares too few q-grams with an item for any of its windows holds none of
    them. Windows are counted in the other texts only.
    """

    def __init__(self, items: list[tuple[int, str]], s: Settings):
        """``items``: (item id, plain text)."""
        self.s = s
        found = [(item, k, w, n) for n, (item, text) in enumerate(items) for k, w in enumerate(windows(text, s))]
        self.item = [f[0] for f in found]
        self.window = [f[1] for f in found]
        self.points = [_points(f[2]) for f in found]
        #: The window that is the whole item, of its parts; else -1.
        self.whole = np.array([i - f[1] if f[1] and len(items[f[3]][1]) <= s.window else -1 for i, f in enumerate(found)], dtype=np.int64)
        self.length = np.array([len(p) for p in self.points], dtype=np.int64)
        self.budget = np.where(self.length >= s.shortest, np.floor(s.rate * self.length), 0).astype(np.int64)
        q = np.minimum(s.q, self.length)
        bound = np.maximum(1, self.length + 1 - q * (self.budget + 1))
        shift = np.ceil(np.log2(self.budget + 1)).astype(np.int64)
        self.short = [i for i in range(len(found)) if self.length[i] < s.q]
        self.windows = Grams(self.points, bound, shift, s)
        # an item that is a window itself stands for its parts; of a longer one each window stands for itself
        heads = [i for i in range(len(found)) if self.whole[i] < 0]
        ends = np.append(heads[1:], len(found)).astype(np.int64) if heads else np.empty(0, np.int64)
        least = np.array([bound[a:b].min() for a, b in zip(heads, ends)], dtype=np.int64)
        self.items = Grams([self.points[i] for i in heads], least, shift[heads] if heads else shift[:0], s)
        self.item_length = self.length[heads] if heads else self.length[:0]

    def search(self, texts: list[str], any_one: bool = False) -> Iterator[tuple[int, int, int, int, int]]:
        """``(text number, window number, edits, start, stop)`` of each window found in each plain text; no parts of an item found whole.

        With ``any_one`` it is enough to find one window of each text that holds any.
        """
        for i in self.short:
            needle = "".join(map(chr, self.points[i].astype(int)))
            for t, text in enumerate(texts):
                at = f" {text} ".find(f" {needle} ")
                if at >= 0:
                    yield t, i, 0, at, at + len(needle)
        points, starts, sizes = self._joined(texts)
        who, low, high = self.items.bands(_codes(points, self.s.q))
        if not len(who):
            return
        # the characters that an item may have in the band, and the texts that they lie in
        first = np.searchsorted(starts, np.maximum(low, 0), "right") - 1
        last = np.searchsorted(starts, np.minimum(high + self.item_length[who], len(points) - 1), "right") - 1
        some = np.zeros(len(texts) + 1, np.int64)
        np.add.at(some, first, 1)
        np.add.at(some, last + 1, -1)
        some = np.flatnonzero(np.cumsum(some)[:-1])
        for t, *found in self._search([texts[t] for t in some], any_one):
            yield int(some[t]), *found

    def _joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Characters of all texts with a gap between, the texts' starts and sizes."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        starts = np.cumsum(sizes + self.s.q) - sizes - self.s.q
        return _points((" " * self.s.q).join(texts)), starts, sizes

    def _search(self, texts: list[str], any_one: bool) -> Iterator[tuple[int, int, int, int, int]]:
        points, starts, sizes = self._joined(texts)
        who, low, high = self.windows.bands(_codes(points, self.s.q))
        middle = np.clip((low + high) // 2 + self.length[who] // 2, 0, len(points) - 1)
        text = np.searchsorted(starts, middle, "right") - 1
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        settled: set = set()  # what no further band can change
        name = (lambda k: int(text[k])) if any_one else (lambda k: (int(text[k]), int(who[k])))
        part = self.whole[who] >= 0
        order = np.argsort(part, kind="stable")  # whole items first
        cells = np.cumsum((high - low + 2 * self.budget[who] + 1 + self.length[who])[order]) // self.s.cells
        cut = np.diff(cells, prepend=0) + np.diff(part[order].astype(np.int64), prepend=0)
        for at in np.split(order, np.flatnonzero(cut)):
            at = np.array([k for k in at if name(k) not in settled and (text[k], self.whole[who[k]]) not in best], dtype=np.int64)
            if not len(at):
                continue
            edits, first, stop = self._aligned(points, who[at], low[at], high[at], starts[text[at]], sizes[text[at]])
            for k, e, f, z in zip(at, edits, first, stop):
                if e <= self.budget[who[k]]:
                    key, found = (int(text[k]), int(who[k])), (int(e), int(f - starts[text[k]]), int(z - starts[text[k]]))
                    best[key] = min(best.get(key, found), found)
                    if any_one or e == 0:
                        settled.add(name(k))
        yield from ((t, i, *found) for (t, i), found in sorted(best.items()) if (t, int(self.whole[i])) not in best)

    def _aligned(self, points: np.ndarray, who: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray, size: np.ndarray):
        """Edits, start and stop of the best alignment in each band; bands over equal characters are aligned once."""
        low, high, end = low - self.budget[who], high + self.budget[who], start + size
        if len(who) > 1:
            reach = int((high - low + self.length[who]).max()) + 1
            around = low[:, None] + np.arange(-1, reach)
            inside = (around >= start[:, None]) & (around < end[:, None])
            seen = np.where(inside, points[np.clip(around, 0, len(points) - 1)], np.uint64(1 << 40))
            _, kept, again = np.unique(np.column_stack([who.astype(np.uint64), seen]), axis=0, return_index=True, return_inverse=True)
            if len(kept) < len(who):
                again = again.reshape(-1)
                edits, first, stop = banded(points, self.points, who[kept], low[kept], high[kept], start[kept], end[kept])
                moved = low - low[kept][again]
                return edits[again], first[again] + moved, stop[again] + moved
        return banded(points, self.points, who, low, high, start, end)


def banded(
    points: np.ndarray, items: list[np.ndarray], who: np.ndarray, low: np.ndarray, high: np.ndarray, left: np.ndarray, right: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edits, start and stop of the best alignment of each candidate's item within its band and its text.

    All candidates go through the rows of the alignment table side by side; a
    cell's column is its diagonal, so a row needs the row before and one running
    minimum for characters left out of the item.
    """
    n, width = len(who), int((high - low).max()) + 1
    length = np.array([len(items[i]) for i in who])
    deep = int(length.max())
    item = np.zeros((n, deep), dtype=np.uint64)
    for k, i in enumerate(who):
        item[k, : length[k]] = items[i]
    column = np.arange(width)
    far = np.int64(1 << 30)
    place = low[:, None] + column[None, :]  # text place before which the item starts, at row 0
    inside = lambda p: (p >= left[:, None]) & (p <= right[:, None]) & (column[None, :] < (high - low)[:, None])
    cost = np.where(inside(place), 0, far).astype(np.int64)
    origin = place.copy()
    best_cost, best_from, best_to = np.full(n, far), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for row in range(1, deep + 1):
        here = place + row  # text characters up to ``here`` are used
        ok = inside(here)
        letter = points[np.clip(here - 1, 0, len(points) - 1)]
        step = cost + (letter != item[:, row - 1 : row]) + np.where(here - 1 >= left[:, None], 0, far)
        skip = np.concatenate([cost[:, 1:], np.full((n, 1), far)], axis=1) + 1  # an item character without partner
        skip_from = np.concatenate([origin[:, 1:], np.zeros((n, 1), np.int64)], axis=1)
        take = skip < step
        cost = np.where(ok, np.where(take, skip, step), far)
        origin = np.where(take, skip_from, origin)
        # A text character without partner moves one diagonal to the right.
        run = np.minimum.accumulate((cost - column) * width + column, axis=1)
        source = run % width
        shifted = np.take_along_axis(cost, source, axis=1) + column - source
        better = shifted < cost
        cost = np.where(better & ok, shifted, cost)
        origin = np.where(better, np.take_along_axis(origin, source, axis=1), origin)
        done = np.flatnonzero(length == row)
        if len(done):
            end = cost[done].argmin(axis=1)
            best_cost[done] = cost[done, end]
            best_from[done] = origin[done, end]
            best_to[done] = here[done, end]
    return best_cost, best_from, best_to


def stored_items(benchmark: DataFrame, s: Settings, id_col: str = "item_id", text_col: str = "text") -> list[list[str]]:
    """The distinct items in plain form as Parquet files, which tasks read; the files of each block of about ``block_chars``."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(plain)

    rows = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    rows = stored(rows.select("item_id", cut("text").alias("text")).where("text <> ''").distinct(), "benchmark-items")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // s.block_chars)
    if not blocks:
        return []
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int")
    path = scratch_path(benchmark.sparkSession, "benchmark-blocks")
    rows.withColumn("block", block).repartition("block").write.partitionBy("block").parquet(path)
    found = [[uri for uri, _ in listed(f"{path}/block={b}", ".parquet")] for b in range(blocks)]
    return [files for files in found if files]


def read_items(files: list[str]) -> list[tuple]:
    """``(item_id, plain text)`` of a block, in order."""
    found: list[tuple] = []
    for uri in files:
        with open_random(uri) as f:
            table = pq.ParquetFile(f).read(columns=["item_id", "text"])
        found += zip(table["item_id"].to_pylist(), table["text"].to_pylist())
    return sorted(found, key=lambda r: (r[0] is not None, r[0], r[1]) if r[0] is not None else (False, 0, r[1]))


def matches(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, part, edits, start, stop``: where in a document's text each (window of an) item is, at its best place."""
    s = settings
    spark = docs.sparkSession
    kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id long, item_id {kind}, part int, edits int, start long, stop long"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    found = spark.createDataFrame([], schema)
    for files in stored_items(benchmark, s):

        def work(source: Iterable[dict], files=files) -> Iterator[tuple]:
            index = Index(read_items(files), s)
            held, size = [], 0
            for r in source:
                held.append((r["doc_id"], r["text"], plain(r["text"])))
                size += len(held[-1][2])
                if size >= s.batch_chars:
                    yield from _report(index, held)
                    held, size = [], 0
            yield from _report(index, held)

        found = found.unionByName(in_arrow(rows, schema, work))
    return found


def without_matches(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; all columns as they were.

    The test is a function of the text, so rows need no id and none is joined.
    """
    s = settings
    kept = docs
    for files in stored_items(benchmark, s):

        def clean(parts, files=files):
            index = Index(read_items(files), s)
            for texts in parts:
                flags = np.ones(len(texts), dtype=bool)
                sizes = np.array([len(t) if t else 0 for t in texts]).cumsum() // s.batch_chars
                for k in np.unique(sizes):
                    rows = np.flatnonzero(sizes == k)
                    for t, *_ in index.search([plain(texts.iloc[r]) for r in rows], any_one=True):
                        flags[rows[t]] = False
                yield pd.Series(flags)
            del index
            give_back()

        test = F.pandas_udf(clean, "boolean", functionType=F.PandasUDFType.SCALAR_ITER)
        kept = kept.where(test(F.col("text").cast("string")))
    return kept


def _report(index: Index, held: list[tuple[int, str, str]]) -> Iterator[tuple]:
    for t, i, edits, start, stop in index.search([h[2] for h in held]):
        key, text, _ = held[t]
        at = places(text)
        yield key, index.item[i], index.window[i], edits, int(at[start]), int(at[max(start, stop - 1)]) + 1
