"""Language identification by rank-order n-gram profiles.

A language's profile is its most frequent character n-grams by rank, counted
over all of its training texts. A document's n-grams are ranked alike, and its
distance to a language is the sum of how far each of its n-grams is out of place
(an n-gram missing from the profile counts as the profile's length).

Defined cases: a null text or one without any letter is ``und`` with score 0;
rows with a null language or key are never learned from; equal distances go to
the first language by name; with nothing learned every text is ``und``; repeated
rows count once each in training and get equal predictions.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tracewright.llm.common import WordTable, give_back, in_arrow

UNKNOWN = "und"
#: N-grams of a profile. An n-gram of up to three characters is one number: 21 bits hold any code point.
PROFILE, _BITS = 400, 21
#: Distinct (language, word) counts that a task holds before it passes their n-grams on.
HELD_WORDS = 200_000
#: Border of a word.
_BORDER = ord("_")

#: Letters, and numbers that are no decimal digits, such as fractions and Roman numerals.
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """The lower-case letter runs of a whole text; a letter is what Unicode has as one."""
    words = _WORD.findall(text.lower())
    if all(map(str.isalpha, words)):
        return words
    return [part for w in words for part in "".join(c if c.isalpha() else " " for c in w).split()]


def _codes(words: list[str]) -> list[np.ndarray]:
    """Codes of the 1-, 2- and 3-grams that start at each place of the words in a row between borders; a 3-gram over a border is -1."""
    points = np.frombuffer(f"_{'_'.join(words)}_".encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    two = (points[:-1] << _BITS) | points[1:]
    three = np.where(points[1:-1] == _BORDER, -1, (two[:-1] << _BITS) | points[2:])
    return [points, two, three]


def grams_of(words: list[str]) -> list[np.ndarray]:
    """For each word all n-grams between its borders as numbers; the border alone is none."""
    one, two, three = _codes(words)
    found, at = [], 1
    for w in words:
        stop = at + len(w)
        found.append(np.concatenate([one[at:stop], two[at - 1 : stop], three[at - 1 : stop - 1]]))
        at = stop + 1
    return found


def gram_sums(words: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Codes and sums of the n-grams of counted words."""
    one, two, three = _codes(list(words))
    times = np.repeat(np.fromiter(words.values(), dtype=np.int64), [len(w) + 1 for w in words])
    codes = np.concatenate([one[1:], two, three])
    weight = np.concatenate([times, times, times[: len(three)]])
    real = (codes != _BORDER) & (codes >= 0)
    found, place = np.unique(codes[real], return_inverse=True)
    return found, np.bincount(place, weights=weight[real]).astype(np.int64)


def top_grams(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent of ascending ``codes``, most frequent first, ties by the code."""
    return codes[np.argsort(-counts, kind="stable")[:size]]


def learn_profiles(rows: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """Profiles from all rows of ``(lang, text)``; what reaches the driver is ``size`` n-grams a language.

    Tasks count words in bounded tables and pass on their n-grams' sums, Spark
    adds them up, and the ranking window keeps the first ``size`` before its
    shuffle as well.
    """

    def work(source: Iterable[dict]) -> Iterator[tuple]:
        words: dict[str, Counter] = defaultdict(Counter)
        held = 0

        def flush() -> Iterator[tuple]:
            for lang, seen in words.items():
                if seen:
                    codes, sums = gram_sums(seen)
                    yield from ((lang, c, n) for c, n in zip(codes.tolist(), sums.tolist()))
            words.clear()

        for r in source:
            mine = words[r["lang"]]
            before = len(mine)
            mine.update(words_of(r["text"]))
            held += len(mine) - before
            if held >= HELD_WORDS:
                yield from flush()
                held = 0
        yield from flush()

    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counts = in_arrow(known, "lang string, gram long, n long", work).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    profiles: dict[str, list] = defaultdict(list)
    for r in counts.withColumn("rank", rank).where(F.col("rank") <= size).select("lang", "gram", "rank").collect():
        profiles[r.lang].append((r.rank, r.gram))
    return {lang: [g for _, g in sorted(p)] for lang, p in sorted(profiles.items())}


class Identifier:
    """Out-of-place distances of texts to profiles."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.langs = sorted(profiles)
        self.size = size
        self.codes = np.unique(np.array([g for p in profiles.values() for g in p] or [0], dtype=np.int64))
        self.places = np.full((len(self.codes), len(self.langs)), -1, dtype=np.int64)
        for i, lang in enumerate(self.langs):
            self.places[np.searchsorted(self.codes, profiles[lang]), i] = np.arange(len(profiles[lang]))
        self.table = WordTable(grams_of, limit=100_000)

    def predict(self, text: str | None) -> tuple[str, float]:
        """``language, score``: the share by which its distance is below the largest possible."""
        words = words_of(text) if text else []
        if not words or not self.langs:
            return UNKNOWN, 0.0
        at = self.table.lookup(words)
        values = self.table.values
        grams = np.sort(np.concatenate([values[i] for i in at]))
        edges = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        mine = top_grams(grams[edges], np.diff(edges, append=len(grams)), self.size)
        place = np.minimum(np.searchsorted(self.codes, mine), len(self.codes) - 1)
        ranks = np.where((self.codes[place] == mine)[:, None], self.places[place], -1)
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(mine))[:, None]))
        total = apart.sum(axis=0)
        best = int(total.argmin())
        return self.langs[best], float(1 - total[best] / (self.size * len(mine)))


#: The share of training scores that may lie below a score, half of which is the least a known language has (fixed values).
FLOOR_SHARE, FLOOR_PART = 0.01, 0.5


def score_floor(scores: DataFrame) -> float:
    """``FLOOR_PART`` of the score that ``FLOOR_SHARE`` of ``scores (score)`` are below, to a thousandth; 0 without any.

    Counts by thousandths come to the driver, so the floor does not depend on how rows are dealt.
    """
    steps = scores.groupBy(F.floor(F.col("score") * 1000).alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy("step").collect()
    total, below = sum(r.n for r in steps), 0
    for r in steps:
        below += r.n
        if below > FLOOR_SHARE * total:
            return FLOOR_PART * r.step / 1000
    return 0.0


def predicted(text: Column, profiles: dict[str, list[int]]) -> Column:
    """``struct<lang_pred, score>`` of a text column."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        identifier = Identifier(profiles)
        for texts in parts:
            yield pd.DataFrame([identifier.predict(t) for t in texts], columns=["lang_pred", "score"])
        del identifier
        give_back()

    kind = "struct<lang_pred string, score double>"
    return F.pandas_udf(run, kind, functionType=F.PandasUDFType.SCALAR_ITER)(text.cast("string"))
