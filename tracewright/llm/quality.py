"""Quality classifier: supervised subword embeddings.

Every word, every character n-gram of a word, every word bigram (with
``Settings.pairs``) and, as one more feature, every word bigram of the kind
"same word again" hashes to a bucket with a learned vector; a document is the
average of the vectors of all its words' features, a linear layer and a softmax
give the probability of label 1. Training is plain stochastic gradient descent
in numpy over a bounded sample of labelled documents; scoring covers whole
texts.

Because the average and the layer are linear, a word's share of a score is one
number, which each worker keeps in a bounded table.

Defined cases: a null or blank text is scored by the layer's bias alone; rows
without a label, or whose label is neither 0 nor 1, are not learned from; with
nothing to learn from every score is 0.5; repeated rows get equal scores.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import WordTable, give_back


@dataclass(frozen=True)
class Settings:
    """Training parameters. ``sample_docs`` labelled documents of at most ``sample_bytes`` each, by the hash of their id, bound what is learned from."""

    buckets: int = 1 << 16
    width: int = 10
    shortest: int = 3
    longest: int = 5
    sample_docs: int = 6000
    sample_bytes: int = 32_768
    epochs: int = 4
    rate: float = 0.2
    seed: int = 7
    #: Whether word bigrams are features.
    pairs: bool = False


#: Distinct words whose features training keeps at a time.
TRAINING_WORDS = 100_000


def features(word: str, s: Settings) -> list[int]:
    """Buckets of a word and of its character n-grams (over UTF-8 bytes between border marks)."""
    w = f"<{word}>".encode()
    crc, mask = zlib.crc32, s.buckets - 1
    found = [crc(w, 1) & mask]
    n = len(w)
    for k in range(s.shortest, min(s.longest, n - 1) + 1):
        found += [crc(w[i : i + k]) & mask for i in range(n - k + 1)]
    return found


def repeats(words: list[str]) -> int:
    """How many words equal the one before them."""
    return sum(map(str.__eq__, words, words[1:]))


def again(s: Settings) -> int:
    """Bucket of the bigrams of a word with itself, whatever the word."""
    return zlib.crc32(b"again", 2) & (s.buckets - 1)


def word_hash(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"), 3)


def pair_buckets(hashes: np.ndarray, s: Settings) -> np.ndarray:
    """Buckets of the bigrams of words with these hashes, in order."""
    h = hashes.astype(np.uint64)
    with np.errstate(over="ignore"):
        mixed = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed >> np.uint64(32)).astype(np.int64) & (s.buckets - 1)


@dataclass
class Model:
    vectors: np.ndarray  # buckets x width
    layer: np.ndarray  # width x 2
    bias: np.ndarray  # 2
    settings: Settings

    def word_parts(self) -> np.ndarray:
        """Each bucket's share of the difference between the two classes."""
        return (self.vectors @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float64)


def untrained(s: Settings) -> Model:
    return Model(np.zeros((s.buckets, s.width), np.float32), np.zeros((s.width, 2), np.float32), np.zeros(2, np.float32), s)


def train(texts: list[str], labels: list[int], s: Settings) -> Model:
    """Stochastic gradient descent, one document a step, the rate falling to zero."""
    rng = np.random.default_rng(s.seed)
    model = untrained(s)  # a feature never met in training adds nothing
    model.layer[:] = rng.normal(0, 1, model.layer.shape)
    kind = np.min_scalar_type(s.buckets - 1)
    table = WordTable(lambda new: [(np.array(features(w, s), dtype=kind), word_hash(w)) for w in new], limit=TRAINING_WORDS)
    docs = []
    for text in texts:
        words = text.split()
        at = table.lookup(words)
        known = [table.values[i] for i in at]
        pairs = pair_buckets(np.array([h for _, h in known], dtype=np.uint64), s).astype(kind) if s.pairs else np.empty(0, kind)
        ids = np.concatenate([*[f for f, _ in known], pairs, np.full(repeats(words), again(s), dtype=kind)])
        buckets, counts = np.unique(ids, return_counts=True)
        docs.append((buckets, counts.astype(np.min_scalar_type(len(ids)))))
    del table
    total, step = s.epochs * len(docs), 0
    for _ in range(s.epochs):
        for i in rng.permutation(len(docs)):
            rate = s.rate * (1 - step / total)
            step += 1
            buckets, counts = docs[i]
            weight = (counts / max(1, int(counts.sum()))).astype(np.float32)
            hidden = weight @ model.vectors[buckets]
            out = hidden @ model.layer + model.bias
            p = np.exp(out - out.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = model.layer @ p
            model.layer -= rate * np.outer(hidden, p).astype(np.float32)
            model.bias -= rate * p.astype(np.float32)
            # The average spreads one step over the features, as if each were met once.
            model.vectors[buckets] -= (rate * len(buckets) * weight)[:, None] * back[None, :].astype(np.float32)
    return model


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Trains on a bounded sample of ``labels (doc_id, label)`` joined with ``docs (doc_id, text)``.

    Only ids and labels are ranked; the at most ``sample_docs`` texts chosen then
    go to one task, which trains and returns the model. An id counts if one of its
    texts is there and not longer than ``sample_bytes``; of several labels of an id
    the smallest counts, of several such texts the one with the smallest hash.
    """
    s = settings
    short = docs.where((F.octet_length("text") <= s.sample_bytes) & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    chosen = (
        labels.where("label in (0, 1) and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min(F.col("label").cast("int")).alias("label"))
        .join(short.select("doc_id"), "doc_id", "left_semi")
        .select("doc_id", "label", F.xxhash64("doc_id").alias("h"))
        .orderBy("h", "doc_id")
        .limit(s.sample_docs)
        .select("doc_id", "label")
    )
    texts = short.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by sample_docs
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text"))
    sample = texts.groupBy("doc_id", "label").agg(least.alias("t")).select("doc_id", "label", "t.text")

    def run(parts):
        rows = pd.concat(list(parts), ignore_index=True)
        if not len(rows):
            return
        rows = rows.sort_values("doc_id")
        m = train(rows.text.tolist(), rows.label.tolist(), s)
        give_back()
        yield pd.DataFrame({"vectors": [m.vectors.tobytes()], "layer": [m.layer.tobytes()], "bias": [m.bias.tobytes()]})

    got = sample.select("doc_id", "label", "text").repartition(1).mapInPandas(run, "vectors binary, layer binary, bias binary").collect()
    if not got:
        return untrained(s)
    r = got[0]
    return Model(
        np.frombuffer(r.vectors, np.float32).reshape(s.buckets, s.width),
        np.frombuffer(r.layer, np.float32).reshape(s.width, 2),
        np.frombuffer(r.bias, np.float32),
        s,
    )


def word_shares(parts: np.ndarray, s: Settings, words: list[str]) -> array:
    """Sum and number of the shares of each word's features, and the word's hash, one after the other."""
    ids = [features(w, s) for w in words]
    counts = np.array([len(i) for i in ids])
    sums = np.add.reduceat(parts[np.concatenate([np.array(i) for i in ids])], np.cumsum(counts) - counts)
    return array("d", np.stack([sums, counts, [float(word_hash(w)) for w in words]], axis=1).tobytes())


class Scorer:
    """Scores whole texts with a model's shares of buckets, one share per distinct word."""

    def __init__(self, parts: np.ndarray, bias: float, settings: Settings):
        self.parts, self.bias, self.again, self.settings = parts, bias, float(parts[again(settings)]), settings
        # The table must not refer to this object: in a cycle it would outlive its task.
        self.table = WordTable(partial(word_shares, parts, settings), limit=200_000, values=array("d"))

    def score(self, text: str | None) -> float:
        words = text.split() if text else []
        total, n = 0.0, 0
        if words:
            at = self.table.lookup(words)
            known = np.frombuffer(self.table.values).reshape(-1, 3)[at]
            total, n = known[:, :2].sum(axis=0).tolist()
            if self.settings.pairs:
                total += float(self.parts[pair_buckets(known[:, 2], self.settings)].sum())
                n += len(words) - 1
            more = repeats(words)
            total += more * self.again
            n += more
        z = self.bias + (total / n if n else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def scored(text: Column, model: Model) -> Column:
    """Probability of label 1 of a text column."""
    parts, bias, settings = model.word_parts(), float(model.bias[1] - model.bias[0]), model.settings

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(parts, bias, settings)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")
        del scorer
        give_back()

    return F.pandas_udf(run, "double", functionType=F.PandasUDFType.SCALAR_ITER)(text.cast("string"))
