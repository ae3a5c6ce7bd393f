"""SpotSigs fingerprints: chains of content words that follow common-word anchors.

Wherever a common word (an anchor) or the start of a line stands, the next
``chain`` content words form a signature together with it; a fingerprint is the
set of a text's signature hashes, written as ascending hex numbers. Likeness is
the Jaccard similarity of two such sets.

Pairs are found without comparing all: sets are put into partitions by length
such that two similar sets are in the same or neighbouring ones, a set meets
only sets that share one of its rarest signatures, and a pair is given up as
soon as its lengths or what is left of the sets rule the threshold out.

Defined cases: a null text is empty and has the empty fingerprint; two empty
fingerprints are equal (likeness 1), an empty and another one have likeness 0; a
text with one content word and no anchor has one signature; repeated rows have
equal fingerprints; a null id stands before all others; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import NULL_KEY, in_arrow, range_of, range_starts, shuffle_width, stored
from tracewright.llm.components import component_labels

#: Anchors: frequent function words of English, German, French and Spanish (fixed values).
ANCHORS = frozenset(
    """
    a an and are as at be but by for from had has have he her his in is it its not of on or she that the their they
    this to was were which with you
    aber als am auch auf aus bei das dass dem den der des die ein eine einen einer er es für im ist mit nach nicht
    noch sich sie sind und von war wie wird zu zum zur
    au aux avec ce ces dans de des du elle en est et il ils la le les leur mais ne nous on ou par pas plus pour que
    qui sa se ses son sont sur un une
    al como con del desde el ella ellos entre era es esta este la las lo los más muy no o para pero por que se ser
    sin sobre su sus un una y
    """.split()
)

_LINE = re.compile(r"[^\n\r]+")
_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Settings:
    """``chain`` content words follow an anchor."""

    chain: int = 2
    anchors: frozenset[str] = field(default=ANCHORS)


def signatures(text: str | None, s: Settings = Settings()) -> np.ndarray:
    """The ascending distinct 64-bit signature hashes of a whole text."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    anchors, chain = s.anchors, s.chain
    found: set[str] = set()
    for line in _LINE.findall(text.lower()):
        words = _WORD.findall(line)
        content = [w for w in words if w not in anchors]
        if not content:
            continue
        found.add("^ " + " ".join(content[:chain]))
        if len(content) == len(words):
            continue
        last, at = len(content), 0
        for w in words:
            if w in anchors:
                if at < last:
                    found.add(" ".join([w, *content[at : at + chain]]))
            else:
                at += 1
    digest = xxhash.xxh64_intdigest
    return np.array(sorted(digest(f) for f in found), dtype=np.uint64)


def as_text(hashes: np.ndarray) -> str:
    """16 lower-case hex digits a signature, ascending."""
    return hashes.astype(">u8").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), dtype=">u8").astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard similarity of two sets of ascending hashes; 0 if it is below ``at_least``, which the lengths alone may tell."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < at_least * large or not small:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    place = np.searchsorted(b, a)
    shared = int((b[np.minimum(place, len(b) - 1)] == a).sum())
    found = shared / (len(a) + len(b) - shared)
    return found if found >= at_least else 0.0


# --- neighbours in id order --------------------------------------------------


def edited(text: str, after: str) -> str:
    """``text`` whose last floor(n/2) code points are replaced by the first as many (or all) of ``after``."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def neighbour_fingerprints(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, with likenesses to the edited text and to the next document.

    The next document is that of the next larger id (after the last: the first).
    Documents are dealt to ranges of ids; the first document of a range also goes
    to the range before it, so each range is worked through on its own.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keyed = rows.withColumn("key", F.coalesce("doc_id", F.lit(NULL_KEY)))
    starts = range_starts(rows.select("doc_id"), "doc_id", 3 * shuffle_width(spark))
    ranges = max(1, len(starts))
    here = keyed.withColumn("range", range_of(starts, "key"))
    first = F.col("key").isin(starts.tolist()) if len(starts) <= 64 else _is_start(starts)
    homes = F.when(first, F.array("range", F.pmod(F.col("range") - 1, F.lit(ranges)).cast("int"))).otherwise(F.array("range"))
    dealt = (
        here.select("doc_id", "key", "text", F.posexplode(homes).alias("guest", "home"))
        .repartition("home")
        .sortWithinPartitions("home", "guest", "key", "text")
    )

    def work(source: Iterable[dict]) -> Iterator[tuple]:
        at, held = None, None  # range, and the document whose successor is awaited with its hashes
        for r in source:
            if r["home"] != at:
                at, held = r["home"], None
            if held is None and r["guest"]:
                continue
            hashes = signatures(r["text"], settings)
            if held is not None:
                yield _row(*held, r["text"], hashes, settings)
            held = None if r["guest"] else (r["doc_id"], r["text"], hashes)

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return in_arrow(dealt, schema, work, rows=500)


def _row(doc_id: int | None, text: str, mine: np.ndarray, after: str, next_hashes: np.ndarray, s: Settings) -> tuple:
    changed = edited(text, after)
    other = signatures(changed, s)
    sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), sha, as_text(mine), as_text(other), likeness(mine, other), likeness(mine, next_hashes)


def _is_start(starts: np.ndarray):
    @F.pandas_udf("boolean")
    def test(k):
        import pandas as pd

        return pd.Series(np.isin(k.to_numpy(np.int64), starts))

    return test("key")


# --- similar documents -------------------------------------------------------


def length_partition(n: int, threshold: float) -> int:
    """Partition of a set of ``n`` signatures: sets whose lengths differ by less than the threshold are at most one apart."""
    return int(math.floor(math.log(n) / -math.log(threshold) + 1e-9)) if n else -1


def similar_documents(docs: DataFrame, threshold: float = 0.8, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, class_id, links`` of every document: classes of documents connected by pairs of likeness ``threshold`` or more.

    Equal fingerprints are one representative. Representatives meet by one of
    their rarest signatures: a set of n and any set as similar as the threshold
    share one of the first n - ceil(threshold * n) + 1 by rising frequency.
    Signatures of a set stay together in one row, so a very common signature,
    which is nobody's rarest unless a set has no other, makes no pairs.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def mark(source: Iterable[dict]) -> Iterator[tuple]:
        for r in source:
            hashes = signatures(r["text"], settings)
            yield r["doc_id"], xxhash.xxh64_intdigest(hashes.tobytes()) - (1 << 63), hashes.view(np.int64).tolist()

    marked = stored(in_arrow(rows, "doc_id long, rep long, sigs array<long>", mark, rows=500), "spotsigs")
    reps = marked.groupBy("rep").agg(F.first("sigs").alias("sigs"))
    pairs = stored(similar_sets(reps, threshold), "spotsigs-pairs")
    labels = component_labels(pairs)
    degrees = pairs.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    members = marked.groupBy("rep").agg(F.min("doc_id").alias("first"))
    rooted = members.join(labels, members.rep == labels.node, "left").select("rep", "first", F.coalesce("label", "rep").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("class_id"))
    facts = rooted.join(named, "root").join(degrees, "rep", "left").select("rep", "class_id", F.coalesce("links", F.lit(0)).alias("links"))
    return marked.select("doc_id", "rep").join(facts, "rep").select("doc_id", "class_id", "links")


def similar_sets(reps: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: pairs of representatives ``(rep, sigs)`` with Jaccard similarity ``threshold`` or more, a < b."""
    each = reps.where(F.size("sigs") > 0).select("rep", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    frequency = each.groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    shared = each.join(frequency.where("df > 1"), "sig")
    # Signatures that one set alone has cannot match, but they count among its rarest.
    alone = each.groupBy("rep", "n").agg(F.count(F.lit(1)).alias("all")).join(
        shared.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("met")), "rep"
    )
    prefix = F.expr(f"n - cast(ceil({threshold} * n) as int) + 1 - (all - size(met))")
    rare = alone.where(prefix > 0).select("rep", "n", F.explode(F.slice("met", F.lit(1), prefix)).alias("m"))
    step = -math.log(threshold)
    keyed = rare.select("rep", "n", F.col("m.sig").alias("sig"), F.floor(F.log("n") / step + F.lit(1e-9)).alias("p"))
    left = keyed.select(F.col("rep").alias("a"), F.col("n").alias("na"), "sig", F.explode(F.array("p", F.col("p") + 1)).alias("p"))
    right = keyed.select(F.col("rep").alias("b"), F.col("n").alias("nb"), "sig", "p")
    close = (F.col("nb") > F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("a") < F.col("b")))
    met = left.join(right, ["sig", "p"]).where(close & (F.col("na") >= threshold * F.col("nb"))).select("a", "b").distinct()
    sets = reps.select("rep", "sigs")
    full = met.join(sets.withColumnsRenamed({"rep": "a", "sigs": "sa"}), "a").join(sets.withColumnsRenamed({"rep": "b", "sigs": "sb"}), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    alike = both >= threshold * (F.size("sa") + F.size("sb") - both)
    return full.where(alike).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


__all__ = ["ANCHORS", "Settings", "as_text", "edited", "from_text", "likeness", "neighbour_fingerprints", "pa", "signatures", "similar_documents"]
