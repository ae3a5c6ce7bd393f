"""Adjusters: ``DataFrame -> DataFrame`` transforms over the span table.

Span-local adjusters are projections. A conditional adjuster rewrites each
column it touches as ``when(pred, new).otherwise(old)``; all rewrites read the
*input* row (one ``withColumns``), so a chain of them is a run of projections
with no exchange. Rewrites of array elements are lambdas, which Spark evaluates
outside generated code. Arithmetic is ``try_*``: no value of a span can stop a
batch.
"""

from __future__ import annotations

import functools
import json
import logging
import math
import zlib
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.spans import (
    has_annotation,
    has_tag_key_containing,
    has_tag_value_in,
)
from tracewright.operators.trace import merge_by_id, sample_traces
from tracewright.schema import (
    CLIENT_RECV,
    CLIENT_SEND,
    FINAGLE_FLUSH,
    FINAGLE_VERSION_KEY_PART,
    HIT_OR_MISS,
    SERVER_RECV,
    SERVER_SEND,
)

log = logging.getLogger(__name__)

Adjuster = Callable[[DataFrame], DataFrame]
Updates = Callable[[], Mapping[str, Column]]


# --- A1 / A3: chain and identity -------------------------------------------
def identity(df: DataFrame) -> DataFrame:
    """A3: passes everything through."""
    return df


def chain(adjusters: Sequence[Adjuster], isolate: bool = True) -> Adjuster:
    """A1: each adjuster takes the previous one's output, in list order.

    With ``isolate`` (A11) an adjuster that fails while building its plan is
    logged and skipped; its input goes on to the next one.
    """
    steps = [guarded(a) for a in adjusters] if isolate else list(adjusters)

    def run(df: DataFrame) -> DataFrame:
        return functools.reduce(lambda acc, a: acc.transform(a), steps, df)

    return run


def guarded(adjuster: Adjuster) -> Adjuster:
    """Skip an adjuster whose plan cannot be built (analysis error etc.)."""

    def run(df: DataFrame) -> DataFrame:
        try:
            out = adjuster(df)
            out.schema  # force analysis now, inside the guard
            return out
        except Exception as exc:  # noqa: BLE001 - isolation is the point
            log.warning("adjuster %r was left out, its plan cannot be built: %s", adjuster, exc)
            return df

    run.__name__ = getattr(adjuster, "__name__", "adjuster")
    return run


# --- A2: conditional span adjuster ------------------------------------------
_PRED = "__adjust_pred"


def sound(*values: Column) -> Column:
    """Whether all ``values`` can be evaluated for the row: false where one of them raises an error.

    The values are hashed within a function that gives null in place of an error. They stand in a lambda, as Spark
    would else evaluate parts that several of them share ahead of that function.
    """
    inside = F.transform(F.array(F.lit(0)), lambda _: F.struct(*values))
    return F.try_to_binary(F.xxhash64(inside).cast("string"), F.lit("utf-8")).isNotNull()


def conditional(
    predicate: Column | Callable[[], Column],
    updates: Updates,
    prepare: Callable[[Column], Mapping[str, Column]] | None = None,
    total: bool = False,
) -> Adjuster:
    """A2: ``pred ? adjust(span) : span``; same rows, same order, no shuffle.

    ``predicate`` null counts as false. The predicate is evaluated once per
    row into a staging column, and ``prepare(pred)`` may stage shared
    intermediate columns the updates read (e.g. annotation times): lambda
    expressions never compare equal, so Spark cannot de-duplicate repeated
    higher-order functions by itself. A later filter on a rewritten column may
    still repeat a staged expression in the filter.

    A11: a span for which the predicate, a staged column or an update raises an
    error at run time stays as it is. This evaluates each of them twice; with
    ``total``, for expressions that cannot raise, once and without that guard.
    """
    safe = (lambda *_: F.lit(True)) if total else sound

    def run(df: DataFrame) -> DataFrame:
        pred = predicate() if callable(predicate) else predicate
        staged = df.withColumn(_PRED, F.when(safe(pred), F.coalesce(pred, F.lit(False))).otherwise(F.lit(False)))
        p = F.col(_PRED)
        extra = dict(prepare(p)) if prepare else {}
        if extra:
            if not total:
                staged = staged.withColumn(_PRED, p & sound(*extra.values()))
            staged = staged.withColumns({c: e if total else F.when(p, e) for c, e in extra.items()})
        new = updates()
        if not total:
            staged = staged.withColumn(_PRED, p & sound(*[F.when(p, e) for e in new.values()]))
        out = staged.withColumns({c: F.when(p, e).otherwise(F.col(c)) for c, e in new.items()})
        return out.drop(_PRED, *extra)

    return run


# --- A5: backfill timestamp and duration ------------------------------------
_TIMES = "__ann_times"


def annotation_times() -> Column:
    """Earliest cs, latest cr, earliest sr, latest ss in one pass over the
    annotations (``least``/``greatest`` skip nulls)."""
    nb = F.lit(None).cast("bigint")
    init = F.struct(nb.alias("cs"), nb.alias("cr"), nb.alias("sr"), nb.alias("ss"))

    def step(acc: Column, a: Column) -> Column:
        v, t = a["value"], a["timestamp"]
        return F.struct(
            F.when(v == CLIENT_SEND, F.least(acc["cs"], t)).otherwise(acc["cs"]).alias("cs"),
            F.when(v == CLIENT_RECV, F.greatest(acc["cr"], t)).otherwise(acc["cr"]).alias("cr"),
            F.when(v == SERVER_RECV, F.least(acc["sr"], t)).otherwise(acc["sr"]).alias("sr"),
            F.when(v == SERVER_SEND, F.greatest(acc["ss"], t)).otherwise(acc["ss"]).alias("ss"),
        )

    return F.aggregate("annotations", init, step)


def _stage_times(pred: Column | None = None) -> dict[str, Column]:
    times = annotation_times()
    return {_TIMES: times if pred is None else F.when(pred, times)}


def backfill_updates() -> dict[str, Column]:
    """Contract: fill only null fields from the client pair (cs, cr) when cs is
    present, else from the server pair (sr, ss). Earliest start, latest end;
    duration only when both ends exist, end > start and it fits into 64 bits.
    Reads the staged
    annotation times (see ``annotation_times``)."""
    t = F.col(_TIMES)
    has_cs = t["cs"].isNotNull()
    start = F.when(has_cs, t["cs"]).otherwise(t["sr"])
    end = F.when(has_cs, t["cr"]).otherwise(t["ss"])
    return {
        "timestamp": F.coalesce(F.col("timestamp"), start),
        "duration": F.coalesce(F.col("duration"), F.when(end > start, F.try_subtract(end, start))),
    }


def backfill_timestamp_duration(df: DataFrame) -> DataFrame:
    """A5 applied to every span."""
    return df.withColumns(_stage_times()).withColumns(backfill_updates()).drop(_TIMES)


# --- A6 / A7: Finagle -------------------------------------------------------
def is_finagle() -> Column:
    """Any tag key containing ``finagle.version`` (case-sensitive)."""
    return has_tag_key_containing(FINAGLE_VERSION_KEY_PART)


def finagle_adjuster(apply_timestamp_and_duration: bool = True) -> Adjuster:
    """Finagle spans get A5; with the flag off it is the identity."""
    if not apply_timestamp_and_duration:
        return identity
    return conditional(is_finagle, backfill_updates, _stage_times, total=True)


# --- A8: Finagle issue 343 --------------------------------------------------
def issue343_predicate() -> Column:
    return has_annotation(FINAGLE_FLUSH) & has_tag_value_in(HIT_OR_MISS)


def issue343_adjuster() -> Adjuster:
    """A span with a ``finagle.flush`` annotation and any tag value equal to
    Hit or Miss loses all its ``finagle.flush`` annotations."""

    def updates() -> dict[str, Column]:
        return {
            "annotations": F.filter(
                "annotations", lambda a: ~F.coalesce(a["value"] == F.lit(FINAGLE_FLUSH), F.lit(False))
            )
        }

    return conditional(issue343_predicate, updates, total=True)


# --- A9: root server span ---------------------------------------------------
def is_root_server_span() -> Column:
    return has_annotation(SERVER_RECV) & F.col("parent_id").isNull()


def root_server_backfill() -> Adjuster:
    """A9 (as in the reference test): backfill only root spans with ``sr``."""
    return conditional(is_root_server_span, backfill_updates, _stage_times, total=True)


# --- A12: prune -------------------------------------------------------------
def prune(tag_keys: Iterable[str] = (), annotation_values: Iterable[str] = ()) -> Adjuster:
    """Drop tags by key and annotations by value (deny lists)."""
    keys = [F.lit(k) for k in tag_keys]
    values = [F.lit(v) for v in annotation_values]

    def run(df: DataFrame) -> DataFrame:
        upd = {}
        if keys:
            upd["binary_annotations"] = F.filter(
                "binary_annotations", lambda b: ~F.coalesce(b["key"].isin(*keys), F.lit(False))
            )
        if values:
            upd["annotations"] = F.filter("annotations", lambda a: ~F.coalesce(a["value"].isin(*values), F.lit(False)))
        return df.withColumns(upd) if upd else df

    return run


# --- A13: re-key ------------------------------------------------------------
def rekey(salt: int) -> Adjuster:
    """Rewrite span ids consistently (parents too) by XOR with ``salt``.

    XOR is a bijection on 64-bit ids, so distinct ids stay distinct and every
    parent link still points at its rewritten parent; no join needed.
    """
    s = F.lit(salt).cast("bigint")

    def run(df: DataFrame) -> DataFrame:
        return df.withColumns({"id": F.col("id").bitwiseXOR(s), "parent_id": F.col("parent_id").bitwiseXOR(s)})

    return run


# --- A14: normalize service names -------------------------------------------
def _alias_lookup(aliases: Mapping[str, str]) -> Callable[[Column], Column]:
    """Alias of a name, or null, from one folded constant: a map of maps by the name's hash.

    A map is searched from its start, so ``n`` aliases in about ``sqrt(n)`` maps
    cost ``2 * sqrt(n)`` steps, and any number of them is one literal.
    """
    parts = max(1, math.isqrt(len(aliases)))
    table: dict[str, dict[str, str]] = {}
    for k, v in sorted(aliases.items()):
        table.setdefault(str(zlib.crc32(k.encode()) % parts), {})[k] = v
    maps = F.from_json(F.lit(json.dumps(table)), "map<string,map<string,string>>")

    def find(name: Column) -> Column:
        part = F.pmod(F.crc32(name.cast("binary")), F.lit(parts)).cast("string")
        return F.try_element_at(F.try_element_at(maps, part), name)

    return find


def normalize_services(aliases: Mapping[str, str] | None = None, missing: str = "unknown") -> Adjuster:
    """Lower-case and trim every endpoint service name, map aliases, and
    fill missing (null or empty) names with ``missing``.

    The alias table is configuration of any size; it is one constant of the
    plan, so there is no join and no broadcast.
    """
    find = _alias_lookup(aliases) if aliases else None

    def norm(name: Column) -> Column:
        n = F.lower(F.trim(name))
        n = F.when(n.isNull() | (n == ""), F.lit(missing)).otherwise(n)
        return F.coalesce(find(n), n) if find is not None else n

    def fix_ep(ep: Column) -> Column:
        return F.when(ep.isNull(), ep).otherwise(ep.withField("service_name", norm(ep["service_name"])))

    def run(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                "annotations": F.transform("annotations", lambda a: a.withField("endpoint", fix_ep(a["endpoint"]))),
                "binary_annotations": F.transform(
                    "binary_annotations", lambda b: b.withField("endpoint", fix_ep(b["endpoint"]))
                ),
            }
        )

    return run


# --- A15: scrub private data ------------------------------------------------
# fixed value: pattern for the local part of an e-mail address
EMAIL_LOCAL_PART = r"[A-Za-z0-9._%+-]+@"


def scrub(pattern: str = EMAIL_LOCAL_PART, replacement: str = "***@", hash_keys: Iterable[str] = ()) -> Adjuster:
    """Mask matches of ``pattern`` in the value of every string tag; tags
    whose key is in ``hash_keys`` get the SHA-256 hex of their value instead, as
    a string. Values of other kinds stay byte for byte."""
    hk = [F.lit(k) for k in hash_keys]

    def clean(b: Column) -> Column:
        masked = F.regexp_replace(b["value"].cast("string"), pattern, replacement).cast("binary")
        value = F.when(F.coalesce(b["type"], F.lit("STRING")) == "STRING", masked).otherwise(b["value"])
        if not hk:
            return b.withField("value", value)
        hashed = F.coalesce(b["key"].isin(*hk), F.lit(False))
        value = F.when(hashed, F.sha2(b["value"], 256).cast("binary")).otherwise(value)
        return b.withField("value", value).withField("type", F.when(hashed, F.lit("STRING")).otherwise(b["type"]))

    def run(df: DataFrame) -> DataFrame:
        return df.withColumn("binary_annotations", F.transform("binary_annotations", clean))

    return run


# --- settings -> adjuster list (J5) -----------------------------------------
#: What the keys of the settings begin with.
SETTINGS = ("merge.", "finagle.", "normalize.", "prune.", "scrub.", "sample.", "rekey.")


def adjusters_from_settings(settings: Mapping[str, object]) -> list[Adjuster]:
    """The adjusters that the settings turn on, in this order; without settings there are none.

    * ``merge.enabled``: merge by id, first, so that the others see whole spans;
    * ``finagle.enabled`` (``finagle.apply-timestamp-and-duration``, on unless
      told otherwise), with it ``finagle.adjust-issue343``;
    * ``normalize.enabled``, or ``normalize.aliases`` (``name:alias``, comma list);
    * ``prune.tag-keys``, ``prune.annotation-values`` (comma lists);
    * ``scrub.enabled``, ``scrub.pattern``, ``scrub.replacement``, ``scrub.hash-keys``;
    * ``sample.min-duration`` (micros), ``sample.keep-errors`` (on unless told otherwise);
    * ``rekey.salt`` (a whole number), last, as it changes the ids.

    A key that none of them knows is refused.
    """
    unread = {str(k): v for k, v in settings.items()}
    out: list[Adjuster] = []

    def text(key: str, default: str | None = None) -> str | None:
        v = unread.pop(key, None)
        return default if v is None else str(v)

    def flag(key: str, default: bool = False) -> bool:
        return text(key, str(default)).strip().lower() == "true"

    def names(key: str) -> list[str]:
        return [n.strip() for n in text(key, "").split(",") if n.strip()]

    if flag("merge.enabled"):
        out.append(merge_by_id)
    finagle, times, issue343 = flag("finagle.enabled"), flag("finagle.apply-timestamp-and-duration", True), flag("finagle.adjust-issue343")
    if finagle:
        out.append(finagle_adjuster(times))
    if finagle and issue343:
        out.append(issue343_adjuster())
    aliases = dict(pair.split(":", 1) for pair in names("normalize.aliases"))
    if flag("normalize.enabled") or aliases:
        out.append(normalize_services(aliases))
    tag_keys, annotation_values = names("prune.tag-keys"), names("prune.annotation-values")
    if tag_keys or annotation_values:
        out.append(prune(tag_keys, annotation_values))
    pattern, replacement, hashed = text("scrub.pattern"), text("scrub.replacement", "***@"), names("scrub.hash-keys")
    if flag("scrub.enabled") or pattern or hashed:
        out.append(scrub(pattern or EMAIL_LOCAL_PART, replacement, hashed))
    slow, errors = text("sample.min-duration"), flag("sample.keep-errors", True)
    if slow is not None:
        out.append(functools.partial(sample_traces, min_duration=int(slow), keep_errors=errors))
    salt = text("rekey.salt")
    if salt is not None:
        out.append(rekey(int(salt)))
    if unread:
        raise ValueError(f"unknown adjuster settings: {sorted(unread)}")
    return out


# --- A2/A11 with arbitrary Python: Arrow batches, guarded -------------------
def python_adjuster(fn: Callable, name: str | None = None) -> Adjuster:
    """A span-level adjuster written in Python over Arrow record batches.

    ``fn(batch: pyarrow.RecordBatch) -> pyarrow.RecordBatch`` must keep the
    span schema and the rows. It runs in ``mapInArrow`` (vectorised transfer,
    one batch at a time, never a whole trace). A11: if ``fn`` raises for a
    batch, the batch is halved until the failing spans stand alone; only they
    pass through unchanged, so the result does not depend on how spans are
    batched or partitioned. A task logs the number of its failures once.
    """
    label = name or getattr(fn, "__name__", "python_adjuster")

    def adjusted(batch, failures: list):
        try:
            out = fn(batch)
            if out.schema != batch.schema or out.num_rows != batch.num_rows:
                raise TypeError("adjuster changed the span schema or the number of spans")
            yield out
        except Exception as exc:  # noqa: BLE001 - isolation is the point
            if batch.num_rows <= 1:
                failures.append(exc)
                yield batch
                return
            half = batch.num_rows // 2
            yield from adjusted(batch.slice(0, half), failures)
            yield from adjusted(batch.slice(half), failures)

    def guarded_batches(batches):
        import logging as _logging

        count, last = 0, None
        for batch in batches:
            failures: list = []
            yield from adjusted(batch, failures)
            count, last = count + len(failures), failures[-1] if failures else last
        if count:
            _logging.getLogger("tracewright.adjust").warning("%s left %d spans as they were; last error: %s", label, count, last)

    def run(df: DataFrame) -> DataFrame:
        from tracewright.session import ship_package

        ship_package(df.sparkSession)
        return df.mapInArrow(guarded_batches, df.schema)

    run.__name__ = label
    return run
