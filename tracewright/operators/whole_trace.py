"""A4: adjusters in user code that see a whole trace, whatever its size.

A trace may hold most of all spans, so no function gets it whole. User code says
what it needs to know of a trace as facts, which are made from slices and merged,
then gets slices of spans together with the trace's merged facts. Slices of one
trace go to many tasks; a slice is at most one Arrow batch. What is to be added
once a trace is made from the facts alone.
"""

from __future__ import annotations

import logging
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tracewright.schema import SPAN_COLUMNS, SPAN_SCHEMA, TRACE_COLS
from tracewright.session import ship_package, stored

log = logging.getLogger("tracewright.adjust")

#: Traces whose facts a task keeps before it passes them on.
HELD_TRACES = 20_000
_FACTS = "__facts"
_FAILED = b""


@dataclass(frozen=True)
class TraceAdjuster:
    """User code of a whole-trace adjuster; spans are tables of the span schema.

    * ``facts(spans)`` of a slice of a trace, and ``merge(a, b)`` of two facts, in
      any order and grouping; facts are small, as each span meets a copy of them;
    * ``adjust(spans, facts)`` gives the spans of the slice as they shall be:
      rewritten, fewer, or more;
    * ``finish(facts)`` gives spans (dicts) to add once to the trace.

    If ``facts`` or ``merge`` raises, the trace stays as it is; if ``adjust`` or
    ``finish`` does, the slice stays, or nothing is added.
    """

    facts: Callable[[pa.Table], object]
    merge: Callable[[object, object], object]
    adjust: Callable[[pa.Table, object], pa.Table] | None = None
    finish: Callable[[object], list[dict]] | None = None


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.Table]]:
    """The spans of each trace in a batch."""
    rows = pa.Table.from_batches([batch])
    rows = rows.sort_by([(c, "ascending") for c in TRACE_COLS])
    high, low = (rows[c].to_numpy() for c in TRACE_COLS)
    change = ((high[1:] != high[:-1]) | (low[1:] != low[:-1])).nonzero()[0] + 1
    ends = [0, *change.tolist(), rows.num_rows] if rows.num_rows else []
    for start, end in zip(ends, ends[1:]):
        yield (int(high[start]), int(low[start])), rows.slice(start, end - start)


def _merged(merge: Callable, a: bytes, b: bytes) -> bytes:
    if a == _FAILED or b == _FAILED:
        return _FAILED
    try:
        return pickle.dumps(merge(pickle.loads(a), pickle.loads(b)))
    except Exception as exc:  # noqa: BLE001 - isolation is the point
        log.warning("facts of a trace cannot be merged, it stays as it is: %s", exc)
        return _FAILED


def trace_adjuster(user: TraceAdjuster, name: str = "trace_adjuster") -> Callable[[DataFrame], DataFrame]:
    """The adjuster ``DataFrame -> DataFrame`` of user code; three passes of Arrow batches, one exchange of facts."""
    key = [T.StructField(c, T.LongType(), False) for c in TRACE_COLS]
    facts_type = T.StructType([*key, T.StructField(_FACTS, T.BinaryType(), False)])
    facts_schema, span_schema = to_arrow_schema(facts_type), to_arrow_schema(SPAN_SCHEMA)

    def batch_of(facts: dict[tuple[int, int], bytes]) -> pa.RecordBatch:
        columns = [[k[0] for k in facts], [k[1] for k in facts], list(facts.values())]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, facts_schema)], schema=facts_schema)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], bytes] = {}
        for batch in batches:
            for trace, spans in _slices(batch):
                try:
                    found = pickle.dumps(user.facts(spans))
                except Exception as exc:  # noqa: BLE001
                    log.warning("%s has no facts of a trace, it stays as it is: %s", name, exc)
                    found = _FAILED
                held[trace] = _merged(user.merge, held[trace], found) if trace in held else found
            if len(held) >= HELD_TRACES:
                yield batch_of(held)
                held = {}
        if held:
            yield batch_of(held)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Facts come in order of traces: those of one trace are next to each other."""
        last: tuple[int, int] | None = None
        held: dict[tuple[int, int], bytes] = {}
        for batch in batches:
            for high, low, found in zip(*(batch.column(c).to_pylist() for c in (*TRACE_COLS, _FACTS))):
                if (high, low) == last:
                    held[last] = _merged(user.merge, held[last], found)
                    continue
                if len(held) >= HELD_TRACES:
                    yield batch_of(held)
                    held = {}
                last = (high, low)
                held[last] = found
        if held:
            yield batch_of(held)

    def checked(spans: pa.Table) -> pa.Table:
        spans = spans.select(SPAN_COLUMNS).cast(span_schema)
        for field, column in zip(span_schema, spans.columns):
            if not field.nullable and column.null_count:
                raise ValueError(f"a span without {field.name}")
        return spans

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, spans in _slices(batch):
                found = spans[_FACTS][0].as_py()
                spans = spans.select(SPAN_COLUMNS).cast(span_schema)  # what joins add may be null in the schema
                if found is not None and found != _FAILED:
                    try:
                        spans = checked(user.adjust(spans, pickle.loads(found)))
                    except Exception as exc:  # noqa: BLE001
                        log.warning("%s left %d spans of a trace as they were: %s", name, spans.num_rows, exc)
                out.append(spans)
            if out:
                yield from pa.concat_tables(out).combine_chunks().to_batches()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for found in batch.column(_FACTS).to_pylist():
                if found != _FAILED:
                    try:
                        new = list(user.finish(pickle.loads(found)))
                        checked(pa.Table.from_pylist(new, schema=pa.schema([f.with_nullable(True) for f in span_schema])))
                        out += new
                    except Exception as exc:  # noqa: BLE001
                        log.warning("%s added nothing to a trace: %s", name, exc)
            if out:
                yield from pa.Table.from_pylist(out, schema=span_schema).combine_chunks().to_batches()

    def run(df: DataFrame) -> DataFrame:
        ship_package(df.sparkSession)
        spans = df.select(*SPAN_COLUMNS)
        partial = spans.mapInArrow(gather, facts_type)
        facts = partial.repartition(*TRACE_COLS).sortWithinPartitions(*TRACE_COLS).mapInArrow(unite, facts_type)
        facts = stored(facts, "trace-facts")  # a row a trace, read by both passes that follow
        out = spans
        if user.adjust is not None:
            # skewed partitions of spans are split, as an outer join to facts needs no trace in one place
            out = spans.join(facts, list(TRACE_COLS), "left").mapInArrow(apply, SPAN_SCHEMA)
        if user.finish is not None:
            out = out.unionByName(facts.mapInArrow(add, SPAN_SCHEMA))
        return out

    run.__name__ = name
    return run


def drop_spans(spans: pa.Table, which: pa.ChunkedArray) -> pa.Table:
    """The spans for which ``which`` is not true."""
    return spans.filter(pc.invert(pc.fill_null(which, False)))
