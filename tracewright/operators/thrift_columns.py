"""Thrift spans of a whole Arrow batch at once.

Each message has a cursor. In every step all cursors read one field (or the end
of a struct) together; values go as they come to flat columns, one event a
value, and nested arrays are put together from those at the end. No span is a
Python object. A message with anything unusual (nested unknown fields, a list
given twice, a value missing, broken bytes) leaves this path and is read by
:func:`tracewright.operators.thrift.read_spans`, which decides what it is worth.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tracewright.operators.thrift import (
    ANNOTATION_TYPES,
    T_BOOL,
    T_BYTE,
    T_DOUBLE,
    T_I16,
    T_I32,
    T_I64,
    T_LIST,
    T_STOP,
    T_STRING,
    T_STRUCT,
    ThriftError,
    read_spans,
)

SPAN, ANN, TAG, ANN_EP, TAG_EP, DONE = range(6)
#: Sizes of values that stand as they are.
_FIXED = {T_BOOL: 1, T_BYTE: 1, T_DOUBLE: 8, T_I16: 2, T_I32: 4, T_I64: 8}
_SIZE = np.zeros(256, np.int64)
for _kind, _n in _FIXED.items():
    _SIZE[_kind] = _n
# --- fixed values: field ids of the span model, by struct, kind and id --------
_KNOWN = [
    (SPAN, T_I64, 1), (SPAN, T_STRING, 3), (SPAN, T_I64, 4), (SPAN, T_I64, 5), (SPAN, T_I64, 10), (SPAN, T_I64, 11), (SPAN, T_I64, 12),
    (ANN, T_I64, 1), (ANN, T_STRING, 2), (TAG, T_STRING, 1), (TAG, T_STRING, 2), (TAG, T_I32, 3),
    (ANN_EP, T_I32, 1), (ANN_EP, T_I16, 2), (ANN_EP, T_STRING, 3), (TAG_EP, T_I32, 1), (TAG_EP, T_I16, 2), (TAG_EP, T_STRING, 3),
]
_LISTS = {6: ANN, 8: TAG}


def _code(ctx, kind, field):
    return (ctx << 16) | (kind << 8) | field


_WANTED = np.zeros(1 << 19, bool)
for _known in _KNOWN:
    _WANTED[_code(*_known)] = True


class _Events:
    """Values by the code of their field: rows and values, a later one of a row in place of an earlier one."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)

    def settle(self) -> None:
        self.all = [np.concatenate(c) for c in zip(*self.parts)] if self.parts else [np.empty(0, np.int64)] * 4

    def column(self, code: int, rows: int, width: int = 1) -> tuple[np.ndarray, ...]:
        """Whether each row has the field, and its value(s)."""
        at = self.all[0] == code
        there, values = np.zeros(rows, bool), [np.zeros(rows, np.int64) for _ in range(width)]
        there[self.all[1][at]] = True
        for value, found in zip(values, self.all[2:]):
            value[self.all[1][at]] = found[at]
        return there, *values


class _Batch:
    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        n = len(starts)
        self.data = np.concatenate([data, np.zeros(16, np.uint8)])  # cursors may look a little behind the end
        self.pos, self.end = starts.copy(), ends
        self.ctx = np.where(ends > starts, SPAN, DONE)
        self.slow = ends <= starts
        self.left = np.zeros((3, n), np.int64)  # structs still to come in the lists of spans, annotations, tags
        self.row = np.zeros((5, n), np.int64)  # the row that each cursor is in, by struct
        self.count = [0, 0, 0]
        self.owner: list[list[np.ndarray]] = [[], [], []]  # message of each span, span of each annotation and tag
        self.seen = np.zeros((3, n), bool)  # lists that a span has had
        self.numbers, self.texts = _Events(), _Events()
        self.endpoints: list[list[np.ndarray]] = [[], []]

    def big(self, at: np.ndarray, size: int) -> np.ndarray:
        """Signed big-endian numbers."""
        value = np.zeros(len(at), np.uint64)
        for i in range(size):
            value = (value << np.uint64(8)) | self.data[at + i]
        shift = np.uint64(64 - 8 * size)
        return (value << shift).view(np.int64) >> np.int64(64 - 8 * size)

    def fail(self, who: np.ndarray) -> None:
        self.slow[who] = True
        self.ctx[who] = DONE

    def begin(self, kind: int, who: np.ndarray) -> None:
        """New rows of spans, annotations or tags."""
        self.row[kind, who] = np.arange(self.count[kind], self.count[kind] + len(who))
        self.count[kind] += len(who)
        self.owner[kind].append(who if kind == SPAN else self.row[SPAN, who])
        self.ctx[who] = kind
        if kind == SPAN:
            self.seen[:, who] = False

    def run(self) -> None:
        who = np.flatnonzero(self.ctx == SPAN)
        many = self.data[self.pos[who]] == T_STRUCT
        self.open_list(SPAN, who[many])
        self.left[SPAN, who[~many]] = 1
        self.begin(SPAN, who[~many])
        act = np.flatnonzero(self.ctx != DONE)
        while len(act):
            self.step(act)
            act = act[self.ctx[act] != DONE]

    def open_list(self, kind: int, who: np.ndarray) -> None:
        """Cursors stand before an element type and a count."""
        at = self.pos[who]
        count = self.big(at + 1, 4)
        good = (self.data[at] == T_STRUCT) & (at + 5 <= self.end[who]) & (count >= 0) & (count <= self.end[who] - at - 5)
        self.fail(who[~good])
        who, count = who[good], count[good]
        self.pos[who] += 5
        self.left[kind, who] = count
        some = count > 0
        self.begin(kind, who[some])
        if kind == SPAN:
            self.finish(who[~some])

    def finish(self, who: np.ndarray) -> None:
        self.ctx[who] = DONE
        self.slow[who] |= self.pos[who] != self.end[who]

    def step(self, act: np.ndarray) -> None:
        at, ctx = self.pos[act], self.ctx[act]
        kind = self.data[at].astype(np.int64)
        inside = at < self.end[act]
        stop = inside & (kind == T_STOP)
        self.pos[act[stop]] += 1
        self.close(act[stop], ctx[stop])
        field = self.big(at + 1, 2)
        code = _code(ctx, kind, field & 0xFF)
        size = _SIZE[kind]
        fixed = inside & (size > 0) & (at + 3 + size <= self.end[act])
        wanted = (field >= 0) & (field < 256) & _WANTED[np.minimum(code, len(_WANTED) - 1)]
        self.pos[act[fixed]] += 3 + size[fixed]
        for one in (T_I64, T_I32, T_I16):
            at_one = np.flatnonzero(fixed & wanted & (kind == one))
            if len(at_one):
                self.numbers.add(code[at_one], self.row[ctx[at_one], act[at_one]], self.big(at[at_one] + 3, _FIXED[one]))
        text = inside & (kind == T_STRING)
        length = np.where(text, self.big(at + 3, 4) if text.any() else 0, 0)
        text &= (length >= 0) & (at + 7 + length <= self.end[act])
        self.pos[act[text]] += 7 + length[text]
        known = np.flatnonzero(text & wanted)
        if len(known):
            self.texts.add(code[known], self.row[ctx[known], act[known]], at[known] + 7, length[known])
        done = stop | fixed | text
        for struct, endpoint, number in ((ANN, ANN_EP, 3), (TAG, TAG_EP, 4)):
            host = inside & (kind == T_STRUCT) & (ctx == struct) & (field == number)
            if host.any():
                some = act[host]
                self.pos[some] += 3
                self.ctx[some] = endpoint
                self.row[endpoint, some] = self.row[struct, some]
                self.endpoints[struct - ANN].append(self.row[struct, some])
                done |= host
        for number, struct in _LISTS.items():
            here = inside & (kind == T_LIST) & (ctx == SPAN) & (field == number) & ~self.seen[struct, act]
            if here.any():
                some = act[here]
                self.pos[some] += 3
                self.seen[struct, some] = True
                self.open_list(struct, some)
                done |= here
        self.fail(act[~done])

    def close(self, who: np.ndarray, ctx: np.ndarray) -> None:
        """Ends of structs: the next of a list begins, or what is around it goes on."""
        for endpoint, struct in ((ANN_EP, ANN), (TAG_EP, TAG)):
            self.ctx[who[ctx == endpoint]] = struct
        for struct in (SPAN, ANN, TAG):
            some = who[ctx == struct]
            if len(some):
                self.left[struct, some] -= 1
                more = self.left[struct, some] > 0
                self.begin(struct, some[more])
                if struct == SPAN:
                    self.finish(some[~more])
                else:
                    self.ctx[some[~more]] = SPAN

    # -- arrays ---------------------------------------------------------------

    def bytes_of(self, there: np.ndarray, start: np.ndarray, length: np.ndarray, text: bool, empty: bool = False) -> pa.Array:
        """Values out of the messages, in order of rows; rows without are null (or empty)."""
        length = np.where(there, length, 0)
        ends = np.cumsum(length)
        taken = np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
        body = self.data[taken].tobytes()
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        mask = None if empty or there.all() else pa.array(there).buffers()[1]
        if text:
            heads = np.frombuffer(body, np.uint8)[offsets[:-1][length > 0]] if body else np.empty(0, np.uint8)
            try:
                body.decode()
                split = bool(((heads & 0xC0) == 0x80).any())
            except UnicodeDecodeError:
                split = True
            if split:
                pieces = [body[a:b].decode("utf-8", "replace") if t or empty else None for a, b, t in zip(offsets, offsets[1:], there)]
                return pa.array(pieces, pa.string())
        return pa.Array.from_buffers(pa.string() if text else pa.binary(), len(there), [mask, pa.py_buffer(offsets), pa.py_buffer(body)])

    def settle(self) -> None:
        """Marks the messages of rows that lack what they must have; numbers the rows that stay."""
        self.numbers.settle()
        self.texts.settle()
        span_of = [np.concatenate(o) if o else np.empty(0, np.int64) for o in self.owner]
        message = [span_of[SPAN], span_of[SPAN][span_of[ANN]], span_of[SPAN][span_of[TAG]]]
        needs = {
            SPAN: [(self.numbers, _code(SPAN, T_I64, 1)), (self.numbers, _code(SPAN, T_I64, 4))],
            ANN: [(self.numbers, _code(ANN, T_I64, 1)), (self.texts, _code(ANN, T_STRING, 2))],
            TAG: [(self.texts, _code(TAG, T_STRING, 1)), (self.texts, _code(TAG, T_STRING, 2))],
        }
        for struct, wants in needs.items():
            for events, code in wants:
                self.slow[message[struct][~events.column(code, self.count[struct])[0]]] = True
        self.message, self.span_of = message, span_of

    def endpoint(self, struct: int, keep: np.ndarray) -> pa.Array:
        ctx, rows = (ANN_EP, self.count[ANN]) if struct == ANN else (TAG_EP, self.count[TAG])
        there = np.zeros(rows, bool)
        for some in self.endpoints[struct - ANN]:
            there[some] = True
        has, start, length = self.texts.column(_code(ctx, T_STRING, 3), rows, 2)
        name = self.bytes_of(has[keep], start[keep], length[keep], True)
        has, ip = self.numbers.column(_code(ctx, T_I32, 1), rows)
        unique, place = np.unique(ip[keep] & 0xFFFFFFFF, return_inverse=True)
        dotted = pa.array([".".join(str(v >> s & 255) for s in (24, 16, 8, 0)) for v in unique.tolist()], pa.string())
        ipv4 = dotted.take(pa.array(place, mask=~has[keep]))
        has, port = self.numbers.column(_code(ctx, T_I16, 2), rows)
        port = pa.array((port[keep] & 0xFFFF).astype(np.int32), mask=~has[keep])
        return pa.StructArray.from_arrays([name, ipv4, port], names=["service_name", "ipv4", "port"], mask=pa.array(~there[keep]))

    def spans(self, kind: pa.StructType) -> tuple[pa.Array, np.ndarray]:
        """The spans of messages that stayed, in order, and the message of each."""
        order = np.argsort(self.message[SPAN], kind="stable")
        order = order[~self.slow[self.message[SPAN][order]]]
        rank = np.full(self.count[SPAN], -1)
        rank[order] = np.arange(len(order))

        def number(field: int, default: bool = False) -> pa.Array:
            has, value = self.numbers.column(_code(SPAN, T_I64, field), self.count[SPAN])
            return pa.array(value[order], mask=None if default else ~has[order])

        def nested(struct: int, element: pa.DataType, build) -> pa.Array:
            of = rank[self.span_of[struct]]
            keep = np.argsort(of, kind="stable")
            keep = keep[of[keep] >= 0]
            sizes = np.bincount(of[keep], minlength=len(order))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            return pa.ListArray.from_arrays(offsets, build(keep).cast(element))

        def annotations(keep: np.ndarray) -> pa.Array:
            _, at = self.numbers.column(_code(ANN, T_I64, 1), self.count[ANN])
            has, start, length = self.texts.column(_code(ANN, T_STRING, 2), self.count[ANN], 2)
            columns = [pa.array(at[keep]), self.bytes_of(has[keep], start[keep], length[keep], True), self.endpoint(ANN, keep)]
            return pa.StructArray.from_arrays(columns, names=["timestamp", "value", "endpoint"])

        def tags(keep: np.ndarray) -> pa.Array:
            key, value = (self.texts.column(_code(TAG, T_STRING, f), self.count[TAG], 2) for f in (1, 2))
            has, code = self.numbers.column(_code(TAG, T_I32, 3), self.count[TAG])
            names = pa.array([*ANNOTATION_TYPES, "BYTES"])
            code = np.where(has, np.where((code >= 0) & (code < len(ANNOTATION_TYPES)), code, len(ANNOTATION_TYPES)), ANNOTATION_TYPES.index("STRING"))
            parts = [self.bytes_of(*(c[keep] for c in column), text) for column, text in ((key, True), (value, False))]
            return pa.StructArray.from_arrays([*parts, names.take(pa.array(code[keep])), self.endpoint(TAG, keep)], names=["key", "value", "type", "endpoint"])

        name = self.texts.column(_code(SPAN, T_STRING, 3), self.count[SPAN], 2)
        columns = {
            "trace_id_high": number(12, True), "trace_id": number(1), "id": number(4), "parent_id": number(5),
            "name": self.bytes_of(*(c[order] for c in name), True, True), "timestamp": number(10), "duration": number(11),
            "annotations": nested(ANN, kind.field("annotations").type.value_type, annotations),
            "binary_annotations": nested(TAG, kind.field("binary_annotations").type.value_type, tags),
        }
        return pa.StructArray.from_arrays([columns[f.name] for f in kind], names=[f.name for f in kind]).cast(kind), self.message[SPAN][order]


def decode(values: pa.Array, kind: pa.StructType, bad: str) -> pa.StructArray:
    """``struct(spans, reason)`` of an array of payloads; null payloads give nulls."""
    values = values.cast(pa.binary()) if values.type != pa.binary() else values
    n = len(values)
    offsets = np.frombuffer(values.buffers()[1], np.int32, n + 1, values.offset * 4).astype(np.int64) if n else np.zeros(1, np.int64)
    body = values.buffers()[2] if n else None
    here = np.asarray(values.is_valid()) if n else np.empty(0, bool)
    rows = np.flatnonzero(here)
    batch = _Batch(np.frombuffer(body, np.uint8) if body is not None and len(body) else np.empty(0, np.uint8), offsets[:-1][rows], offsets[1:][rows])
    batch.run()
    batch.settle()
    spans, message = batch.spans(kind)
    sizes = np.bincount(message, minlength=len(rows))
    broken, others, owner = np.zeros(len(rows), bool), [], []
    for m in np.flatnonzero(batch.slow).tolist():
        try:
            found = read_spans(values[int(rows[m])].as_py())
            others += found
            owner += [m] * len(found)
        except ThriftError:
            broken[m] = True
    if others:
        spans = pa.concat_arrays([spans, pa.array(others, kind)])
        message = np.concatenate([message, owner])
        spans = spans.take(pa.array(np.argsort(message, kind="stable")))
        sizes = np.bincount(message, minlength=len(rows))
    of_row, bad_row = np.zeros(n, np.int64), np.zeros(n, bool)
    of_row[rows], bad_row[rows] = sizes, broken
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(of_row)]).astype(np.int32)), spans, mask=pa.array(~here | bad_row))
    reason = pa.array([bad] * n, pa.string()) if n else pa.array([], pa.string())
    reason = reason.take(pa.array(np.zeros(n, np.int64), mask=~bad_row)) if n else reason
    return pa.StructArray.from_arrays([lists, reason], names=["spans", "reason"])
