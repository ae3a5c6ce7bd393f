"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A transcript is a run of lines, some of which open with a speaker marker. Hidden
states are (role, first or later line of a turn); what is seen of a line is its
marker, its length class, its closing punctuation, and whether it opens the
transcript. Start, transition and emission counts come from labelled lines, all
of them, as Spark aggregates; the most likely states come from the Viterbi
recursion, and turns are rendered from them.

One transcript may hold most lines, so its lines are numbered without gaps and
cut into segments of ``SEGMENT`` lines. Over a segment the recursion is a
max-plus matrix; matrices are multiplied in order in rounds of ``FAN`` at a time
until a transcript has at most ``FAN`` of them, and the state that each ends in
is found from the last round down to the segments, which are then decoded on
their own. No task sees a whole transcript, and the result is that of one pass
over it.

Lines are in order of ``turn, row, copy, line``, of which a table need have
``line`` only: rows of one turn stand one after the other, by their hash, and
equal rows too.

Defined cases: a null text is an empty line without marker; null numbers come
first; lines of equal numbers are ordered by their text; a null transcript id
is an id of its own; unlabelled lines are not learned from; with nothing learned
every line is a first line of the first role by name; an empty table gives no
rows; a line or turn may be of any length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.llm.common import in_arrow, shuffle_width, stored

#: What lines of a transcript are ordered by, as far as a table has it.
ORDER = ("turn", "row", "copy", "line")
#: Stands for a null number while lines are put in order.
_NONE = -(2**63)
#: Lines of a segment.
SEGMENT = 1024
#: Matrices that one task multiplies in a round.
FAN = 1024
#: Words of speaker markers, by the class they are seen as (fixed values).
MARKERS = {
    "system": "system", "instructions": "system",
    "user": "user", "human": "user", "q": "user", "question": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "a": "assistant", "answer": "assistant",
}
_MARKER = re.compile(
    r"^\s*(?:<\|(?P<tag>\w+)\|>|\[(?P<box>\w+)\]|#{1,4}\s*(?P<head>\w+)\s*:?(?=\s|$)|\*\*(?P<bold>\w+):?\*\*:?|(?P<name>\w+)\s*:(?=\s|$))\s*",
    re.IGNORECASE,
)
#: Weight of a line's closing punctuation and length classes.
_LENGTHS = (0, 20, 60, 120, 240, 480)


def marker(line: str) -> tuple[str, int]:
    """Class of the speaker marker that opens a line (``none`` without one) and where the text after it begins."""
    m = _MARKER.match(line)
    word = next((g for g in m.groups() if g), "").lower() if m else ""
    return (MARKERS[word], m.end()) if word in MARKERS else ("none", 0)


def seen(line: str | None, opens: bool) -> tuple[str, str, str, str]:
    """The features of a line; each is emitted on its own given the state."""
    kind, start = marker(line or "")
    body = (line or "")[start:].strip()
    size = sum(len(body) > n for n in _LENGTHS)
    end = body[-1:] if body[-1:] in ("?", ".", ":") else "other" if body else "empty"
    return f"m:{kind}", f"n:{size}", f"e:{end}", f"o:{int(opens)}"


@dataclass
class Model:
    states: list[tuple[str, bool]]  # role, first line of a turn
    start: np.ndarray
    move: np.ndarray  # from, to
    emit: dict[str, np.ndarray]
    unseen: np.ndarray

    def scores(self, line: str | None, opens: bool) -> np.ndarray:
        return sum((self.emit.get(f, self.unseen) for f in seen(line, opens)), np.zeros(len(self.states)))


def smoothed(roles: list[str], starts: Counter, moves: Counter, emits: Counter) -> Model:
    """Log probabilities with one added to every count."""
    states = [(r, first) for r in roles for first in (True, False)]
    place = {s: i for i, s in enumerate(states)}
    n = len(states)
    start, move = np.ones(n), np.ones((n, n))
    for s, c in starts.items():
        start[place[s]] += c
    for (a, b), c in moves.items():
        move[place[a], place[b]] += c
    for i, (role, first) in enumerate(states):
        if not first:  # a later line follows a line of its own role and never opens a transcript
            start[i] = 0
            for j, (other, _) in enumerate(states):
                if other != role:
                    move[j, i] = 0
    per_state = np.ones(n)
    for (s, f), c in emits.items():
        if f.startswith("m:"):
            per_state[place[s]] += c
    emit: dict[str, np.ndarray] = {}
    for (s, f), c in emits.items():
        emit.setdefault(f, np.ones(n))[place[s]] += c
    with np.errstate(divide="ignore"):
        return Model(
            states,
            np.log(start / start.sum()),
            np.log(move / move.sum(axis=1, keepdims=True)),
            {f: np.log(v / (per_state + 8)) for f, v in emit.items()},
            np.log(1 / (per_state + 8)),
        )


# --- learning ----------------------------------------------------------------


def fit(lines: DataFrame) -> Model:
    """Counts over all labelled lines ``(conv, line, text, role, first)``; a table of states and features comes back.

    Lines that are :func:`numbered` already keep their places.

    Within a segment lines are read in order; moves across a segment's end come
    from its last state and the first of the next segment, joined on its number.
    """
    place = [c for c in ("at",) if c in lines.columns]
    labelled = lines.where(F.col("role").isNotNull()).select("conv", *order_of(lines), "text", "role", "first", *place)

    def work(source: Iterable[dict]) -> Iterator[tuple]:
        counts: Counter = Counter()
        at, last = None, None
        for r in source:
            here, state = (r["conv"], r["seg"]), f"{r['role']}\t{int(r['first'])}"
            if here != at:
                if at is not None:
                    yield "last", last, "", 1, *at
                yield "first", state, "", 1, *here
            else:
                counts["move", last, state] += 1
            for f in seen(r["text"], bool(r["opens"])):
                counts["emit", state, f] += 1
            at, last = here, state
        if at is not None:
            yield "last", last, "", 1, *at
        for (kind, a, b), n in counts.items():
            yield kind, a, b, n, None, None

    found = stored(in_arrow(_segments(labelled), "kind string, a string, b string, n long, conv string, seg long", work), "transcript-counts")
    ends = found.where("kind = 'last'").select("conv", (F.col("seg") + 1).alias("seg"), "a")
    begins = found.where("kind = 'first'").select("conv", "seg", F.col("a").alias("b"))
    crossing = begins.alias("g").join(ends.alias("e"), F.expr("g.conv <=> e.conv and g.seg = e.seg")).select(F.lit("move").alias("kind"), "a", "b", F.lit(1).alias("n"))
    opening = begins.where("seg = 0").select(F.lit("start").alias("kind"), F.col("b").alias("a"), F.lit("").alias("b"), F.lit(1).alias("n"))
    inner = found.where("kind in ('move', 'emit')").select("kind", "a", "b", "n")
    total = inner.union(crossing).union(opening).groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect()  # states and features
    state = lambda text: (text.split("\t")[0], text.endswith("1"))
    starts, moves, emits = Counter(), Counter(), Counter()
    for r in total:
        if r.kind == "start":
            starts[state(r.a)] += r.n
        elif r.kind == "move":
            moves[state(r.a), state(r.b)] += r.n
        else:
            emits[state(r.a), r.b] += r.n
    roles = sorted({s[0] for s, _ in emits}) or ["user"]
    return smoothed(roles, starts, moves, emits)


def order_of(lines: DataFrame) -> list[str]:
    return [c for c in ORDER if c in lines.columns]


def numbered(lines: DataFrame) -> DataFrame:
    """Adds ``at``: the place of each line in its transcript, from 0 and without gaps.

    Lines are dealt to ranges of (transcript, order, text) and numbered within
    their range; only the first transcript of a range can have begun before it.
    The first and last line of each range come to the driver.
    """
    spark = lines.sparkSession
    order = order_of(lines)
    rows = lines.withColumns({c: F.coalesce(F.col(c).cast("long"), F.lit(_NONE)) for c in order})
    dealt = rows.repartitionByRange(shuffle_width(spark), "conv", *order, F.substring("text", 1, 32)).withColumn("range", F.spark_partition_id())
    rest = [c for c in lines.columns if c not in ("conv", "text", *order)]

    def work(source: Iterable[dict]) -> Iterator[tuple]:
        here, n = None, 0
        for r in source:
            n = n + 1 if n and r["conv"] == here else 1
            here = r["conv"]
            yield *r.values(), n - 1

    schema = T.StructType([*dealt.schema.fields, T.StructField("local", T.LongType())])
    held = stored(in_arrow(dealt.sortWithinPartitions("conv", *order, "text", *rest), schema, work), "transcript-places")
    border = F.struct("conv", "local")
    carried, before = [], None
    for r in held.groupBy("range").agg(F.min(border).alias("first"), F.max(border).alias("last")).orderBy("range").collect():
        start = before[1] if before and before[0] == r.first.conv else 0
        if start:
            carried.append((r.range, r.first.conv, start))
        before = r.last.conv, r.last.local + 1 + (start if r.last.conv == r.first.conv else 0)
    starts = F.broadcast(spark.createDataFrame(carried, "range int, conv string, start long"))  # at most one row a range
    found = held.alias("l").join(starts.alias("s"), F.expr("l.range = s.range and l.conv <=> s.conv"), "left")
    return found.select(*[f"l.{c}" for c in lines.columns], (F.col("l.local") + F.coalesce("s.start", F.lit(0))).alias("at"))


def _segments(lines: DataFrame) -> DataFrame:
    """Lines by segment and in order, with ``opens``: whether a line is the transcript's first; those that have places keep them."""
    key = (lines if "at" in lines.columns else numbered(lines)).withColumn("seg", F.floor(F.col("at") / SEGMENT)).withColumn("opens", F.col("at") == 0)
    return key.repartition("conv", "seg").sortWithinPartitions("conv", "seg", "at")


# --- decoding ----------------------------------------------------------------


def advance(model: Model, front: np.ndarray, line: str | None, opens: bool) -> tuple[np.ndarray, np.ndarray]:
    """One step of the recursion for each row of ``front`` (scores by state): new scores and the states they came from."""
    ways = front[:, :, None] + model.move[None, :, :]
    came = ways.argmax(axis=1)
    return ways.max(axis=1) + model.scores(line, opens)[None, :], came


def decode(lines: DataFrame, model: Model) -> DataFrame:
    """``conv, line, text, role, first`` of every line by the most likely states, with what else it is ordered by.

    Columns of ``lines`` that clash are replaced; lines that are :func:`numbered` already keep their places.
    """
    order = order_of(lines)
    rows = _segments(lines.select("conv", *order, "text", *[c for c in ("at",) if c in lines.columns]))
    n = len(model.states)
    unit = np.where(np.eye(n, dtype=bool), 0.0, -np.inf)

    def matrices(source: Iterable[dict]) -> Iterator[tuple]:
        at, table = None, None
        for r in source:
            if (r["conv"], r["seg"]) != at:
                if at is not None:
                    yield *at, table.ravel().tolist()
                at, table = (r["conv"], r["seg"]), unit
                if r["opens"]:  # the start distribution instead of a move
                    table = np.tile(model.start + model.scores(r["text"], True), (n, 1))
                    continue
            table = advance(model, table, r["text"], bool(r["opens"]))[0]
        if at is not None:
            yield *at, table.ravel().tolist()

    def products(source: Iterable[dict]) -> Iterator[tuple]:
        """Of each run of ``FAN`` matrices their product; its largest entry is made 0, as only differences count."""
        at, table = None, None
        for r in source:
            if (r["conv"], r["run"]) != at:
                if at is not None:
                    yield *at, table.ravel().tolist()
                at, table = (r["conv"], r["run"]), unit
            table = (table[:, :, None] + np.array(r["table"]).reshape(1, n, n)).max(axis=1)
            table = table - table.max()
        if at is not None:
            yield *at, table.ravel().tolist()

    def borders(source: Iterable[dict]) -> Iterator[tuple]:
        """Per run of matrices: forward scores from the state before it, then the best end state of each, back from its last."""
        at, chain = None, []

        def back() -> Iterator[tuple]:
            if not chain:
                return
            front, ways = np.full(n, -np.inf), []
            front[chain[0][2]] = 0.0
            for _, table, *_ in chain:
                both = front[:, None] + table
                ways.append(both.argmax(axis=0))
                front = both.max(axis=0)
                front = front - front.max()
            state = int(front.argmax()) if chain[0][3] is None else chain[0][3]
            for (seg, *_), way in zip(reversed(chain), reversed(ways)):
                yield at[0], seg, int(way[state]), state
                state = int(way[state])

        for r in source:
            if (r["conv"], r["run"]) != at:
                yield from back()
                at, chain = (r["conv"], r["run"]), []
            chain.append((r["seg"], np.array(r["table"]).reshape(n, n), r["enter"], r["leave"]))
        yield from back()

    def runs(tables: DataFrame) -> DataFrame:
        return tables.withColumn("run", F.floor(F.col("seg") / FAN))

    def in_order(tables: DataFrame) -> DataFrame:
        return tables.repartition("conv", "run").sortWithinPartitions("conv", "run", "seg")

    kind = "conv string, seg long, table array<double>"
    rounds = [stored(in_arrow(rows, kind, matrices), "transcript-matrices")]
    while (rounds[-1].agg(F.max("seg")).first()[0] or 0) >= FAN:
        rounds.append(stored(in_arrow(in_order(runs(rounds[-1])), kind, products), "transcript-matrices"))
    # Any state may stand before a transcript: its first matrix has the same row for each.
    known = runs(rounds.pop()).withColumns({"enter": F.lit(0), "leave": F.lit(None).cast("int")})
    while True:
        ends = in_arrow(in_order(known), "conv string, seg long, enter int, leave int", borders)
        if not rounds:
            break
        known = runs(rounds.pop()).alias("t").join(ends.alias("e"), F.expr("t.conv <=> e.conv and t.run = e.seg")).select("t.*", "e.enter", "e.leave")
    known = rows.alias("r").join(ends.alias("e"), F.expr("r.conv <=> e.conv and r.seg = e.seg")).select("r.*", "e.enter", "e.leave")
    dealt = known.repartition("conv", "seg").sortWithinPartitions("conv", "seg", "at")

    def states(source: Iterable[dict]) -> Iterator[tuple]:
        at, held = None, []
        for r in source:
            if (r["conv"], r["seg"]) != at:
                yield from _path(model, held, order)
                at, held = (r["conv"], r["seg"]), []
            held.append(r)
        yield from _path(model, held, order)

    places = "".join(f"{c} long, " for c in order)
    return in_arrow(dealt, f"conv string, {places}text string, role string, first boolean", states)


def _path(model: Model, held: list[dict], order: list[str]) -> Iterator[tuple]:
    """The best states of a segment's lines given the state before it and the one it ends in."""
    if not held:
        return
    n = len(model.states)
    front = np.full((1, n), -np.inf)
    front[0, held[0]["enter"]] = 0.0
    came = []
    for k, r in enumerate(held):
        if k == 0 and r["opens"]:
            front, way = (model.start + model.scores(r["text"], True))[None, :], np.zeros((1, n), np.int64)
        else:
            front, way = advance(model, front, r["text"], bool(r["opens"]))
        came.append(way[0])
    state, path = held[0]["leave"], []
    for way in reversed(came):
        path.append(state)
        state = int(way[state])
    for r, s in zip(held, reversed(path)):
        yield r["conv"], *(None if r[c] == _NONE else r[c] for c in order), r["text"], *model.states[s]


def rendered(lines: DataFrame) -> DataFrame:
    """Adds ``piece``: the line as it stands in the canonical form, its speaker marker gone, a role tag where a turn begins.

    The pieces of a transcript in line order are its canonical rendering; turns
    are not gathered, so none needs to fit into a task.
    """

    @F.udf("string")
    def body(text: str | None) -> str:
        line = text or ""
        return line[marker(line)[1] :].strip()

    tag = F.concat(F.lit("<|"), "role", F.lit("|>\n"))
    return lines.withColumn("piece", F.concat(F.when(F.col("first"), tag).otherwise(F.lit("")), body("text"), F.lit("\n")))


# --- raw transcripts of a table of turns --------------------------------------

#: Ways to write a speaker marker; the last leaves it out (fixed values).
STYLES = ("user: |assistant: |system: ", "### User\t|### Assistant\t|### System\t", "[USER] |[ASSISTANT] |[SYSTEM] ", "Q: |A: |Instructions: ", "||")


def raw_lines(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turns as a transcript: one row a line, the first of a turn behind a marker of the transcript's style.

    Two of seven turns go without their marker, by a hash of transcript and turn, and so
    do all turns of an unknown role; ``role, first`` are the labels. ``turn, row, copy, line`` order the lines: ``line``
    counts within its row, ``row`` is the hash of the row's role and text, and ``copy`` tells equal rows apart.
    """
    conv, turn = F.col(id_col).cast("string"), F.col(turn_col).cast("long")
    style = F.element_at(F.array(*[F.lit(s) for s in STYLES]), (F.pmod(F.xxhash64(conv), F.lit(len(STYLES) - 1)) + 1).cast("int"))
    written = F.pmod(F.xxhash64(conv, turn), F.lit(7)) > 1
    which = F.when(F.col(role_col) == "user", 0).when(F.col(role_col) == "assistant", 1).when(F.col(role_col) == "system", 2)
    mark = F.when(written & which.isNotNull(), F.get(F.split(style, r"\|"), which)).otherwise(F.lit(""))
    role, body = F.col(role_col).cast("string"), F.col(text_col).cast("string")
    rows = turns.select(
        conv.alias("conv"),
        turn.alias("turn"),
        F.xxhash64(role, body).alias("row"),
        F.monotonically_increasing_id().alias("copy"),
        role.alias("role"),
        F.concat(F.regexp_replace(mark, "\t", "\n"), F.coalesce(body, F.lit(""))).alias("written"),
    )
    lines = rows.select("conv", "turn", "row", "copy", "role", F.posexplode(F.split("written", "\n")).alias("line", "text"))
    return lines.select("conv", "turn", "row", "copy", F.col("line").cast("long"), "text", "role", (F.col("line") == 0).alias("first"))
