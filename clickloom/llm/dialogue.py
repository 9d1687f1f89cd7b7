"""Conversation structure repair: the cheapest edits that give ``(s?(ua)+)?``, by big-integer weights.

Roles count by their first character; a sound conversation may open with a system turn and
then alternates user and assistant. Rows are kept (K, free), given the role of a user or an
assistant (R, 2) or deleted (D, 3, the only edit for blank and repeated rows), and empty user
or assistant turns may be inserted anywhere (I, 2). A truncated row that stays costs 1 more.
Of the cheapest edits those with the ASCII-least string of letters, the audit, are taken.

The weight of a path of edits is one integer. Its high digits are the cost; below them stand
places of fixed width, one octal digit to a letter from the first place on, D < I < K < R as 1
to 4, unused places at the end being zero. An edit before a path moves its letters one place
down; two paths add up once the second one's letters are moved to the place where the first
one's end. The least integer is then the cheapest path with the least audit, and a plain
minimum over a graph of (row, what the roles so far allow) finds it. Paths over the same rows
with the same cost are never a prefix of one another (a longer one would hold more inserts),
so the minimum may be taken of any run of rows by itself, for each state before and after it:
runs of ``STEP`` rows give tables of 4 x 4 weights, which combine like products of matrices.

That is how a conversation of any length is worked on. Its rows, without their texts, are put
in order over all tasks by range, a task gives one table for each conversation it holds a part
of, and only those tables meet in one place. Identical rows are one row with a count before
that. ``repaired`` then streams the texts of each conversation past its audit, in the memory
of a few rows; a digest of a whole conversation needs its rows one after the other, so it is
one task that reads a hot conversation's text there.

Order is by turn, nulls first; rows of one turn by role, then by the MD5 of their text, which
also tells equal texts. Defined cases: a null role or text is one space; a null conversation id
is an id; rows without any other than white space are blank whatever their length; an empty
table gives no rows. Other columns are ignored, whatever their names. Ids compare by equality.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, wraps

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clickloom.llm.textbytes import CALL_BYTES

#: Rows of one table of weights; longer runs are combined from several. Conversations of like roles share
#: tables, so some thousand of each kind are kept.
STEP = 128
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")

# States: 0 nothing yet, 1 after s, 2 after u, 3 after a. 0 and 3 may end a conversation.
STATES = range(4)
_KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: Where the one role that may be given or inserted leads, and the role.
_GIVEN = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
_LETTERS = str.maketrans("1234", "DIKR")
_DIGITS = str.maketrans("DIKR", "1234")
_D, _I, _K, _R = 1, 2, 3, 4
#: A cost no path has.
_NEVER = 1 << 80


@dataclass(frozen=True, eq=False)
class Table:
    """least[q][o]: the least weight of all paths from state q to state o, with ``places`` octal places."""

    places: int
    least: list[list[int]]

    def then(self, other: Table) -> Table:
        places = self.places + other.places
        parts = [[_split(w, self.places) for w in row] for row in self.least]
        others = [[_split(w, other.places) for w in row] for row in other.least]
        never = _NEVER << 3 * places
        out = [[never] * 4 for _ in STATES]
        for q in STATES:
            for mid, (cost, low, length) in enumerate(parts[q]):
                if cost >= _NEVER:
                    continue
                high, free = low << 3 * other.places, 3 * (self.places - length)
                for o, (more, next_low, _) in enumerate(others[mid]):
                    if more < _NEVER:
                        weight = ((cost + more) << 3 * places) + high + (next_low << free)
                        out[q][o] = min(out[q][o], weight)
        return Table(places, out)


def _kept(function):
    """Keep results for tables, or numbers of places, that are no larger than one run's."""
    cached = lru_cache(1 << 12)(function)

    @wraps(function)  # tasks find it by its name
    def call(first, *rest):
        places = first.places if isinstance(first, Table) else first
        return (cached if places <= 3 * STEP else function)(first, *rest)

    return call


def _split(weight: int, places: int) -> tuple[int, int, int]:
    """Cost, letters and their number."""
    low = weight & ((1 << 3 * places) - 1)
    unused = ((low & -low).bit_length() - 1) // 3 if low else places
    return weight >> 3 * places, low, places - unused


def _before(weight: int, cost: int, letter: int, places: int) -> int:
    """The weight of an edit and then the path: its letters stand one place further down."""
    bits = 3 * places
    return (((weight >> bits) + cost) << bits) | (letter << bits - 3) | ((weight & ((1 << bits) - 1)) >> 3)


def _with_inserts(least: list[int], places: int) -> list[int]:
    """Up to two inserts first; a third would repeat a state at a cost."""
    for _ in range(2):
        least = [min(w, _before(least[_GIVEN[q]], 2, _I, places)) for q, w in enumerate(least)]
    return least


@lru_cache(1 << 12)
def table_of(rows: tuple[tuple[str, bool, int], ...]) -> Table:
    """The table of a run of rows: (first character of the role, whether it must go, cost of staying)."""
    places = 3 * len(rows)
    columns = []
    for end in STATES:
        least = [_NEVER << 3 * places] * 4
        least[end] = 0
        for initial, must_go, stays in reversed(rows):
            after, least = least, [_before(w, 3, _D, places) for w in least]
            if not must_go:
                for q in STATES:
                    least[q] = min(least[q], _before(after[_GIVEN[q]], 2 + stays, _R, places))
                    if q in _KEEP.get(initial, ()):
                        least[q] = min(least[q], _before(after[_KEEP[initial][q]], stays, _K, places))
            least = _with_inserts(least, places)
        columns.append(least)
    return Table(places, [list(row) for row in zip(*columns)])


def _ending() -> Table:
    never = _NEVER << 6
    columns = [_with_inserts([0 if q == end else never for q in STATES], 2) if end in (0, 3) else [never] * 4 for end in STATES]
    return Table(2, [list(row) for row in zip(*columns)])


@_kept
def cheapest(table: Table) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    whole = table.then(_ending())
    cost, low, length = _split(min(whole.least[0]), whole.places)
    return cost, _letters(low, length, whole.places)


def _letters(low: int, length: int, places: int) -> str:
    return f"{low >> 3 * (places - length):o}".translate(_LETTERS) if length else ""


class Fold:
    """Tables in order, combined so that large ones are combined rarely."""

    def __init__(self):
        self.parts: list[tuple[int, Table]] = []

    def add(self, table: Table) -> None:
        level = 0
        while self.parts and self.parts[-1][0] <= level:
            before, first = self.parts.pop()
            level, table = max(level, before) + 1, first.then(table)
        self.parts.append((level, table))

    def result(self) -> Table:
        if not self.parts:
            return Table(0, [[0 if q == o else _NEVER for o in STATES] for q in STATES])
        *before, (_, out) = self.parts
        for _, table in reversed(before):
            out = table.then(out)
        return out


@dataclass
class Run:
    """Rows of one conversation that follow one another."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    first: str | None = None
    last: str | None = None
    rows: list = field(default_factory=list)
    fold: Fold = field(default_factory=Fold)

    def add(self, turn, initial: str, blank: bool, repeated: bool, truncated: bool, copies: int) -> None:
        self._turn(turn)
        self._role(initial, initial)
        self.illegal += copies - 1
        if blank:
            self.blank += copies
            self._rows(copies, (initial, True, 0))
            return
        self.duplicate += copies - (not repeated)
        if not repeated:
            self.truncated += truncated
            self._rows(1, (initial, False, int(truncated)))
            copies -= 1
        self._rows(copies, (initial, True, 0))

    def _turn(self, turn) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    def _role(self, first: str, last: str) -> None:
        if self.last is None:
            self.first = first
        elif self.last + first not in LEGAL:
            self.illegal += 1
        self.last = last

    def _rows(self, copies: int, row: tuple) -> None:
        for _ in range(copies):
            self.rows.append(row)
            if len(self.rows) == STEP:
                self.close()

    def close(self) -> None:
        if self.rows:
            self.fold.add(table_of(tuple(self.rows)))
            self.rows = []

    def join(self, other: Run, table: Table) -> None:
        """Append a later run, its table given."""
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if other.turns:
            self.turns += other.turns - (other.low == self.high)
            self.low = other.low if self.low is None else self.low
            self.high = other.high
        self._role(other.first, other.last)
        self.fold.add(table)

    @property
    def gaps(self) -> int:
        return self.high - self.low + 1 - self.turns if self.turns else 0


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_RUN_FIELDS = ", ".join(f"{n} bigint" for n in (*_COUNTS, "turns", "low", "high"))
_RUN = f"part int, {_RUN_FIELDS}, first string, last string, places bigint, costs array<bigint>, letters array<string>"
_SUMMARY = "gaps bigint, " + ", ".join(f"{n} bigint" for n in _COUNTS) + ", cost bigint, audit string"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size=lambda row: 256) -> Iterator[pa.RecordBatch]:
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total > CALL_BYTES:
            yield _batch(held, schema)
            held, total = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _runs(schema: pa.Schema):
    """One row for each conversation of a task: its counts and its table of weights."""

    def of(batches):
        part, conv, run = TaskContext.get().partitionId(), None, None
        for own, *row in _rows(batches):
            if run is None or own != conv:
                if run is not None:
                    yield packed(conv, part, run)
                conv, run = own, Run()
            run.add(*row)
        if run is not None:
            yield packed(conv, part, run)

    def packed(conv, part, run):
        run.close()
        table = run.fold.result()
        costs, letters = _packed(table)
        counts = [getattr(run, n) for n in (*_COUNTS, "turns", "low", "high", "first", "last")]
        return (conv, part, *counts, table.places, costs, letters)

    return lambda batches: _batches(of(batches), schema)


@_kept
def _packed(table: Table) -> tuple[list, list]:
    parts = [_split(w, table.places) for row in table.least for w in row]
    costs = [None if c >= _NEVER else c for c, _, _ in parts]
    return costs, [None if c >= _NEVER else _letters(low, n, table.places) for c, low, n in parts]


@_kept
def _unpacked(places: int, costs: tuple, letters: tuple) -> Table:
    weights = []
    for cost, own in zip(costs, letters):
        low = int(own.translate(_DIGITS), 8) << 3 * (places - len(own)) if own else 0
        weights.append((_NEVER if cost is None else cost) << 3 * places | low)
    return Table(places, [weights[4 * q : 4 * q + 4] for q in STATES])


def _summaries(schema: pa.Schema):
    """The runs of each conversation, in order, as one."""

    def of(batches):
        conv, whole = None, None
        for own, _, *counts, first, last, places, costs, letters in _rows(batches):
            if whole is None or own != conv:
                if whole is not None:
                    yield summary(conv, whole)
                conv, whole = own, Run()
            run = Run(**dict(zip((*_COUNTS, "turns", "low", "high"), counts)), first=first, last=last)
            whole.join(run, _unpacked(places, tuple(costs), tuple(letters)))
        if whole is not None:
            yield summary(conv, whole)

    def summary(conv, run):
        cost, audit = cheapest(run.fold.result())
        return (conv, run.gaps, *(getattr(run, n) for n in _COUNTS), cost, audit)

    return lambda batches: _batches(of(batches), schema, lambda row: 256 + len(row[-1]))


def _arrow(name: str, kind, rest: str, spark) -> pa.Schema:
    more = spark.createDataFrame([], rest).schema
    return pa.schema([(name, to_arrow_type(kind)), *((f.name, to_arrow_type(f.dataType)) for f in more)])


def _own(rows: DataFrame, conv_id: str, turn: str, role: str, text: str, copies: Column | None) -> DataFrame:
    text, role = (F.coalesce(rows[c], F.lit(" ")) for c in (text, role))
    many = F.lit(1) if copies is None else copies
    own = rows.select(rows[conv_id].alias("conv_id"), rows[turn].cast("bigint").alias("turn"), role.alias("role"), text.alias("text"), many.cast("bigint").alias("copies"))
    return own.withColumn("key", F.md5("text"))


def _order() -> list[Column]:
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("key")]


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: Column | None = None
) -> DataFrame:
    """One row per conversation: ``conv_id``, faults, the ``cost`` of its repair and the ``audit``.

    ``gaps`` counts the turns missing between its first and last; ``blank``, ``duplicate`` and
    ``truncated`` count rows by their first fault, ``illegal`` neighbours whose roles may not
    follow one another. ``copies`` may say how often a row stands there.
    """
    own = _own(rows, conv_id, turn, role, text, copies)
    end = F.rtrim("text", F.lit(BLANKS))
    marked = own.select("conv_id", "turn", "role", "key", "copies", (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(*".!?")).alias("truncated"))
    one = marked.groupBy("conv_id", "turn", "role", "key", "blank", "truncated").agg(F.sum("copies").alias("copies"))
    first = one.groupBy("conv_id", "role", "key").agg(F.min(F.struct("turn")).alias("first"))
    a, b = one.alias("a"), first.alias("b")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.key") == F.col("b.key"))
    known = a.join(b, same).select("a.*", (~F.col("turn").eqNullSafe(F.col("b.first.turn"))).alias("repeated"))
    ordered = known.repartitionByRange("conv_id", *_order()).sortWithinPartitions(F.asc_nulls_first("conv_id"), *_order())
    small = ordered.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "blank", "repeated", "truncated", "copies")
    spark, kind = rows.sparkSession, own.schema["conv_id"].dataType
    name = kind.simpleString()
    runs = small.mapInArrow(_runs(_arrow("conv_id", kind, _RUN, spark)), f"conv_id {name}, {_RUN}")
    gathered = runs.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return gathered.mapInArrow(_summaries(_arrow("conv_id", kind, _SUMMARY, spark)), f"conv_id {name}, {_SUMMARY}")


def _replay(schema: pa.Schema):
    """The rows that the audits leave, each conversation's audit coming before its rows."""

    def of(batches):
        conv, audit, at, state, nth = None, "", 0, 0, 0
        for own, _, text, role, copies, letters in rows_of(batches):
            if letters is not None:
                yield from inserted(conv, audit, at, len(audit), state, nth)
                conv, audit, at, state, nth = own, letters, 0, 0, 0
                continue
            for _ in range(copies):
                end = at
                while audit[end] == "I":
                    end += 1
                for row in inserted(conv, audit, at, end, state, nth):
                    yield row
                    state, nth = _GIVEN[state], nth + 1
                letter, at = audit[end], end + 1
                if letter != "D":
                    role = role if letter == "K" else _ROLE[state]
                    state = _KEEP[role[:1]][state]
                    yield conv, nth, role, text
                    nth += 1
        yield from inserted(conv, audit, at, len(audit), state, nth)

    def rows_of(batches):
        for batch in batches:
            for start in range(0, len(batch), 64):
                yield from zip(*(c.to_pylist() for c in batch.slice(start, 64).columns))

    def inserted(conv, audit, start, end, state, nth):
        for k in range(end - start):
            yield conv, nth + k, _ROLE[state], ""
            state = _GIVEN[state]

    return lambda batches: _batches(of(batches), schema, lambda row: 64 + len(row[-1]))


_REPAIRED = "nth bigint, role string, text string"


def repaired(
    rows: DataFrame,
    summaries: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    copies: Column | None = None,
) -> DataFrame:
    """The repaired conversations, ``conv_id, nth, role, text``, each in one task and in order.

    ``summaries`` are what ``repair`` returned for the same rows.
    """
    own = _own(rows, conv_id, turn, role, text, copies).withColumns({"audit": F.lit(None).cast("string"), "tag": F.lit(1)})
    heads = summaries.select("conv_id", "audit", F.lit(0).alias("tag"))
    both = own.unionByName(heads, allowMissingColumns=True)
    sent = both.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "tag", *_order())
    kind = own.schema["conv_id"].dataType
    schema = _arrow("conv_id", kind, _REPAIRED, rows.sparkSession)
    sent = sent.select("conv_id", "tag", "text", "role", "copies", "audit")
    return sent.mapInArrow(_replay(schema), f"conv_id {kind.simpleString()}, {_REPAIRED}")


def _digest(schema: pa.Schema):
    def of(batches):
        conv, sha = None, None
        for own, nth, role, text in _rows(batches):
            if nth == 0:
                if sha is not None:
                    yield conv, sha.hexdigest()
                conv, sha = own, hashlib.sha256()
            sha.update(f"{chr(10) if nth else ''}{role}:{text}".encode())
        if sha is not None:
            yield conv, sha.hexdigest()

    return lambda batches: _batches(of(batches), schema)


def digests(repaired_rows: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of each conversation's ``role:text`` lines, of the rows as ``repaired`` returns them."""
    kind = repaired_rows.schema["conv_id"].dataType
    schema = _arrow("conv_id", kind, "sha256 string", repaired_rows.sparkSession)
    return repaired_rows.mapInArrow(_digest(schema), f"conv_id {kind.simpleString()}, sha256 string")
