"""Repair of conversations by cheapest edits, shared by equal endings.

Each row of a conversation becomes one symbol: the initial of its role and its fault. Costs depend on the symbols
alone, and what an ending costs does not depend on what came before it but for the state of the role grammar.
So the symbol strings of all conversations are reduced to the distinct ones, sorted from their ends, and folded
into an automaton that shares equal endings: going from one string to the next keeps the nodes of their common
ending. A node is made once, with the cost to go and the first letter of the best audit for each grammar state;
the best audit of a string is read along these letters.

The grammar of role initials is ``(s?(ua)+)?``. Its states: 0 nothing yet, 1 after s, 2 after u, 3 after a.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import lookup, salted, written

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: The state after a row of the role that a state waits for; 1 is reached by keeping an s in state 0 only.
NEXT = (2, 2, 3, 2)
WAITS_FOR = ("u", "u", "a", "u")
ROLE = {"u": "user", "a": "assistant"}
STATES = range(4)
#: The symbol of a row that must go, whatever its role.
GONE = "d"
WHITE = " \t\n\v\f\r"
#: The first fault of a row.
SOUND, BLANK, DUPLICATE, CUT = range(4)
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
SIGNATURES = pa.schema([("key", pa.string()), ("symbols", pa.string()), *[(c, pa.int64()) for c in COUNTS]])
#: Above every cost of a string, for what no edit reaches.
NEVER = 1 << 60

Node = tuple[tuple[int, ...], str]  # per grammar state the cost to go and the first edit, "." at the end


def _with_inserts(costs: Sequence[int], letters: Sequence[str]) -> Node:
    """Costs and letters once inserts before the next row are allowed too. Of equal costs the least letter counts."""
    costs, letters = list(costs), list(letters)
    for _ in STATES:  # no best way inserts more often in a row
        for state in STATES:
            cost = INSERT + costs[NEXT[state]]
            if cost < costs[state] or cost == costs[state] and "I" < letters[state]:
                costs[state], letters[state] = cost, "I"
    return tuple(costs), "".join(letters)


#: The node of the empty ending: states 0 and 3 may end.
END: Node = _with_inserts([0, NEVER, NEVER, 0], "....")


def kept(symbol: str, state: int) -> int | None:
    """The state after a row is kept as it is, None where its role does not fit."""
    initial = symbol.lower()
    if initial == "s" and state == 0:
        return 1
    return NEXT[state] if initial == WAITS_FOR[state] else None


def node_before(symbol: str, rest: Node) -> Node:
    """The node of ``symbol`` followed by an ending whose node is ``rest``. D, K and R come in the order of letters."""
    after, costs, letters = rest[0], [], []
    extra = TRUNCATED if symbol.isupper() else 0
    for state in STATES:
        ways = [(DELETE + after[state], "D")]
        if symbol != GONE:
            if (to := kept(symbol, state)) is not None:
                ways.append((extra + after[to], "K"))
            ways.append((REROLE + extra + after[NEXT[state]], "R"))
        cost, letter = min(ways)
        costs.append(cost)
        letters.append(letter)
    return _with_inserts(costs, letters)


@dataclass
class EndingAutomaton:
    """The automaton of a run of strings sorted from their ends. Only the nodes of the last string are held: the others are
    complete, and no later string comes back to them."""

    last: str = ""  # reversed
    made: int = 0

    def __post_init__(self):
        self.nodes: list[Node] = [END]

    def repair(self, symbols: str) -> tuple[int, str]:
        """The least cost of a string and the ASCII-least audit of that cost."""
        backwards = symbols[::-1]
        shared, most = 0, min(len(self.last), len(backwards))
        while shared < most and self.last[shared] == backwards[shared]:
            shared += 1
        del self.nodes[shared + 1 :]
        for symbol in backwards[shared:]:
            self.nodes.append(node_before(symbol, self.nodes[-1]))
        self.made += len(backwards) - shared
        self.last = backwards
        return self.nodes[-1][0][0], self._audit(backwards)

    def _audit(self, backwards: str) -> str:
        at, state, edits = len(backwards), 0, []
        while (letter := self.nodes[at][1][state]) != ".":
            edits.append(letter)
            if letter == "I":
                state = NEXT[state]
                continue
            at -= 1
            if letter == "K":
                state = kept(backwards[at], state)
            elif letter == "R":
                state = NEXT[state]
        return "".join(edits)


def damaged(df: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) as the query's contract damages them; ``dropped`` marks those that it drops.

    A null role or text is one space, as are nulls in the string that is hashed; conv_id and turn stay null.
    """

    def filled(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    rows = df.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), kind.alias("kind"))
    text = F.expr("case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end")
    role = F.expr("case kind when 4 then 'user' else role end")
    copies = F.explode(F.expr("case kind when 3 then array(0, 1) else array(0) end"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("dropped"), copies.alias("copy"))


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with ``key``, the conversation as text, and ``said``, a digest of role and text."""
    said = F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256))
    return rows.withColumns({"key": F.col("conv_id").cast("string"), "turn": F.col("turn").cast("long"), "said": said})


def signatures(rows: DataFrame) -> DataFrame:
    """A row per conversation: key, its symbols in order, and the counts of the rows after damage. Texts do not move:
    what a row needs of its text is found where it lies, and duplicates meet by digest."""
    ends = F.rtrim("text", F.lit(WHITE))
    initial, pick = F.substring("role", 1, 1), Window.partitionBy("key", "dropped", "said").orderBy("turn", "copy")
    narrow = _ordered(rows).select(
        "key", "dropped", "turn", "said", "copy", initial.alias("initial"), (ends == "").alias("blank"),
        (~F.right(ends, F.lit(1)).isin(*".!?")).alias("cut"),
    ).repartition("key")
    fault = F.when(F.col("blank"), BLANK).when(F.row_number().over(pick) > 1, DUPLICATE).when(F.col("cut"), CUT).otherwise(SOUND)
    ordered = narrow.withColumn("fault", fault).select("key", "dropped", "turn", "said", "copy", "initial", "fault")
    ordered = ordered.sortWithinPartitions("key", "dropped", "turn", "said", "copy")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = None
        for batch in batches:
            done = []
            for key, dropped, turn, _, _, initial, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if one is None or one.key != key:
                    if one:
                        done.append(one.row())
                    one = Signature(key)
                if not dropped:
                    one.add(turn, initial, fault)
            yield from _batch(done, SIGNATURES)
        yield from _batch([one.row()] if one else [], SIGNATURES)

    return ordered.mapInArrow(fold, "key string, symbols string, gaps long, blank long, duplicate long, truncated long, illegal long")


def _batch(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


class Signature:
    """What is known of a conversation after some of its rows, taken in order."""

    def __init__(self, key: str | None):
        self.key, self.symbols, self.faults, self.illegal = key, [], [0] * 4, 0
        self.first = self.turn = self.initial = None
        self.turns = 0

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        symbol = initial if initial in ("s", "u", "a") else "o"
        self.symbols.append(GONE if fault in (BLANK, DUPLICATE) else symbol.upper() if fault == CUT else symbol)
        self.faults[fault] += 1
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn, self.turns = turn, self.turns + 1

    def row(self) -> tuple:
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        return self.key, "".join(self.symbols), gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT], self.illegal


def cheapest_audits(strings: DataFrame) -> DataFrame:
    """(symbols, cost, audit) of the distinct strings in the column ``symbols``. A task takes a range of strings in the
    order of their reversals, so its strings share their endings; only the path between two ranges is made twice."""
    backwards = strings.select("symbols").distinct().withColumn("backwards", F.reverse("symbols"))
    backwards = backwards.repartitionByRange("backwards").sortWithinPartitions("backwards").select("symbols")
    schema = pa.schema([("symbols", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = EndingAutomaton()
        for batch in batches:
            yield from _batch([(s, *automaton.repair(s)) for s in batch.column(0).to_pylist()], schema)

    return backwards.mapInArrow(solve, "symbols string, cost long, audit string")


class Repair:
    """A conversation being rewritten along its audit: the digest of the lines so far."""

    def __init__(self, head: tuple):
        self.head, self.audit = head, head[1]
        self.at = self.state = 0
        self.digest, self.lines = hashlib.sha256(), 0

    def _line(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._line(ROLE[WAITS_FOR[self.state]], "")
            self.state, self.at = NEXT[self.state], self.at + 1

    def take(self, role: str, text: str) -> None:
        """The next row, and the inserts before it."""
        self._inserts()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self._line(role, text)
            self.state = kept(role[:1], self.state)
        elif edit == "R":
            self._line(ROLE[WAITS_FOR[self.state]], text)
            self.state = NEXT[self.state]

    def row(self) -> tuple:
        self._inserts()
        return *self.head, self.digest.hexdigest()


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``audits`` (key, audit, further columns) with ``repaired_sha256``, the digest of the conversation's lines
    ``role:text`` after its edits. Texts move once; a task streams one row at a time behind its audit."""
    heads = audits.withColumn("kind", F.lit(0))
    body = _ordered(rows).filter("not dropped").select("key", F.lit(1).alias("kind"), "turn", "said", "copy", "role", "text")
    both = heads.unionByName(body, allowMissingColumns=True).repartition("key").sortWithinPartitions("key", "kind", "turn", "said", "copy")
    columns = audits.columns
    stream = both.select("kind", "role", "text", *columns)
    types = [*audits.dtypes, ("repaired_sha256", "string")]
    arrow = pa.schema([(c, pa.string() if t == "string" else pa.int64()) for c, t in types])

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = None
        for batch in batches:
            done = []
            for kind, role, text, *head in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind:
                    one.take(role, text)
                else:
                    if one:
                        done.append(one.row())
                    one = Repair(tuple(head))
            yield from _batch(done, arrow)
        yield from _batch([one.row()] if one else [], arrow)

    return stream.mapInArrow(rewrite, ", ".join(f"{c} {t}" for c, t in types))


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Per conversation its faults, the least cost of its repair, the audit of that repair and a digest of its result.

    ``rows`` has (conv_id, turn, role, text, dropped, copy), as ``damaged`` gives them; a dropped row counts
    only for its conversation's being there. Rows go by turn, null turns first; equal turns by a digest of role and
    text. A null conv_id is a conversation of its own; repeated rows are duplicates; a conversation without rows
    has zeros, an empty audit and the digest of the empty text; an empty table gives no rows.
    A conversation of any length streams through one task, as its digest must; only its symbols and its audit, a
    character a row each, are held. Equal symbol strings are solved once, however many conversations have them.
    """
    spark = rows.sparkSession
    found = written(spark, salted(signatures(rows)), "signatures")
    audits = lookup(found, cheapest_audits(found), "symbols").select("key", "audit", *COUNTS, "cost")
    done = repaired(rows, audits).withColumn("conv_id", F.col("key").cast(rows.schema["conv_id"].dataType))
    return done.select("conv_id", *COUNTS, "cost", "audit", "repaired_sha256")
