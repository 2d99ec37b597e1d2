"""Structure repair of conversations by an integer-minimum path over scalar weights.

A repaired conversation is empty, or an optional system row and then user and assistant
rows in turn.  Rows are kept (K, free), given the other role (R, 2), deleted (D, 3) or
inserted (I, 2); a row that was cut short costs 1 more unless it is deleted.  The weight of
a path is one whole number: its high digits carry the cost, and below them each letter of
the audit has three bits at its own place, zeros filling the places after the last letter.
The least number is therefore the cheapest path, and of those the one whose letters come
first in ASCII.  A letter and the state before it fix the state after it, so the audit alone
gives the repaired rows.

Conversations are not gathered to be solved.  Rows are dealt by ranges of (conversation,
turn) and cut into blocks of at most `BLOCK_ROWS` rows, wherever a conversation is long.  A block is
a 4 x 4 table of costs between states; chained backwards the tables give what each block's
four ends still cost, then blocks are solved apart, each for its four beginnings, and a last
pass in order picks the one that applies.  That pass alone sees a conversation in one task,
block by block, since its digest is one over all its text; it holds the audit it returns.
Rows are only inserted before a row of the block or at the end of the conversation, so two
audits of one block are never one the beginning of the other.

- A null conversation id is a conversation; null roles, texts and turns count as one
  space wherever they are read as text.  Null turns come first and are no part of gaps.
- Rows of one turn go by role and a digest of their text; equal rows are interchangeable.
- Conversations without rows after the damage have zeros, an empty audit and the digest of nothing.
- An empty role has an initial of its own, which fits nowhere. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.frames import by_key, few, groups, scan_groups
from corpusloom.session import materialise, parallelism

BLOCK_ROWS = 1024
BLOCK_CHARS = 1 << 20

DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
_LETTERS = " DIKR"
_BITS = 3
_COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}

# Beginning, after system, after user, after assistant.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)
_NAMES = {USER: "user", ASSISTANT: "assistant"}
# Initials and faults of a row, in one byte: 4 x initial + fault.
_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
WHOLE, TRUNCATED, BLANK, DUPLICATE = range(4)
_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
# What the four states still cost at the end of a conversation: user and assistant after a
# system row, assistant after a user row.
_TAIL = ((), (INSERT, INSERT), (INSERT,), ())
END = tuple(sum(_COST[x] for x in letters) for letters in _TAIL)
_NEVER = 1 << 60


def _edits(code: int, state: int) -> Iterator[tuple[int, int, int]]:
    """Letter, cost and next state of what can be done with a row."""
    initial, fault = divmod(code, 4)
    yield DELETE, _COST[DELETE], state
    if fault >= BLANK:
        return
    more = int(fault == TRUNCATED)
    if initial == _NEXT[state] or (state == BEGIN and initial == SYSTEM):
        yield KEEP, more, initial
    yield REROLE, _COST[REROLE] + more, _NEXT[state]


@lru_cache(maxsize=4096)
def costs(codes: bytes) -> tuple[int, ...]:
    """The least cost of a block's rows from each state to each state, 16 numbers."""
    table = [[0 if s == t else _NEVER for t in range(4)] for s in range(4)]
    for code in reversed(codes):
        table = _before(
            [[min(c + table[t][end] for _, c, t in _edits(code, s)) for end in range(4)] for s in range(4)],
            lambda own, after: [min(a, _COST[INSERT] + b) for a, b in zip(own, after)],
        )
    return tuple(min(c, _NEVER) for row in table for c in row)


def _before(values: list, better) -> list:
    """Values of the states before a row when up to two rows can be inserted first."""
    once = [better(values[s], values[_NEXT[s]]) for s in range(4)]
    return [better(values[s], once[_NEXT[s]]) for s in range(4)]


@lru_cache(maxsize=4096)
def solve(codes: bytes, rest: tuple[int, ...], last: bool) -> tuple[tuple[int, str], ...]:
    """For each state before a block: its least weight's cost with `rest`, and its audit.

    `rest` is what the rows after the block cost from each state.
    """
    places = 3 * len(codes) + 2
    shift = _BITS * places
    low = (1 << shift) - 1

    def lead(letter: int, cost: int, weight: int) -> int:
        # One more letter in front: the letters behind it move down by one place.
        return ((weight >> shift) + cost << shift) + (letter << shift - _BITS) + ((weight & low) >> _BITS)

    weights = []
    for state in range(4):
        weight = (0 if last else rest[state]) << shift
        for letter in _TAIL[state] if last else ():
            weight = lead(letter, _COST[letter], weight)
        weights.append(weight)
    for code in reversed(codes):
        weights = [min(lead(letter, cost, weights[t]) for letter, cost, t in _edits(code, s)) for s in range(4)]
        weights = _before(weights, lambda own, after: min(own, lead(INSERT, _COST[INSERT], after)))
    return tuple((weight >> shift, _letters(weight & low, places)) for weight in weights)


def _letters(digits: int, places: int) -> str:
    text = format(digits, f"0{places}o")
    return "".join(_LETTERS[int(d)] for d in text.rstrip("0"))


def follow(codes: bytes, audit: str, state: int) -> Iterator[tuple[int, int | None, int]]:
    """Letter, row of the block (none if inserted) and state after it, for each edit."""
    at = 0
    for mark in audit:
        letter = _LETTERS.index(mark)
        if letter == INSERT:
            state = _NEXT[state]
            yield letter, None, state
            continue
        state = next(t for own, _, t in _edits(codes[at], state) if own == letter)
        yield letter, at, state
        at += 1


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after the damage, equal ones once with their number `n`.

    A dropped row leaves a row of number 0, so that its conversation is not forgotten.
    """
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    gone = kind == 0
    nothing = F.lit("")
    rows = conversations.select(
        "conv_id",
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, nothing).when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(gone | (kind == 1), nothing).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(gone, 0).when(kind == 3, 2).otherwise(1).alias("n"),
    )
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))


def mark_faults(rows: DataFrame) -> DataFrame:
    """Rows with `code` of their first copy and `more` of the others.

    Only texts that a conversation has in several turns are joined back.
    """
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    said = F.sha2(F.concat(conv, F.lit("\x1f"), "role", F.lit("\x1f"), "text"), 256)
    solid = F.rtrim(F.col("text"), F.lit("\t\n\x0b\x0c\r "))
    rows = materialise(rows.withColumn("said", said).withColumn("end", F.substring(solid, -1, 1)), "turns")
    again = rows.filter("n > 0 and end <> ''").groupBy("said").agg(
        F.count(F.lit(1)).alias("turns"), F.bool_or(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("least")
    ).filter("turns > 1")
    again = materialise(again.drop("turns"), "again")
    marked = rows.join(F.broadcast(again) if few(again) else again, "said", "left")
    first = F.col("unnumbered").isNull() | F.when(F.col("unnumbered"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("least"))
    initial = F.substring("role", 1, 1)
    who = F.lit(0)
    for letter, number in _INITIAL.items():
        who = F.when(initial == letter, 4 * number).otherwise(who)
    fault = F.when(F.col("end") == "", BLANK).when(~first, DUPLICATE).when(~F.col("end").isin(".", "!", "?"), TRUNCATED).otherwise(WHOLE)
    other = F.when(F.col("end") == "", BLANK).otherwise(DUPLICATE)
    return marked.select(
        "conv_id", "turn", "role", "said", "n", (who + fault).cast("int").alias("code"), (who + other).cast("int").alias("more"), "text"
    )


class _Block:
    """Consecutive rows of one conversation."""

    def __init__(self, conv, part: int, seq: int):
        self.conv, self.part, self.seq = conv, part, seq
        self.codes = bytearray()
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.first = self.last = None
        self.turns = self.chars = 0

    def row(self) -> dict:
        codes = bytes(self.codes)
        return {
            "conv_id": self.conv, "part": self.part, "seq": self.seq, "codes": codes, "roles": self.roles, "texts": self.texts,
            "first_turn": self.first, "last_turn": self.last, "turns": self.turns, "costs": list(costs(codes)),
        }


def _cut(schema: pa.Schema, block_rows: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        block: _Block | None = None
        ready: list[dict] = []
        held = 0
        for batch in batches:
            for conv, turn, role, n, code, more, text in zip(*(c.to_pylist() for c in batch.columns)):
                for copy in range(max(n, 1)):
                    if block is None or conv != block.conv or len(block.codes) >= block_rows or block.chars >= BLOCK_CHARS:
                        if block:
                            ready.append(block.row())
                            held += block.chars
                            if len(ready) >= 512 or held >= 4 * BLOCK_CHARS:
                                yield pa.RecordBatch.from_pylist(ready, schema)
                                ready, held = [], 0
                        block = _Block(conv, part, seq)
                        seq += 1
                    if not n:
                        continue
                    own = more if copy else code
                    block.codes.append(own)
                    if turn is not None and turn != block.last:
                        block.first = turn if block.first is None else block.first
                        block.last = turn
                        block.turns += 1
                    if own % 4 < BLANK:
                        block.roles.append(role)
                        block.texts.append(text)
                        block.chars += len(text)
        if block:
            ready.append(block.row())
        yield pa.RecordBatch.from_pylist(ready, schema)

    return cut


_BLOCK = "part int, seq long, codes binary, roles array<string>, texts array<string>, first_turn {1}, last_turn {1}, turns long, costs array<long>"


def _types(rows: DataFrame) -> tuple[str, str]:
    return tuple(rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))


def _arrow(frame: DataFrame, *names: str) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(frame.select(*names).schema)
    return [schema.field(n) for n in names]


def cut_blocks(marked: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks in the order of their (part, seq), written."""
    order = ["conv_id", "turn", "role", "said"]
    kinds = _types(marked)
    conv, turn = _arrow(marked, "conv_id", "turn")
    strings = pa.list_(pa.string())
    schema = pa.schema([
        conv, ("part", pa.int32()), ("seq", pa.int64()), ("codes", pa.binary()), ("roles", strings), ("texts", strings),
        ("first_turn", turn.type), ("last_turn", turn.type), ("turns", pa.int64()), ("costs", pa.list_(pa.int64())),
    ])
    placed = marked.repartitionByRange(parallelism(marked.sparkSession), *order).sortWithinPartitions(*order)
    rows = placed.select("conv_id", "turn", "role", "n", "code", "more", "text")
    return materialise(rows.mapInArrow(_cut(schema, block_rows), f"conv_id {kinds[0]}, " + _BLOCK.format(*kinds)), "blocks")


_REST = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("rest", pa.list_(pa.int64())), ("last", pa.bool_())])


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the rows after each block cost, from the last block of a conversation backwards."""

    def rows() -> Iterator[dict]:
        for group in groups(batches, "conv_id"):
            rest, last = END, True
            for row in reversed(group.select(["part", "seq", "costs"]).to_pylist()):
                yield {"part": row["part"], "seq": row["seq"], "rest": list(rest), "last": last}
                table, last = row["costs"], False
                rest = tuple(min(table[4 * s + t] + rest[t] for t in range(4)) for s in range(4))

    yield from scan_groups(_REST, rows())


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        found = [
            solve(codes, tuple(rest), last)
            for codes, rest, last in zip(*(batch.column(c).to_pylist() for c in ("codes", "rest", "last")))
        ]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("conv_id", "part", "seq")),
                pa.array([[c for c, _ in x] for x in found], pa.list_(pa.int64())),
                pa.array([[a for _, a in x] for x in found], pa.list_(pa.string())),
            ],
            ["conv_id", "part", "seq", "weights", "audits"],
        )


class _Report:
    """One conversation while its blocks pass in order."""

    def __init__(self, conv):
        self.conv, self.state, self.cost = conv, BEGIN, None
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.first = self.last = self.role = None
        self.audit: list[str] = []
        self.digest, self.written = hashlib.sha256(), False

    def add(self, block: dict, weights: list[int], audits: list[str]) -> None:
        codes = block["codes"]
        for code in codes:
            role, fault = divmod(code, 4)
            self.faults[fault] += 1
            self.illegal += self.role is not None and (self.role, role) not in _LEGAL
            self.role = role
        if block["turns"]:
            self.turns += block["turns"] - (self.last == block["first_turn"])
            self.first = block["first_turn"] if self.first is None else self.first
            self.last = block["last_turn"]
        self.cost = weights[self.state] if self.cost is None else self.cost
        audit = audits[self.state]
        self.audit.append(audit)
        said = iter(zip(block["roles"], block["texts"]))
        for letter, row, state in follow(codes, audit, self.state):
            self.state = state
            role, text = next(said) if row is not None and codes[row] % 4 < BLANK else ("", "")
            if letter != DELETE:
                role = role if letter == KEEP else _NAMES[state]
                self.digest.update((b"\n" if self.written else b"") + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                self.written = True

    def row(self) -> dict:
        return {
            "conv_id": self.conv, "gaps": 0 if self.first is None else self.last - self.first + 1 - self.turns,
            "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[TRUNCATED],
            "illegal": self.illegal, "cost": self.cost or 0, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest(),
        }


def _reported(schema: pa.Schema):
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Report | None = None
        answer = None
        ready: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["audits"] is not None:
                    answer = row
                    continue
                if now is None or row["conv_id"] != now.conv:
                    if now:
                        ready.append(now.row())
                    now = _Report(row["conv_id"])
                now.add(row, answer["weights"], answer["audits"])
            yield pa.RecordBatch.from_pylist(ready, schema)
            ready = []
        if now:
            yield pa.RecordBatch.from_pylist([now.row()], schema)

    return report


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per conversation: what is wrong with it, its cheapest edits and their result.

    `rows` have conv_id, turn, role, text and the number `n` of equal rows (0: none, but
    the conversation is reported).
    """
    blocks = cut_blocks(mark_faults(rows), block_rows)
    kind = blocks.schema["conv_id"].dataType.simpleString()
    chained = by_key(blocks.select("conv_id", "part", "seq", "costs"), "conv_id", then=("part", "seq")).mapInArrow(
        _chain, "part int, seq long, rest array<long>, last boolean"
    )
    open_blocks = blocks.select("conv_id", "part", "seq", "codes").join(chained, ["part", "seq"])
    solved = open_blocks.mapInArrow(
        _solved, f"conv_id {kind}, part int, seq long, weights array<long>, audits array<string>"
    )
    # A block's answer comes just before it, so texts are shuffled once and joined to nothing.
    texts = blocks.drop("costs").withColumn("kind", F.lit(1))
    stream = solved.withColumn("kind", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([
        *_arrow(blocks, "conv_id"), *((c, pa.int64()) for c in counts), ("audit", pa.string()), ("repaired_sha256", pa.string()),
    ])
    fields = ", ".join(f"{c} long" for c in counts)
    ordered = by_key(stream, "conv_id", then=("part", "seq", "kind"))
    return ordered.mapInArrow(_reported(schema), f"conv_id {kind}, {fields}, audit string, repaired_sha256 string")


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """The repair of every conversation after the damage."""
    return repair(damage(conversations))
