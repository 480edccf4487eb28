"""Repair of conversation structure at least cost, by depth-first branch and bound.

A conversation is right if its roles' initials read ``(s?(ua)+)?``.  Edits, each with a cost and a letter: Keep a row (0),
Rerole it to user or assistant (2), Delete it (3, the only way for blank and duplicate rows), Insert an empty user or
assistant row anywhere (2); a truncated row that stays adds 1.  The search is over nodes (row, state), the state being the
initial written last.  Its stack is explicit; a prefix goes when its cost and the lower bound of the rows left exceed the
incumbent, or when its node was reached before at no more cost.  Children come in ASCII order of their letters, so of
prefixes of equal cost the first to reach a node has the ASCII-least audit, and no audits are compared.  The bound of the
rows left is the least cost of passing them if the end were free; the incumbent comes from one dive along the bounds, so
it lies within the cost of an ending of the optimum, and a node is entered a few times at most.

At scale: rows are range-partitioned by conversation, turn, role and text, so a conversation of any length spreads over
tasks.  A task cuts it into blocks of bounded size.  A conversation in one block is repaired there.  The blocks of
others carry the least (cost, audit) from each state to each state, which meet in order of their blocks; then every block
writes out its own part of the best audit, and the parts are hashed one after the other.

Defined results: rows go by turn (nulls first), then role, then text.  A null role, text, turn or id counts as one space
where it is read; the id itself stays null in the result, and all rows of null id are one conversation.  Empty roles have
an initial that is never legal.  Repeated rows are damaged alike; all but the first are duplicates.  Counts of turns wrap
as longs do.  No rows: no conversations.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.scratch import stored

#: Rows, and characters of text, at which a block ends.
BLOCK_ROWS, BLOCK_CHARS = 4096, 4 << 20
DELETE, INSERT, REROLE, CUT_OFF = 3, 2, 2, 1
#: States: nothing written yet, or the initial written last.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES, ENDS = (START, SYSTEM, USER, ASSISTANT), (START, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: State after the next role that may be inserted or rerolled; state after keeping a row with this initial.
NEXT = (USER, USER, ASSISTANT, USER)
KEPT = {"s": (SYSTEM, -1, -1, -1), "u": (USER, USER, -1, USER), "a": (-1, -1, ASSISTANT, -1)}
ILLEGAL = (-1, -1, -1, -1)
NEVER = 1 << 60

#: A row to the search: its initial, whether it must go, and what it adds if it stays.
Row = tuple[str, bool, int]


def _endings(exits: tuple[int, ...]) -> list[tuple[int, str]]:
    """For each state the cost and letters of inserting until one of the exits."""
    out = []
    for state in STATES:
        n, at = 0, state
        while at not in exits and n < len(STATES):
            n, at = n + 1, NEXT[at]
        out.append((INSERT * n, "I" * n) if at in exits else (NEVER, ""))
    return out


def _bounds(rows: list[Row], endings: list[tuple[int, str]]) -> list[list[int]]:
    """For each row and state, the least cost of the rows from there on if an ending cost nothing."""
    after = [0 if cost < NEVER else NEVER for cost, _ in endings]
    out = [after]
    for initial, must_go, adds in reversed(rows):
        after, kept = out[-1], KEPT.get(initial, ILLEGAL)
        here = [DELETE + after[q] for q in STATES]
        if not must_go:
            for q in STATES:
                here[q] = min(here[q], REROLE + adds + after[NEXT[q]])
                if kept[q] >= 0:
                    here[q] = min(here[q], adds + after[kept[q]])
        for _ in range(2):  # inserts ahead of the row
            here = [min(here[q], INSERT + here[NEXT[q]]) for q in STATES]
        out.append(here)
    return out[::-1]


def _children(row: Row, q: int) -> Iterator[tuple[str, int, int, int]]:
    """Edits at a row in state q, in ASCII order: letter, cost, state after, rows passed."""
    initial, must_go, adds = row
    yield "D", DELETE, q, 1
    yield "I", INSERT, NEXT[q], 0
    if not must_go:
        kept = KEPT.get(initial, ILLEGAL)[q]
        if kept >= 0:
            yield "K", adds, kept, 1
        yield "R", REROLE + adds, NEXT[q], 1


def _dive(rows: list[Row], bound: list[list[int]], q: int) -> tuple[int, int]:
    """Cost and last state of going along the least bounds."""
    total, i = 0, 0
    while i < len(rows):
        _, cost, q, passed = min(_children(rows[i], q), key=lambda x: (x[1] + bound[i + x[3]][x[2]], x[0] == "I"))
        total, i = total + cost, i + passed
    return total, q


def repair(rows: list[Row], start: int = START, exits: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """The least cost, and the ASCII-least audit of that cost, that lead from a state over all rows to one of the exits."""
    n, endings = len(rows), _endings(exits)
    bound = _bounds(rows, endings)
    if bound[0][start] >= NEVER:
        return None
    cost, at = _dive(rows, bound, start)
    limit, best = cost + endings[at][0] + 1, None  # the dive's audit need not be the least: a prefix may still equal its cost
    least = [[NEVER] * len(STATES) for _ in range(n + 1)]
    # a link is (letter, link before): prefixes share their beginnings
    stack: list[tuple[int, int, int, tuple | None]] = [(0, start, 0, None)]
    while stack:
        i, q, cost, link = stack.pop()
        if cost >= least[i][q] or cost + bound[i][q] >= limit:
            continue
        least[i][q] = cost
        if i == n:
            if cost + endings[q][0] < limit:
                limit = cost + endings[q][0]
                best = limit, link, endings[q][1]
            continue
        for letter, more, after, passed in reversed([*_children(rows[i], q)]):
            if cost + more < least[i + passed][after] and cost + more + bound[i + passed][after] < limit:
                stack.append((i + passed, after, cost + more, (letter, link)))
    cost, link, ending = best
    letters = []
    while link:
        letters.append(link[0])
        link = link[1]
    return cost, "".join(reversed(letters)) + ending


def repaired(audit: str, rows: list[tuple[str, str]], state: int = START) -> Iterator[tuple[str, str]]:
    """Role and text of the rows that the edits leave."""
    left = iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(left)
        if letter == "K":
            state = KEPT[role[:1]][state]
            yield role, text
        elif letter != "D":
            state = NEXT[state]
            yield NAMES[state], text


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, there)``: rows after damage by the checksum of id and turn; a dropped row stays as one that
    is not there, so that its conversation is known."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).when(F.col("fate") != 0, F.col("text")).otherwise("")
    rows = rows.withColumn("text", text).withColumn("role", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")))
    times = F.array_repeat(F.col("fate") != 0, F.when(F.col("fate") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", "role", "text", F.explode(times).alias("there"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows with ``blank``, ``cut`` and ``fresh``: no row of an earlier turn has the same role and text."""
    rows = rows.withColumn("blank", ~F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumn("cut", ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).withColumn("name", F.md5("text"))
    # one row for each different text of a conversation, aggregated before the exchange
    firsts = rows.where("there AND NOT blank").groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("name").alias("n")).agg(F.bool_or(F.col("turn").isNull()).alias("unset"), F.min("turn").alias("first"))
    both = rows.join(firsts, rows["conv_id"].eqNullSafe(firsts["c"]) & (rows["role"] == firsts["r"]) & (rows["name"] == firsts["n"]), "left")
    fresh = F.col("turn").eqNullSafe(F.when(~F.col("unset"), F.col("first")))
    return both.select("conv_id", "turn", "role", "text", "there", "blank", "cut", fresh.alias("fresh"))


def _long(x: int) -> int:
    return (x + (1 << 63)) % (1 << 64) - (1 << 63)


class Tally:
    """What is counted of a conversation's rows, block after block."""

    FIELDS = ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "head", "tail")

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.head = self.tail = None  # least and greatest turn, first and last initial

    def _beside(self, initial: str) -> None:
        if self.tail is not None and self.tail + initial not in ("su", "ua", "au"):
            self.illegal += 1

    def row(self, turn: int | None, role: str, fault: str) -> None:
        self._beside(role[:1])
        self.head, self.tail = role[:1] if self.head is None else self.head, role[:1]
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)

    def add(self, other: dict) -> None:
        """Takes in the next block's tally."""
        for x in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, x, getattr(self, x) + other[x])
        if other["head"] is not None:
            self._beside(other["head"])
            self.head, self.tail = other["head"] if self.head is None else self.head, other["tail"]
        if other["low"] is not None:
            self.turns += other["turns"] - (self.high == other["low"])
            self.low, self.high = other["low"] if self.low is None else self.low, other["high"]

    def state(self) -> dict:
        return {x: getattr(self, x) for x in self.FIELDS}

    def result(self) -> dict:
        gaps = 0 if self.low is None else _long(self.high - self.low + 1 - self.turns)
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}


def _type(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TALLY = "blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, head string, tail string"
_WAYS = "array<struct<start: int, exit: int, cost: long, audit: string>>"


class _Block:
    """Consecutive rows of one conversation."""

    def __init__(self, conv: object, number: int, begins: bool) -> None:
        self.conv, self.number, self.begins = conv, number, begins
        self.rows: list[Row] = []
        self.said: list[tuple[str, str]] = []
        self.tally, self.chars = Tally(), 0

    def add(self, x: dict, again: bool) -> None:
        fault = "blank" if x["blank"] else "duplicate" if again or not x["fresh"] else "truncated" if x["cut"] else ""
        self.tally.row(x["turn"], x["role"], fault)
        self.rows.append((x["role"][:1], fault in ("blank", "duplicate"), CUT_OFF if fault == "truncated" else 0))
        self.said.append((x["role"], x["text"]))
        self.chars += len(x["text"])

    def full(self) -> bool:
        return len(self.rows) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS

    def out(self, part: int, whole: bool) -> dict:
        head = {"conv_id": self.conv, "part": part, "number": self.number}
        if whole:
            cost, audit = repair(self.rows)
            text = "\n".join([f"{r}:{t}" for r, t in repaired(audit, self.said)])
            return {**head, "done": {**self.tally.result(), "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}}
        found = {(a, b): repair(self.rows, a, (b,)) for a in ((START,) if self.begins else STATES) for b in STATES}
        ways = [{"start": a, "exit": b, "cost": w[0], "audit": w[1]} for (a, b), w in found.items() if w]
        return {**head, "tally": self.tally.state(), "ways": ways, "said": [{"role": r, "text": t} for r, t in self.said]}


def _rows(batches: Iterator[pa.RecordBatch], most: int = 1024) -> Iterator[dict]:
    for batch in batches:
        for i in range(0, batch.num_rows, most):
            yield from batch.slice(i, most).to_pylist()


def _batches(found: Iterator[dict], schema: pa.Schema, most: int = 512, chars: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for x in found:
        held.append(x)
        size += sum(len(y["text"]) for y in x.get("said") or ())
        if len(held) >= most or size >= chars:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _blocks(rows: Iterator[dict], part: int) -> Iterator[dict]:
    """Rows in order into blocks; a conversation that neither touches an end of the task nor fills a block is done here."""
    block, last, first_run, number = None, None, True, 0
    for x in rows:
        if block is not None and block.conv != x["conv_id"]:
            yield block.out(part, whole=block.begins and block.number == number_of_first and not first_run)
            block, last, first_run = None, None, False
        if block is None:
            number_of_first = number
            block, number = _Block(x["conv_id"], number, begins=not first_run), number + 1
        elif block.full():
            yield block.out(part, whole=False)
            block, number = _Block(x["conv_id"], number, begins=False), number + 1
        if x["there"]:
            own = (x["turn"], x["role"], x["text"])
            block.add(x, again=own == last)
            last = own
    if block is not None:
        yield block.out(part, whole=False)


def _best_ways(blocks: Iterator[dict]) -> Iterator[dict]:
    """For each conversation, in order of its blocks: the tally, the cost, and each block's state and part of the audit."""

    def ended(conv: object, tally: Tally, at: dict, keys: list[tuple[int, int]]) -> Iterator[dict]:
        cost, _, link = min((at[q] for q in ENDS if q in at), key=lambda x: x[:2])
        parts = []
        while link:
            parts.append(link[0])
            link = link[1]
        for i, ((part, number), (start, audit)) in enumerate(zip(keys, reversed(parts), strict=True)):
            yield {"conv_id": conv, "part": part, "number": number, "start": start, "audit": audit, "done": None if i else {**tally.result(), "cost": cost}}

    conv, tally, at, keys = None, None, {}, []
    for x in blocks:
        if tally is None or x["conv_id"] != conv:
            if tally is not None:
                yield from ended(conv, tally, at, keys)
            conv, tally, at, keys = x["conv_id"], Tally(), {START: (0, "", None)}, []
        tally.add(x["tally"])
        keys.append((x["part"], x["number"]))
        further: dict[int, tuple] = {}
        for w in x["ways"]:
            if w["start"] in at:
                cost, audit, link = at[w["start"]]
                found = cost + w["cost"], audit + w["audit"], ((w["start"], w["audit"]), link)
                if w["exit"] not in further or found[:2] < further[w["exit"]][:2]:
                    further[w["exit"]] = found
        at = further
    if tally is not None:
        yield from ended(conv, tally, at, keys)


def _hashed(blocks: Iterator[dict]) -> Iterator[dict]:
    """Each conversation's audit and the hash of its repaired rows, block after block."""
    conv, done, audit, text, begun = None, None, [], None, False
    for x in blocks:
        if done is None or x["conv_id"] != conv:
            if done is not None:
                yield {"conv_id": conv, **done, "audit": "".join(audit), "repaired_sha256": text.hexdigest()}
            conv, done, audit, text, begun = x["conv_id"], x["done"], [], hashlib.sha256(), False
        audit.append(x["audit"])
        for role, said in repaired(x["audit"], [(y["role"], y["text"]) for y in x["said"]], x["start"]):
            text.update(("\n" * begun + f"{role}:{said}").encode())
            begun = True
    if done is not None:
        yield {"conv_id": conv, **done, "audit": "".join(audit), "repaired_sha256": text.hexdigest()}


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """Per conversation of the damaged rows: faults, cost, audit and hash of the repair."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark, key = conversations.sparkSession, T.StructField("conv_id", conversations.schema["conv_id"].dataType)
    place = [key, *_type("part int, number long")]
    schema = T.StructType([*place, T.StructField("done", _type(_RESULT)), T.StructField("tally", _type(_TALLY)), *_type(f"ways {_WAYS}, said array<struct<role: string, text: string>>")])
    way = T.StructType([*place, *_type("start int, audit string"), T.StructField("done", _type(_RESULT.rpartition(", audit")[0]))])
    final = T.StructType([key, *_type(_RESULT)])
    arrow = {k: to_arrow_schema(s, prefers_large_types=False) for k, s in (("block", schema), ("way", way), ("final", final))}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_blocks(_rows(batches), TaskContext.get().partitionId()), arrow["block"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_best_ways(_rows(batches, 1)), arrow["way"], 1)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_hashed(_rows(batches, 1)), arrow["final"], 1)

    # a bounded beginning of the text deals rows out in the same order that the text sorts them
    rows = with_faults(damaged(conversations)).repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))
    blocks = stored(rows.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(cut, schema), "conversation-blocks")
    open_ones = blocks.where("done IS NULL")
    ways = open_ones.select("conv_id", "part", "number", "tally", "ways").repartition("conv_id").sortWithinPartitions("conv_id", "part", "number").mapInArrow(choose, way)
    ways = stored(ways, "conversation-ways").drop("conv_id")
    parts = open_ones.select("conv_id", "part", "number", "said").join(ways, ["part", "number"])
    rest = parts.select("conv_id", "part", "number", "start", "audit", "done", "said").repartition("conv_id").sortWithinPartitions("conv_id", "part", "number").mapInArrow(finish, final)
    return blocks.where("done IS NOT NULL").select("conv_id", "done.*").union(stored(rest, "long-conversations"))
