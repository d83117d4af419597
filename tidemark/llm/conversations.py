"""Repair of conversations by a generalised LR parse of their roles.

The role grammar is compiled to LR(0) states. A parse holds one stack per state on top; every row
offers the actions keep, rerole and delete, and between rows turns may be inserted. Each action
has a weight, and stacks that come to have equal tops are merged: the one of smaller (cost, audit)
stays. In this grammar the top alone decides what may follow, so the merge loses nothing.

A conversation may hold any share of all rows. Rows are therefore dealt out by ranges of
(conversation, turn, role, text digest), and a task parses blocks of at most ``BLOCK`` rows from
every possible top; a conversation that lies within a task is parsed to its end there, and of the
others the blocks are joined in order: ``(cost, audit)`` of a row of blocks is that of its parts
added up, again merged by minimum at equal tops. What one task holds of a conversation are the
best audits so far, one letter a row.

Rows have ``conv_id, turn, role, text``; nulls of role and text count as one space, a null
``conv_id`` is a conversation of its own, and null turns come first. Rows of one turn are taken by
role, then by the SHA-256 of the text; rows that are equal throughout stand one after the other.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept

BLOCK = 4096
ROWS = 4096  # of an output batch
KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = frozenset(("su", "ua", "au"))
SPACES = " \t\n\x0b\x0c\r"
# The conversations in order: nothing, or pairs of user and assistant, at the head maybe a system turn.
GRAMMAR = {"C": ((), ("P",)), "P": (("T",), ("s", "T"), ("P", "T")), "T": (("u", "a"),)}
BLANK, DUPLICATE, TRUNCATED, SOUND = "bdt."
FAULTS = {BLANK: "blank", DUPLICATE: "duplicate", TRUNCATED: "truncated"}
COUNTS = (*FAULTS.values(), "illegal")
ORDER = ("conv_id", "turn", "role", "digest")

Best = tuple[int, str]  # cost and audit


def _closure(items: frozenset) -> frozenset:
    found = set(items)
    while True:
        more = {
            (head, body, 0) for _, rule, at in found if at < len(rule) for head in (rule[at],) for body in GRAMMAR.get(head, ())
        } - found
        if not more:
            return frozenset(found)
        found |= more


@lru_cache(maxsize=1)
def automaton() -> tuple[list[dict[str, int]], list[tuple[str, int] | None], frozenset[int]]:
    """Per LR state its shifts and gotos, and its reduction (symbol, length); and the states in which input may end.

    State 0 is the start. The symbol ``C`` is accepted instead of reduced.
    """
    states = [_closure(frozenset(("C", body, 0) for body in GRAMMAR["C"]))]
    moves: list[dict[str, int]] = []
    for state in states:  # grows while it is read
        moves.append({})
        for symbol in sorted({rule[at] for _, rule, at in state if at < len(rule)}):
            after = _closure(frozenset((h, rule, at + 1) for h, rule, at in state if at < len(rule) and rule[at] == symbol))
            if after not in states:
                states.append(after)
            moves[-1][symbol] = states.index(after)
    done = [[(head, len(rule)) for head, rule, at in state if at == len(rule)] for state in states]
    ends = frozenset(n for n, full in enumerate(done) if any(head == "C" for head, _ in full))
    return moves, [next((r for r in full if r[0] != "C"), None) for full in done], ends


@lru_cache(maxsize=1)
def tops() -> dict[int, tuple[int, ...]]:
    """The states that can be on top between two turns, each with one stack that has it there."""
    found, waiting = {0: (0,)}, [(0,)]
    while waiting:
        stack = waiting.pop()
        for letter in "sua":
            after = shifted(stack, letter)
            if after and after[-1] not in found:
                found[after[-1]] = after
                waiting.append(after)
    return dict(sorted(found.items()))


def shifted(stack: tuple[int, ...], letter: str) -> tuple[int, ...] | None:
    """The stack after a turn of this role initial and all reductions; None where the grammar has no such turn."""
    moves, reductions, _ = automaton()
    to = moves[stack[-1]].get(letter)
    if letter in GRAMMAR or to is None:
        return None
    stack = (*stack, to)
    while reductions[stack[-1]]:
        symbol, length = reductions[stack[-1]]
        stack = stack[: len(stack) - length]
        stack = (*stack, moves[stack[-1]][symbol])
    return stack


@lru_cache(maxsize=1)
def _steps() -> dict[tuple[int, str], int]:
    """The top that follows a top by a role initial."""
    after = {(top, letter): shifted(stack, letter) for top, stack in tops().items() for letter in "sua"}
    return {key: stack[-1] for key, stack in after.items() if stack}


def _merge(stacks: dict[int, Best], top: int, cost: int, audit: str) -> bool:
    """Put a stack beside the others; of two with equal tops the smaller (cost, audit) stays."""
    if top in stacks and stacks[top] <= (cost, audit):
        return False
    stacks[top] = (cost, audit)
    return True


def _with_inserts(stacks: dict[int, Best]) -> dict[int, Best]:
    steps, waiting = _steps(), list(stacks)
    while waiting:
        top = waiting.pop()
        cost, audit = stacks[top]
        for letter in ROLES:
            to = steps.get((top, letter))
            if to is not None and _merge(stacks, to, cost + INSERT_COST, audit + INSERT):
                waiting.append(to)
    return stacks


@lru_cache(maxsize=1 << 15)
def parse(rows: str, start: int) -> dict[int, Best]:
    """Per top the smallest (cost, audit) after these rows, begun with a stack of the top ``start``.

    ``rows`` has two letters a row: its role initial (``?`` for any but s, u, a) and its fault.
    """
    steps = _steps()
    stacks = _with_inserts({start: (0, "")})
    for at in range(0, len(rows), 2):
        initial, fault = rows[at], rows[at + 1]
        after: dict[int, Best] = {}
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        for top, (cost, audit) in stacks.items():
            _merge(after, top, cost + DELETE_COST, audit + DELETE)
            if fault in (BLANK, DUPLICATE):
                continue
            for letter in "sua":
                to = steps.get((top, letter))
                if to is None:
                    continue
                if letter == initial:
                    _merge(after, to, cost + extra, audit + KEEP)
                if letter in ROLES:
                    _merge(after, to, cost + extra + REROLE_COST, audit + REROLE)
        stacks = _with_inserts(after)
    return stacks


def cheapest(stacks: dict[int, Best]) -> Best:
    """The smallest (cost, audit) of the stacks at which the grammar lets input end."""
    _, _, ends = automaton()
    return min(best for top, best in stacks.items() if top in ends)


def joined(stacks: dict[int, Best], block: dict[int, dict[int, Best]]) -> dict[int, Best]:
    """Stacks after a block, of which the result from every top is known."""
    after: dict[int, Best] = {}
    for top, (cost, audit) in stacks.items():
        for to, (more, letters) in block[top].items():
            if to not in after or cost + more <= after[to][0]:
                _merge(after, to, cost + more, audit + letters)
    return after


# --- rows -----------------------------------------------------------------------------------


def with_digest(rows: DataFrame) -> DataFrame:
    """The rows with nulls of role and text as a space, and the digest by which equal turns are ordered."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    return rows.select("conv_id", "turn", role, text).withColumn("digest", F.unhex(F.sha2(F.col("text"), 256)))


def faults(rows: DataFrame) -> DataFrame:
    """Distinct rows with their first fault: ``conv_id, turn, role, digest, copies, fault``.

    Equal rows are one row with ``copies``; all but the first are duplicates, or blank. Of rows
    that differ by turn alone the earliest turn is no duplicate.
    """
    solid = F.rtrim(F.col("text"), F.lit(SPACES))
    ended = F.substring(solid, -1, 1).isin(".", "!", "?")
    state = F.when(F.length(solid) == 0, BLANK).when(ended, SOUND).otherwise(TRUNCATED)
    distinct = kept(
        with_digest(rows).withColumn("state", state).groupBy(*ORDER, "state").agg(F.count("*").alias("copies"))
    )
    # Null turns come first, so a group with one has its first row there.
    earliest = F.when(F.bool_or(F.col("turn").isNull()), None).otherwise(F.min("turn")).alias("turn")
    first = distinct.groupBy("conv_id", "role", "digest").agg(earliest).withColumn("first", F.lit(True))
    first = first.select(*[F.col(c).alias(f"first_{c}") for c in ORDER], "first")
    same = [F.col(c).eqNullSafe(F.col(f"first_{c}")) for c in ORDER]
    fault = F.when((F.col("state") != BLANK) & F.col("first").isNull(), DUPLICATE).otherwise(F.col("state"))
    return distinct.join(first, same, "left").select(*ORDER, "copies", fault.alias("fault"))


def plans(rows: DataFrame) -> DataFrame:
    """Per conversation its faults and the cheapest repair.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``: ``gaps`` are the turns
    missing between the smallest and the largest, ``illegal`` the neighbours whose role initials
    do not follow each other, ``audit`` has the first letter of every edit. Conversations without
    rows have none here; an empty table gives no rows.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    found = kept(faults(rows))
    dealt = found.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).select("conv_id", "role", "copies", "fault")
    plan = f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, cost long, audit string"
    blocks = kept(dealt.mapInArrow(_parsed, f"{plan}, part int, block int, head string, tail string, table string"))
    # Only blocks of conversations that go over the border of a task, or of a block.
    split = blocks.where("table IS NOT NULL").repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    ready = blocks.where("table IS NULL").select("conv_id", *COUNTS, "cost", "audit")
    ready = ready.unionByName(split.mapInArrow(_composed, plan))
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    gaps = found.select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))
    gaps = gaps.withColumnRenamed("conv_id", "of")
    return ready.join(gaps, F.col("conv_id").eqNullSafe(F.col("of"))).select("conv_id", "gaps", *COUNTS, "cost", "audit")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: ``conv_id, place, edit, role, text``, place from 0.

    ``found`` are the ``plans`` of the same rows. A conversation is read in order by one task, a
    row at a time.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, place long, edit string, role string, text string"
    return _in_order(rows, found).mapInArrow(_turns, schema)


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """SHA-256 of the repaired ``role:text``, joined by line ends, per conversation that has rows."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _in_order(rows, found).mapInArrow(_digests, f"conv_id {kind}, repaired_sha256 string")


def _in_order(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order; no conversation goes over the border of a task."""
    texts = with_digest(rows).withColumn("audit", F.lit(None).cast("string"))
    audits = found.select("conv_id", "audit")
    both = audits.unionByName(texts, allowMissingColumns=True).withColumn("is_row", F.col("audit").isNull())
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", *ORDER[1:])
    return ordered.select("conv_id", "audit", "role", "text")


# --- tasks ----------------------------------------------------------------------------------


class _Block:
    """Rows of one conversation that stand together: letters for the parse, counts, first and last initial."""

    def __init__(self, conv, number: int = 0):
        self.conv, self.number, self.size = conv, number, 0
        self.letters: list[str] = []
        self.counts = dict.fromkeys(COUNTS, 0)
        self.head: str | None = None
        self.tail = ""

    def add(self, initial: str, fault: str, times: int) -> None:
        self.letters.append(((initial if initial in ("s", "u", "a") else "?") + fault) * times)
        self.size += times
        if fault != SOUND:
            self.counts[FAULTS[fault]] += times
        if self.head is None:
            self.head = initial
        elif self.tail + initial not in LEGAL_PAIRS:
            self.counts["illegal"] += 1
        self.counts["illegal"] += times - 1  # no role may follow itself
        self.tail = initial

    def whole(self) -> dict:
        cost, audit = cheapest(parse("".join(self.letters), 0))
        return {"conv_id": self.conv, **self.counts, "cost": cost, "audit": audit}

    def part(self, task: int) -> dict:
        table = {top: parse("".join(self.letters), top) for top in tops()}
        place = {"part": task, "block": self.number, "head": self.head, "tail": self.tail}
        return {"conv_id": self.conv, **self.counts, **place, "table": json.dumps(table)}


def _copies(role: str, copies: int, fault: str) -> Iterator[tuple[str, str, int]]:
    """A distinct row as runs of at most a block: its first copy, then the others."""
    yield role[:1], fault, 1
    for at in range(1, copies, BLOCK):
        yield role[:1], BLANK if fault == BLANK else DUPLICATE, min(BLOCK, copies - at)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parse the sorted rows of a task.

    The first and the last conversation of a task may have rows in others: they give blocks, as do
    those of more than a block.
    """
    task, schema = TaskContext.get().partitionId(), None
    out: list[dict] = []
    block, starts_here = None, False
    for batch in batches:
        schema = schema or _schema(batch, [*COUNTS, "cost"], ["part", "block"], ["head", "tail", "table"])
        for conv, role, copies, fault in _rows(batch):
            if block is None or conv != block.conv:
                if block is not None:
                    out.append(block.whole() if starts_here and not block.number else block.part(task))
                    starts_here = True
                block = _Block(conv)
            for initial, kind, times in _copies(role, copies, fault):
                if block.size + times > BLOCK:
                    out.append(block.part(task))
                    block = _Block(conv, block.number + 1)
                block.add(initial, kind, times)
        yield pa.RecordBatch.from_pylist(out, schema)
        out = []
    if block is not None:
        yield pa.RecordBatch.from_pylist([block.part(task)], schema)


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join the blocks of each conversation, which come in order."""
    schema, conv, stacks, counts, tail = None, None, None, None, ""

    def ended() -> pa.RecordBatch:
        cost, audit = cheapest(stacks)
        return pa.RecordBatch.from_pylist([{"conv_id": conv, **counts, "cost": cost, "audit": audit}], schema)

    for batch in batches:
        schema = schema or _schema(batch, [*COUNTS, "cost"], [], [])
        for row in batch.to_pylist():
            if stacks is None or row["conv_id"] != conv:
                if stacks is not None:
                    yield ended()
                conv, stacks, counts = row["conv_id"], {0: (0, "")}, dict.fromkeys(COUNTS, 0)
            elif tail + row["head"] not in LEGAL_PAIRS:
                counts["illegal"] += 1
            tail = row["tail"]
            for name in COUNTS:
                counts[name] += row[name]
            table = {int(a): {int(b): tuple(v) for b, v in to.items()} for a, to in json.loads(row["table"]).items()}
            stacks = joined(stacks, table)
    if stacks is not None:
        yield ended()


def _schema(batch: pa.RecordBatch, longs: list[str], ints: list[str], strings: list[str]) -> pa.Schema:
    fields = [("conv_id", batch.schema.field("conv_id").type), *((c, pa.int64()) for c in longs), ("audit", pa.string())]
    return pa.schema([*fields, *((c, pa.int32()) for c in ints), *((c, pa.string()) for c in strings)])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, object, str, str, str]]:
    """``(number of the conversation, conv_id, edit, role, text)`` of repaired turns, one by one.

    Every conversation also gives ``(number, conv_id, "", "", "")`` at its head.
    """
    number, audit, at, top, conv = 0, "", 0, 0, None
    steps = _steps()

    def inserts() -> Iterator[tuple]:
        nonlocal at, top
        while at < len(audit) and audit[at] == INSERT:
            letter = next(c for c in ROLES if (top, c) in steps)
            top, at = steps[top, letter], at + 1
            yield number, conv, INSERT, ROLES[letter], ""

    for batch in batches:
        for row_conv, row_audit, role, text in _rows(batch):
            if row_audit is not None:
                yield from inserts()
                number, conv, audit, at, top = number + 1, row_conv, row_audit, 0, 0
                yield number, conv, "", "", ""
                continue
            yield from inserts()
            edit, at = audit[at], at + 1
            if edit == REROLE:
                letter = next(c for c in ROLES if (top, c) in steps)
                role, top = ROLES[letter], steps[top, letter]
            elif edit == KEEP:
                top = steps[top, role[:1]]
            if edit != DELETE:
                yield number, conv, edit, role, text
    yield from inserts()


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds, place, out = [], 0, []

    def watched() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds[:] = [batch.schema.field("conv_id").type]
            yield batch

    def made() -> pa.RecordBatch:
        names = ("conv_id", "place", "edit", "role", "text")
        types = (kinds[0], pa.int64(), pa.string(), pa.string(), pa.string())
        columns = zip(*out, strict=True) if out else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    for _, conv, edit, role, text in _edited(watched()):
        place = place + 1 if edit else -1
        if edit:
            out.append((conv, place, edit, role, text))
        if len(out) == ROWS:
            yield made()
            out = []
    if out:
        yield made()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds, out, now, digest, empty = [], [], 0, hashlib.sha256(), True

    def watched() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds[:] = [batch.schema.field("conv_id").type]
            yield batch

    def made() -> pa.RecordBatch:
        ids, found = zip(*out, strict=True)
        columns = [pa.array(ids, kinds[0]), pa.array([d.hexdigest() for d in found], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "repaired_sha256"])

    for number, conv, edit, role, text in _edited(watched()):
        if number != now:
            if len(out) >= ROWS:
                yield made()
                out = []
            now, digest, empty = number, hashlib.sha256(), True
            out.append((conv, digest))
        if edit:
            digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            empty = False
    if out:
        yield made()
