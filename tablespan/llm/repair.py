"""Repair of conversations whose turns are damaged or out of order, at the least cost.

A repaired conversation has role initials s?(ua)+ or no rows at all. Every row is kept, given another role, or deleted, and
empty user or assistant rows may be inserted anywhere; blank rows and duplicates must go. Among the cheapest edits the
one whose initials (D, I, K, R) read least is taken.

Method: depth-first branch and bound. A node is a place between rows and a state of the wanted pattern; the explicit
stack holds prefixes (place, state, cost, audit). A prefix is dropped if its cost and the lower bound of the rest exceed
the incumbent, if it ties with the incumbent and its audit already reads greater, or if its node's dominance table has a
prefix that costs less, or the same and reads less. The search ends when the stack is empty: then nothing left could be
better. The bound of a suffix is what its rows cost at least from the prefix's state on, audits left out of account; it is
computed from the last row backwards, so few prefixes are taken up that lead nowhere.

Scale: a conversation's rows are numbered in order and cut into segments of SEGMENT rows, so that one search never sees more,
however long a conversation is. A segment is searched for every pair of states at its ends; the best chain of segments
is then found by a pass over (state, cost, audit) entries, and a last pass reads the rows in order, with the edits chosen,
and feeds them to a running digest. No pass holds a conversation's texts: memory is bounded by a segment's roles, one row, and
the conversation's audit, which is one character a row and a result. The order of one conversation and its digest are
sequential by nature; its rows stream through one task, sorted by Spark with spilling. States differ in no other way than
by their end, and equal costs with equal counts of rows never have one audit as the beginning of the other, so the best
prefix of a node stays the best whatever follows.

Defined results: a null conv_id is a conversation of its own; rows are ordered by turn, nulls first, then role and text, so
that equal rows are neighbours; a null role or text is one space, which no pattern allows to stay as a role, and a role
without a first character neither; a role counts by its first character; turn differences are taken over turns that are
not null, and are 0 without any; a conversation without rows has zeros, an empty audit and the digest of nothing; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from math import inf

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablespan.scratch import written_table

SEGMENT = 128
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

NONE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
#: The wanted pattern: START, after a system row, after a user row, after an assistant row. Nothing or an answer may end it.
START, SYSTEM, USER, ANSWER = range(4)
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ANSWER}, ANSWER: {"u": USER}}
ENDS = (START, ANSWER)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")


def wanted(state: int) -> str:
    """The initial of the role that an inserted or changed row takes in this state."""
    return "a" if state == USER else "u"


def moves(state: int, initial: str, fault: int) -> list[tuple[int, str, int]]:
    """(cost, edit, state after) of what can be done with a row in this state."""
    out = [(DELETE, "D", state)]
    if fault not in (BLANK, DUPLICATE):
        extra = TRUNCATED if fault == CUT else 0
        out.append((REROLE + extra, "R", NEXT[state][wanted(state)]))
        if initial in NEXT[state]:
            out.append((extra, "K", NEXT[state][initial]))
    return out


def bounds(initials: list[str], faults: list[int], goals: tuple[int, ...]) -> list[list[float]]:
    """For every place and state, a lower bound of what the rows from there on cost until one of `goals` is reached: their
    costs alone, whatever the audit. It is found from the last row backwards."""
    def with_inserts(costs: list[float]) -> list[float]:
        for _ in range(3):                          # no more than three lead to every state that inserts reach
            costs = [min(c, INSERT + costs[NEXT[q][wanted(q)]]) for q, c in enumerate(costs)]
        return costs

    out = [with_inserts([0 if q in goals else inf for q in range(4)])]
    for initial, fault in zip(reversed(initials), reversed(faults)):
        out.append(with_inserts([min(cost + out[-1][to] for cost, _, to in moves(q, initial, fault)) for q in range(4)]))
    return out[::-1]


def search(initials: list[str], faults: list[int], entry: int, goals: tuple[int, ...]) -> tuple[int, str] | None:
    """The cheapest edits, and of those the least audit, that lead from the state `entry` before the rows to one of `goals`
    after them; None if none do."""
    n, rest = len(initials), bounds(initials, faults, goals)
    best: tuple[int, str] | None = None
    known: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")] if rest[0][entry] < inf else []
    while stack:
        at, state, cost, audit = stack.pop()
        if best is not None and (cost + rest[at][state], audit) > (best[0], best[1][:len(audit)]):
            continue
        if (at, state) in known and known[at, state] <= (cost, audit):
            continue
        known[at, state] = (cost, audit)
        if at == n and state in goals:
            best = (cost, audit) if best is None else min(best, (cost, audit))
        further = [(INSERT, "I", at, NEXT[state][wanted(state)])]
        if at < n:
            further += [(more, edit, at + 1, to) for more, edit, to in moves(state, initials[at], faults[at])]
        # the least bound is taken up first, of equal ones the least edit
        further.sort(key=lambda m: (m[0] + rest[m[2]][m[3]], m[1]), reverse=True)
        stack += [(place, to, cost + more, audit + edit) for more, edit, place, to in further if rest[place][to] < inf]
    return best


def ordered_rows(conversations: DataFrame) -> DataFrame:
    """Rows (conv, pos, turn, role, text, fault): the rows of each conversation numbered from 0, with their first fault. `conv` is
    the conv_id as text, empty for null. Both windows are served by one shuffle on conv."""
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    place = F.row_number().over(Window.partitionBy("conv").orderBy("turn", "role", "text")) - 1
    rows = rows.withColumn("pos", place.cast("long"))
    again = F.row_number().over(Window.partitionBy("conv", "role", "text").orderBy("pos")) > 1
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(last == "", BLANK).when(F.col("again"), DUPLICATE).when(~last.isin(".", "!", "?"), CUT).otherwise(NONE)
    return rows.withColumn("again", again).select("conv", "pos", "turn", "role", "text", fault.alias("fault"))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best edits of each segment for every pair of states. Rows come by (conv, seg, pos)."""
    def found(key, initials, faults):
        for entry in range(4) if key[1] else (START,):
            for end in range(4):
                hit = search(initials, faults, entry, (end,))
                if hit is not None:
                    yield {"conv": key[0], "seg": key[1], "entry": entry, "end": end, "cost": hit[0], "audit": hit[1]}

    out, key, initials, faults = [], None, [], []
    schema = pa.schema([("conv", pa.string()), ("seg", pa.int64()), ("entry", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()),
                        ("audit", pa.string())])
    for batch in batches:
        for conv, seg, initial, fault in zip(*[batch.column(c).to_pylist() for c in ("conv", "seg", "initial", "fault")]):
            if (conv, seg) != key:
                if key is not None:
                    out.extend(found(key, initials, faults))
                key, initials, faults = (conv, seg), [], []
            initials.append(initial)
            faults.append(fault)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if key is not None:
        yield pa.RecordBatch.from_pylist(list(found(key, initials, faults)), schema)


class _Chain:
    """The best chains of one conversation's segments, one for each state they end in. What all of them begin with is set
    aside, so only the segments in which they differ are carried along and compared."""

    def __init__(self):
        self.begin: list[str] = []
        self.best: dict[int, tuple[int, str, list[str]]] = {START: (0, "", [])}     # state: cost, audit, the same by segment

    def extend(self, entries: list[tuple[int, int, int, str]]) -> None:
        after: dict[int, tuple[int, str, list[str]]] = {}
        for entry, end, cost, audit in entries:
            if entry in self.best:
                before = self.best[entry]
                new = (before[0] + cost, before[1] + audit)
                if end not in after or new < after[end][:2]:
                    after[end] = (*new, [*before[2], audit])
        chains = [chain[2] for chain in after.values()]
        same = 0
        while all(len(c) > same and c[same] == chains[0][same] for c in chains):
            same += 1
        self.begin += chains[0][:same]
        self.best = {q: (cost, "".join(parts[same:]), parts[same:]) for q, (cost, _, parts) in after.items()}

    def chosen(self) -> tuple[int, list[str]]:
        cost, _, parts = min(self.best[q] for q in ENDS if q in self.best)
        return cost, self.begin + parts


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each segment in the best chain of its conversation. Entries come by (conv, seg)."""
    schema = pa.schema([("conv", pa.string()), ("seg", pa.int64()), ("audit", pa.string()), ("cost", pa.int64())])

    def rows(conv: str, chain: _Chain) -> list[dict]:
        cost, parts = chain.chosen()
        return [{"conv": conv, "seg": seg, "audit": part, "cost": 0 if seg else cost} for seg, part in enumerate(parts)]

    out, conv, seg, chain, entries = [], None, None, _Chain(), []
    for batch in batches:
        for c, s, *entry in zip(*[batch.column(x).to_pylist() for x in ("conv", "seg", "entry", "end", "cost", "audit")]):
            if (c, s) != (conv, seg) and entries:
                chain.extend(entries)
                entries = []
            if c != conv:
                if conv is not None:
                    out += rows(conv, chain)
                chain = _Chain()
            conv, seg = c, s
            entries.append(entry)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if conv is not None:
        chain.extend(entries)
        yield pa.RecordBatch.from_pylist(rows(conv, chain), schema)


_EDITS = re.compile("I*[DKR](?:I+$)?")


class _Conversation:
    """The report of one conversation, from its rows in order."""

    def __init__(self, conv: str):
        self.counts = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0}
        self.conv, self.audit, self.digest, self.state, self.rows = conv, [], sha256(), START, 0
        self.first = self.last = self.before = None
        self.turns = 0

    def segment(self, audit: str, cost: int) -> None:
        self.audit.append(audit)
        self.edits = iter(_EDITS.findall(audit))
        self.counts["cost"] += cost

    def _put(self, initial: str, role: str, text: str) -> None:
        self.digest.update((("\n" if self.rows else "") + role + ":" + text).encode())
        self.rows += 1
        self.state = NEXT[self.state][initial]

    def row(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.turns += turn != self.last
            self.last = turn
        if fault:
            self.counts[("", "blank", "duplicate", "truncated")[fault]] += 1
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.before = role[:1]
        for edit in next(self.edits):
            new = wanted(self.state)
            if edit == "I":
                self._put(new, ROLES[new], "")
            elif edit == "R":
                self._put(new, ROLES[new], text)
            elif edit == "K":
                self._put(role[:1], role, text)

    def report(self) -> dict:
        if self.first is not None:
            self.counts["gaps"] = self.last - self.first + 1 - self.turns
        return {"conv": self.conv, **self.counts, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One report per conversation. Rows come by (conv, seg, pos); a segment's edits come before its rows, at pos -1."""
    schema = pa.schema([("conv", pa.string()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    out, at = [], None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "pos", "turn", "role", "text", "fault", "audit", "cost")]
        for conv, pos, turn, role, text, fault, audit, cost in zip(*columns):
            if at is None or conv != at.conv:
                if at is not None:
                    out.append(at.report())
                at = _Conversation(conv)
            if pos < 0:
                at.segment(audit, cost)
            else:
                at.row(turn, role, text, fault)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if at is not None:
        yield pa.RecordBatch.from_pylist([at.report()], schema)


def _in_order(df: DataFrame, by: list[str], *then: str) -> DataFrame:
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *by).sortWithinPartitions(*by, *then)


def best_edits(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv, seg, audit, cost): the edits of each segment of `ordered_rows`; the conversation's cost stands in segment 0."""
    seg = F.expr(f"pos div {segment}")
    slim = rows.select("conv", seg.alias("seg"), "pos", F.substring("role", 1, 1).alias("initial"), "fault")
    found = _in_order(slim, ["conv", "seg"], "pos").mapInArrow(
        _segments, "conv string, seg long, entry int, end int, cost long, audit string")
    return _in_order(found, ["conv"], "seg").mapInArrow(_chains, "conv string, seg long, audit string, cost long")


def repaired(conversations: DataFrame, originals: DataFrame | None = None, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for each conversation, and for each conv_id
    of `originals` that has no rows."""
    rows = written_table(ordered_rows(conversations), "conversation-rows")
    seg = F.expr(f"pos div {segment}").alias("seg")
    turns = rows.select("conv", seg, "pos", "turn", "role", "text", "fault", F.lit(None).cast("string").alias("audit"), F.lit(None).cast("long").alias("cost"))
    null = lambda kind: F.lit(None).cast(kind)
    edits = best_edits(rows, segment).select("conv", "seg", F.lit(-1).cast("long").alias("pos"), null("long").alias("turn"), null("string").alias("role"),
                                             null("string").alias("text"), null("int").alias("fault"), "audit", "cost")
    found = _in_order(turns.unionByName(edits), ["conv"], "seg", "pos").mapInArrow(
        _reports, ", ".join(["conv string", *[f"{c} long" for c in COUNTS], "audit string", "repaired_sha256 string"]))
    every = (originals if originals is not None else conversations).select(
        "conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")).distinct()
    return every.join(found, "conv", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def repaired_turns(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The repaired conversations themselves: (conv_id, pos, edit, role, text), rows in order by pos from 0."""
    rows = written_table(ordered_rows(conversations), "conversation-rows")
    edits = best_edits(rows, segment)
    tokens = edits.select("conv", "seg", F.posexplode(F.regexp_extract_all("audit", F.lit("(I*[DKR](?:I+$)?)"), F.lit(1))).alias("k", "token"))
    steps = (rows.join(tokens.select("conv", (F.col("seg") * segment + F.col("k")).alias("pos"), "token"), ["conv", "pos"])
             .select("conv", "pos", F.posexplode(F.filter(F.split("token", ""), lambda e: ~e.isin("D", ""))).alias("step", "edit"), "role", "text"))
    order = Window.partitionBy("conv").orderBy("pos", "step")
    last = Window.partitionBy("conv")
    placed = steps.withColumn("at", (F.row_number().over(order) - 1).cast("long")).withColumn("n", F.count(F.lit(1)).over(last))
    # an odd number of rows begins with a system row, and the others alternate from there
    new = F.when((F.col("at") - F.col("n") % 2) % 2 == 0, "user").otherwise("assistant")
    return placed.select(F.when(F.col("conv") != "", F.col("conv")).cast("long").alias("conv_id"), F.col("at").alias("pos"), "edit",
                         F.when(F.col("edit") == "K", F.col("role")).otherwise(new).alias("role"),
                         F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults, chosen by the CRC-32 of `conv_id:turn`: rows lost, emptied, without marks at sentence ends,
    repeated, or given to the user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("fate"))
    fate = F.col("fate")
    rows = rows.where(fate != 0).select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(True), F.when(fate == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")
