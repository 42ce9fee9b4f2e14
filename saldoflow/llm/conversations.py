"""Repair of conversations whose turns are out of order, repeated, empty or cut off, by a survivor-coalescence Viterbi search.

The rows of a conversation are read by turn (null turns first, then by role, the first ``SORTED_CHARS`` characters and a digest of the text). Each row
is kept, given the role of the user or of the assistant, or deleted, and rows without text may be inserted, so that the
initials of the roles read ``(s?(ua)+)?`` at the least cost; of equal costs the edits whose initials (D, I, K, R) come first
in ASCII order are taken.

* The search keeps one survivor for each of the four states of that pattern. Their edits form a tree of back pointers with reference counts:
  once all survivors share an ancestor, the edits up to it are final and leave memory. A survivor that a cheaper one can
  imitate from here on, whatever follows, is dropped, or the survivor that has deleted everything would keep the tree whole.
* Two survivors of equal cost for one state are told apart by their complete unresolved edits. The edits of two survivors
  differ and neither begins with the other, because each ends at the same row; so the order of two suffixes is that of their parents, then
  that of the last edits, and a rank for each survivor carries the whole comparison along.
* Rows are dealt by ranges of (conversation, turn), so a conversation of any size spreads over many parts. For conversations on a border (at most one
  for each border) a first pass finds the costs and the order of all entry and exit states of each part; the driver joins these few
  numbers, and the second pass starts and ends each part in the states found. A part never holds more unresolved rows than its own.

Rows with a null conversation form one conversation; a null role or text is one space, a null turn stays null. Repeated rows are turns
like others (the second is a duplicate). An empty table gives no rows. Columns beyond the four named ones are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldoflow.llm.scratch import Scratch

BLANKS = " \t\n\x0b\x0c\r"
SORTED_CHARS = 64
USER, ASSISTANT = "user", "assistant"
# Costs of the edits; a row that is cut off and not deleted costs TRUNCATED more.
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# States: nothing yet, after the system row, after a user, after an assistant.
START, SYSTEM, ASKED, ANSWERED = range(4)
STATES = 4
_INSERTED = {START: ASKED, SYSTEM: ASKED, ASKED: ANSWERED, ANSWERED: ASKED}
_KEPT = {(START, "s"): SYSTEM, (START, "u"): ASKED, (SYSTEM, "u"): ASKED, (ASKED, "a"): ANSWERED, (ANSWERED, "u"): ASKED}
_ENDING = {START: "", SYSTEM: "II", ASKED: "I", ANSWERED: ""}
# What it costs at most to go on from one state as another one would, whatever follows.
_IMITATION = {
    (ANSWERED, SYSTEM): 0,
    (ANSWERED, START): DELETE,
    (ANSWERED, ASKED): INSERT,
    (ASKED, ANSWERED): INSERT,
    (ASKED, SYSTEM): INSERT,
    (ASKED, START): INSERT + DELETE,
    (START, ANSWERED): 0,
    (START, SYSTEM): 0,
    (START, ASKED): INSERT,
    (SYSTEM, ANSWERED): 2 * INSERT,
    (SYSTEM, START): 2 * INSERT + DELETE,
    (SYSTEM, ASKED): INSERT,
}
LEGAL_PAIRS = ("su", "ua", "au")

EDITS = "part int, place long, edit string, turn long, role_before string, role string, text string, fault string, illegal boolean, cost long"
_ORDER = ("conv_id", "turn", "role", "head", "digest", "row_id")


def _steps(initial: str, fault: str | None) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, edits) for a row: the cheapest way between any two states, ties to the first in ASCII order."""
    best: dict[tuple[int, int], tuple[int, str]] = {(state, state): (DELETE, "D") for state in range(STATES)}
    if fault not in ("blank", "duplicate"):
        extra = TRUNCATED if fault == "truncated" else 0
        for state in range(STATES):
            at, before = state, ""
            for _ in range(3):
                ways = [(ANSWERED if at == ASKED else ASKED, RELABEL, "R")]
                if (at, initial) in _KEPT:
                    ways.append((_KEPT[at, initial], 0, "K"))
                for to, cost, edit in ways:
                    way = (cost + extra + INSERT * len(before), before + edit)
                    best[state, to] = min(best.get((state, to), way), way)
                at, before = _INSERTED[at], before + "I"
    return [(a, b, cost, edits) for (a, b), (cost, edits) in sorted(best.items())]


_ROW_STEPS = {(i, f): _steps(i, f) for i in ("s", "u", "a", "") for f in (None, "blank", "duplicate", "truncated")}


def _steps_of(role: str, fault: str | None) -> list[tuple[int, int, int, str]]:
    return _ROW_STEPS[role[:1] if role[:1] in ("s", "u", "a") else "", fault]


class Node:
    """An edit of the back pointer tree; ``children`` counts what refers to it, ``names`` sums the ids of its child nodes."""

    __slots__ = ("parent", "begins", "ends", "edits", "row", "children", "names")

    def __init__(self, parent: Node | None, begins: int, ends: int, edits: str, row):
        self.parent, self.begins, self.ends, self.edits, self.row = parent, begins, ends, edits, row
        self.children, self.names = 0, 0


class Survivors:
    """The search over the rows of one conversation, or of the part of one that begins in ``state``."""

    def __init__(self, state: int = START):
        self.root = Node(None, state, state, "", None)
        self.nodes: dict[int, Node] = {id(self.root): self.root}
        self.alive: dict[int, tuple[int, int, Node]] = {state: (0, 0, self.root)}  # state: cost, rank, last edit
        self.root.children = 1

    def _drop(self, node: Node) -> None:
        """Takes back one reference to ``node`` and frees every node that nothing refers to."""
        node.children -= 1
        while node.children == 0 and node.parent is not None:
            parent = node.parent
            parent.names -= id(node)
            parent.children -= 1
            del self.nodes[id(node)]
            node = parent

    def read(self, role: str, fault: str | None, row) -> Iterator[Node]:
        """Takes the next row and yields the edits that have become final."""
        found: dict[int, tuple[int, int, str, int]] = {}
        for begins, ends, cost, edits in _steps_of(role, fault):
            if begins in self.alive:
                total, rank, _ = self.alive[begins]
                way = (total + cost, rank, edits, begins)
                if ends not in found or way < found[ends]:
                    found[ends] = way
        kept = {
            x: way
            for x, way in found.items()
            if not any(y != x and other[0] + _IMITATION[y, x] < way[0] for y, other in found.items())
        }
        ranked = sorted(kept, key=lambda x: (kept[x][1], kept[x][2]))
        alive = {}
        for rank, ends in enumerate(ranked):
            total, _, edits, begins = kept[ends]
            parent = self.alive[begins][2]
            node = Node(parent, begins, ends, edits, row)
            self.nodes[id(node)] = node
            node.children = 1
            parent.children += 1
            parent.names += id(node)
            alive[ends] = (total, rank, node)
        before, self.alive = self.alive, alive
        for _, _, node in before.values():
            self._drop(node)
        leaves = {id(node) for _, _, node in alive.values()}
        while self.root.children == 1 and id(self.root) not in leaves:
            only = self.nodes[self.root.names]
            del self.nodes[id(self.root)]
            only.parent, self.root = None, only
            yield only

    def unresolved(self, state: int) -> Iterator[Node]:
        """The edits of the survivor in ``state`` that are not final yet, in order."""
        path, node = [], self.alive[state][2]
        while node is not self.root:
            path.append(node)
            node = node.parent
        yield from reversed(path)

    def best(self) -> int:
        """The state of the cheapest survivor at the end of the conversation."""
        return min(self.alive, key=lambda s: (self.alive[s][0] + INSERT * len(_ENDING[s]), self.alive[s][1], _ENDING[s]))


def _joined(summaries: list[dict]) -> dict[int, tuple[int, int | None, str | None]]:
    """For each part of one conversation: the states in which it begins and ends (None: at the end), and the initial before it."""
    alive = {START: (0, 0, ())}
    for part in summaries:
        found: dict[int, tuple] = {}
        for begins, (total, rank, path) in alive.items():
            for ends in range(STATES):
                cost, order = part["costs"][begins * STATES + ends], part["ranks"][begins * STATES + ends]
                if cost >= 0:
                    way = (total + cost, rank, order, (*path, begins))
                    if ends not in found or way[:3] < found[ends][:3]:
                        found[ends] = way
        ranked = sorted(found, key=lambda x: found[x][1:3])
        alive = {x: (found[x][0], rank, found[x][3]) for rank, x in enumerate(ranked)}
    last = min(alive, key=lambda s: (alive[s][0] + INSERT * len(_ENDING[s]), alive[s][1]))
    begins = alive[last][2]
    result, before = {}, None
    for i, part in enumerate(summaries):
        result[part["part"]] = (begins[i], begins[i + 1] if i + 1 < len(begins) else None, before)
        before = part["last_initial"]
    return result


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass one: for every part of a conversation the cost and the order of the ways from each state to each other."""
    names = ["conv_id", "part", "costs", "ranks", "last_initial"]
    key, tables, initial, key_type = None, {}, "", None

    def row() -> pa.RecordBatch:
        costs, ranks = [-1] * STATES**2, [-1] * STATES**2
        for begins, alive in tables.items():
            for ends, (cost, rank) in alive.items():
                costs[begins * STATES + ends], ranks[begins * STATES + ends] = cost, rank
        values = [pa.array([key[1]], key_type), pa.array([key[0]], pa.int32()), pa.array([costs], pa.list_(pa.int64()))]
        return pa.record_batch([*values, pa.array([ranks], pa.list_(pa.int64())), pa.array([initial])], names=names)

    for batch in batches:
        key_type = batch.schema.field("conv_id").type
        columns = [batch.column(n).to_pylist() for n in ("part", "conv_id", "role", "fault")]
        for part, conv, role, fault in zip(*columns, strict=True):
            if key != (part, conv):
                if key is not None:
                    yield row()
                key, tables = (part, conv), {s: {s: (0, 0)} for s in range(STATES)}
            for begins, alive in tables.items():
                found: dict[int, tuple] = {}
                for a, b, cost, edits in _steps_of(role, fault):
                    if a in alive:
                        way = (alive[a][0] + cost, alive[a][1], edits)
                        if b not in found or way < found[b]:
                            found[b] = way
                ranked = sorted(found, key=lambda x: found[x][1:])
                tables[begins] = {x: (found[x][0], rank) for rank, x in enumerate(ranked)}
            initial = role[:1]
    if key is not None:
        yield row()


@dataclass
class _Segment:
    part: int
    conv: object
    survivors: Survivors
    ends: int | None
    before: str | None
    place: int = 0


def _editor(borders: dict):
    """Pass two: the edits of every conversation, in order."""

    def edit_rows(node: Node, segment: _Segment) -> Iterator[tuple]:
        state = node.begins
        for edit in node.edits:
            if edit == "I":
                state = _INSERTED[state]
                yield inserted(state, segment)
                continue
            turn, role, text, fault, illegal = node.row
            cost = {"K": 0, "R": RELABEL, "D": DELETE}[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
            now = role if edit == "K" else None if edit == "D" else ASSISTANT if node.ends == ANSWERED else USER
            name = {"K": "Keep", "R": "Rerole", "D": "Delete"}[edit]
            yield (segment.conv, segment.part, segment.place, name, turn, role, now, text, fault, illegal, cost)
            segment.place += 1

    def inserted(state: int, segment: _Segment) -> tuple:
        role = USER if state == ASKED else ASSISTANT
        segment.place += 1
        return (segment.conv, segment.part, segment.place - 1, "Insert", None, None, role, "", None, False, INSERT)

    def finished(segment: _Segment) -> Iterator[tuple]:
        state = segment.survivors.best() if segment.ends is None else segment.ends
        for node in segment.survivors.unresolved(state):
            yield from edit_rows(node, segment)
        if segment.ends is None:
            for _ in _ENDING[state]:
                state = _INSERTED[state]
                yield inserted(state, segment)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment: _Segment | None = None
        for batch in batches:
            kinds = [batch.schema.field("conv_id").type, pa.int32(), pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 4, pa.bool_(), pa.int64()]
            out: list[tuple] = []
            columns = [batch.column(n).to_pylist() for n in ("part", "conv_id", "turn", "role", "text", "fault")]
            for part, conv, turn, role, text, fault in zip(*columns, strict=True):
                if segment is None or (segment.part, segment.conv) != (part, conv):
                    if segment is not None:
                        out.extend(finished(segment))
                    begins, ends, before = borders.get((part, conv), (START, None, None))
                    segment = _Segment(part, conv, Survivors(begins), ends, before)
                illegal = segment.before is not None and segment.before + role[:1] not in LEGAL_PAIRS
                segment.before = role[:1]
                for node in segment.survivors.read(role, fault, (turn, role, text, fault, illegal)):
                    out.extend(edit_rows(node, segment))
            yield batch_of(out, kinds)
        if segment is not None:
            yield batch_of(list(finished(segment)), kinds)

    def batch_of(rows: list[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
        names = ["conv_id", *[c.split()[0] for c in EDITS.split(", ")]]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return run


def _rows(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    named = lambda c: F.col(f"`{c}`")
    spaced = lambda c: F.coalesce(named(c).cast("string"), F.lit(" "))
    return conversations.select(
        named(conv_col).alias("conv_id"),
        named(turn_col).cast("long").alias("turn"),
        spaced(role_col).alias("role"),
        spaced(text_col).alias("text"),
    )


def marked(conversations: DataFrame, scratch: Scratch, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """All rows with the first ``fault`` of each (blank, duplicate, truncated or null), written in ``part``s by range of (conversation, turn)."""
    rows = _rows(conversations, conv_col, turn_col, role_col, text_col)
    whole = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    # Row ids tell equal rows apart; they are written, so both sides of the join below see the same ones.
    rows = scratch.save(
        rows.select("*", F.left("text", F.lit(SORTED_CHARS)).alias("head"), F.md5(whole).alias("digest"), F.monotonically_increasing_id().alias("row_id"))
    )
    when = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)), "row_id")
    seen = rows.groupBy("conv_id", "digest").agg(F.min(when).alias("first"), F.count("*").alias("n")).where("n > 1")
    seen = seen.select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first")
    bare = F.rtrim("text", F.lit(BLANKS))
    fault = (
        F.when(bare == "", "blank")
        .when(F.col("first") < when, "duplicate")
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    faults = rows.join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left").withColumn("fault", fault)
    dealt = faults.repartitionByRange(*_ORDER).withColumn("part", F.spark_partition_id())
    return scratch.save(dealt.select("part", *_ORDER, "text", "fault"))


def repair(conversations: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """One row for each edit: the conversation, its place (``part``, then ``place``), the edit, the row before and after it, and its cost.

    ``role`` is null for deleted rows; ``turn``, ``role_before`` and ``fault`` are null for inserted ones. ``illegal`` marks rows
    whose role may not follow that of the row before them. A conversation whose cheapest repair is empty has only deletions.
    """
    scratch = Scratch(conversations.sparkSession, "conversations")
    rows = marked(conversations, scratch, conv_col, turn_col, role_col, text_col)
    spread = F.max("part") > F.min("part")
    split = rows.groupBy("conv_id").agg(spread.alias("split")).where("split").select(F.col("conv_id").alias("c"))
    ordered = lambda df: df.repartition("part").sortWithinPartitions("part", *_ORDER)
    key = rows.schema["conv_id"].dataType.simpleString()
    # At most one conversation lies on each border between parts, so this is bounded by the number of parts.
    light = rows.select("part", *_ORDER, "fault").join(split, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")
    found = ordered(light).mapInArrow(_costs, f"conv_id {key}, part int, costs array<long>, ranks array<long>, last_initial string")
    by_conversation: dict = {}
    for row in found.toArrow().to_pylist():
        by_conversation.setdefault(row["conv_id"], []).append(row)
    borders = {}
    for conv, parts in by_conversation.items():
        for part, states in _joined(sorted(parts, key=lambda r: r["part"])).items():
            borders[part, conv] = states
    return ordered(rows).mapInArrow(_editor(borders), f"conv_id {key}, {EDITS}")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turn, role, text)`` with planted faults, by a checksum of conversation and turn."""
    id_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = _rows(conversations, "conv_id", "turn", "role", "text")
    kind = F.crc32(F.concat(id_of("conv_id"), F.lit(":"), id_of("turn")).cast("binary")) % 20
    rows = rows.withColumn("kind", kind).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, USER).otherwise(F.col("role"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("time")).drop("time")


_DIGEST = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation from its edits in order; a row without an edit only names the conversation."""
    none = object()
    conv, kinds = none, None

    def fresh() -> dict:
        counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        return counts | {"least": None, "last": None, "turns": 0, "audit": [], "sha": hashlib.sha256(), "rows": 0}

    def row(s: dict) -> tuple:
        gaps = s["last"] - s["least"] + 1 - s["turns"] if s["turns"] else 0
        counts = [s[n] for n in ("blank", "duplicate", "truncated", "illegal", "cost")]
        return (conv, gaps, *counts, "".join(s["audit"]), s["sha"].hexdigest())

    state = fresh()
    for batch in batches:
        kinds = [batch.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
        out = []
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "edit", "turn", "role", "text", "fault", "illegal", "cost")]
        for c, edit, turn, role, text, fault, illegal, cost in zip(*columns, strict=True):
            if c != conv:
                if conv is not none:
                    out.append(row(state))
                conv, state = c, fresh()
            if edit is None:
                continue
            state["audit"].append(edit[0])
            state["cost"] += cost
            state["illegal"] += illegal
            if fault is not None:
                state[fault] += 1
            if turn is not None and turn != state["last"]:  # turns come in order
                state["least"] = turn if state["least"] is None else state["least"]
                state["last"] = turn
                state["turns"] += 1
            if role is not None:
                state["sha"].update(b"\n" * (state["rows"] > 0) + f"{role}:{text}".encode())
                state["rows"] += 1
        if out:
            yield _columns(out, kinds)
    if conv is not none:
        yield _columns([row(state)], kinds)


def _columns(rows: list[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
    names = ["conv_id", *[c.split()[0] for c in _DIGEST.split(", ")]]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def digest(edits: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """Counts, cost, the initials of all edits and a checksum of the repaired rows, for every id in ``conv_ids``.

    A checksum over a whole conversation is one stream, so this runs through each conversation in one task, holding
    no more than its hash state and initials.
    """
    names = [f.name for f in edits.schema]
    named = conv_ids.select(F.col("conv_id"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in edits.schema if f.name != "conv_id"])
    rows = edits.select(*names).unionByName(named.distinct())
    key = edits.schema["conv_id"].dataType.simpleString()
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place").mapInArrow(_digests, f"conv_id {key}, {_DIGEST}")
