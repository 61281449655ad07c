"""Operator 13: repair of the turn structure of conversations by a survivor-coalescence Viterbi.

A conversation is sound if the initials of its roles read ``(s?(ua)+)?`` and no turn is blank,
repeated or cut short. Each turn is kept (0), given the role user or assistant (2) or deleted (3,
the only choice for blank and repeated turns); empty turns may be inserted (2); a truncated turn
that stays costs 1 more. The repair is the cheapest sequence of edits, among equal costs the one
whose initials (D, I, K, R) come first in ASCII order.

Spark deals conversations out and sorts each by turn; a task then streams through its turns, so
a conversation is never held as a whole. Four states survive after each turn (nothing yet, after
a system, a user, an assistant turn). Their histories are paths of one tree of back-pointers with
reference counts: a branch without references is freed, a node with one child is joined to it, and
as soon as all survivors share their first edits, these are emitted and forgotten. Equal costs are
told apart at the fork of the two unresolved histories, of which nothing is cut off. A survivor
goes once another one, whatever follows, ends cheaper.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
HOLD = 4 << 20  # bytes of unresolved turns that are held in memory, twice at most
START, SYSTEM, USER, ASSISTANT = range(4)
# Where a turn with this initial leads from each state; a state without an entry forbids it.
NEXT = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
#: The only turn of a user or an assistant that may follow a state, and where it leads.
GIVEN = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
# AHEAD[p][q]: p can follow any future of q at this extra cost at most. A missing system turn is
# deleted (3), a user or assistant turn that the future of q does not need is inserted (2).
AHEAD = {
    START: {SYSTEM: 0, USER: 2, ASSISTANT: 0},
    SYSTEM: {START: 7, USER: 2, ASSISTANT: 4},
    USER: {START: 5, SYSTEM: 2, ASSISTANT: 2},
    ASSISTANT: {START: 3, SYSTEM: 0, USER: 2},
}
BLANK = "[\\x20\\x09-\\x0D]"
SPACE = " \t\n\x0b\f\r"


class Node:
    """Edits since the parent. ``refs`` counts the children and the survivor that end here."""

    __slots__ = ("parent", "edits", "kids", "refs", "depth")

    def __init__(self, parent: "Node | None", edit: bytes):
        self.parent, self.edits, self.kids, self.refs = parent, bytearray(edit), {}, 0
        self.depth = parent.depth + 1 if parent else 0
        if parent:
            parent.kids[edit[0]] = self
            parent.refs += 1


def _free(node: Node) -> None:
    """Give back nodes that nothing refers to; join a node with the only child that is left."""
    while not node.refs and node.parent:
        parent = node.parent
        del parent.kids[node.edits[0]]
        parent.refs -= 1
        node = parent
    if node.parent and node.refs == 1 and node.kids:
        (kid,) = node.kids.values()
        kid.parent, kid.depth = node.parent, node.depth
        node.edits += kid.edits
        kid.edits = node.edits
        node.parent.kids[node.edits[0]] = kid


def _before(a: Node, b: Node) -> bool:
    """Whether the history that ends in ``a`` comes before that which ends in ``b``."""
    if a is b:
        return False
    up, over = a, b
    last = {id(a): None}
    while up.parent:
        last[id(up.parent)] = up
        up = up.parent
    below = None
    while id(over) not in last:
        below, over = over, over.parent
    mine = last[id(over)]
    if mine is None or below is None:  # one is the beginning of the other
        return mine is None
    return mine.edits[0] < below.edits[0]


class Survivors:
    """The forward pass over one conversation; ``emit`` gets edits as soon as they are certain."""

    def __init__(self, emit: Callable[[bytes], None]):
        self.emit, self.root = emit, Node(None, b"")
        self.best: dict[int, tuple[int, Node]] = {}
        self._settle([(START, 0, self.root, b"")])

    def _settle(self, arcs: list[tuple[int, int, Node, bytes]]) -> None:
        """Survivors from (state, cost, history, edit), then inserts, pruning and emission."""
        old = [node for _, node in self.best.values()]
        chosen: dict[int, tuple[int, Node, bytes]] = {}
        for state, cost, node, edit in arcs:
            held = chosen.get(state)
            if held is None or cost < held[0] or cost == held[0] and self._earlier(node, edit, held[1], held[2]):
                chosen[state] = (cost, node, edit)
        fresh = {}
        for state, (cost, node, edit) in chosen.items():
            fresh[state] = (cost, Node(node, edit) if edit else node)
        for _, node in fresh.values():
            node.refs += 1
        for node in old:
            node.refs -= 1
        moved = True
        while moved:
            moved = False
            for state in list(fresh):
                cost, node = fresh[state]
                after = GIVEN[state][1]
                held = fresh.get(after)
                if held and (held[0] < cost + INSERT or held[1].parent is node and held[1].edits == b"I"):
                    continue
                if held is None or held[0] > cost + INSERT or self._earlier(node, b"I", held[1], b""):
                    fresh[after] = (cost + INSERT, Node(node, b"I"))
                    fresh[after][1].refs += 1
                    if held:
                        held[1].refs -= 1
                        old.append(held[1])
                    moved = True
        for state in list(fresh):
            if any(p != state and p in fresh and fresh[p][0] + AHEAD[p][state] < fresh[state][0] for p in AHEAD):
                node = fresh.pop(state)[1]
                node.refs -= 1
                old.append(node)
        for node in old:
            _free(node)
        for _, node in fresh.values():
            if node.parent:
                _free(node.parent)
        self.best = fresh
        self._coalesce()

    @staticmethod
    def _earlier(a: Node, edit_a: bytes, b: Node, edit_b: bytes) -> bool:
        if a is b:
            return edit_a < edit_b
        # A history that goes on below the other one's end is told apart by its first edit there.
        for x, y, edit, sign in ((a, b, edit_a, True), (b, a, edit_b, False)):
            up = y
            while up.parent is not None and up.parent is not x:
                up = up.parent
            if up.parent is x:
                return (edit < bytes(up.edits[:1])) == sign
        return _before(a, b)

    def _coalesce(self) -> None:
        ends = {id(node) for _, node in self.best.values()}
        while id(self.root) not in ends and len(self.root.kids) == 1:
            (kid,) = self.root.kids.values()
            self.emit(bytes(kid.edits))
            kid.edits, kid.parent, kid.depth = bytearray(), None, 0
            self.root = kid

    def turn(self, initial: str, truncated: bool, must_go: bool) -> None:
        arcs = []
        for state, (cost, node) in self.best.items():
            arcs.append((state, cost + DELETE, node, b"D"))
            if not must_go:
                stays = cost + TRUNCATED * truncated
                arcs.append((GIVEN[state][1], stays + REROLE, node, b"R"))
                if state in NEXT.get(initial, {}):
                    arcs.append((NEXT[initial][state], stays, node, b"K"))
        self._settle(arcs)

    def end(self) -> int:
        """Emit the rest; the cost of the repair."""
        cost, node = None, None
        for state in (START, ASSISTANT):
            if state in self.best:
                c, n = self.best[state]
                if cost is None or c < cost or c == cost and self._earlier(n, b"", node, b""):
                    cost, node = c, n
        parts = []
        while node.parent:
            parts.append(bytes(node.edits))
            node = node.parent
        self.emit(b"".join(reversed(parts)))
        return cost

    def nodes(self) -> int:
        """Nodes held now, for tests of the bound on memory."""
        found, todo = 0, [self.root]
        while todo:
            found, node = found + 1, todo.pop()
            todo += node.kids.values()
        return found


class Waiting:
    """Turns whose edit is not certain yet, first in, first out. Two blocks of about ``HOLD`` bytes
    are in memory at most; others wait in a file without a name, which goes with the object."""

    def __init__(self):
        self.front: deque = deque()
        self.blocks: deque[tuple[int, int]] = deque()
        self.back, self.size, self.file = [], 0, None

    def push(self, turn: tuple[str, str] | None) -> None:
        self.back.append(turn)
        self.size += 50 if turn is None else 100 + len(turn[0]) + len(turn[1])
        if self.size >= HOLD:
            self.file = self.file or tempfile.TemporaryFile()
            data = pickle.dumps(self.back)
            self.blocks.append((self.file.seek(0, 2), len(data)))
            self.file.write(data)
            self.back, self.size = [], 0

    def pop(self) -> tuple[str, str] | None:
        if not self.front:
            if self.blocks:
                at, length = self.blocks.popleft()
                self.file.seek(at)
                self.front = deque(pickle.loads(self.file.read(length)))
            else:
                self.front, self.back, self.size = deque(self.back), [], 0
        return self.front.popleft()


class Repair:
    """Edits of one conversation applied to its turns, which wait only until they are resolved."""

    def __init__(self, put: Callable[[str, str, str], None] | None = None):
        self.audit, self.hash, self.state, self.put = bytearray(), hashlib.sha256(), START, put
        self.waiting = Waiting()
        self.first = True
        self.survivors = Survivors(self._apply)

    def add(self, role: str, text: str, truncated: bool, must_go: bool) -> None:
        self.waiting.push(None if must_go else (role, text))
        self.survivors.turn(role[:1], truncated, must_go)

    def _apply(self, edits: bytes) -> None:
        self.audit += edits
        for edit in edits:
            turn = None if edit == 73 else self.waiting.pop()  # I takes no turn
            if edit == 68:  # D
                continue
            if edit == 75:  # K
                role, text = turn
                self.state = NEXT[role[:1]][self.state]
            else:
                role, self.state = GIVEN[self.state]
                text = turn[1] if turn else ""
            line = f"{role}:{text}".encode("utf-8", "surrogatepass")
            self.hash.update(line if self.first else b"\n" + line)
            self.first = False
            if self.put:
                self.put(chr(edit), role, text)


class Report:
    """All figures of one conversation, turn by turn."""

    def __init__(self, put=None):
        self.repair = Repair(put)
        self.turns: list[int] = []
        self.n_turns, self.low, self.high = 0, None, None
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.before: str | None = None

    def add(self, turn, role, text, blank, repeated, truncated) -> None:
        if turn is not None:  # turns come in order
            self.n_turns += self.high is None or turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        fault = "blank" if blank else "duplicate" if repeated else "truncated" if truncated else None
        if fault:
            self.counts[fault] += 1
        if self.before is not None:
            self.counts["illegal"] += self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        self.repair.add(role, text, fault == "truncated", fault in ("blank", "duplicate"))

    def row(self) -> tuple:
        cost = self.repair.survivors.end()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.n_turns
        return (gaps, *self.counts.values(), cost, self.repair.audit.decode(), self.repair.hash.hexdigest())


def prepared(conversations: DataFrame, damaged: bool = False) -> DataFrame:
    """Turns with their faults, dealt out by conversation: conv_id, turn, role, text, there, blank,
    repeated, truncated. Turns that the damage drops stay as rows with ``there`` false."""
    key = F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(F.concat(F.col("conv_id").cast("string"), F.lit(":"), key).cast("binary")) % 20 if damaged
         else F.lit(5)).cast("int").alias("harm"))
    copy = F.explode(F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm").isin(0, 1), "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("harm") != 0).alias("there"), copy.alias("copy"),
    ).repartition("conv_id")
    seen = Window.partitionBy("conv_id", "role", "text", "there").orderBy(F.col("turn").asc_nulls_first(), "copy")
    bare = F.rtrim("text", F.lit(SPACE))
    return rows.select(
        "conv_id", "turn", "role", "text", "there",
        (F.length(F.ltrim("text", F.lit(SPACE))) == 0).alias("blank"),
        (F.row_number().over(seen) > 1).alias("repeated"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"),
    ).sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")
_REPORT_TYPE = pa.schema([(c, pa.int64()) for c in (
    "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [
        ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, here, report = [], None, None
    for conv, turn, role, text, there, *faults in _turns(batches):
        if conv != here:
            if report:
                out.append((here, *report.row()))
            here, report = conv, Report()
            if len(out) >= 2000:
                yield _batch(out, _REPORT_TYPE)
                out = []
        if there:
            report.add(turn, role, text, *faults)
    if report:
        out.append((here, *report.row()))
    yield _batch(out, _REPORT_TYPE)


def repair_report(conversations: DataFrame, damaged: bool = False) -> DataFrame:
    """One row per conversation: faults, cost, edits and the digest of its repaired turns.

    Columns conv_id, turn, role and text are read, others ignored. A null role or text counts as
    one space; null turns come first, turns with one number by role, then text. Rows without a
    conv_id belong to no conversation and are left out; an empty table gives no rows. ``damaged``
    spoils the turns first by a checksum of conversation and turn, which makes faults for a test;
    a conversation that loses all turns has zeros, no edits and the digest of nothing.
    """
    return prepared(conversations, damaged).mapInArrow(_report, REPORT)


_TURN_TYPE = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()),
                        ("role", pa.string()), ("text", pa.string())])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, here, report = [], None, None

    def put(edit: str, role: str, text: str) -> None:
        out.append((here, place[0], edit, role, text))
        place[0] += 1

    place = [0]
    for conv, turn, role, text, there, *faults in _turns(batches):
        if conv != here:
            if report:
                report.row()
            here, report, place[0] = conv, Report(put), 0
        if len(out) >= 2000:
            yield _batch(out, _TURN_TYPE)
            out.clear()
        if there:
            report.add(turn, role, text, *faults)
    if report:
        report.row()
    yield _batch(out, _TURN_TYPE)


def repaired_turns(conversations: DataFrame, damaged: bool = False) -> DataFrame:
    """The turns of the repaired conversations in order of ``place``, with the edit that each comes
    from (K, R or I). Rows are read as in :func:`repair_report`."""
    return prepared(conversations, damaged).mapInArrow(
        _repaired, "conv_id long, place long, edit string, role string, text string")
