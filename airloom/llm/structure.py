"""Repair of conversation structure: the cheapest edits that make roles alternate, least audit.

A repaired conversation reads `(s?(ua)+)?` in role initials. A row is kept (K, 0), given the role
user or assistant (R, 3) or deleted (D, 4); empty turns are inserted (I, 3). Blank rows and
repeats must go, truncated ones cost 3 more if they stay.

1. Light rows (turn, role, hash of the text, faults, copies) are sorted by ranges of
   (conversation, turn) and cut into blocks of `BLOCK` rows, one byte for each. A conversation
   of any length is so spread over tasks; each block's costs from state to state are 16 numbers.
2. Only these matrices are brought together by conversation: from its last block backwards they
   give the costs that lie ahead of every block.
3. Cost DP: all blocks of a batch are run side by side from their last row. The arcs that keep
   the least cost form the graph of cheapest repairs. Its nodes (row, state) are ranked by
   their least audits of 1, 2, 4, ... letters, each rank from a pair of the round before
   (an ended audit ranks first); an arc is chosen by letter and its target's rank, and audits
   are read off the doubled pointers, for each state in which a block may begin.
4. Rows with texts meet the audits of their conversation, sorted; they are streamed, never
   gathered: per edit a row (`repair`) or per conversation its figures (`report`).

A SHA-256 over a whole conversation is sequential by definition, so `report` reads each in one
task, row by row; what it holds is the audit, which is part of its result.

Defined results: rows are ordered by turn (null first), role, then MD5 of the text; copies of a
row are neighbours; null role or text is one space; null ids form one conversation; roles other
than s…, u…, a… cannot be kept; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.functions.joins import join_null_safe
from airloom.llm.shared import stored

BLOCK = 4096
SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
FAR = 1 << 40
#: States: nothing yet, after s, after u, after a. `NEXT` is where a user's or assistant's turn leads.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = np.array([USER, USER, ASSISTANT, USER])
#: A row's byte: class of its role (s, u, a, other) and, times 4, its fault.
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
LETTERS = np.frombuffer(b" DIKR", np.uint8)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each byte and state: what keeping costs and where it leads, what a new role costs;
    for each byte: costs from state to state, insertions before the row included."""
    keep, goal = np.full((16, 4), FAR), np.zeros((16, 4), np.int64)
    rerole, step = np.full((16, 4), FAR), np.full((16, 4, 4), FAR)
    ahead = np.full((4, 4), FAR)
    for s in range(4):
        ahead[s, s] = 0
        at, cost = NEXT[s], INSERT
        while cost < ahead[s, at]:
            ahead[s, at] = cost
            at, cost = NEXT[at], cost + INSERT
    for byte in range(16):
        role, fault = byte & 3, byte >> 2
        edit = np.full((4, 4), FAR)
        for s in range(4):
            edit[s, s] = DELETE
            if fault in (SOUND, TRUNCATED):
                extra = CUT_OFF if fault == TRUNCATED else 0
                rerole[byte, s] = REROLE + extra
                edit[s, NEXT[s]] = min(edit[s, NEXT[s]], REROLE + extra)
                to = {0: SYSTEM if s == START else None, 1: USER if s != USER else None, 2: ASSISTANT if s == USER else None}.get(role)
                if to is not None:
                    keep[byte, s], goal[byte, s] = extra, to
                    edit[s, to] = min(edit[s, to], extra)
        step[byte] = (ahead[:, :, None] + edit[None, :, :]).min(1)
    return keep, goal, rerole, step


KEEP, GOAL, REROLES, STEP = _tables()
#: What it costs to end well from each state.
AT_END = np.array([0, 2 * INSERT, INSERT, 0])


def _rounds(size: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places from the last to the first, with the blocks that reach so far."""
    order = np.argsort(-size, kind="stable")
    falling = -size[order]
    for t in range(int(size.max(initial=0)) - 1, -1, -1):
        yield t, order[: np.searchsorted(falling, -t)]


def matrices(codes: np.ndarray, base: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Costs from state to state over each block of row bytes."""
    made = np.tile(np.where(np.eye(4, dtype=bool), 0, FAR), (len(size), 1, 1))
    for t, here in _rounds(size):
        made[here] = np.minimum((STEP[codes[base[here] + t]][:, :, :, None] + made[here][:, None]).min(2), FAR)
    return made


def audits(codes: np.ndarray, base: np.ndarray, size: np.ndarray, end: np.ndarray, final: np.ndarray, first: np.ndarray):
    """For each wanted (block, start state): cost ahead, audit (bytes), state at the end.

    `end` holds the costs ahead of each block's end, `final` and `first` whether a block is
    its conversation's last and first (a first one begins in START only).
    """
    # nodes: place 0 .. size of each block, times 4 states
    origin = base + np.arange(len(size))
    n = int(size.sum()) + len(size)
    cost = np.zeros((n, 4), np.int64)
    cost[origin + size] = end
    for t, here in _rounds(size):
        at = origin[here] + t
        cost[at] = np.minimum((STEP[codes[base[here] + t]] + cost[at + 1][:, None, :]).min(2), FAR)
    ends = np.zeros(n, bool)
    ends[origin + size] = True
    stop = np.zeros(n, bool)
    stop[(origin + size)[~final]] = True
    byte = np.zeros(n, np.int64)
    byte[~ends] = codes
    node = np.arange(4 * n)
    state, flat = np.tile(np.arange(4), n), cost.reshape(-1)
    row = np.repeat(byte, 4)
    inner, may_insert = np.repeat(~ends, 4), np.repeat(~stop, 4)
    below = np.where(inner, node + 4, node)  # the same state a row further
    next_state = NEXT[state]
    arcs = [  # letter 1 D, 2 I, 3 K, 4 R: target, cost, allowed
        (below, DELETE, inner),
        (node - state + next_state, INSERT, may_insert),
        (below - state + GOAL[row, state], KEEP[row, state], inner),
        (below - state + next_state, REROLES[row, state], inner),
    ]
    best = [allowed & (flat < FAR) & (price + flat[to] == flat) for to, price, allowed in arcs]
    letter, hop = np.zeros(4 * n, np.int64), node.copy()
    for i in (3, 2, 1, 0):
        letter[best[i]], hop[best[i]] = i + 1, arcs[i][0][best[i]]
    # ranks of the audits' first 1, 2, 4, ... letters, places they lead to, letters up to the end
    rank, length, jumps = letter, (letter > 0).astype(np.int64), [hop]
    while True:
        to = jumps[-1]
        rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + rank[to], return_inverse=True)[1]
        length = length + length[to]
        further = to[to]
        if np.array_equal(further, to):
            break
        jumps.append(further)
    # the letters of a node's arcs differ, so this settles on the arcs that were ranked
    wide = int(rank.max(initial=0)) + 1
    ways = np.stack([np.where(ok, (i + 1) * wide + rank[to], 5 * wide) for i, (ok, (to, _, _)) in enumerate(zip(best, arcs))])
    pick = ways.argmin(0)
    chosen = np.where(ways.min(0) < 5 * wide, np.choose(pick, [a[0] for a in arcs]), node)
    jumps = [chosen]
    while not np.array_equal(further := jumps[-1][jumps[-1]], jumps[-1]):
        jumps.append(further)
    block = np.repeat(np.arange(len(size)), np.where(first, 1, 4))
    begin = np.arange(len(block)) - np.searchsorted(block, block)  # the start state
    source = 4 * origin[block] + begin
    count = length[source]
    walk = np.repeat(source, count)
    place = np.arange(len(walk)) - np.repeat(np.cumsum(count) - count, count)
    for k, jump in enumerate(jumps):
        walk = np.where(place >> k & 1 == 1, jump[walk], walk)
    text = LETTERS[letter[walk]].tobytes()
    stops = np.cumsum(count)
    made = [text[b - c : b] for b, c in zip(stops.tolist(), count.tolist())]
    return block, flat[source], made, jumps[-1][source] % 4


def faulty(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, h, code, again, n: distinct rows with their bytes and copies.

    `code` is the byte of the first copy, `again` that of the others.
    """
    bare = F.rtrim("text", F.lit(SPACES))
    blank = F.max(bare == "")
    cut_off = F.max(~F.substring(bare, -1, 1).isin(".", "!", "?"))
    light = rows.groupBy("conv_id", "turn", "role", F.md5("text").alias("h")).agg(
        F.sum("n").alias("n"), blank.alias("blank"), cut_off.alias("cut_off")
    )
    light = stored(light)
    said = light.groupBy("conv_id", "role", "h").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("times"))
    more = said.filter("times > 1").select("conv_id", "role", "h", "first")
    found = join_null_safe(light, more, ["conv_id", "role", "h"], "left")
    repeat = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    fault = F.when(F.col("blank"), BLANK).when(repeat, DUPLICATE).when(F.col("cut_off"), TRUNCATED).otherwise(SOUND)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    again = F.when(F.col("blank"), BLANK).otherwise(DUPLICATE)
    return found.select(
        "conv_id", "turn", "role", "h", "n", (kind + 4 * fault).cast("int").alias("code"), (kind + 4 * again).cast("int").alias("again")
    )


def cut_blocks(light: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, part, number, codes, costs: blocks in the order of (part, number)."""
    kind = light.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        done: list[tuple] = []
        held, owner, begun, key_type = bytearray(), None, False, None

        def batch_of() -> pa.RecordBatch:
            size = np.array([len(d[2]) for d in done])
            codes = np.frombuffer(b"".join(d[2] for d in done), np.uint8)
            costs = matrices(codes, np.cumsum(size) - size, size).reshape(-1, 16)
            columns = [pa.array([d[0] for d in done], key_type), pa.array([part] * len(done), pa.int32())]
            columns += [pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.binary())]
            columns += [pa.array(costs.tolist(), pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "number", "codes", "costs"])

        for batch in batches:
            key_type = batch.schema.field(0).type
            for conv, n, code, again in zip(*(c.to_pylist() for c in batch.columns)):
                if begun and conv != owner and held:
                    done.append((owner, number, bytes(held)))
                    number, held = number + 1, bytearray()
                owner, begun, left = conv, True, n
                while left:
                    take = min(left, block - len(held))
                    held += (bytes([code]) if left == n else bytes([again])) + bytes([again]) * (take - 1)
                    left -= take
                    if len(held) == block:
                        done.append((owner, number, bytes(held)))
                        number, held = number + 1, bytearray()
                if len(done) > 20_000 or len(done) * block > 1 << 25 and sum(len(d[2]) for d in done) > 200_000:
                    yield batch_of()
                    done.clear()
        if held:
            done.append((owner, number, bytes(held)))
        if done:
            yield batch_of()

    order = ["conv_id", "turn", "role", "h"]
    placed = light.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "n", "code", "again")
    return placed.mapInArrow(run, f"conv_id {kind}, part int, number long, codes binary, costs array<long>")


def costs_ahead(blocks: DataFrame) -> DataFrame:
    """part, number, first, end: for blocks of conversations that have several.

    `end` are the costs ahead of a block's end, null for a last one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, begun, vector, kept = None, False, AT_END, None  # kept: the block last read

        for batch in batches:
            out = []
            for conv, part, number, costs in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or conv != before:
                    if kept is not None and kept[3] is not None:
                        out.append((kept[0], kept[1], True, kept[3]))
                    vector, end = AT_END, None
                else:
                    out.append((kept[0], kept[1], False, kept[3]))
                    end = vector.tolist()
                before, begun, kept = conv, True, (part, number, None, end)
                vector = np.minimum((np.array(costs).reshape(4, 4) + vector).min(1), FAR)
            if out:
                yield batch_of(out)
        if kept is not None and kept[3] is not None:
            yield batch_of([(kept[0], kept[1], True, kept[3])])

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        types = [pa.int32(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["part", "number", "first", "end"])

    by = ["conv_id", F.col("part").desc(), F.col("number").desc()]
    placed = blocks.select("conv_id", "part", "number", "costs").repartition("conv_id").sortWithinPartitions(*by)
    return placed.mapInArrow(run, "part int, number long, first boolean, end array<long>")


def audited(blocks: DataFrame) -> DataFrame:
    """conv_id, part, number, codes, cost, audits, ends: lists by start state (one if first)."""
    kind = blocks.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "part", "number", "codes", "cost", "audits", "ends"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum([len(x) for x in batch.column("codes").to_pylist()])
            start = 0
            while start < len(sizes):
                # about 100,000 rows at a time
                stop = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + 100_000)))
                part = batch.slice(start, stop - start)
                start = stop
                codes = part.column("codes").to_pylist()
                size = np.array([len(c) for c in codes])
                ends, firsts = part.column("end").to_pylist(), part.column("first").to_pylist()
                first = np.array([f is not False for f in firsts])
                final = np.array([e is None for e in ends])
                end = np.array([AT_END if e is None else e for e in ends])
                flat = np.frombuffer(b"".join(codes), np.uint8).astype(np.int64)
                block, cost, made, last = audits(flat, np.cumsum(size) - size, size, end, final, first)
                cuts = pa.array(np.append(np.searchsorted(block, np.arange(len(size))), len(block)).astype(np.int32))
                columns = [part.column(n) for n in names[:4]] + [
                    pa.ListArray.from_arrays(cuts, pa.array(cost)),
                    pa.ListArray.from_arrays(cuts, pa.array(made, pa.binary())),
                    pa.ListArray.from_arrays(cuts, pa.array(last.astype(np.int32))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    found = blocks.join(costs_ahead(blocks), ["part", "number"], "left").select("conv_id", "part", "number", "codes", "first", "end")
    schema = f"conv_id {kind}, part int, number long, codes binary, cost array<long>, audits array<binary>, ends array<int>"
    return found.mapInArrow(run, schema)


def typed(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text, n (copies of the row): what the repair works on."""
    return turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        F.lit(1).cast("long").alias("n"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Typed rows with seeded faults; a dropped row stays with no copies, for its conversation's sake."""
    named: list[Column] = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    h = F.crc32(F.concat(named[0], F.lit(":"), named[1])) % 20
    return rows.select(
        "conv_id",
        "turn",
        F.when(h == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(h == 1, F.lit("")).when(h == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.when(h == 0, 0).when(h == 3, 2).otherwise(1) * F.col("n")).cast("long").alias("n"),
    )


class Conversation:
    """Edits of one conversation, read row by row."""

    def __init__(self, conv):
        self.conv, self.state, self.audit, self.codes, self.cost = conv, START, b"", b"", 0
        self.parts: list[bytes] = []
        self.bytes: list[bytes] = []
        self.row = self.at = 0
        self.turns: list[int] | None = None  # least, largest, distinct

    def block(self, codes: bytes, cost: list[int], audits: list[bytes], ends: list[int]) -> None:
        if not self.parts:
            self.cost = cost[0]
        self.parts.append(audits[self.state])
        self.bytes.append(codes)
        self.state = ends[self.state]

    def begin(self) -> None:
        self.audit, self.codes, self.state = b"".join(self.parts), b"".join(self.bytes), START
        self.parts, self.bytes = [], []

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == b"I":
            self.at, self.state = self.at + 1, int(NEXT[self.state])
            yield "I", None, "user" if self.state == USER else "assistant", ""

    def edits(self, turn: int | None, role: str, text: str) -> Iterator[tuple]:
        """(edit, turn, role, text) up to and including this row's; a deleted one has its own role."""
        yield from self.inserted()
        edit = chr(self.audit[self.at])
        byte = self.codes[self.row]
        self.at, self.row = self.at + 1, self.row + 1
        if edit == "K":
            self.state = int(GOAL[byte, self.state])
        elif edit == "R":
            self.state = int(NEXT[self.state])
            role = "user" if self.state == USER else "assistant"
        if turn is not None:
            if self.turns is None:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns = [self.turns[0], turn, self.turns[2] + 1]
        yield edit, turn, role, text

    def figures(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit."""
        codes = np.frombuffer(self.codes, np.uint8)
        faults, roles = np.bincount(codes >> 2, minlength=4), codes & 3
        pairs = roles[:-1] * 4 + roles[1:]
        legal = np.isin(pairs, [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1])
        low, high, distinct = self.turns or (0, -1, 0)
        return (
            high - low + 1 - distinct, int(faults[BLANK]), int(faults[DUPLICATE]), int(faults[TRUNCATED]),
            int(len(pairs) - legal.sum()), self.cost, self.audit.decode(),
        )


def _met(rows: DataFrame, block: int) -> DataFrame:
    """Rows of typed turns after the blocks of their conversation, sorted within each task."""
    blocks = stored(cut_blocks(faulty(rows.filter("n > 0")), block))
    found = audited(blocks)
    said = rows.withColumn("h", F.md5("text"))
    both = found.withColumn("said", F.lit(0)).unionByName(said.withColumn("said", F.lit(1)), allowMissingColumns=True)
    by = ["conv_id", "said", "part", "number", "turn", "role", "h"]
    return both.repartition("conv_id").sortWithinPartitions(*by).select(
        "conv_id", "said", "codes", "cost", "audits", "ends", "turn", "role", "text", "n"
    )


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Conversation, tuple | None]]:
    """Each edit with its conversation; at a conversation's end, None."""
    now = None
    for batch in batches:
        for conv, said, codes, cost, audits, ends, turn, role, text, n in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or conv != now.conv:
                if now is not None:
                    yield from ((now, e) for e in now.inserted())
                    yield now, None
                now, begun = Conversation(conv), False
            if not said:
                now.block(codes, cost, audits, ends)
                continue
            if not begun:
                now.begin()
                begun = True
            for _ in range(n):
                yield from ((now, e) for e in now.edits(turn, role, text))
    if now is not None:
        yield from ((now, e) for e in now.inserted())
        yield now, None


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every edit of typed rows: conv_id, pos (from 1), edit, turn, role, text; deleted rows too."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        types = [first.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
        names = ["conv_id", "pos", "edit", "turn", "role", "text"]
        out, size = [], 0
        for now, edit in _conversations(chain([first], batches)):
            if edit is not None:
                out.append((now.conv, now.at, *edit))
                size += len(edit[3])
            if size > 8_000_000 or len(out) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return _met(rows, block).mapInArrow(run, f"conv_id {kind}, pos long, edit string, turn long, role string, text string")


def report(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per conversation of typed rows: gaps, faults, cost, audit and digest of the repaired turns."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        types = [first.schema.field(0).type, *[pa.int64()] * 6, pa.string(), pa.string()]
        out, digest, begun = [], hashlib.sha256(), False
        for now, edit in _conversations(chain([first], batches)):
            if edit is None:
                out.append((now.conv, *now.figures(), digest.hexdigest()))
                digest, begun = hashlib.sha256(), False
                if len(out) >= 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out = []
            elif edit[0] != "D":
                digest.update(f"{chr(10) if begun else ''}{edit[2]}:{edit[3]}".encode())
                begun = True
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    numbers = ", ".join(f"{n} long" for n in names[1:7])
    return _met(rows, block).mapInArrow(run, f"conv_id {kind}, {numbers}, audit string, repaired_sha256 string")


def _sql() -> str:
    """The DP forwards, with audits and repaired texts carried as strings: {c, a, t} by state."""

    def go(x: str, cost: str, letter: str, said: str | None = None) -> str:
        text = f"{x}.t || chr(10) || {said}" if said else f"{x}.t"
        return f"{{'c': {x}.c + {cost}, 'a': {x}.a || '{letter}', 't': {text}}}"

    def to(role: str, *sources: str) -> str:
        """Rerole, or keep where the row already has that initial; rows that must go do neither."""
        made = [
            f"CASE WHEN must THEN gone WHEN initial = '{role[0]}' THEN {go(x, 'extra', 'K', 'said')} "
            f"ELSE {go(x, '3 + extra', 'R', f"'{role}:' || text")} END"
            for x in sources
        ]
        return ", ".join(made)

    user, assistant = "'user:'", "'assistant:'"
    ahead = f"least(u, {go('o', '3', 'I', user)}, {go('s', '3', 'I', user)}, {go('a', '3', 'I', user)})"
    none, begin = "{'c': 1000000000::BIGINT, 'a': '', 't': ''}", "{'c': 0::BIGINT, 'a': '', 't': ''}"
    return rf"""
WITH RECURSIVE tab(i, v, k) AS (
  SELECT i::UBIGINT, i::UBIGINT, 0 FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END, k + 1 FROM tab WHERE k < 8
), crc AS (SELECT list(v ORDER BY i) AS t FROM tab WHERE k = 8),
turns AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(range(1, length(k) + 1), lambda j: ascii(substr(k, j, 1))::UBIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1]))) % 20 AS h
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations), crc
), hurt AS (
  SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM turns, range(CASE WHEN h = 3 THEN 2 ELSE 1 END) WHERE h <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos,
    count(*) OVER (PARTITION BY conv_id) AS n, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM hurt
), judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS previous FROM placed
), rows AS (
  SELECT *, fault IN ('blank', 'duplicate') AS must, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra,
    role || ':' || text AS said, {none} AS gone FROM judged
), dp(conv_id, pos, o, s, u, a) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, {begin}, {none}, {none}, {none} FROM rows
  UNION ALL
  SELECT conv_id, pos, {go('o', '4', 'D')},
    least({go('s', '4', 'D')}, CASE WHEN initial = 's' AND NOT must THEN {go('o', 'extra', 'K', 'said')} ELSE gone END),
    least({go('u', '4', 'D')}, {to('user', 'o', 's', 'a')}), least({go('a', '4', 'D')}, {to('assistant', 'u')})
  FROM (
    SELECT * EXCLUDE (a), least(a, {go('u', '3', 'I', assistant)}) AS a FROM (
      SELECT rows.*, o, s, a, {ahead} AS u FROM dp JOIN rows ON rows.conv_id IS NOT DISTINCT FROM dp.conv_id AND rows.pos = dp.pos + 1
    )
  )
), ended AS (
  SELECT conv_id, least(o, a, {go('(' + ahead + ')', '3', 'I', assistant)}) AS best
  FROM dp WHERE (conv_id, pos) IN (SELECT (conv_id, max(pos)) FROM dp GROUP BY conv_id)
), figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pos > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations)
LEFT JOIN figures USING (conv_id) LEFT JOIN ended USING (conv_id)
"""


ORACLE = _sql()
