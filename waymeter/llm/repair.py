"""Repair of a conversation's structure by bidirectional Dijkstra over its edit lattice.

A node is a number of rows read and a state of the role pattern `(s?(ua)+)?`; keeping, reroling, deleting and
inserting are its edges. One heap goes forward from the first row, one back from the last. Each settles a node with
its least cost and, of all ways of that cost, the least audit. Where an edge joins the two sides the ways are
concatenated; the search ends when no cheaper and no equal crossing is left, and the least audit wins. Audits of one
cost at one node read the same rows, so none begins another and the least part always makes the least whole.

Rows are sorted by ranges of (conversation, turn), so one huge conversation is dealt to many tasks as well. A
conversation inside one task and one segment is repaired there. Of any other, each segment is searched for every pair
of states at its ends, the segments are joined in order, and the repaired rows go through the digest one segment at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeter.llm.shared import slices, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows and characters of a segment at most (one row may be longer); repeated rows that are joined by broadcast at most.
ROWS, CHARACTERS, BROADCAST = 512, 4 << 20, 100_000
#: A row is its role's first letter, none where the pattern has no such letter, and what is wrong with it.
OTHER, SYSTEM, USER, ASSISTANT = range(4)
MUST_GO, CUT_OFF, GONE = 4, 8, 16
#: after[state][letter]; states: nothing yet, s, u last, a last.
AFTER = ((None, 1, 2, None), (None, None, 2, None), (None, None, None, 3), (None, None, 2, None))
BEFORE = tuple(tuple((q, k) for q in range(4) for k in range(4) if AFTER[q][k] == state) for state in range(4))
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
ENDS = (0, 3)
SPACE = r"[^\x20\x09-\x0D]"


def _row_edges(code: int, kind: int) -> Iterator[tuple[int, str]]:
    """Cost and initial of the edits that make the row a row of the letter `kind`."""
    if code & MUST_GO:
        return
    extra = TRUNCATED if code & CUT_OFF else 0
    if code & 3 == kind != OTHER:
        yield KEEP + extra, "K"
    elif kind in (USER, ASSISTANT):
        yield REROLE + extra, "R"


def _forward(codes: bytes, node: tuple[int, int]) -> Iterator[tuple[int, str, tuple[int, int]]]:
    i, q = node
    for kind, to in enumerate(AFTER[q]):
        if to is None:
            continue
        if kind != SYSTEM:
            yield INSERT, "I", (i, to)
        if i < len(codes):
            for cost, letter in _row_edges(codes[i], kind):
                yield cost, letter, (i + 1, to)
    if i < len(codes):
        yield DELETE, "D", (i + 1, q)


def _backward(codes: bytes, node: tuple[int, int]) -> Iterator[tuple[int, str, tuple[int, int]]]:
    i, q = node
    for state, kind in BEFORE[q]:
        if kind != SYSTEM:
            yield INSERT, "I", (i, state)
        if i:
            for cost, letter in _row_edges(codes[i - 1], kind):
                yield cost, letter, (i - 1, state)
    if i:
        yield DELETE, "D", (i - 1, q)


class _Side:
    """One direction's heap and settled nodes. Free edges lead away from the side's start, so among nodes of one cost
    those nearer to it come first, and a node's least audit is known when it is settled."""

    def __init__(self, starts: list[tuple[int, int]], edges, back: bool):
        self.edges, self.back = edges, back
        self.settled: dict[tuple[int, int], tuple[int, str]] = {}
        self.heap: list = []
        for node in starts:
            heappush(self.heap, (0, 0, "", node))

    def drop(self) -> None:
        while self.heap and self.heap[0][3] in self.settled:
            heappop(self.heap)

    def settle(self, codes: bytes, other: _Side, best: tuple[int, str] | None) -> tuple[int, str] | None:
        """Settles the nearest node; the cheapest way so far, with those that now cross to the other side."""
        cost, steps, audit, node = heappop(self.heap)
        self.settled[node] = cost, audit
        crossings = []
        if node in other.settled:
            crossings.append((0, "", node))
        for price, letter, to in self.edges(codes, node):
            if to not in self.settled:
                joined = letter + audit if self.back else audit + letter
                heappush(self.heap, (cost + price, steps + (to[0] != node[0]), joined, to))
            if to in other.settled:
                crossings.append((price, letter, to))
        for price, letter, to in crossings:
            there, rest = other.settled[to]
            whole = rest + letter + audit if self.back else audit + letter + rest
            found = cost + price + there, whole
            best = found if best is None or found < best else best
        return best


def search(codes: bytes, start: int = 0, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """Least cost from the state `start` before the rows to one of `ends` behind them, and the least audit of that
    cost; None where no end can be reached."""
    here = _Side([(0, start)], _forward, back=False)
    there = _Side([(len(codes), q) for q in ends], _backward, back=True)
    best = None
    while True:
        here.drop()
        there.drop()
        if not here.heap or not there.heap:
            return best
        if best is not None and here.heap[0][0] + there.heap[0][0] > best[0]:
            return best
        side, other = (here, there) if here.heap[0][0] <= there.heap[0][0] else (there, here)
        best = side.settle(codes, other, best)


@lru_cache(100_000)
def _remembered(codes: bytes, start: int = 0, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    return search(codes, start, ends)


def repaired_rows(audit: str, rows: Iterator[tuple[int, str, str]], state: int = 0) -> Iterator[str]:
    """`role:text` of the repaired rows; `rows` are (code, role, text)."""
    for edit in audit:
        kind = ASSISTANT if state == 2 else USER
        if edit == "I":
            state = AFTER[state][kind]
            yield ("assistant:" if kind == ASSISTANT else "user:")
            continue
        code, role, text = next(rows)
        if edit == "K":
            state = AFTER[state][code & 3]
            yield f"{role}:{text}"
        elif edit == "R":
            state = AFTER[state][kind]
            yield ("assistant:" if kind == ASSISTANT else "user:") + text


class _Digest:
    """SHA-256 of texts joined by newlines."""

    def __init__(self):
        self.hash, self.begun = hashlib.sha256(), False

    def add(self, lines: Iterator[str]) -> _Digest:
        for line in lines:
            self.hash.update((b"\n" if self.begun else b"") + line.encode())
            self.begun = True
        return self


class _Counts:
    """What is counted along the rows of a conversation, one after another or segment after segment."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None
        self.first = self.last = None

    def row(self, turn: int | None, code: int, duplicate: bool) -> None:
        if code & MUST_GO:
            self.duplicate += duplicate
            self.blank += not duplicate
        self.truncated += bool(code & CUT_OFF)
        kind = code & 3
        self.illegal += self.last is not None and (self.last, kind) not in LEGAL
        self.first, self.last = kind if self.first is None else self.first, kind
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def follow(self, s: dict) -> None:
        """Adds a segment's counts, as `packed` gives them."""
        self.blank += s["blank"]
        self.duplicate += s["duplicate"]
        self.truncated += s["truncated"]
        if s["first"] is not None:
            self.illegal += s["illegal"] + (self.last is not None and (self.last, s["first"]) not in LEGAL)
            self.first, self.last = s["first"] if self.first is None else self.first, s["last"]
        if s["low"] is not None:
            self.turns += s["turns"] - (s["low"] == self.high)
            self.low, self.high = s["low"] if self.low is None else self.low, s["high"]

    def packed(self) -> dict:
        return {n: getattr(self, n) for n in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last")}

    def result(self, cost: int, audit: str, digest: _Digest) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
                "cost": cost, "audit": audit, "repaired_sha256": digest.hash.hexdigest()}


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
SEGMENT = ("part long, segment long, codes binary, roles array<string>, texts array<string>, "
           "turns long, low long, high long, first long, last long")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and `gone`: rows as the fault of their crc32 leaves them. Dropped rows stay as `gone`,
    so that a conversation that loses all rows is not forgotten. A null in the key, role or text is one space."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault").isin(0, 1), "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (F.col("fault") == 0).alias("gone"), F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("copies"))
    return rows.withColumn("copy", F.explode("copies")).drop("copies", "copy")


def _letter(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(OTHER)


def _coded(rows: DataFrame) -> DataFrame:
    """Rows with `seat` (the turn, nulls first), `digest` of the text, `code`, and the first seat of the same role and
    text in the conversation where they stand in several turns."""
    seat = F.coalesce("turn", F.lit(-(1 << 63)))
    blank, cut = ~F.col("text").rlike(SPACE), ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    code = F.when(F.col("gone"), GONE).otherwise(_letter(F.col("role")) + F.when(blank, MUST_GO).when(cut, CUT_OFF).otherwise(0))
    rows = rows.select("conv_id", "turn", "role", "text", seat.alias("seat"), F.sha2("text", 256).alias("digest"), code.cast("int").alias("code"))
    again = rows.where((F.col("code") < GONE) & F.col("code").bitwiseAND(MUST_GO).eqNullSafe(0)).groupBy("conv_id", "role", "digest").agg(
        F.min("seat").alias("since"), F.max("seat").alias("upto")).where("since < upto")
    again = written(again.select(F.col("conv_id").alias("of"), F.col("role").alias("as"), F.col("digest").alias("text_digest"), "since"), "again")
    few = again.limit(BROADCAST + 1).count() <= BROADCAST
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("as")) & (F.col("digest") == F.col("text_digest"))
    return rows.join(F.broadcast(again) if few else again, same, "left").drop("of", "as", "text_digest")


def _segments(rows: DataFrame, key: T.StructField) -> DataFrame:
    """One pass over sorted rows: results of conversations that begin and end inside the task and one segment, and
    segments of the others."""
    schema = T.StructType([key, *T.StructType.fromDDL(f"{RESULT}, {SEGMENT}").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, types = TaskContext.get().partitionId(), None
        number, begun, before, out = 0, False, None, []
        counts, codes, roles, texts, size, pieces, first = _Counts(), bytearray(), [], [], 0, 0, True

        def segment(conv) -> dict:
            return {"conv_id": conv, "part": part, "segment": number, "codes": bytes(codes), "roles": roles, "texts": texts, **counts.packed()}

        def whole(conv) -> dict:
            cost, audit = _remembered(bytes(codes))
            lines = repaired_rows(audit, zip(codes, roles, texts))
            return {"conv_id": conv, **counts.result(cost, audit, _Digest().add(lines))}

        def rows_() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist(out, pa.schema(types))
            out.clear()
            return made

        held = None
        for batch in slices(batches, 1000):
            if types is None:
                types = [pa.field(schema.names[0], batch.column(0).type), *_ARROW]
            for conv, turn, role, text, digest, code, since, seat in zip(*(c.to_pylist() for c in batch.columns)):
                fresh, full = not begun or conv != held, len(codes) >= ROWS or size >= CHARACTERS
                if begun and (fresh or full):
                    # The task's first conversation may begin in the task before.
                    out.append(whole(held) if fresh and not first and not pieces else segment(held))
                    number, pieces, first = number + 1, pieces + 1, first and not fresh
                if fresh or full:
                    counts, codes, roles, texts, size = _Counts(), bytearray(), [], [], 0
                if fresh:
                    begun, held, pieces, before = True, conv, 0, None
                if code != GONE:
                    mine = (seat, role, digest)
                    duplicate = not code & MUST_GO and (mine == before or since is not None and seat > since)
                    if duplicate:
                        code = code & 3 | MUST_GO
                    before = mine
                    counts.row(turn, code, duplicate)
                    codes.append(code)
                    roles.append(role)
                    texts.append(text)
                    size += len(text) + len(role)
                if len(out) >= 1000 or full:
                    yield rows_()
        if begun:
            out.append(segment(held))
            yield rows_()

    columns = ["conv_id", "turn", "role", "text", "digest", "code", "since", "seat"]
    return rows.select(columns).mapInArrow(run, schema)


_ARROW = [
    *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string()),
    ("part", pa.int64()), ("segment", pa.int64()), ("codes", pa.binary()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
    *((n, pa.int64()) for n in ("turns", "low", "high", "first", "last")),
]


def _paths(segments: DataFrame) -> DataFrame:
    """part, segment and `costs` and `audits` of the 16 ways from a state before the segment to one behind it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 100):
            found = [[_remembered(c, q, (r,)) for q in range(4) for r in range(4)] for c in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:3], pa.array([[w and w[0] for w in ways] for ways in found], pa.list_(pa.int64())),
                pa.array([[w and w[1] for w in ways] for ways in found], pa.list_(pa.string())),
            ], ["conv_id", "part", "segment", "costs", "audits"])

    schema = T.StructType([segments.schema["conv_id"], *T.StructType.fromDDL("part long, segment long, costs array<long>, audits array<string>").fields])
    return segments.select("conv_id", "part", "segment", "codes").mapInArrow(run, schema)


def joined(segments: list[list[tuple[int, str] | None]]) -> list[tuple[int, int, str]]:
    """(state before, cost, audit) of every segment on the cheapest way, the least audit of equal ones, through all."""
    ways = {0: (0, "", ())}
    for paths in segments:
        after: dict[int, tuple] = {}
        for q, (cost, audit, trail) in ways.items():
            for r in range(4):
                if paths[4 * q + r] is not None:
                    price, part = paths[4 * q + r]
                    found = (cost + price, audit + part, (trail, (q, price, part)))
                    if r not in after or found[:2] < after[r][:2]:
                        after[r] = found
        ways = after
    trail, out = min((ways[q] for q in ENDS if q in ways), key=lambda w: w[:2])[2], []
    while trail:
        trail, step = trail
        out.append(step)
    return out[::-1]


def _chosen(paths: DataFrame) -> DataFrame:
    """at_part, at_segment, state, price, edits: each segment's part of its conversation's cheapest way."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("part", "ascending"), ("segment", "ascending")]).to_pylist()
        steps = joined([[None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"])] for r in rows])
        columns = [[r["part"] for r in rows], [r["segment"] for r in rows], *map(list, zip(*steps))]
        return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string()])], ["at_part", "at_segment", "state", "price", "edits"])

    return paths.groupBy("conv_id").applyInArrow(run, "at_part long, at_segment long, state long, price long, edits string")


def _finished(segments: DataFrame, key: T.StructField) -> DataFrame:
    """Results of conversations in several segments, or at a task's ends; one segment at a time is in memory."""
    chosen = written(_chosen(_paths(segments)), "edits")
    on = (F.col("part") == F.col("at_part")) & (F.col("segment") == F.col("at_segment"))
    rows = segments.join(chosen, on).repartition("conv_id").sortWithinPartitions("conv_id", "part", "segment")
    names = ["conv_id", "codes", "roles", "texts", "state", "price", "edits", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last"]
    schema = T.StructType([key, *T.StructType.fromDDL(RESULT).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, held, counts, digest, cost, audit, types = False, None, None, None, 0, [], None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"conv_id": held, **counts.result(cost, "".join(audit), digest)}], pa.schema(types))

        for batch in slices(batches, 1):
            types = types or [pa.field(schema.names[0], batch.column(0).type), *_ARROW[:8]]
            s = batch.to_pylist()[0]
            if not begun or s["conv_id"] != held:
                if begun:
                    yield row()
                begun, held, counts, digest, cost, audit = True, s["conv_id"], _Counts(), _Digest(), 0, []
            counts.follow(s)
            digest.add(repaired_rows(s["edits"], zip(s["codes"], s["roles"], s["texts"]), s["state"]))
            cost += s["price"]
            audit.append(s["edits"])
        if begun:
            yield row()

    return rows.select(names).mapInArrow(run, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for every conv_id of `rows`
    (conv_id, turn, role, text, gone), as `damaged` gives them.

    Rows stand by turn, nulls first; those of one turn by role and a digest of the text, so repeats stand together. A
    role that does not begin with s, u or a fits nowhere unless it is changed. A null conv_id is a conversation.
    Conversations without rows have zeros, an empty audit and the digest of nothing; an empty table gives no rows;
    other columns are not read. The audit of a conversation is one value, so its edits meet in one task: a letter per
    row, not its text.
    """
    key = T.StructField("conv_id", rows.schema["conv_id"].dataType)
    order = ["conv_id", "seat", "role", "digest"]
    coded = _coded(rows)
    made = written(_segments(coded.repartitionByRange(*order).sortWithinPartitions(*order), key), "segments")
    done = made.where("part IS NULL").select("conv_id", *T.StructType.fromDDL(RESULT).names)
    return done.unionByName(_finished(made.where("part IS NOT NULL"), key))
