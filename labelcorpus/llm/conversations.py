"""Conversation structure repair: bidirectional Dijkstra over the edit lattice.

A node of the lattice is a row border of the conversation and the state of the wanted order of role initials,
``(s?(ua)+)?``. Its edges are the edits: Keep (0), Rerole to user or assistant (2), Delete (3) take a row, Insert of an
empty user or assistant turn (2) takes none; a truncated row that stays adds 1, blank and duplicate rows have to go. A
forward and a reverse heap grow until their least costs together exceed the best path; then every edge that joins a
node settled forward with one settled in reverse at the best cost is a crossing, and the least audit (the edits'
initials) of the crossings is taken. Each border and state keeps the least audit of its cheapest paths: two of
them are never the beginning of one another (the letters fix the path, and a path that comes back to its node costs
something), so the least of a part stays the least of the whole.

Conversations are solved in one task each while they are bounded (``MOST_ROWS`` rows, ``MOST_BYTES`` of text). Larger ones are
cut: their rows are sorted over many tasks, each task cuts its part into segments, and a segment's answer is the table
of its least costs and audits from each state to each state, by the same search. A fold over a conversation's tables
picks every segment's audit, and the segments are then repaired in place. Duplicates within large conversations come from an
aggregate over (conversation, role, text).

Defined cases: a null role or text is one space; rows are taken by turn, nulls first, ties by role and text. An
initial is the first character of the role as it is; an empty role has none and never fits. Null conversation ids are
one conversation. Repeated rows are repeated rows (duplicates). Rows that are not ``present`` only name their
conversation; a conversation without other rows gives one chunk without turns and zeros. Extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, stored

MOST_ROWS = 2_000
MOST_BYTES = 32 << 20
#: Solved conversations of at most this many rows are kept by shape, up to this many shapes.
SHORT, MOST_SHAPES = 64, 100_000

START, SYSTEM, USER, ASSISTANT = range(4)
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The state after a user or assistant turn is put in; ``USER`` is a user turn.
ADD = (USER, USER, ASSISTANT, USER)
COMES_FROM = {t: [s for s in range(4) if ADD[s] == t] for t in range(4)}
KEPT_FROM = {(t, i): [s for s in range(4) if KEEP.get((s, i)) == t] for t in range(4) for i in "sua"}
GOOD_PAIRS = {"su", "ua", "au"}
ENDS = (START, ASSISTANT)

#: A row's shape: its initial (``o``: any other), upper case if truncated, ``x`` if it has to go.
def shape_of(initial: str, fault: str) -> str:
    if fault in ("blank", "duplicate"):
        return "x"
    letter = initial if initial in ("s", "u", "a") else "o"
    return letter.upper() if fault == "truncated" else letter


def _row(shape: str) -> tuple[bool, str, int]:
    """Has to go, initial, cost of staying."""
    return shape == "x", shape.lower(), int(shape.isupper())


def _forward(rows: list, i: int, state: int) -> Iterator[tuple[int, int, int, str]]:
    """Edges from a node: (row border, state, cost, letter)."""
    yield i, ADD[state], 2, "I"
    if i < len(rows):
        gone, initial, extra = rows[i]
        yield i + 1, state, 3, "D"
        if not gone:
            yield i + 1, ADD[state], 2 + extra, "R"
            after = KEEP.get((state, initial))
            if after is not None:
                yield i + 1, after, extra, "K"


def _backward(rows: list, i: int, state: int) -> Iterator[tuple[int, int, int, str]]:
    """Edges into a node, by where they come from."""
    for before in COMES_FROM[state]:
        yield i, before, 2, "I"
    if i:
        gone, initial, extra = rows[i - 1]
        yield i - 1, state, 3, "D"
        if not gone:
            for before in COMES_FROM[state]:
                yield i - 1, before, 2 + extra, "R"
            for before in KEPT_FROM.get((state, initial), ()):
                yield i - 1, before, extra, "K"


def cheapest(shapes: str, first: int = START, last: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """Least cost from the state ``first`` to one of ``last`` over all rows, and the least audit at that cost."""
    rows = [_row(s) for s in shapes]
    n = len(rows)
    # Labels (cost, audit) by node; heaps by (cost, steps taken): the only edges without cost take a row, so a
    # node's cheapest predecessors are settled before it.
    labels = ({(0, first): (0, "")}, {(n, s): (0, "") for s in last})
    heaps = ([(0, 0, first)], [(0, 0, s) for s in last])
    settled: tuple[dict, dict] = ({}, {})
    best = None
    while heaps[0] and heaps[1]:
        if best is not None and heaps[0][0][0] + heaps[1][0][0] > best:
            break
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        mine, other, heap = labels[side], labels[1 - side], heaps[side]
        cost, taken, state = heapq.heappop(heap)
        node = (n - taken if side else taken, state)
        if node in settled[side]:
            continue
        cost, audit = settled[side][node] = mine[node]
        if node in other and (best is None or cost + other[node][0] < best):
            best = cost + other[node][0]
        for i, to, price, letter in (_backward if side else _forward)(rows, *node):
            label = cost + price, letter + audit if side else audit + letter
            if (i, to) not in mine or label < mine[i, to]:
                mine[i, to] = label
                heapq.heappush(heap, (label[0], n - i if side else i, to))
    if best is None:
        return None
    ahead, behind = settled
    ahead.setdefault((0, first), (0, ""))
    for s in last:
        behind.setdefault((n, s), (0, ""))
    least = None
    for node, (cost, audit) in ahead.items():
        met = behind.get(node)
        if met and cost + met[0] == best:
            path = audit + met[1]
            least = path if least is None or path < least else least
        for i, to, price, letter in _forward(rows, *node):
            met = behind.get((i, to))
            if met and cost + price + met[0] == best:
                path = audit + letter + met[1]
                least = path if least is None or path < least else least
    return best, least


def repaired(audit: str, turns: list[tuple[str, str]], state: int = START) -> list[tuple[str, str]]:
    """The (role, text) turns after the edits."""
    out, rows = [], iter(turns)
    for letter in audit:
        if letter == "D":
            next(rows)
            continue
        role, text = next(rows) if letter != "I" else ("", "")
        if letter == "K":
            state = KEEP[state, role[:1]]
        else:
            state = ADD[state]
            role = "user" if state == USER else "assistant"
        out.append((role, text))
    return out


def fault_of(text: str, seen: bool) -> str:
    """The row's first fault, or nothing."""
    end = text.rstrip(SPACES)[-1:]
    return "blank" if not end else "duplicate" if seen else "truncated" if end not in ".!?" else ""


COUNTS = ("rows", "turns", "blank", "duplicate", "truncated", "illegal")
CHUNK = ("conv_id {kind}, chunk bigint, chunks bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
         "illegal bigint, cost bigint, audit string, repaired array<struct<role:string,text:string>>")
SEGMENT = ("conv_id {kind}, part int, seq bigint, min_turn bigint, max_turn bigint, first_initial string, last_initial string, "
           + ", ".join(f"{c} bigint" for c in COUNTS)
           + ", ways array<struct<from:int,to:int,cost:bigint,audit:string>>, given array<struct<role:string,text:string>>")


def _tally(rows: list[tuple], faults: list[str]) -> dict:
    """Counts over rows (turn, role, text) of one conversation in order."""
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return {"min_turn": turns[0] if turns else None, "max_turn": turns[-1] if turns else None, "turns": len(set(turns)),
            "rows": len(rows), "first_initial": initials[0] if rows else None, "last_initial": initials[-1] if rows else None,
            "illegal": sum(a + b not in GOOD_PAIRS for a, b in zip(initials, initials[1:])),
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")}}


def _gaps(low, high, turns: int) -> int:
    return 0 if low is None else high - low + 1 - turns


def _groups(batches: Iterable[pa.RecordBatch], most: int | None = None) -> Iterator[tuple[object, list[tuple]]]:
    """Rows of sorted batches by conversation, as (id, rows); parts of at most ``most`` rows if asked.

    Rows are the further columns' values.
    """
    held, key, begun, size = [], None, False, 0
    parts = (batch.slice(at, 500) for batch in batches for at in range(0, batch.num_rows, 500))
    for batch in parts:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if begun and (row[0] != key or (most and (len(held) >= most or size >= MOST_BYTES))):
                yield key, held
                held, size = [], 0
            key, begun = row[0], True
            held.append(row[1:])
            size += 2 * len(row[3])
    if begun:
        yield key, held


def _pairs(rows: list[tuple[str, str]]) -> list[dict]:
    return [{"role": r, "text": t} for r, t in rows]


def _solve_whole(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv_id, turn, role, text, present) of bounded conversations to one chunk each."""
    known: dict[str, tuple[int, str]] = {}
    out, size = [], 0
    for key, held in _groups(batches):
        rows = [r[:3] for r in held if r[3]]
        seen, faults = set(), []
        for _, role, text in rows:
            faults.append(fault_of(text, (role, text) in seen))
            seen.add((role, text))
        shapes = "".join(shape_of(r[:1], f) for (_, r, _), f in zip(rows, faults))
        answer = known.get(shapes)
        if answer is None:
            answer = cheapest(shapes)
            if len(shapes) <= SHORT:
                if len(known) >= MOST_SHAPES:
                    known.clear()
                known[shapes] = answer
        tally = _tally(rows, faults)
        turns = repaired(answer[1], [r[1:] for r in rows])
        out.append({"conv_id": key, "chunk": 0, "chunks": 1, "gaps": _gaps(tally["min_turn"], tally["max_turn"], tally["turns"]),
                    **{c: tally[c] for c in ("blank", "duplicate", "truncated", "illegal")},
                    "cost": answer[0], "audit": answer[1], "repaired": _pairs(turns)})
        size += 100 + sum(len(t) for _, t in turns)
        if size > 4 << 20:
            yield pa.RecordBatch.from_pylist(out, schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _solve_segments(batches: Iterator[pa.RecordBatch], schema: pa.Schema, most_rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv_id, turn, role, text, seen earlier) of large conversations to segments with their tables."""
    part, seq, last_key, last_row = TaskContext.get().partitionId(), 0, None, None
    for key, held in _groups(batches, most_rows):
        if key != last_key:
            last_key, last_row = key, None
        rows, faults = [r[:3] for r in held], []
        for row, (*_, seen) in zip(rows, held):
            faults.append(fault_of(row[2], seen or row == last_row))  # equal rows stand together in one task
            last_row = row
        shapes = "".join(shape_of(r[:1], f) for (_, r, _), f in zip(rows, faults))
        ways = []
        for first in range(4):
            for last in range(4):
                way = cheapest(shapes, first, (last,))
                if way:
                    ways.append({"from": first, "to": last, "cost": way[0], "audit": way[1]})
        yield pa.RecordBatch.from_pylist([{"conv_id": key, "part": part, "seq": seq, **_tally(rows, faults), "ways": ways,
                                           "given": _pairs([r[1:] for r in rows])}], schema)
        seq += 1


def _fold(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted segments (conv_id, part, seq, struct of counts, ways) to each segment's audit, and the conversation's counts.

    Of a conversation it holds four audits, and for each segment four steps back and its distinct audits.
    """
    def finished(key, steps: list, best: dict, total: dict) -> pa.RecordBatch:
        state, (cost, _) = min(((s, best[s]) for s in ENDS if s in best), key=lambda x: x[1])
        picks = []
        for number in range(len(steps) - 1, -1, -1):
            part, seq, back = steps[number]
            before, audit = back[state]
            picks.append({"conv_id": key, "part": part, "seq": seq, "chunk": number, "chunks": len(steps), "state": before,
                          "audit": audit, "cost": cost, "gaps": _gaps(total["min_turn"], total["max_turn"], total["turns"]),
                          **{c: total[c] for c in ("blank", "duplicate", "truncated", "illegal")}})
            state = before
        return pa.RecordBatch.from_pylist(picks, schema)

    key, steps, best, total = None, [], {}, {}
    for batch in batches:
        for row in (batch.slice(at, 1).to_pylist()[0] for at in range(batch.num_rows)):
            if steps and row["conv_id"] != key:
                yield finished(key, steps, best, total)
                steps = []
            count = row["counts"]
            if not steps:
                key, best, total = row["conv_id"], {START: (0, "")}, dict(count)
            else:
                for c in COUNTS:
                    total[c] += count[c]
                if count["min_turn"] is not None:
                    if total["max_turn"] == count["min_turn"]:
                        total["turns"] -= 1
                    total["max_turn"] = count["max_turn"]
                    total["min_turn"] = count["min_turn"] if total["min_turn"] is None else total["min_turn"]
                total["illegal"] += total["last_initial"] + count["first_initial"] not in GOOD_PAIRS
                total["last_initial"] = count["last_initial"]
            after, back = {}, {}
            for way in row["ways"]:
                if way["from"] in best:
                    cost, audit = best[way["from"]]
                    label = cost + way["cost"], audit + way["audit"]
                    if way["to"] not in after or label < after[way["to"]]:
                        after[way["to"]], back[way["to"]] = label, (way["from"], way["audit"])
            best = after
            steps.append((row["part"], row["seq"], back))
    if steps:
        yield finished(key, steps, best, total)


def _repair_segments(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            given, state = row.pop("given"), row.pop("state")
            turns = repaired(row["audit"], [(g["role"], g["text"]) for g in given], state)
            yield pa.RecordBatch.from_pylist([{**row, "repaired": _pairs(turns)}], schema)


def _schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def repair(rows: DataFrame, present: Column | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", most_rows: int = MOST_ROWS) -> DataFrame:
    """Repaired conversations in chunks: conv_id, chunk (0, 1, ... of ``chunks``), the conversation's gaps, blank, duplicate,
    truncated, illegal and cost, the chunk's audit and its repaired turns (role, text).

    A conversation of at most ``most_rows`` rows is one chunk.
    """
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = rows.select(F.col(conv).alias("c"), F.col(turn).cast("bigint").alias("n"),
                       F.when(here, F.coalesce(F.col(role), F.lit(" "))).otherwise(F.lit("")).alias("r"),
                       F.when(here, F.coalesce(F.col(text), F.lit(" "))).otherwise(F.lit("")).alias("t"), here.alias("p"))
    kind = rows.schema["c"].dataType.simpleString()
    chunk = CHUNK.format(kind=kind)
    chunk_schema, segment_schema = _schema(chunk), _schema(SEGMENT.format(kind=kind))

    sizes = rows.groupBy("c").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("t") + F.octet_length("r")).alias("bytes"))
    large = stored(sizes.filter((F.col("rows") > most_rows) | (F.col("bytes") > MOST_BYTES)).select(F.col("c").alias("lc")), "conv-large")
    is_large = F.col("c").eqNullSafe(F.col("lc"))

    small = rows.join(large, is_large, "left_anti")
    whole = (small.repartition("c").sortWithinPartitions("c", "n", "r", "t")
             .mapInArrow(lambda b: _solve_whole(b, chunk_schema), chunk)
             .withColumn("chunks", F.lit(1).cast("bigint")))  # a constant: who asks for several chunks need not run this
    if large.isEmpty():
        return whole

    big = rows.join(large, is_large, "left_semi")
    big = big.withColumn("h", F.sha2(F.concat_ws("\0", "r", "t"), 256))
    order = F.struct(F.col("n").isNotNull(), F.col("n"))
    first = (big.filter("p").groupBy(F.col("c").alias("fc"), F.col("h").alias("fh"))
             .agg(F.min(order).alias("first"), F.max(order).alias("last")).filter("first < last"))
    marked = big.filter("p").join(first, F.col("c").eqNullSafe(F.col("fc")) & (F.col("h") == F.col("fh")), "left")
    marked = marked.select("c", "n", "r", "t", F.coalesce(order > F.col("first"), F.lit(False)).alias("d"))
    # Cut by the beginning of a text, so that the sample for the cuts stays small; equal rows stay together.
    segments = stored(marked.repartitionByRange("c", "n", "r", F.left("t", F.lit(32))).sortWithinPartitions("c", "n", "r", "t")
                      .mapInArrow(lambda b: _solve_segments(b, segment_schema, most_rows), SEGMENT.format(kind=kind)), "conv-segments")

    pick = (f"conv_id {kind}, part int, seq bigint, chunk bigint, chunks bigint, state int, audit string, cost bigint, gaps bigint, "
            "blank bigint, duplicate bigint, truncated bigint, illegal bigint")
    pick_schema = _schema(pick)
    counted = segments.select("conv_id", "part", "seq", F.struct("min_turn", "max_turn", "first_initial", "last_initial", *COUNTS)
                              .alias("counts"), "ways")
    picks = (counted.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
             .mapInArrow(lambda b: _fold(b, pick_schema), pick))
    mended = segments.select("part", "seq", "given").join(picks, ["part", "seq"]).drop("part", "seq")
    mended = mended.mapInArrow(lambda b: _repair_segments(b, chunk_schema), chunk)
    # Large conversations none of whose rows is present.
    void = big.groupBy("c").agg(F.max("p").alias("p")).filter("NOT p").select("c", F.lit(None).cast("bigint").alias("n"),
                                                                              F.lit("").alias("r"), F.lit("").alias("t"), "p")
    void = void.mapInArrow(lambda b: _solve_whole(b, chunk_schema), chunk)
    return whole.unionByName(mended).unionByName(void)


def digests(chunks: DataFrame) -> DataFrame:
    """One row per conversation: its counts, the whole audit and the SHA-256 of its repaired turns, a ``role:text`` line each.

    One chunk is hashed in place; of several, the audits are joined and the turns go through the hash one chunk at a
    time, in order.
    """
    line = F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    one = chunks.filter("chunks = 1").select(*columns, "audit", F.sha2(F.concat_ws("\n", line), 256).alias("repaired_sha256"))
    kind = chunks.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, " + ", ".join(f"{c} bigint" for c in columns[1:]) + ", audit string, repaired_sha256 string"
    schema = _schema(ddl)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, audits, begun, digest = None, [], False, None
        for batch in batches:
            for row in (batch.slice(at, 1).to_pylist()[0] for at in range(batch.num_rows)):
                if first and row["conv_id"] != first["conv_id"]:
                    yield pa.RecordBatch.from_pylist([{**first, "audit": "".join(audits), "repaired_sha256": digest.hexdigest()}], schema)
                    first = None
                if first is None:
                    first, audits, begun, digest = {c: row[c] for c in columns}, [], False, hashlib.sha256()
                audits.append(row["audit"])
                if row["turns"]:
                    digest.update(("\n" if begun else "").encode() + row["text"].encode())
                    begun = True
        if first:
            yield pa.RecordBatch.from_pylist([{**first, "audit": "".join(audits), "repaired_sha256": digest.hexdigest()}], schema)
    several = chunks.filter("chunks > 1").select(*columns, "chunk", "audit", F.size("repaired").alias("turns"), F.concat_ws("\n", line).alias("text"))
    several = several.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(joined, ddl)
    return one.unionByName(several)
