"""Conversation structure repair: bidirectional Dijkstra over the edit lattice.

A conversation is well formed if the initials of its roles read
``(s?(ua)+)?``: a system turn at most in front, then user and assistant in
turn. The lattice has a node for every (number of turns read, state); the
states are nothing yet, after s, after u, after a. Keep, Rerole and Delete
read a turn, Insert adds an empty one. A forward and a reverse heap grow
towards each other, every crossing of least cost is finished, and of those
the least concatenated audit (the edits' initials) is taken. Where audits
of one cost end in one node, none is the beginning of another (it would hold
the same edits of read turns and fewer inserts, so it would cost less), so
least parts make a least whole.

No conversation is gathered to be repaired. Turns travel as slim rows
without their text; equal turns are merged with a count, first occurrences
are found by aggregation, and the rows are range-partitioned in order, so a
long conversation lies over many tasks. A run that surely is a whole
conversation of at most ``PIECE`` turns is searched at once. Other runs are
cut into pieces; for every pair of states a piece is entered and left in,
the same search gives its cheapest audit, and ``_folded`` chains the pieces.
The texts are read once more, with the audits, to write the repaired turns
(``repaired``) or their digests (``digests``): a stream that holds one Arrow
batch and one audit.

Defined results: null roles and texts are one space (such texts are blank, such
roles have no legal initial); a null conversation id is a conversation of its
own; null turns come first; rows of one turn are ordered by role, text; equal rows
of one turn are repeats; a conversation without present rows has zeros, an
empty audit and the digest of the empty string; an empty table gives an
empty result; further columns play no part.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintage.llm.common import WS, checkpointed, ship

#: Turns of a piece at most.
PIECE = 512
KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1
#: States, and where the initial of a turn leads.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
DONE = (START, ASSISTANT)
#: The role a rerouted or inserted turn gets in each state.
GETS = {s: "assistant" if "a" in to else "user" for s, to in NEXT.items()}
_ADDS = [(s, NEXT[s][GETS[s][0]], COST[INSERT], INSERT) for s in NEXT]
#: Kinds of turns, by their first fault.
FINE, CUT, BLANK, REPEAT = range(4)

_ORDER = ["conv", "turn", "by_role", "by_text", "digest"]


# ------------------------------------------------------------------- search

def turn_steps(initial: str, kind: int) -> list[tuple[int, int, int, str]]:
    """(state, state after, cost, letter) of the edits that read one turn."""
    out = [(s, s, COST[DELETE], DELETE) for s in NEXT]
    if kind in (FINE, CUT):
        fault = TRUNCATED if kind == CUT else 0
        out += [(s, to[initial], COST[KEEP] + fault, KEEP) for s, to in NEXT.items() if initial in to]
        out += [(s, NEXT[s][GETS[s][0]], COST[REROLE] + fault, REROLE) for s in NEXT]
    return out


def cheapest(steps: list[list[tuple]], start: int, goals, adds) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest way from ``start`` before the first step
    to one of ``goals`` after the last; the least audit of those. ``steps[i]``
    leads from layer i to i + 1; turns may be inserted in layer i if
    ``adds(i)``. None if there is no way."""
    n = len(steps)
    away = [{} for _ in range(n + 1)]
    back = [{} for _ in range(n + 1)]
    for i in range(n + 1):
        edges = [(s, i, t, i, c, a) for s, t, c, a in _ADDS] if adds(i) else []
        if i < n:
            edges += [(s, i, t, i + 1, c, a) for s, t, c, a in steps[i]]
        for s, i0, t, i1, c, a in edges:
            away[i0].setdefault(s, []).append((i1, t, c, a))
            back[i1].setdefault(t, []).append((i0, s, c, a))
    # ties by layer: what a free edge leads to is popped after all it can come from
    ahead, behind = [(0, 0, "", start)], [(0, 0, "", g) for g in goals]
    heapq.heapify(behind)
    from_start: dict[tuple[int, int], tuple[int, str]] = {}
    to_goal: dict[tuple[int, int], tuple[int, str]] = {}
    best = None
    while ahead or behind:
        reach = (ahead[0][0] if ahead else 0) + (behind[0][0] if behind else 0)
        if best is not None and reach > best[0]:
            break
        forward = bool(ahead) and (not behind or ahead[0][0] <= behind[0][0])
        cost, layer, audit, state = heapq.heappop(ahead if forward else behind)
        if not forward:
            layer = n - layer
        node, mine, other = (layer, state), *((from_start, to_goal) if forward else (to_goal, from_start))
        if node in mine:
            continue
        mine[node] = (cost, audit)
        crossings = [(0, "", node)]
        for i, t, c, a in (away if forward else back)[layer].get(state, ()):
            crossings.append((c, a, (i, t)))
            if (i, t) not in mine:
                if forward:
                    heapq.heappush(ahead, (cost + c, i, audit + a, t))
                else:
                    heapq.heappush(behind, (cost + c, n - i, a + audit, t))
        for c, a, there in crossings:
            if there in other:
                far, rest = other[there]
                found = (cost + c + far, audit + a + rest if forward else rest + a + audit)
                if best is None or found < best:
                    best = found
    return best


# ------------------------------------------------------------------- pieces

def _piece(turns: list[tuple], whole: bool) -> dict:
    """What a piece's turns (turn, present, initial, kind, repeat, n) say of
    themselves, and its cheapest ways."""
    out = {"rows": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "first": None, "last": None,
           "lo": None, "hi": None, "turns": 0, "paths": []}
    steps = []
    for turn, present, initial, kind, repeat, n in turns:
        if not present:
            continue
        if turn is not None and turn != out["hi"]:
            out["turns"] += 1
            out["lo"] = turn if out["lo"] is None else out["lo"]
            out["hi"] = turn
        if out["rows"]:
            out["illegal"] += out["last"] + initial not in ("su", "ua", "au")
        else:
            out["first"] = initial
        out["illegal"] += n - 1
        out["rows"] += n
        out["last"] = initial
        alone = kind not in (BLANK, REPEAT) and not repeat
        out["blank"] += n * (kind == BLANK)
        out["duplicate"] += 0 if kind == BLANK else n - alone
        out["truncated"] += alone and kind == CUT
        if alone:
            steps.append(turn_steps(initial, kind))
        if n > alone:
            steps.append([(s, s, (n - alone) * COST[DELETE], DELETE * (n - alone)) for s in NEXT])
    if whole:
        cost, audit = cheapest(steps, START, DONE, lambda i: True)
        out["paths"] = [{"s": START, "t": START, "cost": cost, "audit": audit}]
    else:
        for s in NEXT:
            for t in NEXT:
                way = cheapest(steps, s, (t,), lambda i: i < len(steps))
                if way:
                    out["paths"].append({"s": s, "t": t, "cost": way[0], "audit": way[1]})
    return out


def _joined(one: dict | None, two: dict) -> dict:
    """The counts of two neighbouring pieces as those of one."""
    if one is None:
        return dict(two)
    out = {k: one[k] + two[k] for k in ("rows", "blank", "duplicate", "truncated", "illegal")}
    if one["rows"] and two["rows"]:
        out["illegal"] += one["last"] + two["first"] not in ("su", "ua", "au")
    out["first"] = one["first"] if one["rows"] else two["first"]
    out["last"] = two["last"] if two["rows"] else one["last"]
    out["lo"] = two["lo"] if one["lo"] is None else one["lo"]
    out["hi"] = one["hi"] if two["hi"] is None else two["hi"]
    out["turns"] = one["turns"] + two["turns"] - (one["hi"] is not None and one["hi"] == two["lo"])
    return out


def _sheet(conv: T.DataType) -> T.StructType:
    long, text = T.LongType(), T.StringType()
    path = T.StructType([T.StructField("s", T.IntegerType()), T.StructField("t", T.IntegerType()),
                         T.StructField("cost", long), T.StructField("audit", text)])
    return T.StructType(
        [T.StructField("conv", conv), T.StructField("whole", T.BooleanType()), T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType())]
        + [T.StructField(c, long) for c in ("rows", "blank", "duplicate", "truncated", "illegal")]
        + [T.StructField("first", text), T.StructField("last", text)] + [T.StructField(c, long) for c in ("lo", "hi", "turns")]
        + [T.StructField("paths", T.ArrayType(path))])


_NOTHING = object()


def _cut(schema: pa.Schema):
    """Runs of one conversation in a partition's ordered rows, as pieces."""
    def run(batches):
        part, conv, turns, seq, edge, out = TaskContext.get().partitionId(), _NOTHING, [], 0, True, []

        def close(whole):
            nonlocal turns, seq
            out.append({"conv": conv, "whole": whole, "part": part, "seq": seq, **_piece(turns, whole)})
            turns, seq = [], seq + 1

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "present", "initial", "kind", "repeat", "n")]):
                if row[0] != conv:
                    if conv is not _NOTHING:
                        # neither at an end of the partition nor cut before
                        close(whole=not edge)
                        edge = False
                    conv = row[0]
                elif len(turns) == PIECE:
                    close(whole=False)
                    edge = True
                turns.append(row[1:])
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if conv is not _NOTHING:
            close(whole=False)
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def _folded(schema: pa.Schema):
    """The pieces of a conversation, in order, as one whole."""
    def run(batches):
        conv, counts, ways, out = _NOTHING, None, {}, []

        def close():
            # turns added after the last one: u and a, a, or none
            ends = [(cost + COST[INSERT] * k, audit + INSERT * k) for s, (cost, audit) in ways.items() for k in ((0, 2, 1, 0)[s],)]
            cost, audit = min(ends)
            out.append({"conv": conv, "whole": True, "part": 0, "seq": 0, **{k: counts[k] for k in schema.names if k in counts and k not in ("conv", "whole", "part", "seq", "paths")},
                        "paths": [{"s": START, "t": START, "cost": cost, "audit": audit}]})

        for batch in batches:
            for row in batch.to_pylist():
                if row["conv"] != conv:
                    if conv is not _NOTHING:
                        close()
                    conv, counts, ways = row["conv"], None, {START: (0, "")}
                counts = _joined(counts, row)
                after: dict[int, tuple[int, str]] = {}
                for p in row["paths"]:
                    if p["s"] in ways:
                        cost, audit = ways[p["s"]]
                        way = (cost + p["cost"], audit + p["audit"])
                        after[p["t"]] = min(after.get(p["t"], way), way)
                ways = after
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if conv is not _NOTHING:
            close()
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


# ---------------------------------------------------------------- operators

def _rows(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, by_role, by_text, digest, role, text, present) of every row."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    present = F.coalesce(F.col("present"), F.lit(False)) if "present" in turns.columns else F.lit(True)
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), blank(role).alias("role"), blank(text).alias("text"),
                        present.alias("present"))
    digest = F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text"))
    return rows.select("conv", "turn", F.substring("role", 1, 32).alias("by_role"), F.substring("text", 1, 64).alias("by_text"),
                       digest.alias("digest"), "role", "text", "present")


def repairs(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv``, gaps, blank, duplicate, truncated,
    illegal, cost, audit. Rows whose column ``present`` (if there is one) is
    not true only keep their conversation in the result."""
    ship(turns.sparkSession)
    shown = F.btrim("text", F.lit(WS))
    kind = F.when(shown == "", BLANK).when(F.substring(shown, -1, 1).isin(".", "!", "?"), FINE).otherwise(CUT)
    slim = (_rows(turns, conv, turn, role, text)
            .groupBy(*_ORDER, "present", F.substring("role", 1, 1).alias("initial"), kind.alias("kind")).agg(F.count(F.lit(1)).alias("n")))
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    seen = (slim.filter("present").groupBy(F.col("conv").alias("in"), F.col("digest").alias("same"))
            .agg(F.min(when).alias("at"), F.count(F.lit(1)).alias("times")).filter("times > 1"))
    marked = checkpointed(slim.join(seen, F.col("conv").eqNullSafe(F.col("in")) & (F.col("digest") == F.col("same")), "left")
                          .select(*_ORDER, "present", "initial", "kind", F.coalesce(when > F.col("at"), F.lit(False)).alias("repeat"), "n"))
    sheet = _sheet(marked.schema["conv"].dataType)
    arrow = _arrow(sheet)
    pieces = checkpointed(marked.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).mapInArrow(_cut(arrow), sheet))
    rest = (pieces.filter("not whole").repartition("conv").sortWithinPartitions("conv", "part", "seq").mapInArrow(_folded(arrow), sheet))
    path = F.element_at("paths", 1)
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("turns"), F.lit(0)).cast("long")
    return pieces.filter("whole").union(rest).select(
        F.col("conv").alias(conv), gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", path["cost"].alias("cost"), path["audit"].alias("audit"))


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _replayed(turns: DataFrame, found: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Every conversation's audit (mark 0) and then its rows, in order."""
    rows = _rows(turns, conv, turn, role, text).filter("present").select(*_ORDER, F.lit(1).alias("mark"), "role", "text")
    null = F.lit(None)
    audits = found.select(F.col(conv).alias("conv"), null.cast("long").alias("turn"), *[null.cast("string").alias(c) for c in _ORDER[2:]],
                          F.lit(0).alias("mark"), null.cast("string").alias("role"), F.col("audit").alias("text"))
    return audits.union(rows).repartition("conv").sortWithinPartitions("conv", "mark", *_ORDER[1:]).select("conv", "mark", "role", "text")


def _edited(batches):
    """(conv, mark, role, text): mark 0 begins a conversation, mark 1 is a turn of its repaired form."""
    conv = audit = None
    at, state = 0, START

    def added():
        nonlocal at, state
        while at < len(audit) and audit[at] == INSERT:
            at += 1
            given = GETS[state]
            state = NEXT[state][given[0]]
            yield conv, 1, given, ""

    for batch in batches:
        for c, mark, role, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if mark == 0:
                if audit is not None:
                    yield from added()
                conv, audit, at, state = c, text, 0, START
                yield conv, 0, None, None
                continue
            yield from added()
            letter, at = audit[at], at + 1
            if letter != DELETE:
                given = role if letter == KEEP else GETS[state]
                state = NEXT[state][given[:1]]
                yield conv, 1, given, text
    if audit is not None:
        yield from added()


def _batches(rows, schema: pa.Schema, size: int = 1024):
    held, weight = [], 0
    for r in rows:
        held.append(r)
        weight += sum(len(x) for x in r if isinstance(x, str))
        if len(held) >= size or weight > 1 << 24:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def repaired(turns: DataFrame, found: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, position, role, text): the repaired conversations, after the
    ``repairs`` of the same rows."""
    rows = _replayed(turns, found, conv, turn, role, text)
    out = T.StructType([T.StructField(conv, rows.schema["conv"].dataType), T.StructField("position", T.LongType()),
                        T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    schema = _arrow(out)

    def run(batches):
        def placed():
            n = 0
            for c, mark, r, t in _edited(batches):
                n = n + 1 if mark else 0
                if mark:
                    yield c, n, r, t
        yield from _batches(placed(), schema)

    return rows.mapInArrow(run, out)


def digests(turns: DataFrame, found: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, audit, repaired_sha256): hexadecimal SHA-256 of the repaired
    ``role:text`` lines, joined by newlines."""
    rows = _replayed(turns, found, conv, turn, role, text)
    out = T.StructType([T.StructField(conv, rows.schema["conv"].dataType), T.StructField("repaired_sha256", T.StringType())])
    schema = _arrow(out)

    def run(batches):
        def hashed():
            conv, sha, n = None, None, 0
            for c, mark, r, t in _edited(batches):
                if not mark:
                    if sha:
                        yield conv, sha.hexdigest()
                    conv, sha, n = c, hashlib.sha256(), 0
                    continue
                sha.update(f"{chr(10) if n else ''}{r}:{t}".encode())
                n += 1
            if sha:
                yield conv, sha.hexdigest()
        yield from _batches(hashed(), schema)

    return rows.mapInArrow(run, out)


# -------------------------------------------------------------- the damage

def damaged(conversations: DataFrame) -> DataFrame:
    """The table with known faults: by crc32 of ``conv_id:turn`` (null: one
    space) modulo 20, 0 drops a row (it stays with ``present`` false), 1
    empties its text, 2 removes its ends of sentences, 3 repeats it, 4 makes
    it the user's."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (F.col("fate") != 0).alias("present"),
                       F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")
