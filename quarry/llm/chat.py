"""Chat formatting by minimum-cost role repair.

Legal conversations are the words of a small automaton: an optional system turn,
then user and assistant in turn, ending with assistant. For every turn of the
input the repair chooses to emit it (under its own role or another), to merge it
into the turn before, or to insert empty turns ahead of it. A role alone fixes
the cost of getting from state to state, so a stretch of turns is a matrix of
least costs and longer stretches are (min, +) products: a conversation is cut
into segments by its order, each of a bounded number of turns whatever their
numbers are (null and repeated ones too), the segments' matrices are combined, the least path's states at
the segment ends are found, and each segment traces its own turns back. Matrices are
combined level by level, and an output turn that goes over segments has a row in each: no row
holds more than a segment's turns or ``FAN`` matrices.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import staged, values
from quarry.session import ship_package

ROLES = ("system", "user", "assistant")
# States: no turn yet, then the role of the last turn. The legal next roles.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
KEEP, MERGE, INSERT, RELABEL, NAME_UNKNOWN = 0, 1, 2, 3, 1
"""Costs; a role that is none of the known ones is cheaper to relabel."""
SYNONYMS = {"human": "user", "prompter": "user", "bot": "assistant", "ai": "assistant", "model": "assistant", "gpt": "assistant"}
SEGMENT = 512
"""Turns in a segment, at most."""
FAN = 64
"""Neighbouring matrices combined at once."""
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
UNKNOWN = 0


def _named(role: int, as_role: int) -> int:
    if role == as_role:
        return KEEP
    return NAME_UNKNOWN if role == UNKNOWN else RELABEL


def _inserts(state: int, role: int) -> list[tuple[int, ...]]:
    """Roles of up to two empty turns that make ``role`` legal after ``state``, the fewest first."""
    out = []
    for n in range(3):
        for path in product((SYSTEM, USER, ASSISTANT), repeat=n):
            steps = (state, *path, role)
            if all(b in NEXT[a] for a, b in zip(steps, steps[1:], strict=False)):
                out.append(path)
    return out


def _steps(role: int) -> list[list[tuple[int, str, tuple[int, ...]]]]:
    """Cheapest action from each state to each: (cost, action, inserted roles).
    Of equal costs fewer inserted turns win, then emitting before merging."""
    table = []
    for a in range(4):
        row = []
        for b in range(4):
            options = [(10**9, "", ())]
            if b != START:
                for path in _inserts(a, b):
                    options.append((_named(role, b) + INSERT * len(path), "emit", path))
                if a == b:
                    options.append((MERGE + _named(role, b), "merge", ()))
            row.append(min(options, key=lambda o: (o[0], len(o[2]), o[1], o[2])))
        table.append(row)
    return table


STEPS = [_steps(role) for role in range(4)]
COSTS = np.array([[[o[0] for o in row] for row in table] for table in STEPS], dtype=np.int64)
NONE = np.where(np.eye(4, dtype=bool), 0, 10**9)
ENDS = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
"""Roles of the empty turns that close a conversation in each state."""


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), 10**9)


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for roles in values(batch.column("roles")):
            m = NONE
            for r in roles:
                m = _times(m, COSTS[r])
            out.append(m.ravel().tolist())
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("at"), pa.array(out, pa.list_(pa.int64()))], ["conv_id", "at", "m"])


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The matrix of each run of neighbours."""
    for batch in batches:
        out = []
        for parts in values(batch.column("parts")):
            m = NONE
            for part in parts:
                m = _times(m, np.array(part["m"]).reshape(4, 4))
            out.append(m.ravel().tolist())
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("at"), pa.array(out, pa.list_(pa.int64()))], ["conv_id", "at", "m"])


_ENDS = "conv_id long, at long, before int, after int, last boolean, cost long"


def _rows_of(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(types)], [c.split()[0] for c in _ENDS.split(", ")])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States of the least path before and after a whole conversation."""
    for batch in batches:
        rows = []
        for conv, at, m in zip(*(values(batch.column(c)) for c in ("conv_id", "at", "m")), strict=True):
            closing = np.array(m).reshape(4, 4)[START] + np.array([INSERT * len(ENDS[s]) for s in range(4)])
            rows.append((conv, at, START, int(closing.argmin()), True, int(closing.min())))
        yield _rows_of(rows)


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states of a run's least path before and after each of its parts."""
    for batch in batches:
        rows = []
        for r in zip(*(values(batch.column(c)) for c in ("conv_id", "parts", "before", "after", "last", "cost")), strict=True):
            conv, parts, before, state, last, cost = r
            mats = [np.array(p["m"]).reshape(4, 4) for p in parts]
            least = [np.where(np.arange(4) == before, 0, 10**9)]
            for m in mats:
                least.append((least[-1][:, None] + m).min(axis=0))
            for i in range(len(mats) - 1, -1, -1):
                left = int((least[i] + mats[i][:, state]).argmin())
                rows.append((conv, parts[i]["at"], left, state, last and i == len(mats) - 1, cost))
                state = left
        yield _rows_of(rows)


def _segment_ends(matrices: DataFrame) -> DataFrame:
    """The least path's states at the ends of every segment of ``matrices(conv_id, at, m)``.

    Up: the matrices of ``FAN`` neighbours at a time are multiplied, until a
    conversation is one. Down: a run's states at its ends give those of its parts.
    No row holds more than ``FAN`` matrices.
    """
    level = staged(matrices, "chat-matrices")
    top, runs = level.agg(F.max("at")).first()[0] or 0, []
    while True:
        parts = F.sort_array(F.collect_list(F.struct("at", "m")))
        runs.append(staged(level.groupBy("conv_id", F.expr(f"at div {FAN}").alias("at")).agg(parts.alias("parts")), "chat-runs"))
        level = runs[-1].mapInArrow(_products, "conv_id long, at long, m array<long>")
        top //= FAN
        if not top:
            break
    ends = level.mapInArrow(_whole, _ENDS)
    for run in reversed(runs):
        named = ends.withColumnsRenamed({"conv_id": "c", "at": "a"})
        both = run.join(named, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("at") == F.col("a"))).drop("c", "a")
        ends = both.mapInArrow(_within, _ENDS)
    return ends


def repair(roles: list[int], before: int = START, after: int | None = None) -> tuple[int, list[tuple[str, int, tuple[int, ...]]]]:
    """Least cost from state ``before`` to ``after``, and for each turn its action,
    role and inserted roles; without ``after``, to a closed conversation."""
    least = [np.where(np.arange(4) == before, 0, 10**9)]
    for r in roles:
        least.append((least[-1][:, None] + COSTS[r]).min(axis=0))
    closing = least[-1] + np.array([INSERT * len(ENDS[s]) for s in range(4)])
    state = int(closing.argmin()) if after is None else after
    cost = int(closing[state] if after is None else least[-1][state])
    out = []
    for i in range(len(roles) - 1, -1, -1):
        prev = int((least[i] + COSTS[roles[i]][:, state]).argmin())
        _, action, path = STEPS[roles[i]][prev][state]
        out.append((action, state, path))
        state = prev
    return cost, out[::-1]


def _trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of output turns. ``out`` counts the turns emitted in the segment; 0 is the one before it."""
    names = ["conv_id", "seg", "out", "seq", "role", "action", "text", "cost"]
    for batch in batches:
        rows: list[tuple] = []
        for r in batch.to_pylist():
            n = seq = 0
            _, steps = repair([t["r"] for t in r["turns"]], r["before"], r["after"])
            for turn, (action, role, path) in zip(r["turns"], steps, strict=True):
                for empty in path:
                    n += 1
                    rows.append((r["conv_id"], r["seg"], n, (seq := seq + 1), empty, "insert", "", r["cost"]))
                n += action == "emit"
                action = action if action == "merge" else "keep" if role == turn["r"] else "relabel"
                rows.append((r["conv_id"], r["seg"], n, (seq := seq + 1), role, action, turn["text"], r["cost"]))
            for empty in ENDS[r["after"]] if r["last"] else ():
                n += 1
                rows.append((r["conv_id"], r["seg"], n, (seq := seq + 1), empty, "insert", "", r["cost"]))
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in rows], t) for j, t in enumerate(types)], names)


def _role_codes(role: str):
    name = F.lower(F.trim(F.col(role)))
    for other, known in SYNONYMS.items():
        name = F.when(name == other, known).otherwise(name)
    code = F.lit(UNKNOWN)
    for i, known in enumerate(ROLES):
        code = F.when(name == known, i + 1).otherwise(code)
    return code


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of a sorted partition with ``n``, the place of a row among the
    partition's rows of its conversation, and ``first``, whether that is the first one."""
    last, seen, first = None, 0, True
    for batch in batches:
        if batch.num_rows == 0:
            continue
        conv = batch.column("conv_id")
        null = conv.is_null().to_numpy(zero_copy_only=False)
        value = conv.fill_null(0).to_numpy(zero_copy_only=False)
        changed = np.flatnonzero((value[1:] != value[:-1]) | (null[1:] != null[:-1])) + 1
        starts, at = np.concatenate([[0], changed]), np.arange(batch.num_rows)
        if (key := (null[0], value[0])) != last:
            first, seen = last is None, 0
        which = np.searchsorted(starts, at, side="right") - 1
        n = at - starts[which] + np.where(which == 0, seen, 0)
        firsts = (which == 0) & first
        last, seen, first = (null[-1], value[-1]), int(n[-1]) + 1, bool(firsts[-1])
        names = [*batch.schema.names, "n", "first"]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64()), pa.array(firsts)], names)


def _in_order(turns: DataFrame, segment: int) -> DataFrame:
    """``turns`` with ``seg``: the place of a row in its conversation, by ``segment``.

    Sorted ranges of rows are numbered each by itself. A conversation that goes over
    several ranges is the first one in all but the range it starts in, so a range
    needs one number more: the rows of its first conversation in the ranges before.
    """
    order = ["conv_id", "turn", "role", "text", "tie"]  # by the tie, equal rows go to several ranges
    tied = staged(turns.withColumn("tie", F.monotonically_increasing_id()), "chat-turns")
    parts = int(tied.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = tied.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("tie")
    schema = "conv_id long, turn long, role string, text string, r int, n long, first boolean"
    numbered = staged(ranges.mapInArrow(_numbered, schema).withColumn("part", F.spark_partition_id()), "chat-order")
    # One row per range and conversation; of those only the first and the last of a range can go over its ends.
    sizes = numbered.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("size"), F.max("first").alias("first"))
    ahead = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", "first", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("offset"))
    offsets = offsets.where("first and offset > 0").select("part", F.lit(True).alias("first"), "offset")
    placed = numbered.join(F.broadcast(offsets), ["part", "first"], "left")  # one row per range at most
    return placed.withColumn("seg", F.floor((F.col("n") + F.coalesce("offset", F.lit(0))) / segment).cast("long"))


def format_chats(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The turns of each conversation after the cheapest repair, rendered.

    ``conversations`` has ``conv_id, turn, role, text``. One row per output
    turn: ``conv_id, out_turn`` (from 0)``, segment, role, actions`` (what was done with
    each piece, in order, joined by commas: keep, relabel, merge, insert)``,
    n_source`` (input turns in it)``, cost`` (of the whole conversation)``,
    rendered``. Turns are taken by ``turn`` (nulls first), of equal ones by
    role and text, so repeated rows are merged like any turns of one role. A
    turn that goes over the end of a segment of the input is a row in each of them, in the order of
    ``segment``: its texts may be any number, and the rows' ``rendered`` put together are the turn. A
    null text is empty; merged texts are joined by line feeds; markers within a
    text are defused by a space. A null or unknown role can become any. Rows
    with a null ``conv_id`` are one conversation. Other columns are not read.
    """
    ship_package(conversations.sparkSession)
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), _role_codes("role").alias("r"),
    )
    turns = _in_order(turns, segment).select("conv_id", "seg", F.struct("turn", "role", "text", "r").alias("t"))
    segs = turns.groupBy("conv_id", "seg").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    segs = staged(segs, "chat-segments")
    matrices = segs.select("conv_id", F.col("seg").alias("at"), F.col("turns.r").alias("roles")).mapInArrow(_matrices, "conv_id long, at long, m array<long>")
    ends = _segment_ends(matrices).withColumnsRenamed({"conv_id": "c", "at": "s"})
    joined = segs.join(ends, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("seg") == F.col("s"))).drop("c", "s")
    pieces = joined.mapInArrow(_trace, "conv_id long, seg long, out int, seq int, role int, action string, text string, cost long")
    pieces = staged(pieces, "chat-pieces")
    ahead = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    # One row per segment and conversation. A segment that begins inside a turn has pieces of number 0.
    sizes = pieces.groupBy("conv_id", "seg").agg(F.max("out").cast("long").alias("n"), (F.min("out") == 0).alias("inside"))
    sizes = staged(sizes, "chat-sizes")
    base = sizes.select(F.col("conv_id").alias("c"), F.col("seg").alias("s"), "n", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    later = sizes.where("inside").select(F.col("conv_id").alias("lc"), (F.col("seg") - 1).alias("ls"), F.lit(True).alias("goes_on"))
    base = base.join(later, F.col("c").eqNullSafe(F.col("lc")) & (F.col("s") == F.col("ls")), "left")
    placed = pieces.join(base, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("seg") == F.col("s")))
    placed = placed.withColumn("out_turn", F.col("base") + F.col("out") - 1)
    goes_on = (F.col("out") == F.col("n")) & F.coalesce("goes_on", F.lit(False))
    merged = placed.groupBy("conv_id", "out_turn", F.col("seg").alias("segment")).agg(
        F.max("role").alias("role"), F.max("cost").alias("cost"), F.sort_array(F.collect_list(F.struct("seq", "action", "text"))).alias("p"),
        (F.max("out") > 0).alias("begins"), F.max(~goes_on).alias("closes"),
    )
    safe = F.transform(
        F.filter("p", lambda x: x["action"] != "insert"),
        lambda x: F.replace(F.replace(x["text"], F.lit(OPEN), F.lit("<| im_start|>")), F.lit(CLOSE), F.lit("<| im_end|>")),
    )
    role = F.element_at(F.array(*(F.lit(r) for r in ROLES)), F.col("role"))
    return merged.select(
        "conv_id",
        "out_turn",
        "segment",
        role.alias("role"),
        F.array_join("p.action", ",").alias("actions"),
        F.size(safe).cast("long").alias("n_source"),
        "cost",
        F.concat(
            F.when(F.col("begins"), F.concat(F.lit(OPEN), role, F.lit("\n"))).otherwise("\n"),
            F.array_join(safe, "\n"),
            F.when(F.col("closes"), f"{CLOSE}\n").otherwise(""),
        ).alias("rendered"),
    )
