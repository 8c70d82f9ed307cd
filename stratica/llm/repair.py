"""Repair of a conversation's structure by its cheapest edits.

The turns of a conversation are to read system (at most one, first), then user and assistant in turn. A shortest-path
programme finds the cheapest edits: keep, change the role, delete, insert an empty turn. Its state is what the
repaired text ends with; costs are computed from the end backwards, edits are chosen walking forwards.

Keeping the cost vector of every row would take memory in proportion to the conversation. Only every
⌈√n⌉-th vector is kept: a first pass streams the rows from the last to the first and emits these checkpoints, a second
streams them forwards, holds one block of ⌈√n⌉ rows, computes the block's vectors again from the checkpoint behind
it, and walks on. Of the edits that are tight (their cost plus the rest's is the least), the first in ASCII order
is taken, which gives the least sequence of letters: D(elete), I(nsert), K(eep), R(ole). From one state a letter leads
to one state only, so the choice never has to be taken back.

A digest of the repaired text needs its lines in order, so a conversation passes through one task, as a stream: a
task holds √n rows of it and the letters of its edits, one byte a row.

Defined results: a null id is a conversation of its own; nulls elsewhere read as one space (a turn that is null sorts
first and counts for no gap); rows of the same turn stand in order of role and text; a conversation whose rows are all
dropped has zeros, no edits and the digest of an empty text; no rows give no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratica.llm.common import written

#: Costs of the edits, and what a truncated turn adds that is not deleted.
KEEP, ROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: What the repaired turns end with: nothing, system, user, assistant. A conversation may end with nothing or assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_TURNS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = ("su", "ua", "au")
_NEVER = 1 << 60
BLANK, DUPLICATE, CUT = 1, 2, 3
_REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _next(state: int, initial: str) -> int | None:
    """The state after keeping a turn with this initial; None where it can't stand here."""
    if initial == "s":
        return SYSTEM if state == START else None
    wanted = _TURNS[state]
    return wanted if initial == _NAMES[wanted][0] else None


def settled(costs: list[int]) -> list[int]:
    """Cost vector after insertions, of which two reach every state."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[_TURNS[s]]) for s, c in enumerate(costs)]
    return costs


END = tuple(settled([0, _NEVER, _NEVER, 0]))


def before(initial: str, fault: int, costs: list[int]) -> list[int]:
    """The cost vector in front of a row, from the one behind it."""
    out = [DELETE + c for c in costs]
    if fault not in (BLANK, DUPLICATE):
        extra = TRUNCATED if fault == CUT else 0
        for s in range(4):
            to = _next(s, initial)
            kept = KEEP + costs[to] if to is not None else _NEVER
            out[s] = min(out[s], extra + kept, extra + ROLE + costs[_TURNS[s]])
    return settled(out)


def edit(state: int, cost: int, row: tuple[str, int] | None, behind: list[int], here: list[int]) -> tuple[str, int]:
    """The ASCII-least tight edit and the state it leads to. ``row`` is (initial, fault), ``behind`` its costs afterwards."""
    if row is not None and cost == DELETE + behind[state]:
        return "D", state
    if cost == INSERT + here[_TURNS[state]]:
        return "I", _TURNS[state]
    initial, fault = row
    extra = TRUNCATED if fault == CUT else 0
    to = _next(state, initial)
    if fault not in (BLANK, DUPLICATE):
        if to is not None and cost == extra + KEEP + behind[to]:
            return "K", to
        if cost == extra + ROLE + behind[_TURNS[state]]:
            return "R", _TURNS[state]
    raise AssertionError("no tight edit")


def walked(rows: list[tuple[str, str, int]], state: int, end: list[int], last: bool) -> tuple[str, list[str], int, int]:
    """Edits and repaired lines of one block ``(role, text, fault)``, the state behind it and the cost in front of it.

    ``end`` is the checkpoint behind the block; ``last`` says that the conversation ends there.
    """
    vectors = [list(end)]
    for role, _, fault in reversed(rows):
        vectors.append(before(role[:1], fault, vectors[-1]))
    vectors.reverse()
    letters, lines, at, cost = [], [], 0, vectors[0][state]
    while at < len(rows) or (last and not (state in (START, ASSISTANT) and vectors[at][state] == 0)):
        role, text, fault = rows[at] if at < len(rows) else ("", "", 0)
        row = (role[:1], fault) if at < len(rows) else None
        letter, to = edit(state, vectors[at][state], row, vectors[at + 1] if row else [], vectors[at])
        letters.append(letter)
        if letter == "K":
            lines.append(f"{role}:{text}")
        elif letter == "R":
            lines.append(f"{_NAMES[to]}:{text}")
        elif letter == "I":
            lines.append(f"{_NAMES[to]}:")
        state, at = to, at + (letter != "I")
    return "".join(letters), lines, state, cost


def fault_of(text: Column, seen: Column) -> Column:
    """The first fault of a row: blank, duplicate (``seen``), truncated; 0 if none."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    ended = F.substring(trimmed, -1, 1).isin(".", "!", "?")
    return F.when(trimmed == "", BLANK).when(seen, DUPLICATE).when(~ended, CUT).otherwise(0)


def damaged(logs: DataFrame) -> DataFrame:
    """The logs with damage that depends on (conv_id, turn) alone; ``copy`` numbers a row and its repeat.

    By the checksum's remainder: 0 drops the row, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = logs.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        space("role").alias("role"), space("text").alias("text"), kind.alias("kind"),
    ).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(copies).alias("copy"),
    )


def judged(turns: DataFrame) -> DataFrame:
    """``turns(conv_id, turn, role, text, copy)`` with ``fault``, position ``at`` from 0 and block ``width``."""
    order = [F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(order[0], "copy")) > 1
    rows = turns.withColumn("fault", fault_of(F.col("text"), seen))
    sizes = rows.groupBy("conv_id").agg(F.ceil(F.sqrt(F.count("*"))).cast("long").alias("width"))
    own = Window.partitionBy("conv_id").orderBy(*order)
    placed = rows.withColumn("at", F.row_number().over(own).cast("long") - 1).alias("r")
    same = F.col("r.conv_id").eqNullSafe(F.col("s.conv_id"))
    return placed.join(sizes.alias("s"), same).select("r.*", "width")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _checkpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (conv_id, at, width, initial, fault), each conversation's last first: the vectors in front of every block but the first."""
    out: list[tuple] = []

    def packed() -> pa.RecordBatch:
        ids, blocks, costs = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(blocks, pa.int64()), pa.array(costs, pa.list_(pa.int64()))], names=["conv_id", "block", "costs"]
        )

    for conv, rows in groupby(_streamed(batches), key=lambda r: r[0]):
        costs = list(END)
        for _, at, width, initial, fault in rows:
            costs = before(initial, fault, costs)
            if at % width == 0 and at:
                out.append((conv, at // width - 1, costs))
        if len(out) > 4096:
            yield packed()
            out.clear()
    if out:
        yield packed()


def _blocks(rows: Iterator[tuple]) -> Iterator[tuple[list[tuple], list[int] | None]]:
    """The rows of each block of one conversation, and the checkpoint behind it (None behind the last)."""
    for _, part in groupby(rows, key=lambda r: r[1]):
        part = list(part)
        costs = part[0][-1]
        yield (part[1:], costs) if costs is not None else (part, None)


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One report per conversation from its rows (conv_id, block, turn, role, text, fault, costs) in order; a block's checkpoint stands before it."""
    out: list[tuple] = []
    names = [f.split()[0] for f in _REPORT.split(", ")]

    def packed() -> pa.RecordBatch:
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    for conv, rows in groupby(_streamed(batches), key=lambda r: r[0]):
        faults, illegal, cost, state = [0, 0, 0, 0], 0, None, START
        turns, lowest, turn_before, initial_before = 0, None, None, None
        audit, digest, first = [], sha256(), True
        for block, costs in _blocks(rows):
            for _, _, turn, role, _, fault, _ in block:
                faults[fault] += 1
                initial = role[:1]
                illegal += initial_before is not None and initial_before + initial not in _LEGAL
                initial_before = initial
                if turn is not None and turn != turn_before:
                    turns, turn_before, lowest = turns + 1, turn, turn if lowest is None else lowest
            letters, lines, state, here = walked([(r[3], r[4], r[5]) for r in block], state, list(costs or END), costs is None)
            cost = here if cost is None else cost
            audit.append(letters)
            for line in lines:
                digest.update((line if first else "\n" + line).encode())
                first = False
        gaps = 0 if lowest is None else turn_before - lowest + 1 - turns
        out.append((conv, gaps, faults[BLANK], faults[DUPLICATE], faults[CUT], illegal, cost, "".join(audit), digest.hexdigest()))
        if len(out) > 1024:
            yield packed()
            out.clear()
    if out:
        yield packed()


def repaired(logs: DataFrame, turns: DataFrame | None = None) -> DataFrame:
    """One report per conversation of ``logs(conv_id, turn, role, text)``: faults found, cheapest edits, digest of the repaired text.

    ``turns`` are the rows to repair, as :func:`damaged` gives them by default.
    """
    rows = written(judged(damaged(logs) if turns is None else turns), "repair-rows")
    block = F.floor(F.col("at") / F.col("width")).cast("long").alias("block")
    latest = rows.select("conv_id", "at", "width", F.substring("role", 1, 1).alias("initial"), "fault")
    latest = latest.repartition("conv_id").sortWithinPartitions("conv_id", F.col("at").desc())
    marks = written(latest.mapInArrow(_checkpoints, "conv_id long, block long, costs array<long>"), "repair-checkpoints")
    nothing = lambda kind: F.lit(None).cast(kind)
    lines = rows.select("conv_id", block, "at", "turn", "role", "text", "fault", nothing("array<long>").alias("costs"))
    marks = marks.select(
        "conv_id", "block", F.lit(-1).cast("long").alias("at"), nothing("long").alias("turn"), nothing("string").alias("role"),
        nothing("string").alias("text"), nothing("int").alias("fault"), "costs",
    )
    both = lines.unionByName(marks).repartition("conv_id").sortWithinPartitions("conv_id", "block", "at").drop("at")
    reports = both.mapInArrow(_reports, _REPORT).alias("r")
    every = logs.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("c")
    out = every.join(reports, F.col("c.conv_id").eqNullSafe(F.col("r.conv_id")), "left")
    counts = [F.coalesce(f"r.{n}", F.lit(0).cast("long")).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit(""), 256)
    return out.select("c.conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
