"""Chat formatting of logged conversations, snapshots collapsed first.

Logs often hold a conversation several times, each time one turn longer. A rolling hash names
every turn prefix; a conversation whose whole hash is a proper prefix of another is a snapshot, and an
anti-join drops it. What remains is rendered with turn markers.

The rolling hash is the exclusive or of the hashes of (position, role, text) up to a turn, twice 64
bits. Being a sum, it needs no conversation in one task: a global sort numbers the turns, ``PART`` consecutive ones form a
cell, cells are summed first, then turns inside each cell. Rendering gives one row per conversation and
part of ``part`` turns for the same reason, whatever the turns' own numbers are; ``PART`` turns or fewer are one row.

Defined results: turns in order of ``turn``, null first; rows that repeat a turn count once; a null
conversation id is a conversation of its own; null texts are empty and null roles ``unknown``; of equal
conversations the smallest id (null last) stays; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratica.llm.common import numbered, written

#: Consecutive turns that are summed, and rendered, together.
PART = 1024
#: Other names of the three roles, and the markers of a turn.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "ai": "assistant", "model": "assistant"}
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def role_name(role: Column) -> Column:
    name = F.lower(F.trim(role))
    for other, usual in ROLES.items():
        name = F.when(name == other, usual).otherwise(name)
    return F.when(F.coalesce(name, F.lit("")) == "", "unknown").otherwise(name)


def placed(logs: DataFrame) -> DataFrame:
    """The different turns of each conversation: conv, conv_id, role, text, position from 1, cell, and hashes h1, h2 of all but the id."""
    turns = logs.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), "conv_id", "turn",
        role_name(F.col("role")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()
    said = [F.xxhash64(F.lit(salt), "role", "text").alias(name) for salt, name in ((1, "h1"), (2, "h2"))]
    rows = numbered(turns.select("*", *said), ["conv", "turn", "h1", "h2"], "chat-turns")
    first = rows.groupBy("conv").agg(F.min("place").alias("first"))
    rows = rows.join(first, "conv").withColumn("position", F.col("place") - F.col("first") + 1)
    cell = F.floor((F.col("position") - 1) / PART).alias("cell")
    hashes = [F.xxhash64("position", h).alias(h) for h in ("h1", "h2")]
    return written(rows.select("conv", "conv_id", "role", "text", "position", cell, *hashes), "chat-placed")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """One row per turn of :func:`placed`: conv, conv_id, position, and the hashes p1, p2 of the turns up to it."""
    cells = Window.partitionBy("conv").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = turns.groupBy("conv", "cell").agg(*(F.expr(f"bit_xor({h})").alias(h) for h in ("h1", "h2")))
    earlier = [F.coalesce(F.expr(f"bit_xor({h})").over(cells), F.lit(0)).alias(f"b{h[1]}") for h in ("h1", "h2")]
    rolling = Window.partitionBy("conv", "cell").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    up_to = [F.expr(f"bit_xor({h})").over(rolling).alias(f"p{h[1]}") for h in ("h1", "h2")]
    return (
        turns.select("conv", "conv_id", "cell", "position", *up_to)
        .join(sums.select("conv", "cell", *earlier), ["conv", "cell"])
        .select("conv", "conv_id", "position", *(F.col(f"p{i}").bitwiseXOR(F.col(f"b{i}")).alias(f"p{i}") for i in "12"))
    )


def maximal(turns: DataFrame) -> DataFrame:
    """The conversations (conv, conv_id, n_turns) of :func:`placed` turns that are no proper prefix and no copy of another."""
    prefixes = written(prefix_hashes(turns), "chat-prefixes")
    ends = prefixes.groupBy("conv").agg(F.max("position").alias("n_turns"))
    with_end = prefixes.join(ends, "conv")
    whole = with_end.where(F.col("position") == F.col("n_turns"))
    # copies fold on the map side; the anti-join then meets every hash once
    first = whole.groupBy("n_turns", "p1", "p2").agg(
        F.min(F.struct(F.col("conv_id").isNull().alias("last"), "conv_id", "conv")).alias("kept")
    )
    proper = with_end.where(F.col("position") < F.col("n_turns")).select(F.col("position").alias("n_turns"), "p1", "p2")
    kept = first.join(proper.distinct(), ["n_turns", "p1", "p2"], "left_anti")
    return kept.select("kept.conv", "kept.conv_id", "n_turns")


def rendered(logs: DataFrame, part: int = PART) -> DataFrame:
    """The maximal conversations as text: conv_id, n_turns, part from 0, and the text of the part's turns.

    Marker strings inside a text are broken by a space, so that no text can open or close a turn.
    """
    turns = placed(logs)
    kept = written(maximal(turns).select("conv", "n_turns"), "chat-kept")
    number = F.floor((F.col("position") - 1) / part).alias("part")
    own = F.array_sort(F.collect_list(F.struct("position", "role", "text")))
    shown = F.transform(
        "turns",
        lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), F.replace(t["text"], F.lit("<|"), F.lit("< |")), F.lit(CLOSE)),
    )
    parts = turns.select("conv", "conv_id", "position", "role", "text", number).join(kept, "conv")
    parts = parts.groupBy("conv", "conv_id", "n_turns", "part").agg(own.alias("turns"))
    return parts.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), "part", F.array_join(shown, "\n").alias("text"))
