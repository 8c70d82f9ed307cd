"""Mixing sources to target weights by weighted fair queueing.

Sources compete for a budget like flows for a link. Each source's documents are shuffled, cut into
packets of at most ``PACKET`` words and stamped with a virtual finish time: words of the source up to
the packet's end, over the source's target. Packets of all sources, repeats included, are served
in the order of these stamps until the budget is used up. What a source was served says which of its
documents are taken, how often, and how much of the one at the edge.

Nothing here gathers a source in one task. A running sum is taken in two steps: over cells of a
source (the first three hex digits of the shuffle key, hence at most 4,096), then inside each cell.
Virtual time is divided the same way, and again inside the slot where the budget ends, so that only
the last sliver needs its packets in full order.

Defined results: a null or blank text has size 0 and is taken for 0 words; a null source is a source
of its own, the last in code-point order; rows that agree in source, id and size share what they are
served equally; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratica.llm.common import spare, words, written

PACKET = 1000
REPEATS = 3
WEIGHTS = (5, 2, 1)
#: Slots of a unit of virtual time, and of each of these slots in turn.
SLOTS = 1024
_UNTIL_NOW = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


def document_size(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def shuffle_key(doc_id: Column) -> Column:
    """A fixed pseudo-random order of the documents; every rerun shuffles alike."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def ranked(sources: DataFrame) -> DataFrame:
    """Distinct sources numbered from 0 in code-point order, null last, without gathering them.

    A global sort gives each partition a run of sources; the runs' lengths give each its offset.
    """
    order = sources.orderBy(F.col("source").asc_nulls_last()).withColumn("_id", F.monotonically_increasing_id())
    order = written(order.withColumn("_run", F.shiftright("_id", 33)), "mix-sources")
    runs = order.groupBy("_run").agg(F.count("*").alias("_n"))
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_run").rowsBetween(*_BEFORE)), F.lit(0)))
    place = F.col("_before") + F.col("_id").bitwiseAND((1 << 33) - 1)
    return order.join(runs, "_run").select("source", "source_size", place.alias("place"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Words each source should give: its weight's share of all words, at most ``repeats`` times its size.

    What a capped source cannot give is shared again by weight until no source is above its cap.
    ``sizes`` has ``source`` and ``source_size``. Only sums over the sources reach the driver.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    table = written(ranked(sizes).select("source", "source_size", weight.cast("long").alias("weight")), "mix-weights")
    cap = repeats * F.col("source_size")
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, capped = 0.0, -1
    while True:
        above = cap <= F.col("weight") * F.lit(level)
        given, shares, count = table.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
            F.count(F.when(above, 1)),
        ).first()
        if count == capped or not shares:
            break
        level, capped = (total - given) / shares, count
    fair = F.col("weight") * F.lit(level)
    return table.select("source", "source_size", F.when(cap <= fair, cap.cast("double")).otherwise(fair).alias("target"))


def _same_source(left: str, right: str) -> Column:
    return F.col(f"{left}.source").eqNullSafe(F.col(f"{right}.source"))


def placed(sized: DataFrame) -> DataFrame:
    """Where each entry starts in its source's shuffled order, in words.

    ``sized`` has source, key, doc_id and size. Rows that agree in all of them form one entry, so
    that the order is total.
    """
    entries = sized.where("size > 0").groupBy("source", "key", "doc_id", "size").agg(F.sum("size").alias("words"))
    entries = written(entries.withColumn("cell", F.substring("key", 1, 3)), "mix-entries")
    cells = entries.groupBy("source", "cell").agg(F.sum("words").alias("words"))
    earlier = F.sum("words").over(Window.partitionBy("source").orderBy("cell").rowsBetween(*_BEFORE))
    cells = cells.withColumn("before", F.coalesce(earlier, F.lit(0)))
    inside = Window.partitionBy("source", "cell").orderBy("key", "doc_id", "size").rowsBetween(*_UNTIL_NOW)
    entries = entries.withColumn("start", F.sum("words").over(inside) - F.col("words"))
    return (
        entries.alias("e")
        .join(cells.alias("c"), _same_source("e", "c") & (F.col("e.cell") == F.col("c.cell")))
        .select("e.source", "key", "doc_id", "size", "e.words", (F.col("start") + F.col("before")).alias("start"))
    )


def packets(places: DataFrame, goals: DataFrame, packet: int, repeats: int) -> DataFrame:
    """The packets of all rounds with their virtual finish times."""
    rounds = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    cuts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("words") - 1, F.lit(packet).cast("long")))
    end = F.col("round") * F.col("source_size") + F.col("start") + F.col("cut") + F.col("part")
    return (
        places.alias("p")
        .join(goals.alias("g"), _same_source("p", "g"))
        .select("p.source", "source_size", "target", "words", "start", rounds.alias("round"))
        .withColumn("cut", cuts)
        .withColumn("part", F.least(F.lit(packet).cast("long"), F.col("words") - F.col("cut")))
        .select("source", "part", (end / F.col("target")).alias("finish"))
    )


def served(queue: DataFrame, budget: int) -> DataFrame:
    """Words each source is served when the queue is worked off by finish time up to the budget."""
    sliver, used, ahead = queue, 0, []
    for scale in (SLOTS, SLOTS * SLOTS):
        # whatever ends later than any budget can is one slot
        slot = F.least(F.floor(F.col("finish") * scale), F.lit(4 * scale))
        sums = sliver.groupBy(slot.alias("slot")).agg(F.sum("part").alias("part"))
        # at most one slot of each kind is kept open: the first at whose end the budget is used up
        line = Window.orderBy("slot").rowsBetween(*_UNTIL_NOW)
        edge = sums.withColumn("end", F.sum("part").over(line) + used).where(F.col("end") >= budget)
        edge = edge.orderBy("slot").first()
        ahead.append(sliver.where(slot < edge["slot"]))
        sliver, used = sliver.where(slot == edge["slot"]), edge["end"] - edge["part"]
    order = Window.orderBy("finish", F.col("source").asc_nulls_last(), "part").rowsBetween(*_UNTIL_NOW)
    room = budget - used - (F.sum("part").over(order) - F.col("part"))
    last = sliver.withColumn("part", F.greatest(F.lit(0).cast("long"), F.least(F.col("part"), room)))
    taken = ahead[0].unionByName(ahead[1]).select("source", "part").unionByName(last.select("source", "part"))
    return taken.groupBy("source").agg(F.sum("part").alias("served"))


def plan(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, packet: int = PACKET
) -> DataFrame:
    """One row per source: source, source_size, target, served, and up to where the last round reaches.

    ``docs`` has doc_id, text and source. ``edge`` is the entry at which the last, incomplete round
    ends and ``edge_words`` what each of its rows still gives.
    """
    thin = docs.select("source", shuffle_key(F.col("doc_id")).alias("key"), "doc_id", document_size(F.col("text")).alias("size"))
    thin = written(thin, "mix-sizes")
    goals = written(targets(thin.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats), "mix-goals")
    budget = goals.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    places = written(placed(thin), "mix-places")
    shares = goals.withColumn("served", F.lit(0).cast("long"))
    if budget:
        given = served(packets(places, goals, packet, repeats), budget)
        shares = goals.alias("g").join(given.alias("s"), _same_source("g", "s"), "left")
        shares = shares.select("g.source", "source_size", "target", F.coalesce("served", F.lit(0).cast("long")).alias("served"))
    shares = written(shares, "mix-served")
    rest = F.col("served") % F.when(F.col("source_size") > 0, F.col("source_size"))
    edges = (
        places.alias("p")
        .join(shares.where("source_size > 0").withColumn("rest", rest).alias("s"), _same_source("p", "s"))
        .where((F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("start") + F.col("words")))
        .select(
            "p.source",
            F.struct("key", "doc_id", "size").alias("edge"),
            F.floor((F.col("rest") - F.col("start")) / (F.col("words") / F.col("size"))).cast("long").alias("edge_words"),
        )
    )
    joined = shares.alias("s").join(edges.alias("e"), _same_source("s", "e"), "left")
    return written(joined.select("s.source", "source_size", "target", "served", "edge", "edge_words"), "mix-plan")


def mixed(docs: DataFrame, sources: DataFrame, name: str = "mix") -> DataFrame:
    """``docs`` with a struct column ``name``: size, source_size, target and the words taken.

    Only the plan's row of the document's source is needed, so no text is shuffled unless the
    sources themselves are too many to broadcast. ``taken`` counts repeats: ``taken / size`` rounds.
    """
    if spare(docs, name) != name:
        raise ValueError(f"the documents already have a column {name}")
    facts = F.struct(
        document_size(F.col("d.text")).alias("size"), "s.source_size", "s.target", "s.served", "s.edge", "s.edge_words"
    )
    joined = docs.alias("d").join(sources.alias("s"), _same_source("d", "s")).select("d.*", facts.alias(name))
    size, edge = F.col(f"{name}.size"), F.col(f"{name}.edge")
    own = F.struct(shuffle_key(F.col("doc_id")).alias("key"), F.col("doc_id"), size.alias("size"))
    last = F.when(own.eqNullSafe(edge), F.col(f"{name}.edge_words")).when(own < edge, size).otherwise(0)
    rounds = F.floor(F.col(f"{name}.served") / F.col(f"{name}.source_size")).cast("long")
    taken = F.when(size > 0, rounds * size + last).otherwise(0).cast("long")
    mix = F.struct(size.alias("size"), F.col(f"{name}.source_size"), F.col(f"{name}.target"), taken.alias("taken"))
    return joined.withColumn(name, mix)
