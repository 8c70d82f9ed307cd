"""Benchmark decontamination with spaced seeds.

A seed compares five tokens of a short span and ignores the others, so a copy with changed words
still agrees at a seed somewhere. Seeds of test items meet seeds of documents in a hash join; around each
hit item and document are compared token by token along the hit's diagonal, and a document is
contaminated where some window of ``WINDOW`` tokens agrees in at least ``AGREE``.

The two masks are lossless for these numbers: whichever two of twelve tokens differ, one of the masks
fits between them (a test tries all cases). So the join finds every window that the rule means.

Defined results: tokens are runs of letters and digits, lower-cased; in scripts written without spaces each letter is a
token; a null or empty text has none; an item of fewer than 12 tokens must occur whole and unchanged (``shortest`` leaves
out items of fewer tokens than that); repeated documents or items each give their own row; no items or no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratica.llm.common import let, spare, written

#: 1 compares a token, 0 ignores it.
MASKS = ("111011", "11010011")
WINDOW = 12
AGREE = 10
#: Items of fewer tokens are not searched.
SHORTEST = 1
#: Unicode scripts written without spaces between words.
UNSPACED = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")
#: Seeds of test items are broadcast up to this many rows (some 60 MB); beyond it the join is left to Spark.
BROADCAST_SEEDS = 1_000_000


def tokens(text: Column) -> Column:
    """64-bit hashes of the tokens, in order."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    # all of them lie above U+0E00: other letters need no look at their script
    alone = r"[\x{E00}-\x{10FFFF}&&[" + "".join(rf"\p{{Is{script}}}" for script in UNSPACED) + "]]"
    apart = F.when(lower.rlike(alone), F.regexp_replace(lower, f"({alone})", " $1 ")).otherwise(lower)
    parts = F.split(apart, r"[^\p{L}\p{N}]+")
    # punctuation at either end of the text leaves an empty string there
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seed(mask: str, array: str = "tokens", at: str = "at") -> Column:
    """Hash of the tokens under the ones of a mask laid at position ``at``; null beyond the end."""
    picked = [F.get(array, F.col(at) + i) for i, bit in enumerate(mask) if bit == "1"]
    fits = F.col(at) + len(mask) <= F.size(array)
    return F.when(fits, F.xxhash64(F.lit(mask), *picked))


def item_seeds(items: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Seeds of the test items: seed, item (a row number), its length, and where in it the seed lies."""
    long_enough = [
        F.when(F.size("tokens") >= WINDOW, _seed(mask)) for mask in MASKS
    ] + [
        F.when((F.size("tokens") == n) & (F.col("at") == 0), _seed("1" * n)) for n in range(shortest, WINDOW)
    ]
    spots = items.select("item", "tokens", F.posexplode("tokens").alias("at", "_token"))
    seeds = spots.select("item", F.size("tokens").alias("length"), "at", F.explode(F.array(*long_enough)).alias("seed"))
    return seeds.where("seed IS NOT NULL")


def hits(docs: DataFrame, seeds: DataFrame, short: list[int]) -> DataFrame:
    """Document tokens facing each item on every diagonal that has a seed in common.

    ``docs`` has row and tokens. One row per (row, item, diagonal): ``first`` is the item's token
    that faces ``facing[0]``.
    """
    masks = [*MASKS, *("1" * n for n in short)]
    spots = docs.select("row", "tokens", F.posexplode("tokens").alias("at", "_token"))
    spots = spots.select("row", "tokens", "at", F.explode(F.array(*map(_seed, masks))).alias("seed"))
    if seeds.count() <= BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)
    start = F.col("d.at") - F.col("s.at")  # where the item would begin in the document
    found = spots.alias("d").join(seeds.alias("s"), F.col("d.seed") == F.col("s.seed"))
    facing = F.slice("tokens", F.greatest(start, F.lit(0)) + 1, F.col("length") + F.least(start, F.lit(0)))
    found = found.select(
        "row", "item", start.alias("diagonal"), F.greatest(-start, F.lit(0)).alias("first"), facing.alias("facing")
    )
    # copies of a diagonal come from one document and so from one task: they fold before the shuffle
    return found.groupBy("row", "item", "diagonal").agg(F.first("first").alias("first"), F.first("facing").alias("facing"))


def contaminated(docs: DataFrame, items: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Rows of documents that hold a test item: doc_id, item_id, doc_at, item_at, agreeing, compared.

    One row for each document row, item and diagonal with a window that agrees; the positions are
    those of the first such window, in tokens; ``agreeing`` of ``compared`` facing tokens are equal.
    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are not read.
    """
    items = items.select("item_id", tokens(F.col("text")).alias("tokens"))
    items = written(items.withColumn("item", F.monotonically_increasing_id()), "leak-items")
    seeds = written(item_seeds(items, shortest), "leak-seeds")
    lengths = seeds.where(F.col("length") < WINDOW).select("length").distinct().collect()  # at most eleven
    rows = docs.select("doc_id", tokens(F.col("text")).alias("tokens"))
    rows = rows.select(F.struct("doc_id", F.monotonically_increasing_id().alias("n")).alias("row"), "tokens")
    found = hits(rows, seeds, sorted(r["length"] for r in lengths))
    facing = found.join(items, "item").withColumn("own", F.slice("tokens", F.col("first") + 1, F.size("facing")))
    equal = F.zip_with("own", "facing", lambda a, b: F.when(a == b, 1).otherwise(0))
    need = F.when(F.size("tokens") < WINDOW, F.size("tokens")).otherwise(AGREE)
    width = F.least(F.size("tokens"), F.lit(WINDOW))

    def windows(bits: Column) -> Column:
        """Positions from which ``width`` facing tokens agree often enough."""
        at = F.when(F.size(bits) >= width, F.sequence(F.lit(0), F.size(bits) - width)).otherwise(F.array().cast("array<int>"))
        total = lambda i: F.aggregate(F.slice(bits, i + 1, width), F.lit(0), lambda s, x: s + x)
        return F.filter(at, lambda i: total(i) >= need)

    facing = facing.withColumn("equal", equal)
    facing = facing.withColumn("windows", let(F.col("equal"), windows)).where(F.size("windows") > 0)
    return facing.select(
        F.col("row.doc_id").alias("doc_id"),
        "item_id",
        (F.col("diagonal") + F.col("first") + F.col("windows")[0]).cast("long").alias("doc_at"),
        (F.col("first") + F.col("windows")[0]).cast("long").alias("item_at"),
        F.aggregate("equal", F.lit(0), lambda s, x: s + x).cast("long").alias("agreeing"),
        F.size("equal").cast("long").alias("compared"),
    )


def clean(docs: DataFrame, items: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """The documents that hold no test item, columns unchanged.

    Rows are told apart by id and text: of an id that repeats, or is missing, only the rows that hold an item go.
    """
    id_ = F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    found = contaminated(docs.select(id_.alias("doc_id"), "text"), items, shortest).select("doc_id.*").distinct()
    tag = spare(docs, "text_hash")
    tagged = docs.withColumn(tag, F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col(f"d.{tag}") == F.col("f.hash"))
    return tagged.alias("d").join(written(found, "leak-found").alias("f"), same, "left_anti").drop(tag)
