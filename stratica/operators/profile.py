"""Column profiles: distinct counts and value tables of many columns in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DISTINCT_THRESHOLD = 50
TOP_VALUES = 20
#: Cells that values are counted in before they are told apart; a value is never more frequent than its cell.
CELLS = 1 << 16
#: A stored profile keeps the values of a column exactly while there are no more than these.
KEPT_VALUES = 1000
_SKETCH_BITS = 14


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value, size, n)`` for every distinct value, null included.

    ``size`` is the number a numeric value stands for, to sort by.

    One scan: each row is turned into its (column, value) cells, which are pre-aggregated before
    the shuffle. Cells are shuffled by column and value, so a column with one dominant value is as
    cheap as any other.
    """
    def size(c: str) -> Column:
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        return (F.col(c) if numeric else F.lit(None)).cast("double").alias("size")

    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), size(c)) for c in columns])
    return (
        df.select(F.explode(cells).alias("cell"))
        .groupBy(F.col("cell.column").alias("column"), F.col("cell.value").alias("value"), F.col("cell.size").alias("size"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def profile(
    df: DataFrame,
    columns: list[str],
    threshold: int = DISTINCT_THRESHOLD,
    top: int = TOP_VALUES,
) -> DataFrame:
    """Rows ``(column, distinct_count, listing, position, value, n)``.

    Null counts as a value. A column with at most ``threshold`` values lists all of them in order
    of value (nulls first); any other lists its ``top`` most frequent ones, ties by value.
    Both rankings are group-limited before their shuffle, and the distinct counts joined back are
    one row per profiled column.
    """
    counts = value_counts(df, columns)
    # counting over n keeps this branch on the same shuffle as the two rankings
    distinct = counts.groupBy("column").agg(F.count_if(F.col("n") > 0).alias("distinct_count"))
    # texts by their characters, numbers by size; longer digits decide where doubles no longer do
    in_order = [F.col("value").isNotNull(), "size", F.when(F.col("size").isNotNull(), F.length("value")), "value"]
    by_value = Window.partitionBy("column").orderBy(*in_order)
    by_count = Window.partitionBy("column").orderBy(F.col("n").desc(), *in_order)
    listed = counts.withColumn("position", F.row_number().over(by_value)).where(
        F.col("position") <= threshold
    ).withColumn("listing", F.lit("all"))
    frequent = counts.withColumn("position", F.row_number().over(by_count)).where(
        F.col("position") <= top
    ).withColumn("listing", F.lit("top"))
    wanted = F.when(F.col("distinct_count") <= threshold, F.lit("all")).otherwise(F.lit("top"))
    return (
        listed.unionByName(frequent)
        .join(distinct.withColumn("listing", wanted), ["column", "listing"])
        .select("column", "distinct_count", "listing", "position", "value", "n")
    )


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """One row of distinct counts with null as a value; the sketch form needs no shuffle of values.

    Exact counts shuffle a value once for each distinct value and task; values longer than a digest
    go as their SHA-256.
    """
    if approximate:
        return df.agg(
            *[(F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).cast("long").alias(c) for c in columns]
        )

    def short(c: str) -> Column:
        value = F.col(c).cast("string")
        return F.when(F.length(value) > 64, F.concat(F.lit("#"), F.sha2(value, 256))).otherwise(value)

    cells = F.array(*[F.struct(F.lit(c).alias("column"), short(c).alias("value")) for c in columns])
    distinct = df.select(F.explode(cells).alias("cell")).select("cell.column", "cell.value").distinct()
    return distinct.agg(*[F.count_if(F.col("column") == c).alias(c) for c in columns])


def _cell(column: str) -> Column:
    return F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(CELLS))


def top_values(df: DataFrame, column: str, top: int = TOP_VALUES) -> DataFrame:
    """``(value, n)``: the most frequent values of a column, exact, ties by value (null first).

    Values are not all shuffled. A first pass counts cells of hashes, which at most ``CELLS`` rows bring together; values of
    the fullest cells are then counted one by one, and the k-th count tells which other cells could still hold a
    value as frequent. Only where nearly all values are equally rare are all of them counted.
    """
    totals = {r[0]: r[1] for r in df.groupBy(_cell(column)).count().collect()}
    chosen = sorted(totals, key=lambda c: -totals[c])[: 4 * top]
    value = F.col(column).cast("string").alias("value")
    while True:
        rows = df.where(_cell(column).isin(chosen)) if len(chosen) < len(totals) else df
        best = rows.groupBy(value).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("value").asc_nulls_first()).limit(top)
        counts = [r["n"] for r in best.collect()]
        least = counts[-1] if len(counts) == top else 0
        open_ = [c for c, n in totals.items() if n >= least]
        if set(open_) <= set(chosen):
            return best
        chosen = open_


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """``(key, salts)`` of the keys with at least ``share`` of all rows; salts is how many such shares a key has.

    Cells are counted first and only the keys of full ones told apart. There are at most 1 / share such keys.
    """
    totals = {r[0]: r[1] for r in df.where(F.col(key).isNotNull()).groupBy(_cell(key)).count().collect()}
    least = max(2, share * sum(totals.values()))
    full = [c for c, n in totals.items() if n >= least]
    counts = df.where(F.col(key).isNotNull() & _cell(key).isin(full)).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least).select(key, F.ceil(F.col("n") / F.lit(float(least))).cast("int").alias("salts"))


def profile_state(df: DataFrame, columns: list[str], part: Column) -> DataFrame:
    """A row per part and column that can be stored and merged: rows, a sketch of its distinct values, and, up to
    ``KEPT_VALUES`` of them, the values with their counts. Null counts as a value."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = (
        df.select(part.alias("part"), F.explode(cells).alias("cell"))
        .groupBy("part", "cell.column", "cell.value").agg(F.count(F.lit(1)).alias("n"))
    )
    # a sketch passes nulls over: every value gets a letter in front, null another
    seen = F.coalesce(F.concat(F.lit("v"), "value"), F.lit("n"))
    facts = counts.groupBy("part", "column").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_count"), F.hll_sketch_agg(seen, F.lit(_SKETCH_BITS)).alias("sketch")
    )
    few = counts.join(facts.where(F.col("distinct_count") <= KEPT_VALUES).select("part", "column"), ["part", "column"], "left_semi")
    kept = few.groupBy("part", "column").agg(F.collect_list(F.struct("value", "n")).alias("kept"))
    return facts.join(kept, ["part", "column"], "left").drop("distinct_count")


def merged_counts(states: DataFrame) -> DataFrame:
    """``(column, value, n)`` of the columns whose values every part has kept."""
    whole = states.groupBy("column").agg(F.count_if(F.col("kept").isNull()).alias("lost")).where("lost = 0")
    kept = states.join(whole, "column", "left_semi").select("column", F.explode("kept").alias("k"))
    return kept.groupBy("column", F.col("k.value").alias("value")).agg(F.sum("k.n").alias("n"))


def merged_profile(states: DataFrame) -> DataFrame:
    """``(column, rows, distinct_count, exact)`` of all parts together; counts that are not exact are a sketch's estimate."""
    exact = merged_counts(states).groupBy("column").agg(F.count(F.lit(1)).alias("known"))
    facts = states.groupBy("column").agg(F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    return facts.join(exact, "column", "left").select(
        "column", "rows", F.coalesce("known", "estimate").alias("distinct_count"), F.col("known").isNotNull().alias("exact")
    )
