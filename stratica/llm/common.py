"""Expressions and tables shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratica.session import work_folder

#: White space is U+0020 and U+0009 to U+000D; a word is a run of anything else.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once per row, however often the body and its lambdas use it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text in order, repeats included; an empty array for null or blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` as a table in the folder the cluster shares.

    It cuts the lineage: later jobs read files that outlive any executor, and Spark knows their
    size when it plans joins. The files go when the application ends.
    """
    spark = df.sparkSession
    folder = work_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def numbered(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """``df`` with ``place``, its position from 0 in ascending ``order`` (nulls first), without gathering it.

    A global sort gives each partition a run of rows, and the runs' lengths give each its offset. Rows that
    agree in ``order`` may be cut between partitions: how they were read decides among them.
    """
    tie = F.monotonically_increasing_id()
    rows = df.withColumn("_tie", tie).orderBy(*order, "_tie").drop("_tie").withColumn("_id", F.monotonically_increasing_id())
    rows = written(rows.withColumn("_run", F.shiftright("_id", 33)), label)
    runs = rows.groupBy("_run").agg(F.count("*").alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("_before", F.coalesce(earlier, F.lit(0))).drop("_n")
    place = F.col("_before") + F.col("_id").bitwiseAND((1 << 33) - 1)
    return rows.join(runs, "_run").withColumn("place", place).drop("_run", "_id", "_before")


def bounded_sample(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """At most ``size`` rows in hash order of ``keys``; all of them where there are no more.

    Rows are thinned by their hash to about twice the size first, so what the tasks send on does not grow with their number.
    """
    n, scale = rows.count(), 1 << 30
    place = F.pmod(F.xxhash64(*keys), F.lit(scale))
    thinned = rows.where(place < 2 * size * scale // n) if n > 2 * size else rows
    return thinned.orderBy(place, *keys).limit(size)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Arrow batches of few rows: whole documents are long, and Python holds a batch at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def spare(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(doc_id: Column, divisor: int) -> Column:
    """CRC-32 of the id as text, modulo ``divisor``; null ids count as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor
