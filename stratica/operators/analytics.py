"""The relational questions, as templates over any view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settled_round(c: Column, digits: int) -> Column:
    """Half-up rounding decided on eight decimals, so that summation noise cannot tip a half."""
    settled = F.round(c.try_cast("decimal(38,8)"), digits).cast("double")
    return F.coalesce(settled, F.round(c, digits))


def rounded(df: DataFrame, column: str, digits: int) -> DataFrame:
    """A result with one column rounded for display."""
    return df.withColumn(column, settled_round(F.col(column), digits))


def average_by(df: DataFrame, group: str, metric: str, where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.where(where)
    return rows.groupBy(group).agg(F.avg(metric).alias(f"avg_{metric}"))


def total_by(df: DataFrame, group: str, metric: str, where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.where(where)
    return rows.groupBy(group).agg(F.sum(metric).alias(f"sum_{metric}"))


def count_entities(df: DataFrame, entity: str, where: Column, group: str | None = None) -> DataFrame:
    """Distinct entities with a qualifying row, optionally per group."""
    rows = df.where(where)
    grouped = rows.groupBy(group) if group else rows
    return grouped.agg(F.count_distinct(entity).alias("entities"))


def percentage_by(entities: DataFrame, group: str, flag: Column) -> DataFrame:
    """Share of entities with the flag, in percent. Unknown flags count as not having it."""
    has = F.coalesce(flag, F.lit(False)).cast("int")
    return entities.groupBy(group).agg((F.avg(has) * 100).alias("pct"))


def top_groups(df: DataFrame, group: str, metric: Column, n: int, name: str = "metric") -> DataFrame:
    """The n groups with the highest metric, ties by group."""
    ranked = df.groupBy(group).agg(metric.alias(name))
    return ranked.orderBy(F.col(name).desc(), F.col(group)).limit(n)


def top_rows(df: DataFrame, metric: str, key: str, n: int) -> DataFrame:
    """The n rows with the highest metric, ties by key."""
    return df.orderBy(F.col(metric).desc(), F.col(key)).limit(n)


def over_threshold(df: DataFrame, group: str, minimum: int) -> DataFrame:
    """Groups with more than ``minimum`` rows."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > minimum)


def like(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.where(F.col(column).like(pattern))
