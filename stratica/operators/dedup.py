"""Keeping one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STREAM_SALTS = 8
_ROW = "_stratica_row"


def latest_by(df: DataFrame, key: str | list[str], order: list[Column], total: bool = False) -> DataFrame:
    """The first row of each key in the given order (pass descending stamps for "latest").

    Unless the order is ``total`` (up to identical copies), a hash of the whole row breaks the
    remaining ties, so that the result does not depend on the plan; a total order spares reading
    columns nobody asks for. Catalyst turns the ``= 1`` filter into a group limit that runs before
    the shuffle: a task sends at most one row per key, however many copies of a key it read.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ties = [] if total else [F.xxhash64(*[f"`{c}`" for c in df.columns]).desc()]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn(_ROW, F.row_number().over(window)).where(F.col(_ROW) == 1).drop(_ROW)


def one_per_entity(df: DataFrame, key: str, columns: list[str], order: Column | None = None) -> DataFrame:
    """Entity rows out of a fact-grain table, whose entity columns repeat on every fact.

    Where they differ, the row highest in ``order`` stands for the entity, then the one with the highest values.
    """
    own = F.struct(*columns)
    first = F.max(own) if order is None else F.max_by(own, F.struct(order, own))
    return df.groupBy(key).agg(first.alias(_ROW)).select(key, *[F.col(f"{_ROW}.`{c}`") for c in columns])


def salt_of(columns: list[str], salts: int) -> Column:
    mixed = F.xxhash64(*[f"`{c}`" for c in columns]).bitwiseXOR(F.xxhash64(F.spark_partition_id()))
    return F.pmod(mixed, F.lit(salts)).cast("int")


def dedup_within_watermark(
    stream: DataFrame, keys: list[str], event_time: str, delay: str, salts: int = STREAM_SALTS
) -> DataFrame:
    """Streaming de-duplication whose state is dropped once the watermark has passed.

    Rows are first de-duplicated per key and salt, then per key: a key with very many copies is
    worked off by several tasks, and the last step sees at most one copy per salt.
    """
    rows = stream.withWatermark(event_time, delay)
    if salts > 1:
        salted = rows.withColumn("_salt", salt_of(stream.columns, salts))
        rows = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return rows.dropDuplicatesWithinWatermark(keys)
