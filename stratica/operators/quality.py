"""Reconciliation of dropped rows and audits of the layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratica.operators.bloom import BITS, may_contain
from stratica.operators.joins import unmatched
from stratica.sources.tables import folder_bytes

# Texts readers of the tables rely on (fixed values).
UNMATCHED_REASON = "unmatched_business_id"
LATE_REASON = "late_or_lost"
BOTH_ACTIVE, SQL_ONLY, VECTOR_ONLY, BOTH_EMPTY = (
    "BOTH SINKS ACTIVE", "SQL only (vector empty)", "Vector only (SQL empty)", "BOTH SINKS EMPTY",
)


def reconcile(
    raw: DataFrame,
    joined: DataFrame,
    key: str,
    *,
    reason: str = UNMATCHED_REASON,
    entities: DataFrame | None = None,
    entity_key: str = "business_id",
    quarantined: DataFrame | None = None,
    may: Column | None = None,
    at: Column | None = None,
    stamp: str = "ingestion_timestamp",
    stamp_date: str = "ingestion_date",
) -> DataFrame:
    """Raw rows the join dropped, with a reason and stamps, in quarantine column order.

    With ``entities`` given, a row whose entity does exist was late or lost rather than unmatched.
    With ``quarantined`` given, rows already there are not reported again, so a second run adds
    nothing; rows are recognised by all their raw columns, nulls included. ``may`` spares rows whose key is certainly
    not joined the shuffle (see ``unmatched``).
    """
    carried = [c for c in raw.columns if c not in (stamp, stamp_date)]
    missing = unmatched(raw, joined, key, may)
    if quarantined is not None:
        # the object leaves null members out, which keeps a null apart from any text
        digest = F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in carried])), 256)
        known = quarantined.select(digest.alias("_row")).distinct()
        missing = missing.withColumn("_row", digest).join(known, "_row", "left_anti").drop("_row")
    label = F.lit(reason)
    if entities is not None:
        keys = entities.select(F.col(entity_key), F.lit(True).alias("_known")).dropDuplicates([entity_key])
        missing = missing.join(keys, entity_key, "left")
        label = F.when(F.col("_known"), F.lit(LATE_REASON)).otherwise(F.lit(reason))
    return missing.select(
        *[F.col(c) for c in carried],
        label.alias("reason"),
        (F.current_timestamp() if at is None else at).alias("quarantine_timestamp"),
        F.to_date(stamp).cast("string").alias(stamp_date),
    )


def reconcile_since(
    raw: DataFrame, joined: DataFrame, key: str, stored: DataFrame, since: str | None, until: str | None = None, *,
    stamp_date: str = "ingestion_date", bits: int = BITS, **options,
) -> DataFrame:
    """:func:`reconcile` of the raw rows that landed from ``since`` up to before ``until``; other dates are not read.

    A joined row carries the later stamp of both sides, so no key of these rows is joined under an earlier date: of the joined table, and of its ``stored`` filters
    ``(date, piece, bits)``, earlier dates are left out too.
    """
    day = F.col(stamp_date).cast("string")
    late = F.lit(True) if since is None else day >= since
    part = raw.where(late if until is None else late & (day < until))
    held = stored if since is None else stored.where(F.col("date").cast("string") >= since)
    return reconcile(part, joined.where(late), key, may=may_contain(held, F.col(key), bits), stamp_date=stamp_date, **options)


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """One row per layer with its row count."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def sink_status(sql_rows: Column, vector_rows: Column) -> Column:
    return (
        F.when((sql_rows > 0) & (vector_rows > 0), F.lit(BOTH_ACTIVE))
        .when(sql_rows > 0, F.lit(SQL_ONLY))
        .when(vector_rows > 0, F.lit(VECTOR_ONLY))
        .otherwise(F.lit(BOTH_EMPTY))
    )


def sink_audit(sql_sink: DataFrame, vector_sink: DataFrame, with_bytes: bool = False) -> DataFrame:
    """Rows of both sinks and their common status, as one row; for file-based sinks with their size."""
    counts = layer_counts({"sql_rows": sql_sink, "vector_rows": vector_sink})
    names = ["sql_rows", "vector_rows"]
    if with_bytes:
        for name, sink in (("sql_bytes", sql_sink), ("vector_bytes", vector_sink)):
            counts = counts.unionByName(folder_bytes(sink).select(F.lit(name).alias("layer"), F.col("bytes").alias("n")))
            names.append(name)
    audit = counts.agg(*[F.sum(F.when(F.col("layer") == name, F.col("n"))).alias(name) for name in names])
    return audit.withColumn("status", sink_status(F.col("sql_rows"), F.col("vector_rows")))
