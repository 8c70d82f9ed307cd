"""Reconciliation, profiles and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratica.operators.bloom import filters
from stratica.operators.profile import distinct_counts, profile
from stratica.operators.quality import layer_counts, reconcile, reconcile_since, sink_audit
from stratica.operators.upsert import read_batches, write_batch
from stratica.proofs.registry import ORACLES, proof, table
from stratica.session import work_folder


def _raw_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("review_id"),
        F.col("o_custkey").cast("string").alias("business_id"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("text"),
        F.col("o_orderdate").cast("string").alias("ingestion_timestamp"),
        F.to_date("o_orderdate").cast("string").alias("ingestion_date"),
    )


def _known(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").where(F.col("c_mktsegment") != "BUILDING")
    return customers.select(F.col("c_custkey").cast("string").alias("business_id"))


def _joined(spark: SparkSession, folder: str) -> DataFrame:
    """What the join kept: reviews of known businesses, except those that came too late."""
    punctual = table(spark, folder, "orders").where(F.col("o_orderstatus") != "P")
    return punctual.select(
        F.col("o_orderkey").cast("string").alias("review_id"), F.col("o_custkey").cast("string").alias("business_id")
    ).join(_known(spark, folder), "business_id")


@proof(
    """SELECT CAST(o_orderkey AS VARCHAR) AS review_id, CAST(o_custkey AS VARCHAR) AS business_id,
              nullif(o_orderpriority, '5-LOW') AS text,
              CASE WHEN c_mktsegment = 'BUILDING' THEN 'unmatched_business_id' ELSE 'late_or_lost' END AS reason,
              strftime(o_orderdate, '%Y-%m-%d') AS ingestion_date
       FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE c_mktsegment = 'BUILDING' OR o_orderstatus = 'P'"""
)
def quarantine_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    """Rows the join dropped, reconciled twice: the second run adds nothing."""
    at = work_folder(spark, "quarantine")
    raw, joined, known = _raw_reviews(spark, folder), _joined(spark, folder), _known(spark, folder)
    reconcile(raw, joined, "review_id", entities=known).write.mode("append").parquet(at)
    again = reconcile(raw, joined, "review_id", entities=known, quarantined=spark.read.parquet(at))
    again.write.mode("append").parquet(f"{at}-second")
    return spark.read.parquet(at, f"{at}-second").drop("quarantine_timestamp")


_BITS = 1 << 17


@proof(ORACLES["quarantine_reconcile"])
def quarantine_by_date(spark: SparkSession, folder: str) -> DataFrame:
    """Reconciled date by date: filters of the joined keys are stored as they land, and the second run reads its own dates only."""
    at, cut = work_folder(spark, "by-date"), "1998-06-01"
    raw, known = _raw_reviews(spark, folder), _known(spark, folder)
    joined = _joined(spark, folder).join(raw.select("review_id", "ingestion_date"), "review_id")
    for number, (since, until) in enumerate(((None, cut), (cut, None))):
        landed = joined.where(F.col("ingestion_date") < cut if until else F.col("ingestion_date") >= cut)
        write_batch(filters(landed, "review_id", "ingestion_date", _BITS), f"{at}/filters", number)
        stored = read_batches(spark, f"{at}/filters")
        rows = reconcile_since(raw, joined, "review_id", stored, since, until, bits=_BITS, entities=known)
        write_batch(rows, f"{at}/quarantine", number)
    return read_batches(spark, f"{at}/quarantine").drop("quarantine_timestamp", "stream", "batch_id")


_PROFILED = {
    "events": ["event_type", "user_id", "props"],
    "part": ["p_brand", "p_type", "p_size", "p_name"],
    "customer": ["c_mktsegment", "c_nationkey", "c_name"],
}


def _profile_sql(name: str, column: str) -> str:
    return f"""
      SELECT '{name}' AS source, '{column}' AS "column", distinct_count, listing, position, value, n FROM (
        SELECT *, CASE WHEN distinct_count <= 50 THEN 'all' ELSE 'top' END AS listing,
               CASE WHEN distinct_count <= 50 THEN by_value ELSE by_count END AS position
        FROM (SELECT value, n, count(*) OVER () AS distinct_count,
                     CAST(row_number() OVER (ORDER BY typed NULLS FIRST) AS INTEGER) AS by_value,
                     CAST(row_number() OVER (ORDER BY n DESC, typed NULLS FIRST) AS INTEGER) AS by_count
              FROM (SELECT {column} AS typed, CAST({column} AS VARCHAR) AS value, count(*) AS n FROM {name} GROUP BY ALL)))
      WHERE listing = 'all' OR position <= 20"""


@proof(" UNION ALL ".join(_profile_sql(n, c) for n, columns in _PROFILED.items() for c in columns))
def profile_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles of three tables, one pass over each."""
    profiles = [
        profile(table(spark, folder, name), columns).withColumn("source", F.lit(name))
        for name, columns in _PROFILED.items()
    ]
    return reduce(DataFrame.unionByName, profiles)


@proof(
    """SELECT count(DISTINCT source) AS source, count(DISTINCT lang) + max(CASE WHEN lang IS NULL THEN 1 ELSE 0 END) AS lang,
              count(DISTINCT text) AS text FROM documents"""
)
def profile_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct counts, null counting as a value."""
    return distinct_counts(table(spark, folder, "documents"), ["source", "lang", "text"])


@proof(
    """WITH j AS (SELECT o_orderstatus, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey)
       SELECT 'raw' AS layer, count(*) AS n FROM j
       UNION ALL SELECT 'joined', count(*) FROM j WHERE c_mktsegment <> 'BUILDING' AND o_orderstatus <> 'P'
       UNION ALL SELECT 'quarantine', count(*) FROM j WHERE c_mktsegment = 'BUILDING' OR o_orderstatus = 'P'"""
)
def layer_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of the layers; raw is the sum of the other two."""
    raw, joined = _raw_reviews(spark, folder), _joined(spark, folder)
    return layer_counts({"raw": raw, "joined": joined, "quarantine": reconcile(raw, joined, "review_id")})


@proof(
    """WITH n AS (SELECT (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM embeddings) AS e)
       SELECT o AS sql_rows, e AS vector_rows, 'BOTH SINKS ACTIVE' AS status, true AS has_bytes FROM n
       UNION ALL SELECT o, 0, 'SQL only (vector empty)', true FROM n UNION ALL SELECT 0, e, 'Vector only (SQL empty)', true FROM n
       UNION ALL SELECT 0, 0, 'BOTH SINKS EMPTY', false FROM n"""
)
def sink_status_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and bytes of both sinks with their common status, in each of the four states."""
    orders, points = table(spark, folder, "orders"), table(spark, folder, "embeddings")
    no_orders, no_points = orders.where("o_orderkey IS NULL"), points.where("vec_id IS NULL")
    audits = [
        sink_audit(sql, vectors, with_bytes=True)
        for sql, vectors in ((orders, points), (orders, no_points), (no_orders, points), (no_orders, no_points))
    ]
    has_bytes = F.col("sql_bytes") + F.col("vector_bytes") > 0
    return reduce(DataFrame.unionByName, audits).select("sql_rows", "vector_rows", "status", has_bytes.alias("has_bytes"))
