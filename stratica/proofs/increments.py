"""Tables that grow by committed batches, and profiles and searches that need not read everything."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratica.functions.literals import literal_text
from stratica.operators.keyed import KeyedTable
from stratica.operators.profile import distinct_counts, merged_counts, merged_profile, profile_state, top_values
from stratica.operators.pruned import CLUSTER, centres, clustered, pruned_topk
from stratica.operators.upsert import land, read_batches, write_batch
from stratica.proofs.registry import proof, table
from stratica.proofs.vectors import VECTOR_DIMS, _centroid_sql, _centroids, _ranked_sql
from stratica.session import work_folder

_VERSION = "CASE WHEN label IN (2, 3) THEN 2 WHEN label < 4 OR label = 9 THEN 1 ELSE 0 END"


@proof(f"SELECT vec_id, label, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total, {_VERSION} AS version FROM embeddings")
def vector_upsert_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches by key into buckets, a compaction, a third batch, and one that was never finished."""
    at, database = work_folder(spark, "keyed"), f"k{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{at}/database'")
    points = table(spark, folder, "embeddings")
    keyed = KeyedTable(spark, f"{database}.points", "vec_id", at, buckets=8)
    parts = ("label <> 9", "label < 4 OR label = 9", "label IN (2, 3)", "label > 5")
    batches = [points.where(part).withColumn("version", F.lit(version)) for version, part in enumerate(parts)]
    keyed.upsert(batches[0], 0)
    keyed.upsert(batches[1], 1)
    keyed.compact()
    keyed.upsert(batches[2], 2)
    keyed.land(batches[3], 3)
    keyed.vacuum()
    total = F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v.cast("double"))
    return keyed.current().select("vec_id", "label", F.round(total, 6).alias("total"), "version")


@proof("SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 = 1 THEN 'second' ELSE 'first' END AS attempt FROM orders WHERE o_orderkey % 3 <> 2")
def append_committed(spark: SparkSession, folder: str) -> DataFrame:
    """Batches written again or not finished: readers see the last finished attempt of each, whole."""
    at = work_folder(spark, "committed")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    third = lambda n, label: orders.where(F.col("o_orderkey") % 3 == n).withColumn("attempt", F.lit(label))
    write_batch(third(0, "first"), at, 0)
    write_batch(third(1, "first"), at, 1)
    write_batch(third(1, "second"), at, 1)
    land(third(0, "given up"), at, 0)
    land(third(2, "given up"), at, 2)
    return read_batches(spark, at).drop("stream", "batch_id")


_SMALL = ["o_orderstatus", "o_orderpriority"]


def _states(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles of two halves of the orders, stored one after the other."""
    at = work_folder(spark, "profiles")
    orders = table(spark, folder, "orders")
    for half in (0, 1):
        write_batch(profile_state(orders.where(F.col("o_orderkey") % 2 == half), [*_SMALL, "o_custkey", "o_orderkey"], F.lit(half)), at, half)
    return read_batches(spark, at)


@proof(
    """SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS n FROM orders GROUP BY ALL
       UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL"""
)
def profile_merged_values(spark: SparkSession, folder: str) -> DataFrame:
    """Value tables of small columns, merged from the halves' profiles."""
    return merged_counts(_states(spark, folder)).where(F.col("column").isin(_SMALL))


@proof(
    """SELECT c AS "column", count(*) AS rows, true AS within FROM orders,
       (VALUES ('o_orderstatus'), ('o_orderpriority'), ('o_custkey'), ('o_orderkey')) AS t(c) GROUP BY c"""
)
def profile_merged_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct counts merged from the halves' sketches: exact for small columns, within 3 % of the whole for others."""
    columns = [*_SMALL, "o_custkey", "o_orderkey"]
    known = distinct_counts(table(spark, folder, "orders"), columns)
    known = known.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("whole")) for c in columns])).alias("k"))
    error = F.abs(F.col("distinct_count") - F.col("whole"))
    within = F.when(F.col("exact"), error == 0).otherwise(error <= 0.03 * F.col("whole"))
    return merged_profile(_states(spark, folder)).join(known.select("k.*"), "column").select("column", "rows", within.alias("within"))


@proof("SELECT CAST(l_partkey AS VARCHAR) AS value, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, value LIMIT 20")
def top_values_exact(spark: SparkSession, folder: str) -> DataFrame:
    """The most frequent values of a column of many, without counting them all."""
    return top_values(table(spark, folder, "lineitem"), "l_partkey")


@proof(
    f"""WITH {_centroid_sql("label")}, {_ranked_sql("embeddings")}
        SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(s, 4) AS score, true AS bounded FROM best WHERE rank <= 10"""
)
def vector_topk_pruned(spark: SparkSession, folder: str) -> DataFrame:
    """Top 10 for every label's mean vector from points stored by cluster: the rows of a full scan, and no more points scored."""
    at = work_folder(spark, "clusters")
    points = table(spark, folder, "embeddings")
    means = centres(points, 32, VECTOR_DIMS, point_id="vec_id")
    clustered(points, means).write.partitionBy(CLUSTER).parquet(at)
    stored = spark.read.parquet(at)
    hits, scored = pruned_topk(stored, _centroids(points, "label"), means, 10, point_id="vec_id")
    whole = points.count()
    hits = hits.join(scored.withColumn("bounded", F.col("scored") <= whole).drop("scored"), "query_id")
    return hits.select("query_id", "vec_id", "rank", F.round("score", 4).alias("score"), "bounded")


_ESCAPED = r"""SELECT p_partkey, concat('u''', p_name, CASE p_partkey % 8
      WHEN 0 THEN '\\x41' WHEN 1 THEN '\\u00e9' WHEN 2 THEN '\\U0001F600' WHEN 3 THEN '\\101\\7'
      WHEN 4 THEN concat('\\', char(10), 'joined') WHEN 5 THEN '\\d\\\\n' WHEN 6 THEN '\\ud83d' ELSE '\\t\\a\\''' END, '''') AS raw FROM part"""


@proof(
    """SELECT p_partkey, CASE WHEN p_partkey % 8 <> 6 THEN p_name || CASE p_partkey % 8
         WHEN 0 THEN 'A' WHEN 1 THEN 'é' WHEN 2 THEN '😀' WHEN 3 THEN 'A' || chr(7) WHEN 4 THEN 'joined'
         WHEN 5 THEN '\\d\\n' ELSE chr(9) || chr(7) || '''' END END AS word FROM part"""
)
def literal_escapes(spark: SparkSession, folder: str) -> DataFrame:
    """String literals with every kind of escape; half a surrogate pair is no character."""
    table(spark, folder, "part").createOrReplaceTempView("part")
    return spark.sql(_ESCAPED).select("p_partkey", literal_text(F.col("raw")).alias("word"))
