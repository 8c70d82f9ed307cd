"""The layers end to end on composed business and review records, in batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratica.operators.joins import unmatched
from stratica.operators.quality import layer_counts, reconcile
from stratica.plans.medallion import bronze, gold_points, silver
from stratica.proofs import records
from stratica.proofs.registry import proof, table
from stratica.session import work_folder
from stratica.sources import contracts as c
from stratica.sources.tables import (
    append_by_name,
    append_by_position,
    ensure_dedup_view,
    provision,
    reset,
)
from stratica.sources.topics import to_frames


@proof(records.expected_silver())
def silver_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Source files to the 65-column typed table, by way of wire frames."""
    businesses, reviews = records.landed(spark, folder)
    raw = [
        bronze(
            to_frames(rows, "business_id", topic, schema_id),
            contract,
            F.lit(at).cast("timestamp"),
        )
        for rows, topic, schema_id, contract, at in (
            (businesses, "businesses", 1, c.BUSINESS, records.BUSINESS_AT),
            (reviews, "reviews", 2, c.REVIEW, records.REVIEW_AT),
        )
    ]
    return silver(*raw)


@proof(
    f"""WITH silver AS ({records.expected_silver()})
        SELECT review_id, name || ' | ' || coalesce(categories, '') || ' | ' || text AS embedding_text,
          '{{"review_id":"' || review_id || '","business_id":"' || business_id || '","name":"' || name
          || '","city":"' || city || '","state":"' || state || '"'
          || CASE WHEN categories IS NOT NULL THEN ',"categories":"' || categories || '"' ELSE '' END
          || ',"business_stars":' || CAST(business_stars AS VARCHAR) || ',"review_stars":' || review_stars
          || ',"review_count":' || review_count || ',"is_open":' || CAST(is_open AS VARCHAR)
          || CASE WHEN alcohol IS NOT NULL THEN ',"alcohol":"' || alcohol || '"' ELSE '' END
          || CASE WHEN noise_level IS NOT NULL THEN ',"noise_level":"' || noise_level || '"' ELSE '' END
          || CASE WHEN wifi IS NOT NULL THEN ',"wifi":"' || wifi || '"' ELSE '' END
          || CASE WHEN outdoor_seating IS NOT NULL THEN ',"outdoor_seating":' || CAST(outdoor_seating AS VARCHAR) ELSE '' END
          || CASE WHEN restaurants_price_range IS NOT NULL THEN ',"restaurants_price_range":' || restaurants_price_range ELSE '' END
          || ',"text":"' || text || '","date":"' || strftime(date, '%Y-%m-%dT%H:%M:%S.000Z') || '"}}' AS payload
        FROM silver"""
)
def gold_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """What accompanies each vector: text to embed and the 17-field payload."""
    points = gold_points(silver(*records.raw_layer(spark, folder)))
    return points.select("review_id", "embedding_text", "payload")


@proof("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def dedup_view_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A catalog table loaded twice with the same stamps, seen through its dedup view."""
    database = f"d{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{work_folder(spark, 'dedup-view')}'")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", F.lit(1).alias("stamp"))
    for _ in range(2):
        orders.write.mode("append").saveAsTable(f"{database}.orders")
    ensure_dedup_view(spark, f"{database}.orders", "o_orderkey", "stamp DESC")
    return spark.table(f"{database}.orders_deduped").drop("stamp")


@proof(
    """SELECT 'before' AS phase, count(*) AS n FROM orders UNION ALL SELECT 'after', 0"""
)
def layer_reset(spark: SparkSession, folder: str) -> DataFrame:
    """A layer filled, dropped with everything in it, and provisioned anew."""
    prefix = f"r{uuid.uuid4().hex[:12]}_"
    provision(spark, prefix, work_folder(spark, "before"))
    append_by_position(records.raw_reviews(spark, folder), f"{prefix}bronze.reviews")
    before = spark.table(f"{prefix}bronze.reviews").count()
    reset(spark, "bronze", "silver", "gold", prefix=prefix)
    provision(spark, prefix, work_folder(spark, "after"))
    after = spark.table(f"{prefix}bronze.reviews").agg(F.lit("after").alias("phase"), F.count(F.lit(1)).alias("n"))
    return spark.createDataFrame([("before", before)], after.schema).unionByName(after)


@proof(
    """WITH j AS (SELECT c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey)
       SELECT 'bronze.businesses' AS layer, count(*) AS n FROM customer WHERE c_mktsegment <> 'BUILDING'
       UNION ALL SELECT 'bronze.reviews', count(*) FROM j
       UNION ALL SELECT 'silver.reviews', 2 * count(*) FROM j WHERE c_mktsegment <> 'BUILDING'
       UNION ALL SELECT 'silver.reviews_deduped', count(*) FROM j WHERE c_mktsegment <> 'BUILDING'
       UNION ALL SELECT 'silver.quarantine', count(*) FROM j WHERE c_mktsegment = 'BUILDING'"""
)
def layer_provisioning(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog tables of every layer created, filled and counted; facts are loaded twice and the
    dedup view shows them once."""
    prefix = f"p{uuid.uuid4().hex[:12]}_"
    provision(spark, prefix, work_folder(spark, "warehouse"))
    businesses, reviews = records.raw_layer(spark, folder)
    absent = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'")
    present = unmatched(businesses, absent.select(F.col("c_custkey").cast("string").alias("business_id")), "business_id")
    append_by_position(present.select(businesses.columns), f"{prefix}bronze.businesses")
    append_by_position(reviews, f"{prefix}bronze.reviews")
    facts = silver(spark.table(f"{prefix}bronze.businesses"), spark.table(f"{prefix}bronze.reviews"))
    append_by_name(facts, f"{prefix}silver.reviews")
    append_by_name(facts, f"{prefix}silver.reviews")
    ensure_dedup_view(spark, f"{prefix}silver.reviews", "review_id")
    dropped = reconcile(
        spark.table(f"{prefix}bronze.reviews"), spark.table(f"{prefix}silver.reviews"), "review_id"
    )
    append_by_position(dropped, f"{prefix}silver.quarantine")
    names = ["bronze.businesses", "bronze.reviews", "silver.reviews", "silver.reviews_deduped", "silver.quarantine"]
    return layer_counts({n: spark.table(prefix + n) for n in names})
