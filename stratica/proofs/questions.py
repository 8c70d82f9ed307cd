"""The documented questions, over the typed business-and-review table.

Relational ones read the review-grain view; semantic ones search all documents, each taken as a review
of the business its number stands for, with every benchmark passage as a question.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratica.operators import analytics
from stratica.operators.dedup import one_per_entity
from stratica.operators.embedding import DIMS, QUERY, embed
from stratica.operators.filters import facet_filter
from stratica.plans.answers import filtered_search, hybrid_search
from stratica.plans.medallion import clean_businesses, silver
from stratica.proofs import records
from stratica.proofs.hashed import cells, scores
from stratica.proofs.registry import proof, stored_documents, table
from stratica.sources.tables import analytics_view, guarded

_VIEW = "gold_reviews_deduped"


def _view(spark: SparkSession, folder: str) -> DataFrame:
    facts = silver(*records.raw_layer(spark, folder))
    return analytics_view(facts, _VIEW, "review_id", [F.col("ingestion_timestamp").desc()])


_SILVER = f"WITH silver AS ({records.expected_silver()})"
_ENTITIES = _SILVER + ", entities AS (SELECT DISTINCT ON (business_id) * FROM silver)"


@proof(f"{_SILVER} SELECT city, CAST(round(CAST(avg(review_stars) AS DECIMAL(38,8)), 4) AS DOUBLE) AS avg_review_stars FROM silver WHERE categories LIKE '%MACHINERY%' GROUP BY city")
def question_average_rating(spark: SparkSession, folder: str) -> DataFrame:
    """Average rating of one category by city, as plain SQL on the view."""
    _view(spark, folder)
    return spark.sql(
        f"SELECT city, CAST(round(CAST(avg(review_stars) AS DECIMAL(38,8)), 4) AS DOUBLE) AS avg_review_stars FROM {_VIEW} "
        "WHERE categories LIKE '%MACHINERY%' GROUP BY city"
    )


@proof(f"{_SILVER} SELECT state, count(DISTINCT business_id) AS entities FROM silver WHERE business_stars = 5.0 GROUP BY state")
def question_five_star_businesses(spark: SparkSession, folder: str) -> DataFrame:
    """How many five-star businesses each state has."""
    return analytics.count_entities(_view(spark, folder), "business_id", F.col("business_stars") == 5.0, "state")


@proof(f"{_SILVER} SELECT city, count(*) AS reviews FROM silver GROUP BY city ORDER BY reviews DESC, city LIMIT 10")
def question_top_cities_by_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.top_groups(_view(spark, folder), "city", F.count(F.lit(1)), 10, "reviews")


@proof(
    f"""{_ENTITIES} SELECT business_id, name, review_count FROM entities WHERE review_count > 500
        ORDER BY review_count DESC, business_id LIMIT 50"""
)
def question_busy_businesses(spark: SparkSession, folder: str) -> DataFrame:
    """Businesses with more than 500 reviews, under the size guard."""
    entities = one_per_entity(_view(spark, folder), "business_id", ["name", "review_count"])
    return guarded(entities.where("review_count > 500"), [F.col("review_count").desc(), F.col("business_id")])


@proof(
    f"""{_ENTITIES} SELECT city, CAST(round(CAST(avg(business_stars) AS DECIMAL(38,8)), 4) AS DOUBLE) AS rating FROM entities
        GROUP BY city ORDER BY rating DESC, city LIMIT 5"""
)
def question_top_cities_by_rating(spark: SparkSession, folder: str) -> DataFrame:
    entities = one_per_entity(_view(spark, folder), "business_id", ["city", "business_stars"])
    return analytics.top_groups(entities, "city", analytics.settled_round(F.avg("business_stars"), 4), 5, "rating")


@proof(
    f"""{_ENTITIES} SELECT city, CAST(round(CAST(avg(CASE WHEN outdoor_seating THEN 1 ELSE 0 END) * 100 AS DECIMAL(38,8)), 4) AS DOUBLE) AS pct
        FROM entities GROUP BY city"""
)
def question_outdoor_share(spark: SparkSession, folder: str) -> DataFrame:
    """Share of businesses with outdoor seating by city."""
    entities = one_per_entity(_view(spark, folder), "business_id", ["city", "outdoor_seating"])
    return analytics.rounded(analytics.percentage_by(entities, "city", F.col("outdoor_seating")), "pct", 4)


@proof(
    f"""WITH b AS ({records.expected_businesses()}) SELECT business_id, city, wifi, hours_sunday FROM b
        WHERE hours_sunday IS NOT NULL AND (wifi = 'free') AND restaurants_delivery
          AND (restaurants_price_range = 2 OR restaurants_price_range = 3) AND (categories LIKE '%HOUSEHOLD%' OR categories LIKE '%BUILDING%')"""
)
def question_open_sundays(spark: SparkSession, folder: str) -> DataFrame:
    """Pills: open on Sunday, free wifi, delivery, $$ or $$$, in either of two categories."""
    chosen = {
        "hours": ["Sunday"], "ambiance": ["Free WiFi"], "amenities": ["Delivery"],
        "price": ["$$", "$$$"], "categories": ["HOUSEHOLD", "BUILDING"],
    }
    entities = clean_businesses(records.raw_businesses(spark, folder))
    return facet_filter(entities, chosen).select("business_id", "city", "wifi", "hours_sunday")


def _points(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as stored points, with the columns of their business: numbers beyond the last start again at the first."""
    entities = clean_businesses(records.raw_businesses(spark, folder))
    first, n = table(spark, folder, "customer").agg(F.min("c_custkey"), F.count("*")).first()
    own = F.lit(first) + F.pmod("point_id", F.lit(n))
    stored = stored_documents(spark, folder).select("point_id", own.cast("string").alias("business_id"), "embedding")
    return stored.join(entities, "business_id")


def _asked(spark: SparkSession, folder: str) -> DataFrame:
    questions = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return embed(questions, "text", task=QUERY, into="query_vector")


_OWN = "CAST((SELECT min(c_custkey) FROM customer) + key % (SELECT count(*) FROM customer) AS VARCHAR)"


def _semantic_sql(selected: str) -> str:
    """Top 10 of every passage among the documents of the selected businesses."""
    return f"""WITH b AS ({records.expected_businesses()}), chosen AS ({selected}),
        {cells("q", "item_id", "text", "benchmark")}, {cells("d", "doc_id", "text", "documents")},
        {scores("q", "d", _OWN + " IN (SELECT business_id FROM chosen)")}
        SELECT q AS query_id, p AS point_id, CAST(rank AS INTEGER) AS rank, round(s, 4) AS score
        FROM best WHERE rank <= 10"""


def _shown(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 4))


def _within(spark: SparkSession, folder: str, ids) -> DataFrame:
    """Search within the businesses ``ids`` selects from the entity table."""
    entities = clean_businesses(records.raw_businesses(spark, folder))
    return _shown(
        hybrid_search(_points(spark, folder), _asked(spark, folder), ids(entities), "business_id", dims=DIMS)
    )


@proof(_semantic_sql("SELECT business_id FROM b ORDER BY business_stars DESC, business_id LIMIT 50"))
def question_semantic_in_top_rated(spark: SparkSession, folder: str) -> DataFrame:
    """Most similar reviews among the 50 highest-rated businesses."""
    return _within(
        spark, folder, lambda e: analytics.top_rows(e, "business_stars", "business_id", 50).select("business_id")
    )


@proof(_semantic_sql("SELECT business_id FROM b WHERE review_count > 500 AND state = 'ASIA' ORDER BY review_count DESC, business_id LIMIT 200"))
def question_semantic_in_busy(spark: SparkSession, folder: str) -> DataFrame:
    """Most similar reviews among well-reviewed businesses of one place, ids under the hybrid guard."""
    place: Column = (F.col("review_count") > 500) & (F.col("state") == "ASIA")
    return _within(
        spark, folder,
        lambda e: guarded(e.where(place), [F.col("review_count").desc(), F.col("business_id")], 200).select("business_id"),
    )


@proof(
    _semantic_sql(
        """SELECT business_id FROM b WHERE city IN (
             SELECT city FROM b GROUP BY city ORDER BY sum(review_count) DESC, city LIMIT 10)"""
    )
)
def question_semantic_in_top_cities(spark: SparkSession, folder: str) -> DataFrame:
    """Most similar reviews in the ten most reviewed cities."""
    return _within(
        spark, folder,
        lambda e: e.join(analytics.top_groups(e, "city", F.sum("review_count"), 10), "city", "left_semi").select("business_id"),
    )


def _with_filters(spark: SparkSession, folder: str, filters: dict) -> DataFrame:
    hits, _ = filtered_search(_points(spark, folder), _asked(spark, folder), filters, dims=DIMS)
    return _shown(hits)


@proof(_semantic_sql("SELECT business_id FROM b WHERE state = 'EUROPE' AND contains(categories, 'FURNITURE')"))
def question_semantic_city_category(spark: SparkSession, folder: str) -> DataFrame:
    return _with_filters(spark, folder, {"state": "EUROPE", "categories": "FURNITURE"})


@proof(_semantic_sql("SELECT business_id FROM b WHERE noise_level = 'average' AND alcohol = 'full_bar'"))
def question_semantic_noise_alcohol(spark: SparkSession, folder: str) -> DataFrame:
    return _with_filters(spark, folder, {"noise_level": "average", "alcohol": "full_bar", "wifi": ""})


@proof(_semantic_sql("SELECT business_id FROM b WHERE contains(name, '0000042') AND is_open"))
def question_semantic_by_name(spark: SparkSession, folder: str) -> DataFrame:
    return _with_filters(spark, folder, {"name": "0000042", "is_open": True})
