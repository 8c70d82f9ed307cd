"""Joins, de-duplication, filters and the relational questions, on the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratica.operators import analytics
from stratica.operators.dedup import one_per_entity
from stratica.operators.filters import Choice, FreeChoice, compile_filter, facet_filter
from stratica.operators.joins import entity_join, unmatched
from stratica.proofs.registry import proof, table
from stratica.sources.tables import analytics_view, guarded


@proof(
    """SELECT c_custkey, c_name, c_mktsegment, o_orderkey, o_totalprice,
              greatest(TIMESTAMP '1998-06-01', o_orderdate) AS ingestion_timestamp,
              CAST(greatest(TIMESTAMP '1998-06-01', o_orderdate) AS DATE) AS ingestion_date
       FROM customer JOIN orders ON c_custkey = o_custkey"""
)
def silver_join(spark: SparkSession, folder: str) -> DataFrame:
    """Facts with their entity, the later stamp and its date."""
    entities = table(spark, folder, "customer").select(
        "c_custkey", "c_name", "c_mktsegment",
        F.lit("1998-06-01").cast("timestamp").alias("ingestion_timestamp"),
    )
    facts = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice",
        F.col("o_orderdate").cast("timestamp").alias("ingestion_timestamp"),
    )
    return entity_join(entities, facts, "c_custkey")


@proof(
    """SELECT coalesce(c_custkey, o_custkey) AS c_custkey, c_name, o_orderkey, o_totalprice,
              greatest(CASE WHEN c_custkey IS NOT NULL THEN TIMESTAMP '1998-06-01' END, o_orderdate) AS ingestion_timestamp,
              CAST(greatest(CASE WHEN c_custkey IS NOT NULL THEN TIMESTAMP '1998-06-01' END, o_orderdate) AS DATE) AS ingestion_date
       FROM (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING')
       FULL JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey"""
)
def silver_outer_join(spark: SparkSession, folder: str) -> DataFrame:
    """Entities without facts and facts without an entity keep their row and their key."""
    entities = table(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'").select(
        "c_custkey", "c_name", F.lit("1998-06-01").cast("timestamp").alias("ingestion_timestamp")
    )
    facts = table(spark, folder, "orders").where("o_orderstatus = 'P'").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice",
        F.col("o_orderdate").cast("timestamp").alias("ingestion_timestamp"),
    )
    return entity_join(entities, facts, "c_custkey", how="full_outer")


@proof(
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'BUILDING')"""
)
def anti_join_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "customer").where(F.col("c_mktsegment") != "BUILDING")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return unmatched(orders, known.select(F.col("c_custkey").alias("o_custkey")), "o_custkey")


_TIEBREAK = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


@proof(
    f"""SELECT * EXCLUDE (row_num) FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                       ORDER BY l_shipdate DESC, {', '.join(_TIEBREAK)}) AS row_num
          FROM lineitem) WHERE row_num = 1"""
)
def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The dedup view: latest row of each key under a total order, queried by name."""
    order = [F.col("l_shipdate").desc(), *[F.col(c) for c in _TIEBREAK]]
    analytics_view(table(spark, folder, "lineitem"), "lineitem_deduped", ["l_orderkey", "l_linenumber"], order)
    return spark.sql("SELECT * FROM lineitem_deduped")


def _fact_view(spark: SparkSession, folder: str) -> DataFrame:
    """Order-grain facts with customer and nation columns."""
    customers = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))


_FACTS = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"


@proof(f"SELECT n_name, CAST(round(CAST(avg(o_totalprice) AS DECIMAL(38,8)), 4) AS DOUBLE) AS avg_o_totalprice FROM {_FACTS} GROUP BY n_name")
def sql_avg_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.rounded(analytics.average_by(_fact_view(spark, folder), "n_name", "o_totalprice"), "avg_o_totalprice", 4)


@proof(f"SELECT c_mktsegment, CAST(round(CAST(sum(o_totalprice) AS DECIMAL(38,8)), 2) AS DOUBLE) AS sum_o_totalprice FROM {_FACTS} GROUP BY c_mktsegment")
def sql_sum_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.rounded(analytics.total_by(_fact_view(spark, folder), "c_mktsegment", "o_totalprice"), "sum_o_totalprice", 2)


@proof(
    f"""SELECT n_name, count(DISTINCT c_custkey) AS entities FROM {_FACTS}
        WHERE o_totalprice > 400000 GROUP BY n_name"""
)
def sql_count_entities(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.count_entities(
        _fact_view(spark, folder), "c_custkey", F.col("o_totalprice") > 400000, "n_name"
    )


@proof(
    """SELECT c_mktsegment, CAST(round(CAST(avg(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) * 100 AS DECIMAL(38,8)), 4) AS DOUBLE) AS pct
       FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) GROUP BY c_mktsegment"""
)
def sql_pct_by_group(spark: SparkSession, folder: str) -> DataFrame:
    """Share of entities in debt, counted once per entity of a fact-grain view."""
    entities = one_per_entity(_fact_view(spark, folder), "c_custkey", ["c_mktsegment", "c_acctbal"])
    return analytics.rounded(analytics.percentage_by(entities, "c_mktsegment", F.col("c_acctbal") < 0), "pct", 4)


@proof(
    f"""SELECT n_name, CAST(round(CAST(avg(o_totalprice) AS DECIMAL(38,8)), 4) AS DOUBLE) AS avg_value FROM {_FACTS}
        GROUP BY n_name ORDER BY avg_value DESC, n_name LIMIT 5"""
)
def sql_topn_groups(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.top_groups(
        _fact_view(spark, folder), "n_name", analytics.settled_round(F.avg("o_totalprice"), 4), 5, "avg_value"
    )


@proof("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12")
def sql_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.over_threshold(table(spark, folder, "orders"), "o_custkey", 12)


@proof(
    """SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_name LIKE '%ring%'
       ORDER BY p_retailprice DESC, p_partkey LIMIT 50"""
)
def sql_like_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A substring question under the default result-size guard."""
    parts = analytics.like(table(spark, folder, "part"), "p_name", "%ring%")
    return guarded(
        parts.select("p_partkey", "p_name", "p_retailprice"),
        [F.col("p_retailprice").desc(), F.col("p_partkey")],
    )


@proof(
    """SELECT p_partkey, p_name, p_brand, p_type, p_size, 'colour,p_type' AS skipped FROM part
       WHERE p_brand = 'Brand#7' AND contains(p_name, 'bolt') AND p_size = 11
          OR p_brand = 'Brand#12' AND contains(p_name, 'red') OR CAST(p_retailprice AS FLOAT) = CAST(900.9 AS FLOAT)"""
)
def filter_compile(spark: SparkSession, folder: str) -> DataFrame:
    """Two filter dictionaries; empty values ask nothing, unknown and unfit ones are reported."""
    spec = {"p_brand": "string", "p_name": "contains", "p_size": "int", "p_type": "bool"}
    first = compile_filter({"p_brand": "Brand#7", "p_name": "bolt", "p_size": "11", "colour": "red",
                            "p_type": "maybe"}, spec)
    second = compile_filter({"p_brand": "Brand#12", "p_name": "red", "p_size": None}, spec)
    third = compile_filter({"price": "900.9"}, {"price": "float"})
    skipped = F.lit(",".join(first.skipped + second.skipped))
    parts = table(spark, folder, "part").withColumn("price", F.col("p_retailprice").cast("float"))
    parts = parts.where(first.predicate | second.predicate | third.predicate).withColumn("skipped", skipped)
    return parts.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "skipped")


_PART_FACETS = {
    "brands": FreeChoice("p_brand", "string"),
    "names": FreeChoice("p_name", "contains"),
    "types": {"Economy": Choice("p_type", "string", "ECONOMY"), "Standard": Choice("p_type", "string", "STANDARD"),
              "Large": Choice("p_size", "int", 50), "Tiny": Choice("p_size", "int", 1)},
    "days": {"Priced": Choice("p_retailprice", "present")},
}


@proof(
    """SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part
       WHERE (p_brand = 'Brand#3' OR p_brand = 'Brand#7' OR p_brand = 'Brand#20')
         AND (contains(p_name, 'ring') OR contains(p_name, 'blue'))
         AND (p_type = 'ECONOMY' OR p_type = 'STANDARD') AND p_retailprice IS NOT NULL""",
    name="facet_filter",
)
def facet_filter_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Choices of one column are alternatives; columns and groups narrow each other."""
    chosen = {"brands": ["Brand#3", "Brand#7", "Brand#20"], "names": ["ring", "blue"],
              "types": ["Economy", "Standard"], "days": ["Priced"]}
    parts = facet_filter(table(spark, folder, "part"), chosen, _PART_FACETS)
    return parts.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")


@proof(
    """SELECT c_custkey, c_name, c_acctbal, 0 AS version FROM customer WHERE c_mktsegment <> 'MACHINERY'
       UNION ALL SELECT c_custkey, upper(c_name), c_acctbal + 1, 1 FROM customer WHERE c_mktsegment = 'MACHINERY'
       UNION ALL SELECT 1000000000 + c_custkey, c_name, c_acctbal, 1 FROM customer WHERE c_mktsegment = 'BUILDING'"""
)
def keyed_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """One merged frame: changed rows replaced, new ones inserted, the rest kept."""
    from stratica.operators.upsert import upsert

    customers = table(spark, folder, "customer")
    base = customers.select("c_custkey", "c_name", "c_acctbal", F.lit(0).alias("version"))
    changed = customers.where(F.col("c_mktsegment") == "MACHINERY").select(
        "c_custkey", F.upper("c_name").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal"),
        F.lit(1).alias("version"),
    )
    added = customers.where(F.col("c_mktsegment") == "BUILDING").select(
        (F.col("c_custkey") + 1000000000).alias("c_custkey"), "c_name", "c_acctbal", F.lit(1).alias("version")
    )
    batch = changed.unionByName(added)
    order = [F.col("version").desc()]
    once = upsert(base, batch, "c_custkey", order)
    return upsert(once, batch, "c_custkey", order)
