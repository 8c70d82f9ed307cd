"""Cleaning rules on composed text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratica.functions import clean
from stratica.functions.literals import bool_dict, literal_text, unparsed
from stratica.plans.medallion import clean_businesses
from stratica.proofs import records
from stratica.proofs.registry import proof, table, views
from stratica.sources import contracts as c


@proof(records.expected_businesses())
def silver_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Every typed business column out of raw text."""
    return clean_businesses(records.raw_businesses(spark, folder)).drop(c.STAMP)


_NUMBERS = """SELECT o_orderkey, CASE o_orderkey % 8
      WHEN 0 THEN CAST(o_totalprice AS STRING)
      WHEN 1 THEN concat('  ', CAST(o_totalprice AS STRING), ' ')
      WHEN 2 THEN 'abc'
      WHEN 3 THEN '1e2'
      WHEN 4 THEN concat('-', CAST(o_totalprice AS STRING))
      WHEN 5 THEN concat('+', CAST(o_orderkey AS STRING), '.')
      WHEN 6 THEN concat(CAST(o_orderkey AS STRING), '99999999999')
    END AS raw FROM orders"""


@proof(
    """SELECT o_orderkey,
         CAST(CASE o_orderkey % 8 WHEN 0 THEN trunc(o_totalprice) WHEN 1 THEN trunc(o_totalprice)
              WHEN 4 THEN -trunc(o_totalprice) WHEN 5 THEN o_orderkey END AS INTEGER) AS whole,
         CAST(CAST(CASE o_orderkey % 8 WHEN 0 THEN o_totalprice WHEN 1 THEN o_totalprice WHEN 3 THEN 100
              WHEN 4 THEN -o_totalprice WHEN 5 THEN o_orderkey
              WHEN 6 THEN CAST(CAST(o_orderkey AS VARCHAR) || '99999999999' AS DOUBLE) END AS FLOAT) AS DOUBLE) AS fractional
       FROM orders"""
)
def numeric_cast(spark: SparkSession, folder: str) -> DataFrame:
    """Lenient numeric reading: decimals truncate, exponents and overflow give null."""
    views(spark, folder, "orders")
    rows = spark.sql(_NUMBERS)
    return rows.select(
        "o_orderkey",
        clean.lenient_int(F.col("raw")).alias("whole"),
        clean.lenient_float(F.col("raw")).cast("double").alias("fractional"),
    )


_DICTS = """SELECT p_partkey, CASE p_partkey % 7
      WHEN 6 THEN '{''garage'': True, ''x'': {''y'': {''z'': [1, (2, {''w'': False})]}}, ''lot'': False}'
      WHEN 0 THEN concat('{''garage'': ', CASE WHEN p_size > 25 THEN 'True' ELSE 'False' END, ', ''street'': True}')
      WHEN 1 THEN '{u''valet'': False, u''garage'': None}'
      WHEN 2 THEN 'None'
      WHEN 3 THEN '{}'
      WHEN 4 THEN p_name
      WHEN 5 THEN '{''garage'': True, ''note'': ''a, {b}: True'', "garage": False, ''lot'': {''x'': True}}'
    END AS raw FROM part"""


@proof(
    """SELECT p_partkey, p_partkey % 7 IN (0, 1, 3, 5, 6) AS is_dict,
         CASE p_partkey % 7 WHEN 0 THEN p_size > 25 WHEN 5 THEN false WHEN 6 THEN true END AS garage,
         CASE p_partkey % 7 WHEN 0 THEN true END AS street,
         CASE p_partkey % 7 WHEN 1 THEN false END AS valet,
         CAST(CASE p_partkey % 7 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 3 THEN 0 WHEN 5 THEN 1 WHEN 6 THEN 2 END AS INTEGER) AS entries
       FROM part"""
)
def dict_literal_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Dict literals to maps, and known keys to columns."""
    views(spark, folder, "part")
    parsed = spark.sql(_DICTS).select("p_partkey", bool_dict(F.col("raw")).alias("flags"))
    return parsed.select(
        "p_partkey",
        F.col("flags").isNotNull().alias("is_dict"),
        *[F.try_element_at("flags", F.lit(k)).alias(k) for k in ("garage", "street", "valet")],
        F.when(F.col("flags").isNotNull(), F.size("flags")).alias("entries"),
    )


_LITERALS = """SELECT p_partkey, CASE p_partkey % 7
      WHEN 0 THEN concat('u''', p_name, '''')
      WHEN 1 THEN concat('''', p_name, '''')
      WHEN 2 THEN 'None'
      WHEN 3 THEN p_name
      WHEN 4 THEN CAST(p_size AS STRING)
      WHEN 5 THEN concat('"', p_type, '''s"')
    END AS raw FROM part"""


@proof(
    """SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN p_name WHEN 1 THEN p_name
         WHEN 4 THEN CAST(p_size AS VARCHAR) WHEN 5 THEN p_type || '''s' END AS word FROM part"""
)
def literal_unwrap(spark: SparkSession, folder: str) -> DataFrame:
    """String literals without their wrappers."""
    views(spark, folder, "part")
    return spark.sql(_LITERALS).select("p_partkey", literal_text(F.col("raw")).alias("word"))


@proof("""SELECT p_partkey, 'raw' AS field, p_name AS raw FROM part WHERE p_partkey % 7 = 4""")
def parse_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Attribute text that could not be parsed, as rows."""
    views(spark, folder, "part")
    return unparsed(spark.sql(_DICTS), "p_partkey", dicts=["raw"])


@proof(
    """WITH h AS (SELECT doc_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(source || '/' || lang || '/' || CAST(doc_id AS VARCHAR))) AS d FROM documents)
       SELECT doc_id, substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-' ||
         CASE WHEN substr(d, 17, 1) IN ('0','4','8','c') THEN '8' WHEN substr(d, 17, 1) IN ('1','5','9','d') THEN '9'
              WHEN substr(d, 17, 1) IN ('2','6','a','e') THEN 'a' ELSE 'b' END
         || substr(d, 18, 3) || '-' || substr(d, 21, 12) AS point_id FROM h"""
)
def uuid5_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Deterministic point ids."""
    from stratica.functions.identity import uuid5

    name = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return table(spark, folder, "documents").select("doc_id", uuid5(name).alias("point_id"))


@proof(
    """SELECT doc_id, source || ' | ' || coalesce(nullif(lang, 'de'), '') || ' | ' || text AS embedding_text
       FROM documents"""
)
def embedding_text(spark: SparkSession, folder: str) -> DataFrame:
    """Text to embed; a missing part leaves an empty place."""
    from stratica.functions.text import embedding_text as joined

    lang = F.nullif(F.col("lang"), F.lit("de"))
    return table(spark, folder, "documents").select(
        "doc_id", joined(F.col("source"), lang, F.col("text")).alias("embedding_text")
    )


@proof(
    """SELECT c_custkey, '{"c_custkey":' || c_custkey
         || CASE WHEN c_custkey % 3 <> 0 THEN ',"c_name":"' || c_name || '"' ELSE '' END
         || CASE WHEN c_custkey % 4 <> 0 THEN ',"c_acctbal":' || CAST(c_acctbal AS VARCHAR) ELSE '' END
         || ',"c_mktsegment":"' || c_mktsegment || '"}' AS payload FROM customer"""
)
def payload_json(spark: SparkSession, folder: str) -> DataFrame:
    """Payload objects without their null members."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key,
        F.to_json(
            F.struct(
                key,
                F.when(key % 3 != 0, F.col("c_name")).alias("c_name"),
                F.when(key % 4 != 0, F.col("c_acctbal")).alias("c_acctbal"),
                "c_mktsegment",
            )
        ).alias("payload"),
    )
