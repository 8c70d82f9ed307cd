"""Routes, contexts and message texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratica.functions import text as answer_texts
from stratica.functions.text import content_text as text_of
from stratica.functions.text import route_of
from stratica.operators.embedding import DIMS, QUERY, embed
from stratica.operators.vectors import hit_view, with_payload
from stratica.plans.answers import contexts, routed_search
from stratica.proofs.hashed import cells, scores
from stratica.proofs.registry import proof, stored_documents, table, views

_REPLIES = """SELECT event_id, CASE event_id % 8
      WHEN 6 THEN '{"route": "SQL"} and more' WHEN 7 THEN '{''route'': ''SQL''}'
      WHEN 0 THEN '{"route": "sql"}' WHEN 1 THEN '{"route": "Vector"}' WHEN 2 THEN '{"route": "HYBRID"}'
      WHEN 3 THEN concat('{"route": "', event_type, '"}') WHEN 4 THEN 'route sql' WHEN 5 THEN '{"path": "SQL"}'
    END AS reply FROM events"""


@proof(
    """SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'SQL' WHEN 1 THEN 'VECTOR' ELSE 'HYBRID' END AS route FROM events"""
)
def route_normalize(spark: SparkSession, folder: str) -> DataFrame:
    views(spark, folder, "events")
    return spark.sql(_REPLIES).select("event_id", route_of(F.col("reply")).alias("route"))


@proof(
    """SELECT conv_id, turn, trim(CASE WHEN role = 'user' THEN text
         ELSE text || chr(10) || role END, ' ' || chr(9) || chr(10) || chr(13) || chr(12)) AS body FROM conversations"""
)
def content_text(spark: SparkSession, folder: str) -> DataFrame:
    """Messages stored as plain text or as a list of content blocks."""
    parts = [
        F.to_json(F.struct(F.lit(kind).alias("type"), text.alias("text")))
        for kind, text in (("text", F.col("text")), ("signature", F.lit(None).cast("string")), ("text", F.col("role")))
    ]
    # a plain string between the blocks has no text field and is passed over
    blocks = F.concat(F.lit("["), parts[0], F.lit(', "plain", '), parts[1], F.lit(","), parts[2], F.lit("]"))
    stored = F.when(F.col("role") == "user", F.concat(F.lit("  "), "text", F.lit("\n"))).otherwise(blocks)
    return table(spark, folder, "conversations").select("conv_id", "turn", text_of(stored).alias("body"))


# Every benchmark passage is a question; its route follows from its id.
_ROUTE = "CASE item_id % 3 WHEN 0 THEN 'VECTOR' WHEN 1 THEN 'HYBRID' ELSE 'SQL' END"
_SQL_RESULT = "CASE WHEN item_id % 3 <> 0 AND item_id % 2 = 0 THEN concat('rows: ', CAST(item_id AS STRING)) END"
# A hybrid question may search two of the sources.
_SOURCES = ["concat('src', CAST(item_id % 20 AS STRING))", "concat('src', CAST((item_id + 7) % 20 AS STRING))"]
_VISIBLE = """q.key % 3 = 0 OR q.key % 3 = 1 AND EXISTS (SELECT 1 FROM documents WHERE doc_id = p.key
             AND source IN ('src' || q.key % 20, 'src' || (q.key + 7) % 20))"""
_ERROR = "CASE WHEN item_id % 10 = 9 THEN 'timeout' END"


def _score_sql(score: str) -> str:
    return f"CAST(round({score}, 4) AS VARCHAR)"


@proof(
    f"""WITH {cells("b", "item_id", "text", "benchmark")}, {cells("d", "doc_id", "text", "documents")},
        {scores("b", "d", pairs=_VISIBLE)},
        shown AS (SELECT q, string_agg(rank || '. ' || source || ' (' || lang || ', ) — Business: ' || n_chars || '★, Review: ★, '
               || 'Categories: ' || lang || chr(10) || '   Review: "' || substr(text, 1, 200) || '..."' || chr(10)
               || '   Relevance: ' || {_score_sql("s")}, chr(10) ORDER BY rank) AS blocks, count(*) AS hits
             FROM best JOIN documents ON doc_id = p WHERE rank <= 10 GROUP BY q),
        asked AS (SELECT item_id, text, {_ROUTE} AS route, {_SQL_RESULT} AS sql_result, {_ERROR} AS error, blocks,
                         coalesce(hits, 0) AS hits FROM benchmark LEFT JOIN shown ON q = item_id)
        SELECT item_id AS query_id, route, CAST(hits AS INTEGER) AS hit_count,
          'User question: ' || text
            || CASE WHEN sql_result IS NOT NULL THEN chr(10) || chr(10) || 'SQL analysis results:' || chr(10) || sql_result ELSE '' END
            || CASE WHEN blocks IS NOT NULL THEN chr(10) || chr(10) || 'Semantic search results:' || chr(10) || blocks ELSE '' END
            AS context,
          CASE WHEN error IS NOT NULL THEN 'I encountered a temporary issue while processing your query. Please try again in a moment.'
               WHEN route = 'SQL' AND sql_result IS NULL THEN 'I couldn''t find data matching that query.'
          END || chr(10) || chr(10) || '---' || chr(10) || 'Routed as: ' || route AS answer
        FROM asked"""
)
def context_render(spark: SparkSession, folder: str) -> DataFrame:
    """A batch of questions by route, with the context each is answered from."""
    views(spark, folder, "benchmark")
    documents = table(spark, folder, "documents")
    points = stored_documents(spark, folder).withColumnRenamed("source", "business_id")
    asked = spark.sql(
        f"SELECT item_id AS query_id, text AS query, {_ROUTE} AS route, {_SQL_RESULT} AS sql_result, {_ERROR} AS error "
        "FROM benchmark"
    )
    questions = embed(asked, "query", task=QUERY, into="query_vector")
    ids = spark.sql(
        f"SELECT item_id AS query_id, explode(array({', '.join(_SOURCES)})) AS business_id FROM benchmark "
        f"WHERE {_ROUTE} = 'HYBRID'"
    )
    hits = routed_search(points, questions, ids, 10, dims=DIMS)
    payload = documents.select(
        F.col("doc_id").alias("point_id"),
        F.col("source").alias("name"),
        F.col("lang").alias("city"),
        F.lit(None).cast("string").alias("state"),
        F.col("lang").alias("categories"),
        F.lit(None).cast("int").alias("review_stars"),
        F.col("n_chars").alias("business_stars"),
        "text",
    )
    shown = hit_view(with_payload(hits, payload, at_most=10 * asked.count()), keep=["query_id", "rank"])
    return contexts(asked, shown)


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_OUTCOMES = """SELECT item_id AS query_id, text AS query,
      CASE item_id % 3 WHEN 0 THEN 'SQL' WHEN 1 THEN 'VECTOR' ELSE 'HYBRID' END AS route,
      CASE WHEN item_id % 2 = 0 THEN 'rows' END AS sql_result, CASE WHEN item_id % 7 = 0 THEN 'timeout' END AS error
    FROM benchmark"""


@proof(
    f"""SELECT query_id, CASE WHEN error IS NOT NULL THEN {_literal(answer_texts.ERROR_TEXT)}
             WHEN route = 'SQL' AND sql_result IS NULL THEN {_literal(answer_texts.NO_SQL_TEXT)}
             WHEN route = 'VECTOR' AND query_id % 4 <> 1 THEN {_literal(answer_texts.NO_VECTOR_TEXT)}
             WHEN route = 'HYBRID' AND sql_result IS NULL AND query_id % 4 <> 1 THEN {_literal(answer_texts.NO_HYBRID_TEXT)}
           END || chr(10) || chr(10) || '---' || chr(10) || 'Routed as: ' || route AS answer
        FROM ({_OUTCOMES})"""
)
def empty_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Questions of each route that failed, found nothing, or found something."""
    views(spark, folder, "benchmark")
    shown = {n: F.lit("x") for n in ("name", "city", "state", "categories", "review_stars", "business_stars")}
    hits = table(spark, folder, "benchmark").where("item_id % 4 = 1").select(
        F.col("item_id").alias("query_id"), F.lit(1).alias("rank"), "text", F.lit(0.5).alias("score"),
        *[c.alias(n) for n, c in shown.items()],
    )
    return contexts(spark.sql(_OUTCOMES), hits).select("query_id", "answer")
