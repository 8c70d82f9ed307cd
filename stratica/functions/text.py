"""Text assembled for embedding and for answers, and the small JSON envelopes around it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratica.functions.clean import decimal_float_text

# Texts and formats readers of the answers rely on (fixed values).
EMBEDDING_SEPARATOR = " | "
ROUTES = ("SQL", "VECTOR", "HYBRID")
FALLBACK_ROUTE = "HYBRID"
QUESTION_HEAD = "User question: "
SQL_HEAD = "SQL analysis results:\n"
HITS_HEAD = "Semantic search results:\n"
BLOCK_SEPARATOR = "\n\n"
ROUTED_SUFFIX = "\n\n---\nRouted as: "
REVIEW_EXCERPT = 200
SMOKE_EXCERPT = 150
ERROR_TEXT = (
    "I encountered a temporary issue while processing your query. Please try again in a moment."
)
NO_SQL_TEXT = "I couldn't find data matching that query."
NO_VECTOR_TEXT = "I couldn't find restaurants matching that description."
NO_HYBRID_TEXT = (
    "I couldn't find results from either the analytics or semantic search. Try rephrasing your query."
)


def embedding_text(*parts: Column) -> Column:
    """Parts joined by the separator; a missing part leaves its place empty."""
    return F.concat_ws(EMBEDDING_SEPARATOR, *[F.coalesce(p, F.lit("")) for p in parts])


def excerpt(text: Column, length: int = REVIEW_EXCERPT) -> Column:
    return F.concat(F.substring(text, 1, length), F.lit("..."))


def score_text(score: Column) -> Column:
    return decimal_float_text(F.round(score, 4))


def hit_block(rank: Column, hit: dict[str, Column]) -> Column:
    """One numbered hit, as shown in an answer's context."""
    return F.format_string(
        '%d. %s (%s, %s) — Business: %s★, Review: %s★, Categories: %s\n   Review: "%s"\n   Relevance: %s',
        rank, hit["name"], hit["city"], hit["state"], hit["business_stars"], hit["review_stars"],
        hit["categories"], excerpt(hit["text"]), score_text(hit["score"]),
    )


def answer_context(route: Column, question: Column, sql_result: Column, hits: Column) -> Column:
    """Question, then the SQL block and the hit blocks the route calls for; absent ones are left out.

    ``hits`` is an array of rendered blocks in rank order.
    """
    sql_block = F.when(
        route.isin("SQL", "HYBRID") & (F.coalesce(sql_result, F.lit("")) != ""),
        F.concat(F.lit(SQL_HEAD), sql_result),
    )
    hit_blocks = F.when(
        route.isin("VECTOR", "HYBRID") & (F.size(hits) > 0),
        F.concat(F.lit(HITS_HEAD), F.array_join(hits, "\n")),
    )
    return F.concat_ws(
        BLOCK_SEPARATOR, F.concat(F.lit(QUESTION_HEAD), question), sql_block, hit_blocks
    )


def empty_answer(route: Column, error: Column, sql_result: Column, hit_count: Column) -> Column:
    """The fixed answer for a failed or empty question; null when there is something to answer from."""
    no_sql = F.coalesce(sql_result, F.lit("")) == ""
    no_hits = F.coalesce(hit_count, F.lit(0)) == 0
    text = (
        F.when(F.coalesce(error, F.lit("")) != "", F.lit(ERROR_TEXT))
        .when((route == "SQL") & no_sql, F.lit(NO_SQL_TEXT))
        .when((route == "VECTOR") & no_hits, F.lit(NO_VECTOR_TEXT))
        .when((route == "HYBRID") & no_sql & no_hits, F.lit(NO_HYBRID_TEXT))
    )
    return routed(text, route)


def routed(answer: Column, route: Column) -> Column:
    return F.concat(answer, F.lit(ROUTED_SUFFIX), route)


def route_of(reply: Column) -> Column:
    """Route named in a ``{"route": …}`` reply; anything unusable falls back."""
    # one JSON value and nothing after it, with the quotes JSON has
    strict = F.json_array_length(F.concat(F.lit("["), reply, F.lit("]"))) == 1
    named = F.upper(F.from_json(F.when(strict, reply), "route string", {"allowSingleQuotes": "false"})["route"])
    return F.when(named.isin(*ROUTES), named).otherwise(F.lit(FALLBACK_ROUTE))


def content_text(content: Column) -> Column:
    """Plain text of a message: a JSON list of blocks gives its ``text`` parts, other text itself."""
    blocks = F.from_json(content, "array<variant>")
    # elements that are no objects have no ``text``
    texts = F.filter(F.transform(blocks, lambda b: F.try_variant_get(b, "$.text", "string")), lambda t: t.isNotNull())
    is_list = content.rlike(r"^\s*\[") & blocks.isNotNull()
    plain = F.when(is_list, F.array_join(texts, "\n")).otherwise(content)
    return F.regexp_replace(plain, r"^\s+|\s+$", "")
