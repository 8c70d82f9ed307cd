"""Questions to answers: SQL, vector and hybrid search as plans over a batch of questions."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratica.functions.text import answer_context, empty_answer, hit_block
from stratica.operators.filters import BUSINESS_FILTERS, CompiledFilter, compile_filter
from stratica.operators.joins import restricted_to
from stratica.operators.vectors import TOP_K, hit_view, restricted_topk, vector_topk, with_payload
from stratica.sources import contracts as c


def filtered_search(
    points: DataFrame,
    queries: DataFrame,
    filters: dict[str, Any],
    k: int = TOP_K,
    *,
    dims: int,
    spec: dict[str, str] = BUSINESS_FILTERS,
    **names,
) -> tuple[DataFrame, CompiledFilter]:
    """Vector search among the points that pass a filter dictionary."""
    compiled = compile_filter(filters, spec)
    return vector_topk(points, queries, k, dims=dims, where=compiled.predicate, **names), compiled


def hybrid_search(
    points: DataFrame,
    queries: DataFrame,
    ids: DataFrame,
    key: str,
    k: int = TOP_K,
    *,
    dims: int,
    **names,
) -> DataFrame:
    """Vector search among the points of the entities a relational question selected: one plan."""
    return vector_topk(restricted_to(points, ids, key), queries, k, dims=dims, **names)


def routed_search(
    points: DataFrame,
    questions: DataFrame,
    sql_ids: DataFrame,
    k: int = TOP_K,
    *,
    dims: int,
    entity: str = "business_id",
    where: Column | None = None,
) -> DataFrame:
    """Hits of a batch of questions ``(query_id, route, query_vector)`` by route.

    A HYBRID question with ids in ``sql_ids (query_id, entity)`` searches those entities only; one
    without falls back to the filtered search, as VECTOR does. SQL questions have no hits.
    """
    searching = questions.where(F.col("route") != "SQL")
    usable = sql_ids.where(F.col(entity).isNotNull() & (F.col(entity).cast("string") != ""))
    hybrid = F.col("route") == "HYBRID"
    limited = searching.where(hybrid).join(usable.select("query_id"), "query_id", "left_semi")
    free = searching.join(limited.select("query_id"), "query_id", "left_anti")
    pairs = usable.join(limited.select("query_id"), "query_id", "left_semi")
    inside = restricted_topk(points, limited, pairs, k, entity=entity, dims=dims)
    everywhere = vector_topk(points, free, k, dims=dims, where=where)
    return everywhere.unionByName(inside)


def contexts(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """One row per question ``(query_id, query, route, sql_result, error)`` with its answer context.

    ``hits`` has the shown fields of at most k hits per question. ``answer`` is filled where the
    outcome is fixed (failed or empty); elsewhere it is null and the context is what to answer from.
    """
    fields = {n: F.col(n) for n in ("name", "city", "state", "business_stars", "review_stars",
                                    "categories", "text", "score")}
    blocks = (
        hits.select("query_id", F.struct("rank", hit_block(F.col("rank"), fields).alias("block")).alias("hit"))
        .groupBy("query_id")
        .agg(F.array_sort(F.collect_list("hit"))["block"].alias("blocks"))
    )
    asked = questions.join(blocks, "query_id", "left").withColumn(
        "blocks", F.coalesce("blocks", F.array().cast("array<string>"))
    )
    route, sql_result = F.col("route"), F.col("sql_result")
    return asked.select(
        "query_id",
        "route",
        F.size("blocks").alias("hit_count"),
        answer_context(route, F.col("query"), sql_result, F.col("blocks")).alias("context"),
        empty_answer(route, F.col("error"), sql_result, F.size("blocks")).alias("answer"),
    )


def shown_hits(hits: DataFrame, points: DataFrame, at_most: int | None = None) -> DataFrame:
    """Hits with the fields an answer shows; ``at_most`` bounds their number."""
    payload = points.select("point_id", *[n for n in c.PAYLOAD_FIELDS if n in points.columns])
    return hit_view(with_payload(hits, payload, at_most=at_most), keep=["query_id", "rank", "point_id"])


def answer(
    points: DataFrame,
    questions: DataFrame,
    sql_ids: DataFrame,
    k: int = TOP_K,
    *,
    dims: int,
    where: Column | None = None,
) -> DataFrame:
    """Questions to contexts in one call: search by route, fetch what hits show, render.

    ``questions`` carries ``query_id, query, route, sql_result, error, query_vector``.
    """
    hits = routed_search(points, questions, sql_ids, k, dims=dims, where=where)
    return contexts(questions, shown_hits(hits, points, k * questions.count()))
