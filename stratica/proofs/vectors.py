"""Embedding and exact cosine search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratica.functions.vectors import dot, has_dims
from stratica.operators.blockwise import blockwise_topk
from stratica.operators.embedding import DIMS, QUERY, embed
from stratica.operators.vectors import dimension_report, hit_view, ranked, vector_topk, with_payload
from stratica.operators.upsert import current, write_batch
from stratica.plans.answers import hybrid_search
from stratica.proofs.hashed import cells, scores
from stratica.proofs.registry import proof, stored_documents, table
from stratica.session import work_folder

VECTOR_DIMS = 64
_NAMES = {"point_id": "vec_id", "vector": "embedding"}


def _centroids(points: DataFrame, by: str | None) -> DataFrame:
    """Mean vector per label (or of everything): a query set derived from the whole table."""
    cells = points.select(*([by] if by else []), F.posexplode("embedding").alias("cell", "v"))
    group = [by] if by else []
    means = cells.groupBy(*group, "cell").agg(F.avg(F.col("v").cast("double")).alias("v"))
    vectors = means.groupBy(*group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("cell", "v"))), lambda c: c["v"]).alias("query_vector")
    )
    return vectors.select((F.col(by) if by else F.lit(0)).alias("query_id"), "query_vector")


def _centroid_sql(by: str) -> str:
    return f"""
      spread AS (SELECT {by} AS query_id, unnest(range(64)) AS i, unnest(embedding) AS v FROM embeddings),
      means AS (SELECT query_id, i, avg(CAST(v AS DOUBLE)) AS v FROM spread GROUP BY ALL),
      queries AS (SELECT query_id, list(v ORDER BY i) AS qv FROM means GROUP BY ALL)"""


def _ranked_sql(points: str) -> str:
    return f"""
      scored AS (SELECT query_id, vec_id, label,
                        round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), qv), 9) AS s
                 FROM queries CROSS JOIN {points}),
      best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM scored)"""


@proof(
    f"""WITH {_centroid_sql("0")}, {_ranked_sql("(SELECT * FROM embeddings WHERE label >= 3)")}
        SELECT CAST(rank AS INTEGER) AS rank, vec_id, CAST(label AS VARCHAR) AS label, round(s, 4) AS score
        FROM best WHERE rank <= 10"""
)
def vector_topk_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """Top 10 for one query vector among the points a filter admits, shown with defaults."""
    points = table(spark, folder, "embeddings")
    hits = vector_topk(points, _centroids(points, None), 10, dims=VECTOR_DIMS, where=F.col("label") >= 3, **_NAMES)
    payload = with_payload(hits, points.select("vec_id", "label"), "vec_id")
    return hit_view(payload, {"label": ""}, keep=["rank", "vec_id"])


@proof(
    f"""WITH {_centroid_sql("label")}, {_ranked_sql("embeddings")}
        SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(s, 4) AS score FROM best WHERE rank <= 10"""
)
def vector_topk_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Top 10 for every label's mean vector in one pass over the points."""
    points = table(spark, folder, "embeddings")
    hits = vector_topk(points, _centroids(points, "label"), 10, dims=VECTOR_DIMS, **_NAMES)
    return hits.withColumn("score", F.round("score", 4))


_ASKING = "queries AS (SELECT vec_id AS query_id, label AS own, CAST(embedding AS DOUBLE[]) AS qv FROM embeddings WHERE vec_id % 100 = 0)"


def _asking(points: DataFrame) -> DataFrame:
    """Every hundredth vector as a question."""
    return points.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"), "label")


@proof(
    f"""WITH {_ASKING}, {_ranked_sql("embeddings")}
        SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(s, 4) AS score FROM best WHERE rank <= 10"""
)
def vector_topk_table(spark: SparkSession, folder: str) -> DataFrame:
    """Top 10 for a table of query vectors that never reaches the driver."""
    points = table(spark, folder, "embeddings")
    hits = blockwise_topk(points, _asking(points), 10, dims=VECTOR_DIMS, **_NAMES)
    return hits.withColumn("score", F.round("score", 4))


@proof(
    f"""WITH {_ASKING}, {_ranked_sql("embeddings WHERE label = own")}
        SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(s, 4) AS score FROM best WHERE rank <= 10"""
)
def restricted_topk_table(spark: SparkSession, folder: str) -> DataFrame:
    """Top 10 for a table of query vectors, each among the points of its own label."""
    points = table(spark, folder, "embeddings")
    asking = _asking(points)
    hits = blockwise_topk(
        points, asking, 10, dims=VECTOR_DIMS, allowed=asking.select("query_id", "label"), entity="label", **_NAMES
    )
    return hits.withColumn("score", F.round("score", 4))


@proof(
    f"""WITH {_centroid_sql("0")}, {_ranked_sql("embeddings")}
        SELECT vec_id, CAST(rank AS INTEGER) AS rank, round(s, 4) AS score FROM best WHERE rank <= 5"""
)
def similarity_smoke(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest points, scored by native expressions instead of in blocks."""
    from stratica.functions.vectors import cosine

    points = table(spark, folder, "embeddings")
    query = _centroids(points, None).first()
    vector = F.array(*[F.lit(float(v)) for v in query["query_vector"]])
    scored = points.select(
        F.lit(0).alias("query_id"), "vec_id", F.round(cosine(F.col("embedding"), vector), 9).alias("score")
    )
    return ranked(scored, "query_id", "vec_id", 5).select("vec_id", "rank", F.round("score", 4).alias("score"))


@proof(
    """SELECT label, len(embedding) AS dims, count(*) AS points,
              count(*) FILTER (len(embedding) = 64 AND label <> 7) AS accepted,
              count(*) FILTER (label = 7) AS refused
       FROM embeddings GROUP BY ALL"""
)
def vector_dim_check(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors against the configured length; those cut short are reported."""
    points = table(spark, folder, "embeddings")
    short = F.when(F.col("label") == 7, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    stored = points.withColumn("stored", short)
    refused = dimension_report(stored, "stored", VECTOR_DIMS).groupBy("label").agg(F.count(F.lit(1)).alias("refused"))
    counts = stored.groupBy("label", F.size("embedding").cast("bigint").alias("dims")).agg(
        F.count(F.lit(1)).alias("points"), F.count_if(has_dims(F.col("stored"), VECTOR_DIMS)).alias("accepted")
    )
    return counts.join(refused, "label", "left").withColumn("refused", F.coalesce("refused", F.lit(0)))


@proof(
    f"""WITH top_labels AS (SELECT label FROM embeddings GROUP BY label ORDER BY count(*) DESC, label LIMIT 3),
        {_centroid_sql("0")}, {_ranked_sql("(SELECT * FROM embeddings WHERE label IN (SELECT label FROM top_labels))")}
        SELECT vec_id, CAST(rank AS INTEGER) AS rank, round(s, 4) AS score FROM best WHERE rank <= 10"""
)
def hybrid_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Top 10 within the three most frequent labels: relational top-N, semi-join and search in one plan."""
    points = table(spark, folder, "embeddings")
    top = (
        points.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "label").limit(3)
    )
    hits = hybrid_search(
        points, _centroids(points, None), top.select("label"), "label", 10, dims=VECTOR_DIMS, **_NAMES
    )
    return hits.select("vec_id", "rank", F.round("score", 4).alias("score"))


@proof(
    """SELECT vec_id, label, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total,
              CASE WHEN label < 4 THEN 1 ELSE 0 END AS version FROM embeddings WHERE label <> 9
       UNION ALL
       SELECT vec_id, label, round(list_sum(CAST(embedding AS DOUBLE[])), 6), 1 FROM embeddings WHERE label = 9"""
)
def vector_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches by key, the second overlapping the first and landed twice."""
    at = work_folder(spark, "points")
    points = table(spark, folder, "embeddings")
    first = points.where("label <> 9").withColumn("version", F.lit(0))
    second = points.where("label < 4 OR label = 9").withColumn("version", F.lit(1))
    write_batch(first, at, 0)
    write_batch(second, at, 1)
    write_batch(second, at, 1)
    total = F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v.cast("double"))
    return current(spark, at, "vec_id").select("vec_id", "label", F.round(total, 6).alias("total"), "version")


@proof(
    f"""WITH {cells("d", "doc_id", "source || ' | ' || lang || ' | ' || text", "documents")}
        SELECT key AS doc_id, 768 AS dims, count(*) AS filled, round(sum(v * v), 6) AS squared,
               round(sum(v * cell), 4) AS weighted FROM d_stored GROUP BY key"""
)
def embed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents embedded on the executors; every cell enters the comparison."""
    from stratica.functions.text import embedding_text

    docs = table(spark, folder, "documents").select(
        "doc_id", embedding_text(F.col("source"), F.col("lang"), F.col("text")).alias("body")
    )
    weighted = F.transform("embedding", lambda v, i: v.cast("double") * i)
    return embed(docs, "body", partitions=spark.sparkContext.defaultParallelism).select(
        "doc_id",
        F.size("embedding").alias("dims"),
        F.size(F.filter("embedding", lambda v: v > 0)).cast("bigint").alias("filled"),
        F.round(dot(F.col("embedding"), F.col("embedding")), 6).alias("squared"),
        F.round(F.aggregate(weighted, F.lit(0.0), lambda s, x: s + x), 4).alias("weighted"),
    )


@proof(
    f"""WITH {cells("b", "item_id", "text", "benchmark")}, {cells("d", "doc_id", "text", "documents")},
        {scores("b", "d")}
        SELECT q AS query_id, p AS doc_id, CAST(rank AS INTEGER) AS rank, round(s, 4) AS score
        FROM best WHERE rank <= 10"""
)
def semantic_search(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark passage as a question, its ten most similar documents."""
    documents = stored_documents(spark, folder).withColumnRenamed("point_id", "doc_id")
    questions = embed(
        table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text"),
        "text", task=QUERY, into="query_vector",
    )
    hits = vector_topk(documents, questions, 10, dims=DIMS, point_id="doc_id")
    return hits.withColumn("score", F.round("score", 4))
