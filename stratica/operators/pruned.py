"""Exact cosine search that leaves most points unread.

Points are stored by cluster: each goes to the nearest of a bounded number of centres, with its angle to it. The
widest angle of a cluster bounds how similar any of its points can be to a query: no point lies nearer than
angle(query, centre) - radius. A search first scores the clusters most promising to a query, enough to hold k points;
the k-th score rules out every cluster whose bound is below it, and the rest is scored in full. Results are those of a full
scan, ties included; what the layout decides is only how many points are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratica.operators.vectors import TOP_K, _unit, _well_formed, ranked, restricted_topk

CLUSTER, ANGLE = "_cluster", "_angle"
#: Points looked at for the centres: this many for each, and never more than ``MOST``.
SAMPLED_EACH, MOST = 32, 20_000
_ROUNDS = 4
#: Bounds are loosened by more than scores are rounded.
_SLACK = 1e-7


def centres(points: DataFrame, clusters: int, dims: int, point_id: str = "point_id", vector: str = "embedding") -> np.ndarray:
    """Unit vectors of the centres, from a bounded sample in hash order of the ids. They set the cost of a search, not its result."""
    size = min(MOST, SAMPLED_EACH * clusters)
    rows = points.where(F.size(vector) == dims).select(F.xxhash64(point_id).alias("h"), vector).orderBy("h").limit(size).collect()
    sample = _unit(np.array([r[1] for r in rows], dtype=np.float64).reshape(-1, dims))
    sample = sample[np.isfinite(sample).all(axis=1)]
    means = sample[:clusters].copy()
    for _ in range(_ROUNDS):
        nearest = (sample @ means.T).argmax(axis=1) if len(means) else np.empty(0, dtype=int)
        for i in range(len(means)):
            if (nearest == i).any():
                means[i] = sample[nearest == i].sum(axis=0)
        means = _unit(means)
    return means


def clustered(points: DataFrame, means: np.ndarray, vector: str = "embedding") -> DataFrame:
    """``points`` with their cluster and angle to its centre, to be written ``partitionBy(CLUSTER)``.

    Points whose vector has another length or is not finite are left out, as a search leaves them out.
    """
    dims = means.shape[1]
    names = [vector, *[c for c in points.columns if c != vector]]
    schema = T.StructType([*points.select(*names).schema.fields, T.StructField(CLUSTER, T.IntegerType()), T.StructField(ANGLE, T.DoubleType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # the shared check expects the vector in second place
            held = pa.RecordBatch.from_arrays([batch.column(0), *batch.columns], names=["_", *batch.schema.names])
            held, rows = _well_formed(held, dims)
            scores = _unit(rows) @ means.T
            own = scores.argmax(axis=1)
            angle = np.arccos(np.clip(scores[np.arange(len(own)), own], -1, 1))
            yield pa.RecordBatch.from_arrays([*held.columns[1:], pa.array(own.astype(np.int32)), pa.array(angle)], names=schema.names)

    return points.select(*names).mapInArrow(assign, schema)


def cluster_table(points: DataFrame) -> DataFrame:
    """``(cluster, radius, n)`` of stored points; no more rows than there are centres."""
    return points.groupBy(CLUSTER).agg(F.max(ANGLE).alias("radius"), F.count(F.lit(1)).alias("n"))


def bounds(queries: DataFrame, sizes: DataFrame, means: np.ndarray, query_id: str = "query_id", query_vector: str = "query_vector") -> DataFrame:
    """``(query id, cluster, most, n)``: the highest similarity any point of the cluster can have to the query."""
    rows = sizes.collect()  # one row per centre
    own = np.array([r[CLUSTER] for r in rows], dtype=np.int32)
    radius, n = np.array([r["radius"] for r in rows]), np.array([r["n"] for r in rows], dtype=np.int64)
    dims = means.shape[1]
    schema = T.StructType(
        [queries.schema[query_id], T.StructField(CLUSTER, T.IntegerType()), T.StructField("most", T.DoubleType()), T.StructField("n", T.LongType())]
    )

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch, vectors = _well_formed(batch, dims)
            if not batch.num_rows or not len(own):
                continue
            angle = np.arccos(np.clip(_unit(vectors) @ means[own].T, -1, 1))
            most = np.cos(np.maximum(0, angle - radius)) + _SLACK
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), len(own))))
            columns = [ids, pa.array(np.tile(own, batch.num_rows)), pa.array(most.ravel()), pa.array(np.tile(n, batch.num_rows))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return queries.select(query_id, query_vector).mapInArrow(bound, schema)


def pruned_topk(
    points: DataFrame,
    queries: DataFrame,
    means: np.ndarray,
    k: int = TOP_K,
    *,
    point_id: str = "point_id",
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
) -> tuple[DataFrame, DataFrame]:
    """The k most similar of the stored ``points`` to each query, as ``vector_topk`` gives them, and ``(query id, scored)``:
    how many points were scored for it."""
    names = {"point_id": point_id, "vector": vector, "query_id": query_id, "query_vector": query_vector, "dims": means.shape[1]}
    reach = bounds(queries, cluster_table(points), means, query_id, query_vector)
    promising = Window.partitionBy(query_id).orderBy(F.col("most").desc(), CLUSTER)
    before = F.coalesce(F.sum("n").over(promising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reach = reach.withColumn("first", before < k)
    seen = points.select(point_id, vector, CLUSTER)
    near = restricted_topk(seen, queries, reach.where("first"), k, entity=CLUSTER, **names)
    floor = near.where(F.col("rank") == k).select(query_id, F.col("score").alias("floor"))
    left = reach.where(~F.col("first")).join(floor, query_id, "left").where(F.col("floor").isNull() | (F.col("most") >= F.col("floor")))
    far = restricted_topk(seen, queries, left, k, entity=CLUSTER, **names)
    hits = ranked(near.drop("rank").unionByName(far.drop("rank")), query_id, point_id, k)
    every = reach.where("first").select(query_id, "n").unionByName(left.select(query_id, "n"))
    return hits, every.groupBy(query_id).agg(F.sum("n").alias("scored"))
