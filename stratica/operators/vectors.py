"""Exact cosine search.

Points stay where they are: a bounded block of query vectors travels to every task, each task
keeps its own best k per query, and only those few rows are shuffled. A block is as many query vectors as
fit into 64 MB (10,000 of 768 dimensions), so one scan serves it; larger query sets take a scan per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stratica.functions.vectors import has_dims

TOP_K = 10
QUERY_BYTES = 64 << 20  # query vectors sent to the tasks at a time: 10,000 of 768 double dimensions
_CELLS = 1 << 22  # scores held at once in a task
_NOISE_DIGITS = 9  # differences below this are summation noise, not similarity


def dimension_report(points: DataFrame, vector: str, dims: int) -> DataFrame:
    """Points whose vector has not the configured length, with the length they have."""
    return points.where(~has_dims(F.col(vector), dims)).withColumn("actual_dims", F.size(vector))


def _well_formed(batch: pa.RecordBatch, dims: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows whose vector has ``dims`` finite numbers, and those vectors as a matrix."""
    sized = pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), dims), False)
    batch = batch.filter(sized)
    rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64)
    finite = np.isfinite(rows).all(axis=1)
    return (batch, rows) if finite.all() else (batch.filter(pa.array(finite)), rows[finite])


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties by id. Every tie at the boundary is weighed before cutting."""
    if len(scores) > k:
        boundary = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= boundary
        scores, ids = scores[keep], ids[keep]
    rank = np.unique(ids, return_inverse=True)[1]
    order = np.lexsort((rank, -scores))[:k]
    return scores[order], ids[order]


def _visible(lists: pa.Array, places: dict, width: int) -> np.ndarray:
    """Row by query mask out of each row's list of query ids."""
    mask = np.zeros((len(lists), width), dtype=bool)
    rows = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    mask[rows, [places[q] for q in lists.flatten().to_pylist()]] = True
    return mask


def _task_topk(query_ids: list, queries: np.ndarray, k: int, dims: int, schema: pa.Schema):
    """Search of one task over batches of (id, vector) or (id, vector, ids of the queries allowed)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(query_ids)
        places = {q: i for i, q in enumerate(query_ids)}
        step = max(1, _CELLS // max(1, len(query_ids)))
        for batch in batches:
            batch, rows = _well_formed(batch, dims)
            ids = np.array(batch.column(0).to_pylist())
            vectors = _unit(rows)
            for start in range(0, len(ids), step):
                part = ids[start : start + step]
                scores = np.round(vectors[start : start + step] @ queries.T, _NOISE_DIGITS)
                mask = None
                if batch.num_columns > 2:
                    mask = _visible(batch.column(2).slice(start, step), places, len(query_ids))
                for q, held in enumerate(best):
                    hopeful = slice(None) if mask is None else mask[:, q]
                    if held is not None and len(held[0]) == k:
                        rising = scores[:, q] >= held[0][-1]
                        hopeful = rising if mask is None else rising & hopeful
                    rivals, names = scores[hopeful, q], part[hopeful]
                    if not len(rivals):
                        continue
                    if held is not None:
                        rivals, names = np.concatenate([held[0], rivals]), np.concatenate([held[1], names])
                    best[q] = _best(rivals, names, k)
        for query_id, held in zip(query_ids, best):
            if held is not None:
                columns = [[query_id] * len(held[0]), held[1].tolist(), held[0].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
                )

    return search


def _query_blocks(queries: DataFrame, query_id: str, block: int, modulus: int = 1, residue: int = 0):
    """Collect the queries in blocks of at most ``block`` rows, halving a hash class that is larger."""
    part = queries if modulus == 1 else queries.where(
        F.pmod(F.xxhash64(query_id), F.lit(modulus)) == residue
    )
    rows = part.limit(block + 1).collect()
    if len(rows) <= block:
        if rows:
            yield rows
        return
    if modulus > 1 << 40:
        raise ValueError("query ids must be distinct")
    yield from _query_blocks(queries, query_id, block, modulus * 2, residue)
    yield from _query_blocks(queries, query_id, block, modulus * 2, residue + modulus)


def ranked(hits: DataFrame, query_id: str, point_id: str, k: int) -> DataFrame:
    """Number each query's hits by score, ties by id, and keep the first k."""
    window = Window.partitionBy(query_id).orderBy(F.col("score").desc(), F.col(point_id))
    return hits.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _hit_schema(points: DataFrame, point_id: str, queries: DataFrame, query_id: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(query_id, queries.schema[query_id].dataType),
            T.StructField(point_id, points.schema[point_id].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _searched(
    candidates_for: Callable[[list], DataFrame],
    queries: DataFrame,
    output: T.StructType,
    k: int,
    dims: int,
    block: int | None,
) -> DataFrame:
    """One scoring pass per block of queries over the candidates that block may see."""
    query_id, point_id = output.names[:2]
    block = block or max(1, QUERY_BYTES // (8 * dims))
    arrow = to_arrow_schema(output)
    passes = []
    for rows in _query_blocks(queries, query_id, block):
        rows = [r for r in rows if r[1] is not None and len(r[1]) == dims]
        ids = [r[0] for r in rows]
        matrix = _unit(np.array([r[1] for r in rows], dtype=np.float64).reshape(-1, dims))
        passes.append(candidates_for(ids).mapInArrow(_task_topk(ids, matrix, k, dims, arrow), output))
    hits = reduce(DataFrame.unionByName, passes) if passes else queries.sparkSession.createDataFrame([], output)
    return ranked(hits, query_id, point_id, k)


def vector_topk(
    points: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    *,
    point_id: str = "point_id",
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    dims: int,
    where: Column | None = None,
    block: int | None = None,
) -> DataFrame:
    """Rows ``(query id, point id, score, rank)``: the k most similar points of every query.

    ``where`` and any semi-join on ``points`` act before scoring. Only the id and the vector
    column are read; fetch payload columns for the few hits with :func:`with_payload`.
    Points whose vector has another length are left out (see :func:`dimension_report`). That is
    checked while scoring: as a filter it would have vectors computed in the same plan twice.
    """
    candidates = points if where is None else points.where(where)
    candidates = candidates.select(point_id, vector)
    wanted = queries.select(query_id, query_vector)
    output = _hit_schema(points, point_id, queries, query_id)
    return _searched(lambda ids: candidates, wanted, output, k, dims, block)


def restricted_topk(
    points: DataFrame,
    queries: DataFrame,
    allowed: DataFrame,
    k: int = TOP_K,
    *,
    entity: str,
    point_id: str = "point_id",
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    dims: int,
    block: int | None = None,
) -> DataFrame:
    """Top k where each query may only see the points of its own entities.

    ``allowed`` holds ``(query id, entity)`` pairs. For a block of queries they become one row per
    entity listing the queries that may see it, at most a block of ids long, so that every point
    is joined and scored once however many queries it is open to.
    """
    pairs = allowed.select(query_id, entity).where(F.col(entity).isNotNull())
    seen = points.select(point_id, vector, entity)
    wanted = queries.select(query_id, query_vector)

    def candidates(ids: list) -> DataFrame:
        viewers = pairs.where(F.col(query_id).isin(ids)).groupBy(entity).agg(F.collect_set(query_id).alias("viewers"))
        return seen.join(viewers, entity).select(point_id, vector, "viewers")

    output = _hit_schema(points, point_id, queries, query_id)
    return _searched(candidates, wanted, output, k, dims, block)


# What a hit shows, with the text used where a field is missing (fixed values).
HIT_FIELDS = {
    "name": "Unknown",
    "city": "",
    "state": "",
    "categories": "",
    "review_stars": "",
    "business_stars": "",
    "text": "",
}


BROADCAST_HITS = 200_000


def with_payload(
    hits: DataFrame, payload: DataFrame, point_id: str = "point_id", at_most: int | None = None
) -> DataFrame:
    """Attach payload columns to the hits.

    ``at_most`` is how many hits there can be (k times the queries). Up to ``BROADCAST_HITS`` of them travel to
    the payloads, which then are not shuffled; beyond it, or without a bound, the join is left to Spark.
    """
    small = at_most is not None and at_most <= BROADCAST_HITS
    return (F.broadcast(hits) if small else hits).join(payload, point_id)


def hit_view(hits: DataFrame, fields: dict[str, str] = HIT_FIELDS, keep: list[str] = ()) -> DataFrame:
    """The shown fields of each hit as text with their defaults, and the score to four digits."""
    shown = [F.coalesce(F.col(n).cast("string"), F.lit(d)).alias(n) for n, d in fields.items()]
    return hits.select(*keep, *shown, F.round("score", 4).alias("score"))
