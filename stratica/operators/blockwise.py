"""Exact search for query sets of any size.

Queries are a table that stays on the executors. Both sides are dealt out by hash, queries into blocks and points into
parts; every part meets every block in a task of its own, one matrix product for each. A part has as
many rows as a block, so each pass of the points moves as many bytes of queries as of points, and a task holds
two bounded pieces whatever the tables' sizes. Where one block is enough, :func:`vector_topk` moves no points.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from stratica.operators.vectors import QUERY_BYTES, TOP_K, _hit_schema, _task_topk, _unit, _well_formed, ranked

LEAST_PART_BYTES = 1 << 20  # few queries do not cut the points into crumbs
_PART, _BLOCK, _VIEWERS = "_part", "_block", "_viewers"


def _cell(k: int, dims: int, seen: list[str], asked: list[str], schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Search of one block of queries in one part of the points."""

    def search(points: pa.Table, queries: pa.Table) -> pa.Table:
        ids, rows = [], [np.zeros((0, dims))]
        for batch in queries.select(asked).to_batches():
            batch, vectors = _well_formed(batch, dims)
            ids += batch.column(0).to_pylist()
            rows.append(_unit(vectors))
        fit = set(ids)
        # queries without a fit vector stay in the lists of viewers, but find nothing
        ids += [q for q in queries.column(asked[0]).to_pylist() if q not in fit]
        matrix = np.concatenate([*rows, np.zeros((len(ids) - sum(map(len, rows)), dims))])
        found = _task_topk(ids, matrix, k, dims, schema)(points.select(seen).to_batches())
        return pa.Table.from_batches([b for b in found if b.column(0)[0].as_py() in fit], schema=schema)

    return search


def blockwise_topk(
    points: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    *,
    point_id: str = "point_id",
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    dims: int,
    allowed: DataFrame | None = None,
    entity: str | None = None,
    block: int | None = None,
    part: int | None = None,
) -> DataFrame:
    """Rows ``(query id, point id, score, rank)``: the k most similar points of every query, ties by point id.

    With ``allowed (query id, entity)`` a query sees the points of its own entities only; a point then goes to the
    blocks that may see it, once each. Points and queries whose vector is missing, of another length or
    not all numbers have no hits; queries of one id count as one. Only two counts reach the driver.
    """
    block = block or max(1, QUERY_BYTES // (8 * dims))
    # one row for each id: its vector, where there are several the least
    wanted = queries.select(query_id, query_vector).groupBy(query_id).agg(F.min(query_vector).alias(query_vector))
    n = queries.select(query_id).distinct().count()
    blocks = max(1, -(-n // block))
    part = part or max(1, LEAST_PART_BYTES // (8 * dims), -(-n // blocks))
    parts = max(1, -(-points.count() // part))
    block_of = F.pmod(F.xxhash64(query_id), F.lit(blocks)).alias(_BLOCK)
    every = lambda count, name: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))).alias(name)
    seen = [point_id, vector]
    if allowed is None:
        candidates = points.select(*seen, every(blocks, _BLOCK))
    else:
        pairs = allowed.select(query_id, entity).join(wanted.select(query_id), query_id, "left_semi").where(F.col(entity).isNotNull())
        viewers = pairs.groupBy(entity, block_of).agg(F.collect_set(query_id).alias(_VIEWERS))  # at most a block of ids
        candidates = points.select(*dict.fromkeys([*seen, entity])).join(viewers, entity).select(*seen, _VIEWERS, _BLOCK)
        seen = [*seen, _VIEWERS]
    # copies of an id are dealt by their vectors
    left = candidates.withColumn(_PART, F.pmod(F.xxhash64(point_id, vector), F.lit(parts)))
    right = wanted.select(query_id, query_vector, block_of, every(parts, _PART))
    output = _hit_schema(points, point_id, queries, query_id)
    search = _cell(k, dims, seen, [query_id, query_vector], to_arrow_schema(output))
    cells = left.groupBy(_PART, _BLOCK).cogroup(right.groupBy(_PART, _BLOCK))
    return ranked(cells.applyInArrow(search, output), query_id, point_id, k)
