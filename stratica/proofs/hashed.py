"""SQL that states the hashed embedding and cosine search independently, for comparison."""

from __future__ import annotations


def cells(name: str, key: str, text: str, source: str, dims: int = 768) -> str:
    """CTEs giving ``<name>(key, cell, v)``: the non-zero cells of each text's vector, as stored."""
    return f"""
      {name}_words AS (SELECT {key} AS key, unnest(regexp_split_to_array(lower({text}), '[ \\t\\n\\f\\r]+')) AS w FROM {source}),
      {name}_cells AS (SELECT key, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {dims} AS cell, count(*) AS n
                       FROM {name}_words WHERE w <> '' GROUP BY ALL),
      {name}_size AS (SELECT key, sqrt(CAST(sum(n * n) AS DOUBLE)) AS norm FROM {name}_cells GROUP BY key),
      {name}_stored AS (SELECT key, cell, CAST(CAST(n / norm AS FLOAT) AS DOUBLE) AS v
                        FROM {name}_cells JOIN {name}_size USING (key)),
      {name}_unit AS (SELECT key, sqrt(sum(v * v)) AS norm FROM {name}_stored GROUP BY key),
      {name} AS (SELECT key, cell, v / norm AS v FROM {name}_stored JOIN {name}_unit USING (key))"""


def scores(query: str, point: str, keep: str = "true", pairs: str = "true") -> str:
    """CTEs giving ``best(q, p, s, rank)``; texts with nothing in common score zero.

    ``keep`` narrows the points by ``key``, ``pairs`` what a query may see by ``q.key`` and ``p.key``.
    """
    return f"""
      shared AS (SELECT a.key AS qk, b.key AS pk, sum(a.v * b.v) AS s
                 FROM {query} a JOIN {point} b ON a.cell = b.cell GROUP BY ALL),
      scores AS (SELECT q.key AS q, p.key AS p, round(coalesce(s, 0), 9) AS s
                 FROM (SELECT DISTINCT key FROM {query}_words) q
                 JOIN (SELECT DISTINCT key FROM {point}_words WHERE {keep}) p ON {pairs}
                 LEFT JOIN shared ON q.key = qk AND p.key = pk),
      best AS (SELECT q, p, s, row_number() OVER (PARTITION BY q ORDER BY s DESC, p) AS rank FROM scores)"""
