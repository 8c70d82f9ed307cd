"""Registration of queries and of the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratica.operators.embedding import embed
from stratica.session import prepare, work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def proof(sql: str | None = None, name: str | None = None):
    """Register a ``(spark, folder) -> DataFrame`` query, with its SQL where there is one."""

    def register(query):
        label = name or query.__name__

        @wraps(query)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return query(prepare(spark), folder)

        QUERIES[label] = run
        if sql is not None:
            ORACLES[label] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def views(spark: SparkSession, folder: str, *names: str) -> None:
    for name in names:
        table(spark, folder, name).createOrReplaceTempView(name)


_STORED: dict[tuple[str, str], str] = {}


def stored_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents' points (point_id, source, embedding), embedded once per application and folder.

    Every search of stored points reads this table; none has the model in its plan.
    """
    place = (spark.sparkContext.applicationId, folder)
    if place not in _STORED:
        at = work_folder(spark, "document-points")
        documents = table(spark, folder, "documents").select(F.col("doc_id").alias("point_id"), "source", "text")
        embed(documents, "text", partitions=spark.sparkContext.defaultParallelism).drop("text").write.parquet(at)
        _STORED[place] = at
    return spark.read.parquet(_STORED[place])
