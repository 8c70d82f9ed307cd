"""Keyed insert-or-overwrite without a table format.

An attempt at a batch lands in a folder of its own and is seen once it is committed (:mod:`stratica.sources.commits`) under the
stream it comes from and its number there: a replay replaces it in one step, and no other stream's batch does. The
current state is the latest row of each key over all batches. Writing costs what the batch costs, whatever the size of
the table, and a lost executor or a second attempt changes nothing. :func:`compact` folds the history into a new
folder when reads get slow; :class:`stratica.operators.keyed.KeyedTable` reads without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratica.operators.dedup import latest_by
from stratica.sources.commits import CommitLog, new_attempt

STREAM, BATCH_ID = "stream", "batch_id"
_ATTEMPT = "_attempt"
#: Stream labels sort by age; batches written by hand and folded histories come before any stream.
BY_HAND, FOLDED = "0-batch", "0"


class BatchId(int):
    """The number of a micro-batch, with the label of its stream."""

    stream: str

    def __new__(cls, number: int, stream: str):
        made = super().__new__(cls, number)
        made.stream = stream
        return made


def upsert(target: DataFrame, batch: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Target with the batch's rows inserted or, where they come first in ``order``, put in place."""
    return latest_by(target.unionByName(batch), key, order)


def _stream(batch_id: int) -> str:
    return getattr(batch_id, "stream", BY_HAND)


def _folder(path: str, stream: str, batch_id: int, attempt: str) -> str:
    return f"{path}/{STREAM}={stream}/{BATCH_ID}={int(batch_id)}/{_ATTEMPT}={attempt}"


def land(batch: DataFrame, path: str, batch_id: int) -> str:
    """Write a batch where no reader looks yet; returns the attempt to commit."""
    attempt = new_attempt()
    batch.drop(STREAM, BATCH_ID).write.parquet(_folder(path, _stream(batch_id), batch_id, attempt))
    return attempt


def write_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """Land and commit one batch; the same stream and number replaces itself. Keys should occur once in it."""
    attempt = land(batch, path, batch_id)
    CommitLog(batch.sparkSession, path).commit(_stream(batch_id), batch_id, attempt)


def read_batches(spark: SparkSession, path: str, only: int | None = None) -> DataFrame:
    """The rows of all committed batches, or of one."""
    commits = CommitLog(spark, path).visible()
    if only is not None:
        commits = [c for c in commits if (c.stream, c.batch_id) == (_stream(only), int(only))]
    if not commits:
        raise ValueError(f"no finished batch in {path}")
    folders = [_folder(path, c.stream, c.batch_id, c.attempt) for c in commits]
    rows = spark.read.option("basePath", path).parquet(*folders).drop(_ATTEMPT)
    return rows.withColumns({STREAM: F.col(STREAM).cast("string"), BATCH_ID: F.col(BATCH_ID).cast("long")})


def current(spark: SparkSession, path: str, key: str, order: list[Column] | None = None) -> DataFrame:
    """The latest row of each key; by default that of the youngest stream's highest batch.

    Which rows are superseded is found on the key and the columns of the order alone; an anti-join takes them
    out, so that wide columns are neither sorted nor, while the superseded rows are few, shuffled. The
    order must be total within a key.
    """
    rows = read_batches(spark, path)
    order = order or [F.col(STREAM).desc(), F.col(BATCH_ID).desc()]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    named = ["_key", STREAM, BATCH_ID]
    old = rows.withColumn("_place", place).where("_place > 1").select(F.col(key).alias("_key"), STREAM, BATCH_ID)
    same = rows[key].eqNullSafe(F.col("old._key")) & (rows[STREAM] == F.col("old.stream")) & (rows[BATCH_ID] == F.col("old.batch_id"))
    return rows.join(old.toDF(*named).alias("old"), same, "left_anti").drop(STREAM, BATCH_ID)


def compact(spark: SparkSession, path: str, into: str, key: str, order: list[Column] | None = None) -> None:
    """Write the current state as the first batch of a new folder, for later batches to follow."""
    write_batch(current(spark, path, key, order), into, BatchId(-1, FOLDED))
