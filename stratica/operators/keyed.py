"""A keyed table in buckets: upserts append, reads merge inside a bucket.

Rows of a key always hash to the same bucket, whichever batch they come from, so the latest row of a key is found without
moving any: a read has a sort per bucket and no exchange. A batch writes files into the buckets it has keys for and touches no
others. What a reader sees is set by commits (:mod:`stratica.sources.commits`): batches that are not finished, or whose
attempt was given up, are not there. :meth:`KeyedTable.compact` folds the history bucket by bucket, again without an exchange, and
becomes visible in one step; later batches follow it.

Size the buckets so that one, with its history, fits a task: some hundred MB each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratica.operators.dedup import latest_by
from stratica.operators.upsert import BATCH_ID, BY_HAND, FOLDED, STREAM
from stratica.sources.commits import Commit, CommitLog, new_attempt

#: Partition column of the attempts, and the place of a batch in the order of all.
_ATTEMPT, _VERSION = "_attempt", "_version"


class KeyedTable:
    """The catalog table ``name`` in ``location``, keyed by ``key``; created by its first batch.

    Within a batch keys should occur once. A null key is a key like any other.
    """

    def __init__(self, spark: SparkSession, name: str, key: str, location: str, buckets: int = 200):
        self.spark, self.name, self.key, self.location, self.buckets = spark, name, key, location.rstrip("/"), buckets
        self.log = CommitLog(spark, self.location)

    def _write(self, rows: DataFrame, attempt: str, dealt: bool = False) -> None:
        rows = rows if dealt else rows.repartition(self.buckets, self.key)
        (
            rows.withColumn(_ATTEMPT, F.lit(attempt)).write.mode("append").format("parquet")
            .partitionBy(_ATTEMPT).bucketBy(self.buckets, self.key).sortBy(self.key)
            .option("path", f"{self.location}/rows").saveAsTable(self.name)
        )

    def land(self, batch: DataFrame, batch_id: int) -> str:
        """Write a batch without making it visible; returns the attempt to commit."""
        attempt = new_attempt()
        self._write(batch.withColumns({STREAM: F.lit(getattr(batch_id, "stream", BY_HAND)), BATCH_ID: F.lit(int(batch_id)).cast("long")}), attempt)
        return attempt

    def upsert(self, batch: DataFrame, batch_id: int) -> Commit:
        """Insert the batch's rows or put them in place of older ones; the same stream and number replaces itself."""
        return self.log.commit(getattr(batch_id, "stream", BY_HAND), batch_id, self.land(batch, batch_id))

    def _visible(self) -> tuple[DataFrame, int]:
        commits = self.log.visible()
        if not commits:
            raise ValueError(f"{self.name} has no finished batch")
        rows = self.spark.table(self.name).where(F.col(_ATTEMPT).isin([c.attempt for c in commits]))
        return rows, commits[-1].version

    def current(self, order: list[Column] | None = None) -> DataFrame:
        """The latest row of each key: by default that of the youngest stream's highest batch."""
        rows, _ = self._visible()
        return self._latest(rows, order).drop(STREAM, BATCH_ID)

    def _latest(self, rows: DataFrame, order: list[Column] | None) -> DataFrame:
        order = order or [F.col(STREAM).desc(), F.col(BATCH_ID).desc()]
        return latest_by(rows, self.key, order).drop(_ATTEMPT)

    def compact(self, order: list[Column] | None = None) -> Commit:
        """Put the current state in the place of the history; batches that finish meanwhile stay beside it."""
        rows, version = self._visible()
        attempt = new_attempt()
        folded = self._latest(rows, order).withColumns({STREAM: F.lit(FOLDED), BATCH_ID: F.lit(-1).cast("long")})
        self._write(folded, attempt, dealt=True)
        return self.log.commit(FOLDED, -1, attempt, folds=version)

    def vacuum(self) -> list[str]:
        """Drop the attempts that no reader sees any more; give up what readers and writers may still be busy with first."""
        seen = {c.attempt for c in self.log.visible()}
        there = [r[0].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()]
        gone = [a for a in there if a not in seen]
        for attempt in gone:
            self.spark.sql(f"ALTER TABLE {self.name} DROP PARTITION ({_ATTEMPT} = '{attempt}')")
        return gone
