"""Progress of streaming queries as rows, and their supervision."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_SCHEMA = (
    "query string, batch_id long, rows long, input_rate double, processed_rate double, "
    "dropped_late long, offsets string"
)


def _progress_row(progress: dict) -> tuple:
    late = sum(int(op.get("numRowsDroppedByWatermark") or 0) for op in progress.get("stateOperators") or [])
    offsets = [json.dumps(s["endOffset"]) if not isinstance(s["endOffset"], str) else s["endOffset"]
               for s in progress.get("sources") or [] if s.get("endOffset")]
    return (
        progress.get("name"),
        int(progress["batchId"]),
        int(progress.get("numInputRows") or 0),
        float(progress.get("inputRowsPerSecond") or 0.0),
        float(progress.get("processedRowsPerSecond") or 0.0),
        late,
        "; ".join(offsets),
    )


class ProgressLog(StreamingQueryListener):
    """Every progress record of the session's queries, from the moment it is attached.

    A query itself keeps only its last hundred records. Records are written below ``path`` in lots of
    ``lot``; :meth:`rows` gives them all with the rows read so far.
    """

    def __init__(self, spark: SparkSession, path: str, lot: int = 1000):
        self.spark, self.path, self.lot = spark, path, lot
        self.held: list[tuple] = []
        self.written = False
        self.ended: set[str] = set()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        self.held.append(_progress_row(json.loads(event.progress.json)))
        if len(self.held) >= self.lot:
            self._flush()

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def _flush(self) -> None:
        held, self.held = self.held, []
        self.spark.createDataFrame(held, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        self.written = True

    def detach(self, *queries: StreamingQuery, patience: float = 30.0) -> None:
        """Stop listening once the end of the given queries has been heard of: events come with a delay."""
        end = time.monotonic() + patience
        while not {str(q.runId) for q in queries} <= self.ended and time.monotonic() < end:
            time.sleep(0.05)
        self.spark.streams.removeListener(self)

    def rows(self) -> DataFrame:
        held = self.spark.createDataFrame(self.held, PROGRESS_SCHEMA)
        return _with_totals(self.spark.read.parquet(self.path).unionByName(held) if self.written else held)


def _with_totals(rows: DataFrame) -> DataFrame:
    so_far = Window.partitionBy("query").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("total_rows", F.sum("rows").over(so_far))


def progress_table(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """The retained progress of each query (its last hundred records); :class:`ProgressLog` keeps all."""
    rows = [_progress_row(p if isinstance(p, dict) else json.loads(p.json)) for q in queries for p in q.recentProgress]
    return _with_totals(spark.createDataFrame(rows, PROGRESS_SCHEMA))


def supervise(
    spark: SparkSession,
    queries: list[StreamingQuery],
    poll_seconds: float = 5.0,
    until_all_done: bool = False,
) -> dict[str, str]:
    """Wait until a query stops, then stop the others; returns why each one ended.

    With ``until_all_done`` a query may finish by itself (drained input) and only a failure stops
    the rest.
    """
    reasons: dict[str, str] = {}
    while True:
        for query in queries:
            label = query.name or str(query.id)
            if query.isActive or label in reasons:
                continue
            failure = query.exception()
            reasons[label] = f"failed: {failure}" if failure else "stopped"
            if failure or not until_all_done:
                for other in queries:
                    if other.isActive:
                        other.stop()
                        reasons[other.name or str(other.id)] = "stopped with the others"
                return reasons
        if len(reasons) == len(queries):
            return reasons
        try:
            spark.streams.resetTerminated()
            spark.streams.awaitAnyTermination(poll_seconds)
        except Exception:  # the failure itself is read from the query above
            time.sleep(0.05)
