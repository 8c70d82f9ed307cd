"""Streaming sinks: partitioned tables and the fan-out of a micro-batch to several sinks."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratica.operators.upsert import BATCH_ID, STREAM, BatchId, read_batches, write_batch

# Trigger intervals (fixed values).
TABLE_TRIGGER = "10 seconds"
FANOUT_TRIGGER = "60 seconds"

_NOTE_SCHEMA = "sink string, stream string, batch_id long, state string, error string"

Sink = Callable[[DataFrame, int], None]


def _trigger(interval: str | None) -> dict:
    return {"availableNow": True} if interval is None else {"processingTime": interval}


def start_table_sink(
    df: DataFrame,
    query_name: str,
    checkpoint: str,
    partition_cols: list[str],
    *,
    table: str | None = None,
    path: str | None = None,
    trigger: str | None = TABLE_TRIGGER,
) -> StreamingQuery:
    """Append a stream to a partitioned table or folder. ``trigger=None`` drains what is there."""
    writer = (
        df.writeStream.queryName(query_name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_cols)
        .trigger(**_trigger(trigger))
    )
    if table is not None:
        return writer.toTable(table)
    return writer.format("parquet").start(path)


def stream_label(spark: SparkSession, checkpoint: str) -> str:
    """A label of the stream behind a checkpoint: the same after every restart, another for another checkpoint.

    Labels sort by the time their checkpoint was begun.
    """
    file = spark.read.format("binaryFile").load(f"{checkpoint}/metadata").select("modificationTime", "content").first()
    return f"{file['modificationTime']:%Y%m%d%H%M%S%f}-{json.loads(bytes(file['content']))['id']}"


def append_sink(path: str) -> Sink:
    """Append-only load: executors write the batch, and a commit under its stream and number makes it visible.

    A replay replaces its own batch only; other streams, and the same stream from a new checkpoint, add to it. Readers
    (:func:`stratica.operators.upsert.read_batches`) never see a batch in part.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)

    return load


def fan_out(
    stream: DataFrame,
    sinks: dict[str, Sink],
    checkpoint: str,
    dead_letters: str,
    *,
    query_name: str | None = None,
    trigger: str | None = FANOUT_TRIGGER,
) -> StreamingQuery:
    """Give every micro-batch to each sink in turn, one failing never blocking the others.

    The batch is computed once and kept for all sinks. Empty batches are skipped. A failed
    (sink, batch) is set aside with its rows and error for :func:`replay`, because the batch is
    committed all the same.
    """

    label: list[str] = []  # read from the checkpoint by the first batch

    def process(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            if kept.isEmpty():
                return
            if not label:
                label.append(stream_label(batch.sparkSession, checkpoint))
            batch_id = BatchId(number, label[0])
            for name, sink in sinks.items():
                try:
                    sink(kept, batch_id)
                except Exception as error:
                    _set_aside(kept, dead_letters, name, batch_id, error)
        finally:
            kept.unpersist()

    writer = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(trigger))
        .foreachBatch(process)
    )
    return (writer.queryName(query_name) if query_name else writer).start()


def _set_aside(batch: DataFrame, dead_letters: str, sink: str, batch_id: BatchId, error: Exception) -> None:
    write_batch(batch, f"{dead_letters}/rows/{sink}", batch_id)
    _note(batch.sparkSession, dead_letters, sink, batch_id, "failed", str(error))


def _note(spark: SparkSession, dead_letters: str, sink: str, batch_id: BatchId, state: str, error: str | None) -> None:
    entry = spark.createDataFrame([(sink, batch_id.stream, int(batch_id), state, error)], _NOTE_SCHEMA)
    entry.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{dead_letters}/log")


def dead_letter_log(spark: SparkSession, dead_letters: str) -> DataFrame:
    """What failed and what has been replayed since: ``(sink, stream, batch_id, state, error, at)``."""
    schema = f"{_NOTE_SCHEMA}, at timestamp"
    path = f"{dead_letters}/log"
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    from pyspark.errors import AnalysisException

    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except AnalysisException:
        return False


def replay(spark: SparkSession, dead_letters: str, sinks: dict[str, Sink]) -> int:
    """Give set-aside batches to their sinks again, oldest first; returns how many went through.

    Only the names of open (sink, stream, batch) entries come to the driver, never their rows.
    """
    log = dead_letter_log(spark, dead_letters)
    open_entries = (
        log.groupBy("sink", STREAM, BATCH_ID)
        .agg(F.max_by("state", F.struct("at", F.col("state") == "done")).alias("state"))
        .where((F.col("state") == "failed") & F.col("sink").isin(list(sinks)))
        .orderBy(STREAM, BATCH_ID, "sink")
    )
    done = 0
    for entry in open_entries.collect():
        batch_id = BatchId(entry[BATCH_ID], entry[STREAM])
        rows = read_batches(spark, f"{dead_letters}/rows/{entry['sink']}", batch_id).drop(STREAM, BATCH_ID)
        try:
            sinks[entry["sink"]](rows, batch_id)
        except Exception as error:  # the rows stay where they are
            _note(spark, dead_letters, entry["sink"], batch_id, "failed", str(error))
            continue
        _note(spark, dead_letters, entry["sink"], batch_id, "done", None)
        done += 1
    return done
