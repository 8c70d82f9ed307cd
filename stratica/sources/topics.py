"""Keyed topics: a message log read as a stream, over Kafka or over files with the same columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratica.functions.wire import encode_frame

# Admission control and start position (fixed values).
MAX_OFFSETS_PER_TRIGGER = 50_000
STARTING_OFFSETS = "earliest"

FRAME_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
    ]
)


def key_partition(key: Column, partitions: int) -> Column:
    """Topic partition of a key; topics of one size share it, so equal keys sit together."""
    digest = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long")
    return F.pmod(digest, F.lit(partitions)).cast("int")


def to_frames(
    rows: DataFrame,
    key: str,
    topic: str,
    schema_id: int,
    partitions: int = 8,
    at: Column | None = None,
) -> DataFrame:
    """Contract rows as keyed wire frames; purely row-wise."""
    return rows.select(
        F.col(key).cast("binary").alias("key"),
        encode_frame([F.col(f"`{c}`") for c in rows.columns], schema_id).alias("value"),
        (F.current_timestamp() if at is None else at).alias("timestamp"),
        F.lit(topic).alias("topic"),
        key_partition(F.col(key), partitions).alias("partition"),
    )


def write_topic(frames: DataFrame, path: str | None = None, kafka: dict[str, str] | None = None) -> None:
    """Append frames to a topic.

    On files, the rebalance hint gathers each partition's frames into few files, and AQE splits a
    partition that one hot key has made too large.
    """
    if kafka is not None:
        # the broker's partitioner places the keys, whatever the topic's partition count
        frames.drop("partition").write.format("kafka").options(**kafka).save()
        return
    frames.hint("rebalance", "topic", "partition").write.mode("append").partitionBy(
        "topic", "partition"
    ).parquet(path)


def read_topic(
    spark: SparkSession,
    topic: str,
    path: str | None = None,
    kafka: dict[str, str] | None = None,
    max_offsets: int = MAX_OFFSETS_PER_TRIGGER,
    max_files: int = 5,
) -> DataFrame:
    """A topic as a stream of frames. Kafka needs the connector on the class path."""
    if kafka is not None:
        return (
            spark.readStream.format("kafka")
            .option("subscribe", topic)
            .option("startingOffsets", STARTING_OFFSETS)
            .option("maxOffsetsPerTrigger", max_offsets)
            .option("failOnDataLoss", "false")
            .options(**kafka)
            .load()
        )
    return (
        spark.readStream.schema(FRAME_SCHEMA)
        .option("maxFilesPerTrigger", max_files)
        .parquet(path)
        .where(F.col("topic") == topic)
    )
