"""The layered pipeline: frames to raw rows, raw rows to typed facts, typed facts to both gold sinks.

Each stage maps frames to frames; batch and streaming differ only in where rows come from and go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratica.functions import clean
from stratica.functions.identity import uuid5
from stratica.functions.literals import bool_dict, entries_as_columns, literal_text
from stratica.functions.text import embedding_text
from stratica.functions.wire import decode_frames
from stratica.operators.dedup import latest_by
from stratica.operators.embedding import embed
from stratica.operators.joins import entity_join
from stratica.operators.upsert import write_batch
from stratica.sources import contracts as c
from stratica.sources.tables import read_table_stream
from stratica.sources.topics import read_topic
from stratica.streaming.sinks import TABLE_TRIGGER, Sink, append_sink, fan_out, start_table_sink


def stamped(rows: DataFrame, at: Column | None = None) -> DataFrame:
    """Add the landing stamp and its date as text; one value per micro-batch."""
    moment = F.current_timestamp() if at is None else at
    return rows.select(
        "*", moment.cast("string").alias(c.STAMP), F.to_date(moment).cast("string").alias(c.STAMP_DATE)
    )


def bronze(frames: DataFrame, contract: T.StructType, at: Column | None = None) -> DataFrame:
    return stamped(decode_frames(frames, contract), at)


def clean_businesses(raw: DataFrame) -> DataFrame:
    """Typed entity rows out of raw ones, by native expressions.

    The two literal parsers are applied to arrays of attributes in an inner projection: each occurs
    once, so the projection stays small enough for codegen, and is evaluated once per attribute.
    """
    attribute = {a: F.col(f"attributes_{a}") for a in c.ATTRIBUTES}
    parsed = raw.select(
        "*",
        F.transform(F.array(attribute["BusinessParking"], attribute["Music"]), bool_dict).alias("_dicts"),
        F.transform(F.array(*[attribute[a] for a in c.TEXT_ATTRIBUTES]), literal_text).alias("_words"),
    )
    parking, music, words = F.col("_dicts")[0], F.col("_dicts")[1], F.col("_words")
    return parsed.select(
        "business_id", "name", "address", "city", "state", "postal_code",
        clean.lenient_float(F.col("stars")).alias("business_stars"),
        clean.lenient_int(F.col("review_count")).alias("review_count"),
        clean.flag_text(F.col("is_open")).alias("is_open"),
        "categories",
        *[clean.bool_text(attribute[a]).alias(n) for a, n in c.FLAG_ATTRIBUTES.items()],
        *entries_as_columns(parking, c.PARKING_KEYS),
        *entries_as_columns(music, c.MUSIC_KEYS),
        *[words[i].alias(n) for i, n in enumerate(c.TEXT_ATTRIBUTES.values())],
        *[clean.sentinel_int(attribute[a]).alias(n) for a, n in c.PRICE_ATTRIBUTE.items()],
        *[clean.open_hours(F.col(f"hours_{d}")).alias(n) for d, n in c.HOURS.items()],
        clean.timestamp_or_null(F.col(c.STAMP)).alias(c.STAMP),
    )


def clean_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        "business_id", "review_id", "user_id",
        clean.lenient_int(F.col("stars")).alias("review_stars"),
        *[clean.lenient_int(F.col(n)).alias(n) for n in ("useful", "funny", "cool")],
        "text",
        clean.timestamp_or_null(F.col("date")).alias("date"),
        clean.timestamp_or_null(F.col(c.STAMP)).alias(c.STAMP),
    )


def silver(businesses: DataFrame, reviews: DataFrame, **join_options) -> DataFrame:
    """Cleaned reviews with their business, in the layout of the typed table."""
    joined = entity_join(
        clean_businesses(businesses), clean_reviews(reviews), "business_id",
        spread_by=["review_id", "user_id", "text"], **join_options,
    )
    return joined.select(c.typed_layout().names)


def gold_points(facts: DataFrame) -> DataFrame:
    """Vector points without their vectors: id, text to embed, and the payload with nulls left out."""
    return facts.select(
        uuid5(F.col("review_id")).alias("point_id"),
        embedding_text(*[F.col(n) for n in c.EMBEDDED_FIELDS]).alias("embedding_text"),
        F.to_json(F.struct(*c.PAYLOAD_FIELDS)).alias("payload"),
        *c.PAYLOAD_FIELDS,
        c.STAMP,
    )


def vector_sink(path: str, model=None) -> Sink:
    """Embed a batch on the executors and upsert it by point id.

    A point occurring more than once in a batch is embedded in its latest form only.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        points = latest_by(gold_points(batch), "point_id", [F.col(c.STAMP).desc()])
        write_batch(embed(points, "embedding_text", model), path, batch_id)

    return load


def start_bronze(
    spark: SparkSession,
    topic: str,
    contract: T.StructType,
    checkpoint: str,
    *,
    source: dict,
    table: str | None = None,
    path: str | None = None,
    trigger: str | None = TABLE_TRIGGER,
) -> StreamingQuery:
    """Land one topic; each topic is its own query with its own checkpoint."""
    rows = bronze(read_topic(spark, topic, **source), contract)
    return start_table_sink(
        rows, f"bronze_{topic}", checkpoint, [c.STAMP_DATE], table=table, path=path, trigger=trigger
    )


def start_silver(
    spark: SparkSession,
    businesses: str,
    reviews: str,
    table: str,
    checkpoint: str,
    *,
    trigger: str | None = TABLE_TRIGGER,
    **join_options,
) -> StreamingQuery:
    """Join the two raw tables as streams into the typed table."""
    rows = silver(read_table_stream(spark, businesses), read_table_stream(spark, reviews), **join_options)
    return start_table_sink(
        rows, "silver_joined", checkpoint, ["state", c.STAMP_DATE], table=table, trigger=trigger
    )


def start_gold(
    facts: DataFrame,
    sql_path: str,
    vector_path: str,
    checkpoint: str,
    dead_letters: str,
    *,
    model=None,
    trigger: str | None = "60 seconds",
) -> StreamingQuery:
    """Feed the analytic table and the vector collection from one stream of facts."""
    sinks = {"sql": append_sink(sql_path), "vector": vector_sink(vector_path, model)}
    return fan_out(facts, sinks, checkpoint, dead_letters, query_name="gold_dual_sink", trigger=trigger)
