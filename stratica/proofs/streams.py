"""Streaming queries, each drained to its end over files staged from the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratica.operators.dedup import dedup_within_watermark
from stratica.operators.joins import entity_join
from stratica.operators.profile import hot_keys
from stratica.operators.upsert import current, read_batches
from stratica.plans.medallion import start_bronze, vector_sink
from stratica.proofs import records
from stratica.proofs.registry import proof, table
from stratica.session import work_folder
from stratica.sources import contracts as c
from stratica.sources.tables import read_folder_stream, read_table_stream
from stratica.sources.topics import to_frames, write_topic
from stratica.streaming.monitor import ProgressLog, supervise
from stratica.streaming.sinks import append_sink, fan_out, replay, start_table_sink


_WHOLE = 1_000_000  # files per batch where event times are not in file order


def _drain(query) -> None:
    query.awaitTermination()


def _staged(df: DataFrame, label: str) -> str:
    """The frame as a folder of at least a file per core, so that streams see several batches."""
    at = work_folder(df.sparkSession, label)
    df.repartition(df.sparkSession.sparkContext.defaultParallelism).write.parquet(at)
    return at


def _per_trigger(spark: SparkSession) -> int:
    """Files per batch: half a file per core, so batches grow with the cluster."""
    return max(1, spark.sparkContext.defaultParallelism // 2)


@proof(
    """SELECT 'businesses' AS topic, count(*) AS n, count(DISTINCT c_custkey) AS keys FROM customer
       UNION ALL SELECT 'reviews', count(*), count(DISTINCT o_custkey) FROM orders"""
)
def bronze_ingest_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Two topics landed by two independent queries under one supervisor."""
    at = work_folder(spark, "bronze")
    businesses, reviews = records.landed(spark, folder)
    write_topic(to_frames(businesses, "business_id", "businesses", 1), f"{at}/topics")
    write_topic(to_frames(reviews, "business_id", "reviews", 2), f"{at}/topics")
    source = {"path": f"{at}/topics", "max_files": max(8, _per_trigger(spark))}
    queries = [
        start_bronze(spark, topic, contract, f"{at}/checkpoints/{topic}", source=source,
                     path=f"{at}/{topic}", trigger=None)
        for topic, contract in (("businesses", c.BUSINESS), ("reviews", c.REVIEW))
    ]
    supervise(spark, queries, until_all_done=True)

    def summary(topic: str) -> DataFrame:
        return spark.read.parquet(f"{at}/{topic}").agg(
            F.lit(topic).alias("topic"), F.count(F.lit(1)).alias("n"), F.count_distinct("business_id").alias("keys")
        )

    return summary("businesses").unionByName(summary("reviews"))


def _stream_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    entities = table(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'").select(
        "c_custkey", "c_name", "c_mktsegment", F.lit(records.BUSINESS_AT).cast("timestamp").alias(c.STAMP)
    )
    facts = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice",
        F.lit(records.REVIEW_AT).cast("timestamp").alias(c.STAMP),
    )
    left, right = _staged(entities, "entities"), _staged(facts, "facts")
    return (
        read_folder_stream(spark, left, entities.schema, _per_trigger(spark)),
        read_folder_stream(spark, right, facts.schema, _per_trigger(spark)),
    )


_STREAM_JOIN = f"""SELECT c_custkey, c_name, c_mktsegment, o_orderkey, o_totalprice,
          TIMESTAMP '{records.REVIEW_AT}' AS ingestion_timestamp, DATE '{records.REVIEW_AT[:10]}' AS ingestion_date
   FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_mktsegment <> 'BUILDING'"""


@proof(_STREAM_JOIN)
def silver_stream_join(spark: SparkSession, folder: str) -> DataFrame:
    """Two watermarked streams joined over several batches: the rows the batch join gives."""
    at = work_folder(spark, "stream-join")
    entities, facts = _stream_sides(spark, folder)
    joined = entity_join(entities, facts, "c_custkey", spread_by=["o_orderkey"])
    _drain(start_table_sink(joined, "silver_stream_join", f"{at}/checkpoint", ["c_mktsegment", c.STAMP_DATE],
                            path=f"{at}/rows", trigger=None))
    return spark.read.schema(joined.schema).parquet(f"{at}/rows")


@proof(_STREAM_JOIN)
def silver_stream_static_join(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of facts against entities at rest, which needs no join state."""
    at = work_folder(spark, "static-join")
    entities = table(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'").select(
        "c_custkey", "c_name", "c_mktsegment", F.lit(records.BUSINESS_AT).cast("timestamp").alias(c.STAMP)
    )
    joined = entity_join(entities, _stream_sides(spark, folder)[1], "c_custkey")
    _drain(start_table_sink(joined, "silver_static_join", f"{at}/checkpoint", ["c_mktsegment"],
                            path=f"{at}/rows", trigger=None))
    return spark.read.schema(joined.schema).parquet(f"{at}/rows")


@proof(
    """SELECT s.user_id, s.event_id AS signup_id, p.event_id AS purchase_id
       FROM events s JOIN events p ON s.user_id = p.user_id AND s.event_type = 'signup' AND p.event_type = 'purchase'
        AND p.ts BETWEEN s.ts - INTERVAL 1 DAY AND s.ts + INTERVAL 1 DAY"""
)
def silver_stream_join_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """Streams joined within a day of each other, so that state older than that is dropped."""
    at = work_folder(spark, "bounded-join")
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    signups = events.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("signup_id"), "ts")
    purchases = events.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), "ts")
    left, right = _staged(signups, "signups"), _staged(purchases, "purchases")
    joined = entity_join(
        read_folder_stream(spark, left, signups.schema, _WHOLE),
        read_folder_stream(spark, right, purchases.schema, _WHOLE),
        "user_id", stamp="ts", within="1 day", spread_by=["purchase_id"],
    ).select("user_id", "signup_id", "purchase_id")
    _drain(joined.writeStream.format("parquet").option("checkpointLocation", f"{at}/checkpoint")
           .trigger(availableNow=True).start(f"{at}/rows"))
    return spark.read.schema(joined.schema).parquet(f"{at}/rows")


@proof("SELECT event_id, event_type, value FROM events")
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Events arriving twice, kept once."""
    at = work_folder(spark, "dedup")
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    staged = _staged(events.unionByName(events), "events-twice")
    once = dedup_within_watermark(
        read_folder_stream(spark, staged, events.schema, _WHOLE), ["event_id"], "ts", "40 days"
    ).select("event_id", "event_type", "value")
    _drain(once.writeStream.format("parquet").option("checkpointLocation", f"{at}/checkpoint")
           .trigger(availableNow=True).start(f"{at}/rows"))
    return spark.read.schema(once.schema).parquet(f"{at}/rows")


@proof(
    """SELECT sink, CAST(doc_id AS VARCHAR) AS review_id, source AS name, md5(text) AS text_md5
       FROM documents, (VALUES ('sql'), ('vector')) AS s(sink)"""
)
def gold_fanout_stream(spark: SparkSession, folder: str) -> DataFrame:
    """One stream into an analytic and a vector sink; the vector sink fails once and is replayed twice."""
    at = work_folder(spark, "gold")
    facts = _document_facts(spark, folder)
    stream = read_folder_stream(spark, _staged(facts, "documents"), facts.schema, _per_trigger(spark))
    vectors = vector_sink(f"{at}/vector")

    def unreliable(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 1:
            raise ConnectionError("vector store unavailable")
        vectors(batch, batch_id)

    sinks = {"sql": append_sink(f"{at}/sql"), "vector": unreliable}
    _drain(fan_out(stream, sinks, f"{at}/checkpoint", f"{at}/dead", trigger=None))
    replay(spark, f"{at}/dead", {"vector": vectors})
    replay(spark, f"{at}/dead", {"vector": vectors})

    def content(name: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(name).alias("sink"), "review_id", "name", F.md5(F.col("text").cast("binary")).alias("text_md5"))

    return content("sql", read_batches(spark, f"{at}/sql")).unionByName(
        content("vector", current(spark, f"{at}/vector", "point_id"))
    )


@proof("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def append_across_checkpoints(spark: SparkSession, folder: str) -> DataFrame:
    """One sink fed from two checkpoints, the second started over: every row lands, none twice."""
    at = work_folder(spark, "append")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    for half in (0, 1, 1):
        staged = f"{at}/in-{half}"
        orders.where(F.col("o_orderkey") % 2 == half).repartition(4).write.mode("ignore").parquet(staged)
        stream = read_folder_stream(spark, staged, orders.schema, 2)
        _drain(fan_out(stream, {"sql": append_sink(f"{at}/sql")}, f"{at}/checkpoint-{half}", f"{at}/dead", trigger=None))
    return read_batches(spark, f"{at}/sql").drop("stream", "batch_id")


@proof("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def catalog_table_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A catalog table read as a stream into another catalog table, in two runs of one checkpoint."""
    at, database = work_folder(spark, "catalog"), f"s{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{at}/database'")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    for half in (0, 1):
        arrived = customers.where(F.col("c_custkey") % 2 == half).repartition(4)
        arrived.write.mode("append").saveAsTable(f"{database}.arrivals")
        stream = read_table_stream(spark, f"{database}.arrivals", _per_trigger(spark))
        _drain(start_table_sink(stream, "catalog_stream", f"{at}/checkpoint", ["c_mktsegment"],
                                table=f"{database}.landed", trigger=None))
    return spark.table(f"{database}.landed")


@proof(
    """SELECT s.user_id, s.event_id AS signup_id, p.event_id AS purchase_id
       FROM events s JOIN events p ON s.user_id = p.user_id AND s.event_type = 'signup' AND p.event_type = 'purchase'
        AND p.ts BETWEEN s.ts - INTERVAL 1 DAY AND s.ts + INTERVAL 1 DAY"""
)
def stream_join_late(spark: SparkSession, folder: str) -> DataFrame:
    """A bounded join over three arrivals and restarts; the third repeats the first days, too late to join."""
    at = work_folder(spark, "late-join")
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    early = F.col("ts") < "2024-01-25"
    late = events.where("ts < '2024-01-08'").withColumn("event_id", F.col("event_id") + 1_000_000_000)
    sides = {"signup": "signup_id", "purchase": "purchase_id"}
    schema = "user_id long, {} long, ts timestamp"
    for arrived in (events.where(early), events.where(~early), late):
        for kind, name in sides.items():
            rows = arrived.where(F.col("event_type") == kind)
            rows.select("user_id", F.col("event_id").alias(name), "ts").coalesce(1).write.mode("append").parquet(f"{at}/{kind}")
        left, right = (
            spark.readStream.schema(schema.format(name)).parquet(f"{at}/{kind}") for kind, name in sides.items()
        )
        joined = entity_join(left, right, "user_id", stamp="ts", within="1 day", spread_by=["purchase_id"])
        _drain(joined.select("user_id", "signup_id", "purchase_id").writeStream.format("parquet")
               .option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start(f"{at}/rows"))
    return spark.read.parquet(f"{at}/rows")


@proof(_STREAM_JOIN)
def silver_stream_join_hot(spark: SparkSession, folder: str) -> DataFrame:
    """The stream join with salts for the keys found hot among facts at rest only; other entities are kept once."""
    at = work_folder(spark, "hot-join")
    entities, facts = _stream_sides(spark, folder)
    known = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"))
    joined = entity_join(entities, facts, "c_custkey", hot=hot_keys(known, "c_custkey", 0.001), spread_by=["o_orderkey"])
    _drain(start_table_sink(joined, "silver_hot_join", f"{at}/checkpoint", ["c_mktsegment"], path=f"{at}/rows", trigger=None))
    return spark.read.schema(joined.schema).parquet(f"{at}/rows")


def _arrivals(spark: SparkSession, folder: str, label: str) -> tuple[str, dict[str, str], Callable[[DataFrame], None], Callable[[str], DataFrame]]:
    """Signups and purchases as two folders that grow: the place, how to add events, and how to read a side as a stream."""
    at, sides = work_folder(spark, label), {"signup": "signup_id", "purchase": "purchase_id"}

    def arrive(events: DataFrame) -> None:
        for kind, name in sides.items():
            rows = events.where(F.col("event_type") == kind).select("user_id", F.col("event_id").alias(name), "ts")
            rows.coalesce(1).write.mode("append").parquet(f"{at}/{kind}")

    def read(kind: str) -> DataFrame:
        return spark.readStream.schema(f"user_id long, {sides[kind]} long, ts timestamp").parquet(f"{at}/{kind}")

    return at, sides, arrive, read


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@proof(
    """SELECT s.user_id, s.event_id AS signup_id, p.event_id AS purchase_id
       FROM events s JOIN events p ON s.user_id = p.user_id AND s.event_type = 'signup' AND p.event_type = 'purchase'
        AND p.ts BETWEEN s.ts - INTERVAL 1 DAY AND s.ts + INTERVAL 1 DAY"""
)
def stream_join_once(spark: SparkSession, folder: str) -> DataFrame:
    """Facts that arrive twice, before and after a restart, joined and then kept once in the same query."""
    events = _events(spark, folder)
    at, _, arrive, read = _arrivals(spark, folder, "join-once")
    early = F.col("ts") < "2024-01-25"
    again = events.where((F.col("event_type") == "purchase") & (F.col("ts") >= "2024-01-24") & early)
    for arrived in (events.where(early), again.unionByName(events.where(~early))):
        arrive(arrived)
        joined = entity_join(read("signup"), read("purchase"), "user_id", stamp="ts", within="1 day", once=["signup_id", "purchase_id"], salts=1)
        _drain(joined.select("user_id", "signup_id", "purchase_id").writeStream.format("parquet")
               .option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start(f"{at}/rows"))
    return spark.read.parquet(f"{at}/rows")


@proof(
    """SELECT s.user_id, s.event_id AS signup_id, p.event_id AS purchase_id
       FROM (SELECT * FROM events WHERE event_type = 'signup') s LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
         ON s.user_id = p.user_id AND p.ts BETWEEN s.ts - INTERVAL 1 DAY AND s.ts + INTERVAL 1 DAY"""
)
def stream_outer_join(spark: SparkSession, folder: str) -> DataFrame:
    """A left join of streams: a row without a partner is given once the watermark says none can come."""
    events = _events(spark, folder)
    at, _, arrive, read = _arrivals(spark, folder, "outer-join")
    # a later event of each kind moves time past the end
    end = events.groupBy("event_type").agg(F.max("ts").alias("ts")).select(
        F.lit(-1).cast("long").alias("event_id"), (F.col("ts") + F.expr("INTERVAL 100 DAYS")).alias("ts"), F.lit(-1).cast("long").alias("user_id"), "event_type"
    )
    early = F.col("ts") < "2024-01-20"
    kept = events.select("event_id", "ts", "user_id", "event_type")
    for arrived in (kept.where(early), kept.where(~early), end, end.withColumn("ts", F.col("ts") + F.expr("INTERVAL 100 DAYS"))):
        arrive(arrived)
        joined = entity_join(read("signup"), read("purchase"), "user_id", stamp="ts", within="1 day", how="left")
        _drain(joined.select("user_id", "signup_id", "purchase_id").writeStream.format("parquet")
               .option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start(f"{at}/rows"))
    return spark.read.parquet(f"{at}/rows").where("signup_id >= 0")


@proof(
    """SELECT 'orders' AS query, 'stopped' AS ended, (SELECT count(*) FROM orders) AS rows
       UNION ALL SELECT 'customers', 'failed', 0"""
)
def stream_failure(spark: SparkSession, folder: str) -> DataFrame:
    """Two queries under one supervisor, one of which fails in its sink: the other's rows are there, the reason is named."""
    at = work_folder(spark, "failure")
    streams = {name: table(spark, folder, source) for name, source in (("orders", "orders"), ("customers", "customer"))}
    orders = read_folder_stream(spark, _staged(streams["orders"], "orders"), streams["orders"].schema, _WHOLE)
    customers = read_folder_stream(spark, _staged(streams["customers"], "customers"), streams["customers"].schema, _WHOLE)

    def refuse(batch: DataFrame, number: int) -> None:
        raise ConnectionError("sink broke")

    started = lambda frame, name: frame.queryName(name).option("checkpointLocation", f"{at}/{name}-checkpoint").trigger(availableNow=True)
    good = started(orders.writeStream.format("parquet"), "orders").start(f"{at}/orders")
    good.awaitTermination()
    bad = started(customers.writeStream.foreachBatch(refuse), "customers").start()
    reasons = supervise(spark, [good, bad], poll_seconds=0.5, until_all_done=True)
    ended = spark.createDataFrame([(q, r.split(":")[0]) for q, r in reasons.items()], "query string, ended string")
    rows = spark.read.schema(streams["orders"].schema).parquet(f"{at}/orders").agg(F.lit("orders").alias("query"), F.count(F.lit(1)).alias("n"))
    return ended.join(rows, "query", "left").select("query", "ended", F.coalesce("n", F.lit(0)).cast("long").alias("rows"))


@proof("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 4 = 1")
def stream_empty_batches(spark: SparkSession, folder: str) -> DataFrame:
    """A stream some of whose batches are empty after a filter: those reach no sink and set nothing aside."""
    at = work_folder(spark, "empty")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    for part in range(4):
        orders.where(F.col("o_orderkey") % 4 == part).coalesce(1).write.mode("append").parquet(f"{at}/in")
    stream = read_folder_stream(spark, f"{at}/in", orders.schema, 1).where("o_orderkey % 4 = 1")
    _drain(fan_out(stream, {"sql": append_sink(f"{at}/sql")}, f"{at}/checkpoint", f"{at}/dead", trigger=None))
    return read_batches(spark, f"{at}/sql").drop("stream", "batch_id")


def _document_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in the shape of typed facts; columns they have no value for are null."""
    documents = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("review_id"),
        F.col("source").alias("name"),
        F.col("lang").alias("categories"),
        "text",
        F.lit(records.REVIEW_AT).cast("timestamp").alias(c.STAMP),
    )
    return c.conform(documents, c.typed_layout())


@proof(
    """SELECT 'progress_customers' AS query, count(*) AS total_rows FROM customer
       UNION ALL SELECT 'progress_orders', count(*) FROM orders"""
)
def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    """Rows each of two queries has read, one of them in over a hundred batches, from a listener's log."""
    at = work_folder(spark, "progress")
    log = ProgressLog(spark, f"{at}/log", lot=50)
    queries = []
    for query, name, files in (("progress_customers", "customer", 110), ("progress_orders", "orders", 4)):
        rows = table(spark, folder, name)
        rows.repartition(files).write.parquet(f"{at}/in-{name}")
        stream = read_folder_stream(spark, f"{at}/in-{name}", rows.schema, 1)
        queries.append(
            stream.writeStream.queryName(query).format("noop")
            .option("checkpointLocation", f"{at}/checkpoint-{name}").trigger(availableNow=True).start()
        )
    supervise(spark, queries, until_all_done=True)
    log.detach(*queries)
    return log.rows().groupBy("query").agg(F.max("total_rows").alias("total_rows"))
