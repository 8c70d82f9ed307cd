"""Streams over several batches against their batch form; restarts, failures and supervision."""

import pytest
from pyspark.sql import functions as F

from stratica.operators.dedup import dedup_within_watermark
from stratica.operators.joins import entity_join
from stratica.operators.upsert import current, read_batches, write_batch
from stratica.plans import medallion
from stratica.session import work_folder
from stratica.sources import contracts as c
from stratica.sources import tables
from stratica.sources.tables import read_folder_stream
from stratica.sources.topics import to_frames, write_topic
from stratica.streaming.monitor import ProgressLog, progress_table, supervise
from stratica.streaming.sinks import append_sink, dead_letter_log, fan_out, replay, start_table_sink


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def at(column):
    return F.col(column).cast("timestamp").alias("ingestion_timestamp")


def drained(query):
    query.awaitTermination()
    return query


def test_stream_join_equals_batch_join_across_restarts(spark):
    root = work_folder(spark, "join")
    entities = spark.range(20).select(
        F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("size"), F.lit("2024-01-01").cast("timestamp").alias("ingestion_timestamp"))
    facts = spark.range(300).select(
        F.concat(F.lit("k"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 25)).alias("k"),
        F.col("id").alias("f"), F.lit("2024-01-01 08:00:00").cast("timestamp").alias("ingestion_timestamp"))

    def run():
        joined = entity_join(
            read_folder_stream(spark, f"{root}/e", entities.schema, 1), read_folder_stream(spark, f"{root}/f", facts.schema, 1), "k")
        return drained(start_table_sink(joined, "join", f"{root}/cp", ["ingestion_date"], path=f"{root}/out", trigger=None))

    entities.where("size < 10").coalesce(1).write.mode("append").parquet(f"{root}/e")
    facts.where("f < 100").repartition(2).write.mode("append").parquet(f"{root}/f")
    assert run().lastProgress is not None
    entities.where("size >= 10").coalesce(1).write.mode("append").parquet(f"{root}/e")
    facts.where("f >= 100").repartition(2).write.mode("append").parquet(f"{root}/f")
    run()
    run()
    expected = entity_join(entities, facts, "k")
    assert rows(spark.read.schema(expected.schema).parquet(f"{root}/out")) == rows(expected)


def test_outer_stream_join_needs_a_bound(spark):
    left = spark.readStream.format("rate").load().select(F.col("value").alias("k"), F.col("timestamp").alias("ingestion_timestamp"))
    with pytest.raises(ValueError, match="time bound"):
        entity_join(left, left, "k", how="left_outer")


def test_late_rows_leave_the_join_and_are_reconciled(spark):
    root = work_folder(spark, "late")
    schema = "k string, f int, ingestion_timestamp timestamp"

    def land(side, *values):
        spark.createDataFrame(list(values), "k string, f int, ts string").select("k", "f", at("ts")).coalesce(1).write.mode("append").parquet(f"{root}/{side}")

    def run():
        e = read_folder_stream(spark, f"{root}/e", _schema(spark, schema), 100).select("k", F.col("f").alias("e"), "ingestion_timestamp")
        f = read_folder_stream(spark, f"{root}/f", _schema(spark, schema), 100)
        joined = entity_join(e, f, "k", within="2 days")
        query = joined.writeStream.format("parquet").option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start(f"{root}/out")
        return drained(query)

    land("e", ("a", 1, "2024-01-01"), ("b", 2, "2024-01-10"))
    land("f", ("a", 10, "2024-01-01"), ("b", 11, "2024-01-10"))
    run()
    land("e", ("b", 3, "2024-01-10"))
    land("f", ("a", 12, "2024-01-02"), ("b", 13, "2024-01-10"))
    query = run()
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 1
    assert progress_table(spark, [query]).agg(F.sum("dropped_late")).first()[0] == 1
    found = {r["f"] for r in spark.read.parquet(f"{root}/out").collect()}
    assert found == {10, 11, 13}


def _schema(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def test_dedup_within_watermark_over_batches(spark):
    root = work_folder(spark, "dedup")
    events = spark.range(50).select("id", F.lit("2024-01-01").cast("timestamp").alias("ts"))
    for _ in range(2):
        events.coalesce(1).write.mode("append").parquet(f"{root}/in")
    once = dedup_within_watermark(read_folder_stream(spark, f"{root}/in", events.schema, 1), ["id"], "ts", "1 day")
    drained(once.writeStream.format("parquet").option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start(f"{root}/out"))
    assert rows(spark.read.parquet(f"{root}/out").select("id")) == rows(events.select("id"))


def test_fan_out_isolates_and_replays(spark):
    root = work_folder(spark, "fan")
    spark.range(40).withColumn("v", F.lit("x")).repartition(4).write.parquet(f"{root}/in")
    calls = []

    def flaky(batch, batch_id):
        calls.append(batch_id)
        if batch_id == 1 and calls.count(1) < 3:
            raise ConnectionError("down")
        write_batch(batch, f"{root}/flaky", batch_id)

    sinks = {"steady": append_sink(f"{root}/steady"), "flaky": flaky}

    def run():
        stream = read_folder_stream(spark, f"{root}/in", spark.range(0).withColumn("v", F.lit("x")).schema, 2)
        drained(fan_out(stream, sinks, f"{root}/cp", f"{root}/dead", trigger=None))

    run()
    run()
    assert calls.count(1) == 1 and read_batches(spark, f"{root}/steady").count() == 40
    assert read_batches(spark, f"{root}/flaky").count() < 40
    assert replay(spark, f"{root}/dead", sinks) == 0
    assert replay(spark, f"{root}/dead", sinks) == 1
    assert replay(spark, f"{root}/dead", sinks) == 0
    assert rows(current(spark, f"{root}/flaky", "id")) == rows(spark.range(40).withColumn("v", F.lit("x")))
    assert [r[0] for r in dead_letter_log(spark, f"{root}/dead").orderBy("at").select("state").collect()] == ["failed", "failed", "done"]


def test_a_new_checkpoint_adds_to_a_sink(spark):
    root = work_folder(spark, "anew")
    log = ProgressLog(spark, f"{root}/log", lot=2)
    queries = []
    for run, n in ((0, 10), (1, 3), (1, 3)):
        spark.range(n).write.mode("ignore").parquet(f"{root}/in-{run}")
        stream = read_folder_stream(spark, f"{root}/in-{run}", spark.range(0).schema)
        queries.append(drained(fan_out(stream, {"s": append_sink(f"{root}/out")}, tables.fresh_checkpoint(root, "q") if not run else f"{root}/cp",
                                       f"{root}/dead", query_name=f"q{run}", trigger=None)))
    log.detach(*queries)
    assert read_batches(spark, f"{root}/out").count() == 13
    totals = {r["query"]: r["n"] for r in log.rows().groupBy("query").agg(F.max("total_rows").alias("n")).collect()}
    assert totals == {"q0": 10, "q1": 3}


def test_empty_batches_reach_no_sink(spark):
    root = work_folder(spark, "empty")
    spark.range(0).write.parquet(f"{root}/in")
    calls = []
    stream = read_folder_stream(spark, f"{root}/in", spark.range(0).schema)
    drained(fan_out(stream, {"s": lambda b, i: calls.append(i)}, f"{root}/cp", f"{root}/dead", trigger=None))
    assert calls == [] and dead_letter_log(spark, f"{root}/dead").count() == 0 and replay(spark, f"{root}/dead", {}) == 0


def test_supervision_stops_the_rest_on_failure(spark):
    root = work_folder(spark, "supervise")
    steady = spark.readStream.format("rate").load().writeStream.queryName("steady").format("noop").option(
        "checkpointLocation", f"{root}/a").start()

    def fail(batch, batch_id):
        raise RuntimeError("sink broke")

    failing = spark.readStream.format("rate").load().writeStream.queryName("failing").foreachBatch(fail).option(
        "checkpointLocation", f"{root}/b").start()
    reasons = supervise(spark, [steady, failing], poll_seconds=0.5)
    assert "sink broke" in reasons["failing"] and reasons["steady"] == "stopped with the others"
    assert not steady.isActive


def test_layers_as_streams_equal_the_batch_plan(spark):
    """Topics to raw tables to the typed table to both sinks, through catalog tables."""
    prefix, root = "s1_", work_folder(spark, "layers")
    tables.provision(spark, prefix, f"{root}/db")
    businesses = spark.createDataFrame(
        [("b1", "One", "PA", "4.5", "True", "{'lot': True}"), ("b2", "Two", "NV", "bad", "None", "None")],
        "business_id string, name string, state string, stars string, attributes_Caters string, attributes_BusinessParking string")
    businesses = c.conform(businesses, c.BUSINESS)
    reviews = c.conform(spark.createDataFrame(
        [(f"r{i}", f"b{i % 3}", "4.0", "fine ★", "2024-01-01 10:00:00") for i in range(30)],
        "review_id string, business_id string, stars string, text string, date string"), c.REVIEW)
    write_topic(to_frames(businesses, "business_id", "businesses", 1, 2), f"{root}/topics")
    write_topic(to_frames(reviews, "business_id", "reviews", 2, 2), f"{root}/topics")
    for topic, contract in (("businesses", c.BUSINESS), ("reviews", c.REVIEW)):
        drained(medallion.start_bronze(spark, topic, contract, f"{root}/cp/{topic}", source={"path": f"{root}/topics"},
                                       table=f"{prefix}bronze.{topic}", trigger=None))
    raw = [spark.table(f"{prefix}bronze.{t}") for t in ("businesses", "reviews")]
    drained(medallion.start_silver(spark, f"{prefix}bronze.businesses", f"{prefix}bronze.reviews", f"{prefix}silver.reviews",
                                   f"{root}/cp/silver", trigger=None))
    expected = medallion.silver(*raw)
    facts = spark.table(f"{prefix}silver.reviews")
    assert rows(facts.select(expected.columns).na.fill("-")) == rows(expected.na.fill("-")) and facts.count() == 20
    drained(medallion.start_gold(tables.read_table_stream(spark, f"{prefix}silver.reviews"), f"{root}/sql", f"{root}/vec",
                                 f"{root}/cp/gold", f"{root}/dead", trigger=None))
    assert read_batches(spark, f"{root}/sql").count() == 20
    points = current(spark, f"{root}/vec", "point_id")
    assert points.count() == 20 and points.where("size(embedding) = 768").count() == 20
    tables.reset(spark, "bronze", "silver", "gold", prefix=prefix)
