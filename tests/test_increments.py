"""Committed batches, keyed buckets, stored profiles, frequent values, pruned search, hot keys."""

import ast
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratica.functions.literals import literal_text
from stratica.operators import bloom, profile, pruned, upsert
from stratica.operators.dedup import one_per_entity
from stratica.operators.joins import entity_join, unmatched
from stratica.operators.keyed import KeyedTable
from stratica.operators.vectors import vector_topk
from stratica.session import work_folder
from stratica.sources.commits import CommitLog
from stratica.sources.ndjson import first_rows


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_commits_show_the_last_attempt_and_what_follows_a_fold(spark):
    log = CommitLog(spark, work_folder(spark, "log"))
    assert log.visible() == []
    log.commit("s", 0, "a")
    log.commit("s", 1, "b")
    log.commit("s", 0, "c")
    assert [c.attempt for c in log.visible()] == ["b", "c"]
    other = CommitLog(spark, log.folder.rsplit("/", 1)[0])
    last = log.visible()[-1].version
    other.commit("t", 0, "late")  # finished while the fold was being written
    log.commit("0", -1, "fold", folds=last)
    assert [c.attempt for c in log.visible()] == ["late", "fold"]
    # a version is granted once; a commit file cut short is no commit
    assert not log._created(f"{1:012d}.json", "{}")
    assert log._created(f"{99:012d}.json", '{"version": 99, "att')
    assert [c.attempt for c in log.visible()] == ["late", "fold"]


def test_unfinished_batches_are_not_read(spark):
    at = work_folder(spark, "unfinished")
    frame = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(ValueError):
        upsert.read_batches(spark, at)
    upsert.write_batch(frame, at, 0)
    upsert.land(frame.withColumn("v", F.lit(2)), at, 0)
    assert rows(upsert.read_batches(spark, at).select("k", "v")) == [("a", 1)]
    upsert.write_batch(frame.withColumn("v", F.lit(3)), at, 0)
    assert rows(upsert.read_batches(spark, at, 0).select("k", "v")) == [("a", 3)]


def test_keyed_table_reads_without_an_exchange(spark):
    at, database = work_folder(spark, "keyed"), f"t{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{at}/db'")
    keyed = KeyedTable(spark, f"{database}.k", "k", at, buckets=4)
    batch = lambda *values: spark.createDataFrame(list(values), "k string, v int")
    keyed.upsert(batch(("a", 1), ("b", 1), (None, 1)), 0)
    keyed.upsert(batch(("b", 2), ("c", 2)), 1)
    assert rows(keyed.current()) == [("a", 1), ("b", 2), ("c", 2), (None, 1)]
    assert "Exchange" not in keyed.current()._jdf.queryExecution().executedPlan().toString()
    before = keyed.log.visible()
    keyed.compact()
    assert rows(keyed.current()) == [("a", 1), ("b", 2), ("c", 2), (None, 1)]
    assert len(keyed.log.visible()) == 1 and sorted(keyed.vacuum()) == sorted(c.attempt for c in before)
    keyed.upsert(batch(("c", 3), (None, 3)), 2)
    keyed.upsert(batch(("c", 4)), 2)  # the same batch again, in another form
    keyed.upsert(batch(("a", 5)), upsert.BatchId(0, "20240101-x"))
    assert rows(keyed.current()) == [("a", 5), ("b", 2), ("c", 4), (None, 1)]
    assert "Exchange" not in keyed.current()._jdf.queryExecution().executedPlan().toString()


def test_stored_profiles_merge(spark):
    df = spark.range(6000).select(
        (F.col("id") % 3).alias("small"), F.col("id").alias("wide"), F.when(F.col("id") % 2 == 0, "x").alias("half"), (F.col("id") % 4).alias("part")
    )
    states = profile.profile_state(df, ["small", "wide", "half"], F.col("part"))
    found = {r["column"]: r for r in profile.merged_profile(states).collect()}
    assert (found["small"]["rows"], found["small"]["distinct_count"], found["small"]["exact"]) == (6000, 3, True)
    assert found["half"]["distinct_count"] == 2 and found["half"]["exact"]
    assert not found["wide"]["exact"] and abs(found["wide"]["distinct_count"] - 6000) < 180
    counts = rows(profile.merged_counts(states).where("column = 'half'").select("value", "n"))
    assert counts == [("x", 3000), (None, 3000)]


@pytest.mark.parametrize("cells", [4, 1 << 16])
def test_top_values_equal_the_full_count(spark, monkeypatch, cells):
    monkeypatch.setattr(profile, "CELLS", cells)
    heavy = spark.range(5000).select(F.expr("CASE WHEN id % 3 = 0 THEN NULL WHEN id < 900 THEN id % 40 ELSE id END").alias("v"))
    for df, top in ((heavy, 5), (heavy, 60), (spark.range(300).select(F.col("id").alias("v")), 7), (heavy.limit(0), 3)):
        whole = df.groupBy(F.col("v").cast("string").alias("value")).count().collect()
        expected = sorted(((r["value"], r["count"]) for r in whole), key=lambda r: (-r[1], r[0] is not None, r[0] or ""))[:top]
        assert sorted(map(tuple, profile.top_values(df, "v", top).collect()), key=str) == sorted(expected, key=str)


def test_hot_keys_alone_are_spread(spark):
    facts = spark.range(4000).select(F.when(F.col("id") % 4 != 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("f"),
                                     F.lit("2024-01-02").cast("timestamp").alias("ingestion_timestamp"))
    entities = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("e"), F.lit("2024-01-01").cast("timestamp").alias("ingestion_timestamp"))
    hot = profile.hot_keys(facts, "k", 0.1)
    assert rows(hot) == [(7, 8)]
    plain, spread = entity_join(entities, facts, "k"), entity_join(entities, facts, "k", hot=hot)
    assert rows(plain) == rows(spread)
    with pytest.raises(ValueError):
        entity_join(entities, facts, "k", hot=hot, salts=4)


def test_facts_joined_once(spark):
    facts = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("z", 3)], "k string, f int").withColumn("ingestion_timestamp", F.current_timestamp())
    entities = spark.createDataFrame([("a", "x")], "k string, e string").withColumn("ingestion_timestamp", F.current_timestamp())
    assert rows(entity_join(entities, facts, "k", once=["f"]).select("k", "e", "f")) == [("a", "x", 1), ("a", "x", 2)]
    stream = spark.readStream.format("rate").load().select(F.col("value").alias("k"), F.col("timestamp").alias("ingestion_timestamp"))
    with pytest.raises(ValueError):
        entity_join(stream.withColumn("e", F.lit(1)), stream.withColumn("f", F.lit(1)), "k", once=["f"])


def test_pruned_search_equals_the_full_one_and_reads_less(spark):
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(20, 8)) * 4
    vectors = [(middles[i % 20] + rng.normal(size=8) * 0.2).tolist() for i in range(1500)] + [[0.0] * 8, [1.0] * 5, [float("nan")] * 8, None]
    vectors[30:50] = [vectors[30]] * 20  # ties at the boundary
    points = spark.createDataFrame(list(enumerate(vectors)), "point_id int, embedding array<float>")
    queries = spark.createDataFrame([*((i, vectors[i]) for i in (0, 5, 30)), (97, [0.0] * 8), (98, [1.0] * 8)], "query_id int, query_vector array<double>")
    means = pruned.centres(points, 20, 8)
    at = work_folder(spark, "pruned")
    pruned.clustered(points, means).write.partitionBy(pruned.CLUSTER).parquet(at)
    hits, scored = pruned.pruned_topk(spark.read.parquet(at), queries, means, 7)
    names = ["query_id", "point_id", "score", "rank"]
    assert rows(hits.select(names)) == rows(vector_topk(points, queries, 7, dims=8).select(names))
    read = {r["query_id"]: r["scored"] for r in scored.collect()}
    assert read[0] < 700 and read[5] < 700
    few, _ = pruned.pruned_topk(spark.read.parquet(at), queries, means, 5000)
    assert few.where("query_id = 0").count() == 1501


def test_first_rows_keep_the_order_of_the_scan(spark):
    df = spark.range(0, 1000, 1, 7).select(F.col("id").alias("v"))
    for limit in (1, 143, 500, 999, 1000, 5000):
        assert rows(first_rows(df, limit)) == rows(df.limit(limit))
    plan = first_rows(df, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan


def test_entities_that_differ_have_one_row(spark):
    facts = spark.createDataFrame([("a", 1, "x", None), ("a", 2, "w", 1.0), ("b", 1, None, None)], "k string, at int, n string, s double")
    assert rows(one_per_entity(facts, "k", ["n", "s"])) == [("a", "x", None), ("b", None, None)]
    assert rows(one_per_entity(facts.repartition(3), "k", ["n", "s"], F.col("at"))) == [("a", "w", 1.0), ("b", None, None)]


ESCAPED = [
    r"'\x41\x7a'", r"'é'", r"'\U0001F600!'", r"'\101\7\60'", "'a\\\nb'", r"'\d\q\8'", r"'\a\b\f\n\r\t\v\\\'\"'", r'"\x22"', r"'\0'",
    r"'\x4'", r"'\u12'", r"'\U00110000'", r"'\\x41'", r"'\\\x41'", r"u'★'", r"'\377'", r"'\477'", "'tail\\\\'",
]


def test_escapes_equal_python(spark):
    def python_text(value):
        try:
            return ast.literal_eval(value)
        except Exception:
            return None

    frame = spark.createDataFrame([(v,) for v in [*ESCAPED, r"'\ud83d'", r"'\N{DASH}'"]], "v string")
    assert [r[0] for r in frame.select(literal_text(F.col("v"))).collect()] == [python_text(v) for v in ESCAPED] + [None, None]


def test_filters_miss_no_key(spark):
    bits = 1 << 16
    keys = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 3).cast("string").alias("day"))
    stored = bloom.filters(keys.unionByName(keys.limit(1).withColumn("k", F.lit(None))), "k", "day", bits)
    asked = spark.range(9000).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    answers = asked.select("id", bloom.may_contain(stored, F.col("k"), bits).alias("may")).collect()
    assert all(r["may"] for r in answers if r["id"] < 4000)
    assert sum(r["may"] for r in answers if r["id"] >= 4000) < 250
    day = bloom.may_contain(stored.where("date = '1'"), F.col("k"), bits)
    some = asked.where(day & (F.col("id") < 4000)).count()
    assert 1333 <= some < 1400
    rows_ = asked.unionByName(asked.limit(1).withColumn("k", F.lit(None)))
    for may in (None, bloom.may_contain(stored, F.col("k"), bits)):
        assert unmatched(rows_, keys, "k", may).count() == 5001
    nothing = bloom.may_contain(stored.limit(0), F.col("k"), bits)
    assert asked.where(nothing).count() == 0
