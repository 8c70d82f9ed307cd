"""Operators on small frames, against brute force where there is one."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratica.functions.text import ERROR_TEXT, NO_HYBRID_TEXT
from stratica.operators import analytics, filters, quality, upsert
from stratica.operators.dedup import latest_by, one_per_entity, salt_of
from stratica.operators.blockwise import blockwise_topk
from stratica.operators.embedding import HashingModel, _vectors, embed
from stratica.operators.joins import entity_join, restricted_to, unmatched
from stratica.operators.profile import distinct_counts, profile
from stratica.operators.vectors import dimension_report, hit_view, restricted_topk, vector_topk
from stratica.plans.answers import answer, contexts, filtered_search
from stratica.session import checkpointed, work_folder


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_by_is_total(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "w"), (None, 1, "n")],
                               "k string, ts int, v string")
    once = rows(latest_by(df, "k", [F.col("ts").desc()]).na.fill("-"))
    again = rows(latest_by(df.repartition(3), "k", [F.col("ts").desc()]).na.fill("-"))
    assert once == again and [r[:2] for r in once] == [("-", 1), ("a", 2), ("b", 1)]


def test_latest_by_limits_groups_before_the_shuffle(spark):
    at = work_folder(spark, "plan")
    spark.range(10).withColumn("k", F.lit("hot")).write.parquet(at)
    plan = latest_by(spark.read.parquet(at), "k", [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def entities_and_facts(spark):
    entities = spark.createDataFrame(
        [("a", "A", "2024-01-01 00:00:00"), ("b", "B", "2024-01-05 00:00:00"), ("b", "B2", "2024-01-01 00:00:00")],
        "k string, name string, ingestion_timestamp string",
    ).withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp"))
    facts = spark.createDataFrame(
        [("a", i, "2024-01-02 00:00:00") for i in range(50)] + [("b", 50, "2024-01-03 00:00:00"), ("c", 51, None), (None, 52, None)],
        "k string, f int, ingestion_timestamp string",
    ).withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp"))
    return entities, facts


def test_entity_join_resolves_and_multiplies(spark):
    entities, facts = entities_and_facts(spark)
    joined = entity_join(entities, facts, "k")
    assert joined.columns == ["k", "name", "f", "ingestion_timestamp", "ingestion_date"]
    plain = rows(joined)
    assert len(plain) == 52
    assert [(r[1], str(r[4])) for r in plain if r[0] == "b"] == [("B", "2024-01-05"), ("B2", "2024-01-03")]
    assert rows(entity_join(entities, facts, "k", salts=5)) == plain
    assert len(rows(entity_join(entities, facts, "k", within="1 day"))) == 50
    outer = rows(entity_join(entities, facts, "k", how="full_outer").na.fill("-", ["k"]))
    assert len(outer) == 54 and [r[0] for r in outer if r[2] in (51, 52)] == ["-", "c"]
    with pytest.raises(ValueError, match="salts"):
        entity_join(entities, facts, "k", how="left_outer", salts=4)
    with pytest.raises(ValueError, match="rename"):
        entity_join(entities.withColumn("f", F.lit(1)), facts, "k")


def test_salts_spread_one_hot_row(spark):
    copies = spark.range(0, 4000, 1, 40).select(F.lit("hot").alias("k"), F.lit("same").alias("v"))
    share = copies.groupBy(salt_of(["k", "v"], 8).alias("salt")).count().agg(F.max("count")).first()[0]
    assert share <= 1500


def test_unmatched_keeps_null_keys(spark):
    _, facts = entities_and_facts(spark)
    matched = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert {r["f"] for r in unmatched(facts, matched, "k").collect()} == {50, 51, 52}


def test_restricted_to_ignores_empty_ids(spark):
    df = spark.createDataFrame([("a", 1), ("", 2), (None, 3), ("b", 4)], "k string, v int")
    ids = spark.createDataFrame([("a",), ("a",), ("",), (None,)], "k string")
    assert rows(restricted_to(df, ids, "k")) == [("a", 1)]


def test_reconcile_is_idempotent(spark):
    raw = spark.createDataFrame(
        [("1", "x", "t"), ("2", "y", None), (None, "y", "t"), (None, "x", None), ("3", "x", "t")],
        "review_id string, business_id string, text string",
    ).withColumn("ingestion_timestamp", F.lit("2024-01-02 10:00:00"))
    joined = spark.createDataFrame([("3",)], "review_id string")
    known = spark.createDataFrame([("x",), ("x",)], "business_id string")
    first = quality.reconcile(raw, joined, "review_id", entities=known)
    got = {(r["review_id"], r["business_id"], r["reason"], r["ingestion_date"]) for r in first.collect()}
    assert got == {
        ("1", "x", "late_or_lost", "2024-01-02"), ("2", "y", "unmatched_business_id", "2024-01-02"),
        (None, "y", "unmatched_business_id", "2024-01-02"), (None, "x", "late_or_lost", "2024-01-02"),
    }
    kept = checkpointed(first)
    assert quality.reconcile(raw, joined, "review_id", entities=known, quarantined=kept).count() == 0
    assert quality.reconcile(raw.limit(0), joined, "review_id").count() == 0


def test_sink_status(spark):
    full, empty = spark.range(3), spark.range(0)
    assert quality.sink_audit(full, empty).first()["status"] == quality.SQL_ONLY
    assert quality.sink_audit(empty, full).first()["status"] == quality.VECTOR_ONLY
    assert quality.sink_audit(empty, empty).first()["status"] == quality.BOTH_EMPTY


def test_profile_against_counting(spark):
    values = [None, None, "b"] + [f"v{i % 60:02d}" for i in range(200)]
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "many string, few int")
    got = profile(df, ["many", "few"], threshold=50, top=5).orderBy("column", "position").collect()
    few = [tuple(r) for r in got if r["column"] == "few"]
    assert [(r[1], r[2], r[4], r[5]) for r in few] == [(3, "all", "0", 68), (3, "all", "1", 68), (3, "all", "2", 67)]
    many = [tuple(r) for r in got if r["column"] == "many"]
    assert [(r[1], r[2], r[4], r[5]) for r in many] == [(62, "top", f"v{i:02d}", 4) for i in range(5)]
    assert distinct_counts(df, ["many", "few"]).first().asDict() == {"many": 62, "few": 3}
    numbers = spark.createDataFrame([(float(i % 12), "x" * 100 + str(i % 3)) for i in range(30)], "v double, t string")
    listed = profile(numbers, ["v"]).orderBy("position").collect()
    assert [r["value"] for r in listed] == [f"{i}.0" for i in range(12)]
    assert distinct_counts(numbers, ["v", "t"]).first().asDict() == {"v": 12, "t": 3}
    assert distinct_counts(df, ["few"], approximate=True).first()["few"] == 3


SPEC = {"name": "contains", "city": "string", "price": "int", "open": "bool", "stars": "float"}


def test_filter_compilation(spark):
    df = spark.createDataFrame([("Pizzeria A", "X", 2, True, 4.5), ("pizzeria b", "X", 1, False, 3.0)],
                               "name string, city string, price int, open boolean, stars double")
    compiled = filters.compile_filter(
        {"name": "Pizz", "city": "X", "price": "2", "open": "true", "stars": "4.5", "other": 1, "x": None, "y": ""}, SPEC)
    assert compiled.skipped == ["other"] and compiled.apply(df).count() == 1
    assert filters.compile_filter({"open": "false"}, SPEC).apply(df).first()["name"] == "pizzeria b"
    nothing = filters.compile_filter({"price": "cheap", "city": ""}, SPEC)
    assert nothing.predicate is None and nothing.skipped == ["price"] and nothing.apply(df).count() == 2


def test_float_columns_compare_as_floats(spark):
    df = spark.createDataFrame([(4.3, 4.3), (4.5, 4.5)], "stars float, wide double")
    assert filters.compile_filter({"stars": "4.3"}, SPEC).apply(df).count() == 1
    assert filters.compile_filter({"wide": 4.3}, {"wide": "float"}).apply(df).count() == 1


def test_facets_cover_the_documented_groups():
    sizes = {g: len(v) for g, v in filters.BUSINESS_FACETS.items() if isinstance(v, dict)}
    assert sizes == {"ambiance": 6, "price": 4, "amenities": 6, "parking": 5, "music": 7, "hours": 7, "more": 11}


def test_facets_or_within_a_column(spark):
    df = spark.createDataFrame(
        [("t", "full_bar", "quiet", True, True), ("n", "beer_and_wine", "quiet", True, None), ("n", "none", "quiet", True, True),
         ("t", "full_bar", "loud", True, True)],
        "city string, alcohol string, noise_level string, parking_lot boolean, parking_valet boolean",
    )
    chosen = {"cities": ["t", "n"], "ambiance": ["Full Bar", "Beer & Wine", "Quiet"], "parking": ["Lot"]}
    assert filters.facet_filter(df, chosen).count() == 2
    assert filters.facet_filter(df, {**chosen, "parking": ["Lot", "Valet"]}).count() == 1
    assert filters.facet_filter(df, {}).count() == 4


def brute_force(points, queries, k, allowed=None):
    out = []
    for q, qv in queries.items():
        scored = []
        for p, (entity, pv) in points.items():
            if allowed is not None and entity not in allowed.get(q, ()):
                continue
            a, b = np.float64(qv), np.float32(pv).astype(np.float64)
            scored.append((-round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 9), p))
        out += [(q, p, round(-s, 4), i + 1) for i, (s, p) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def search_space(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(60, 8))
    base[20:40] = base[3]  # copies: ties at the boundary
    points = {f"p{i:03d}": (f"e{i % 7}", v.tolist()) for i, v in enumerate(base)}
    queries = {i: base[i].tolist() for i in range(9)}
    p = spark.createDataFrame([(i, e, v) for i, (e, v) in points.items()], "point_id string, business_id string, embedding array<float>")
    q = spark.createDataFrame(list(queries.items()), "query_id int, query_vector array<double>")
    return points, queries, p.repartition(5), q


def searched(df):
    return sorted((r["query_id"], r["point_id"], round(r["score"], 4), r["rank"]) for r in df.collect())


@pytest.mark.parametrize("block", [1024, 2])
def test_vector_topk_equals_brute_force(search_space, block):
    points, queries, p, q = search_space
    assert searched(vector_topk(p, q, 10, dims=8, block=block)) == brute_force(points, queries, 10)


@pytest.mark.parametrize("block", [1024, 2])
def test_restricted_topk_equals_brute_force(spark, search_space, block):
    points, queries, p, q = search_space
    allowed = {i: [f"e{i % 7}", f"e{(i + 3) % 7}"] for i in range(6)}
    pairs = spark.createDataFrame([(i, e) for i, es in allowed.items() for e in es * 2], "query_id int, business_id string")
    got = searched(restricted_topk(p, q, pairs, 6, entity="business_id", dims=8, block=block))
    assert got == brute_force(points, queries, 6, allowed)


@pytest.mark.parametrize(("block", "part"), [(None, None), (2, 7)])
def test_blockwise_topk_equals_brute_force(spark, search_space, block, part):
    points, queries, p, q = search_space
    size = {"dims": 8, "block": block, "part": part}
    assert searched(blockwise_topk(p, q, 10, **size)) == brute_force(points, queries, 10)
    allowed = {i: [f"e{i % 7}", f"e{(i + 3) % 7}"] for i in range(6)}
    pairs = spark.createDataFrame(
        [(i, e) for i, es in allowed.items() for e in es * 2] + [(99, "e1"), (1, None)], "query_id int, business_id string"
    )
    got = searched(blockwise_topk(p, q, 6, allowed=pairs, entity="business_id", **size))
    assert got == brute_force(points, queries, 6, allowed)


def test_blockwise_topk_on_odd_vectors(spark, search_space):
    """Vectors that are missing, short or no numbers find nothing and are not found; a repeated query counts once."""
    points, queries, p, q = search_space
    odd = [F.lit(None), F.slice("v", 1, 3), F.transform("v", lambda _: F.lit(float("nan")))]
    more = q.limit(1).withColumnRenamed("query_vector", "v")
    bad = [more.select((F.lit(50) + i).cast("int").alias("query_id"), c.cast(q.schema["query_vector"].dataType).alias("query_vector")) for i, c in enumerate(odd)]
    asked = q.unionByName(q)
    for b in bad:
        asked = asked.unionByName(b)
    seen = p.unionByName(p.limit(1).withColumn("point_id", F.lit("odd")).withColumn("embedding", F.slice("embedding", 1, 3)))
    assert searched(blockwise_topk(seen, asked, 10, dims=8, block=2, part=7)) == brute_force(points, queries, 10)
    pairs = spark.createDataFrame([(50, "e1"), (51, "e1"), (52, "e1")], "query_id int, business_id string")
    assert blockwise_topk(seen, asked, 10, dims=8, allowed=pairs, entity="business_id").count() == 0
    assert blockwise_topk(p.limit(0), q, 10, dims=8).count() == 0 and blockwise_topk(p, q.limit(0), 10, dims=8).count() == 0


def test_search_filters_first_and_checks_dims(spark, search_space):
    points, queries, p, q = search_space
    hits, compiled = filtered_search(p, q, {"business_id": "e2"}, 3, dims=8, spec={"business_id": "string"})
    only = {i: v for i, v in points.items() if v[0] == "e2"}
    assert searched(hits) == brute_force(only, queries, 3) and compiled.skipped == []
    odd = p.limit(1).withColumn("embedding", F.slice("embedding", 1, 3))
    assert dimension_report(p.unionByName(odd), "embedding", 8).first()["actual_dims"] == 3
    assert vector_topk(odd, q, 3, dims=8).count() == 0
    assert vector_topk(p, q.limit(0), 3, dims=8).count() == 0


def test_one_scan_serves_many_queries(spark):
    """No model under a search of stored points, no exchange with a vector, one scan for 5,000 queries."""
    at = work_folder(spark, "points")
    points = spark.range(40).select(F.col("id").alias("point_id"), F.concat(F.lit("e"), F.col("id") % 5).alias("business_id"),
                                    F.transform(F.sequence(F.lit(1), F.lit(16)), lambda i: (i * F.col("id") % 7).cast("float")).alias("embedding"))
    points.write.parquet(at)
    stored = spark.read.parquet(at)
    queries = spark.range(5000).select(F.col("id").alias("query_id"), F.array_repeat(F.col("id").cast("double") + 1, 16).alias("query_vector"))
    hits = vector_topk(restricted_to(stored, spark.createDataFrame([("e1",)], "business_id string"), "business_id"), queries, 3, dims=16)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan and "Union" not in plan
    physical = hits._jdf.queryExecution().executedPlan().toString()
    assert not any("embedding" in line for line in physical.splitlines() if "Exchange" in line)
    assert hits.count() == 15_000


def test_hits_have_defaults(spark):
    df = spark.createDataFrame([(1, None, None, 0.123456)], "query_id int, name string, city string, score double")
    shown = hit_view(df, {"name": "Unknown", "city": ""}).first().asDict()
    assert shown == {"name": "Unknown", "city": "", "score": 0.1235}


def test_embedding_keeps_order_and_batch_size(spark):
    class Recorder:
        dims = 3

        def __call__(self, texts, task):
            assert len(texts) <= 4 and task == "query"
            return np.array([[len(t), 1, 0] for t in texts], dtype=float)

    df = spark.range(0, 30).select("id", F.expr("repeat('x', int(id))").alias("t")).withColumn(
        "t", F.when(F.col("id") != 7, F.col("t")))
    out = embed(df, "t", Recorder(), task="query", batch=4).collect()
    assert all(r["embedding"] == [0 if r["id"] == 7 else r["id"], 1, 0] for r in out) and len(out) == 30


def test_hashing_model_has_unit_vectors():
    vectors = HashingModel(16)(["a b a", "", "A B a"], "document")
    assert np.allclose(np.linalg.norm(vectors, axis=1), [1, 0, 1]) and np.allclose(vectors[0], vectors[2])


def test_upsert_replays_and_compacts(spark):
    at, folded = work_folder(spark, "points"), work_folder(spark, "points")
    first = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    second = spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    for batch, number in ((first, 0), (second, 1), (second, 1), (first, 0)):
        upsert.write_batch(batch, at, number)
    expected = [("a", 1), ("b", 2), ("c", 2)]
    assert rows(upsert.current(spark, at, "k")) == expected
    assert rows(upsert.upsert(first, second, "k", [F.col("v").desc()])) == expected
    plan = upsert.current(spark, at, "k")._jdf.queryExecution().executedPlan().toString()
    assert not any(" v#" in line or "[v#" in line for line in plan.splitlines() if "Exchange" in line)
    upsert.write_batch(spark.createDataFrame([("c", 3)], "k string, v int"), at, upsert.BatchId(0, "20240101-x"))
    assert rows(upsert.current(spark, at, "k")) == [("a", 1), ("b", 2), ("c", 3)]
    upsert.write_batch(second.where("k = 'c'"), at, upsert.BatchId(0, "20240101-x"))
    upsert.compact(spark, at, folded, "k")
    upsert.write_batch(spark.createDataFrame([("a", 9)], "k string, v int"), folded, 2)
    assert rows(upsert.current(spark, folded, "k")) == [("a", 9), ("b", 2), ("c", 2)]


def test_entity_grain_percentages(spark):
    facts = spark.createDataFrame([("a", "x", True)] * 5 + [("b", "x", False), ("c", "y", None)], "k string, g string, f boolean")
    entities = one_per_entity(facts, "k", ["g", "f"])
    assert rows(analytics.percentage_by(entities, "g", F.col("f"))) == [("x", 50.0), ("y", 0.0)]


def test_contexts_by_route(spark):
    questions = spark.createDataFrame(
        [(1, "q1", "SQL", "10 rows", None), (2, "q2", "VECTOR", None, None), (3, "q3", "HYBRID", None, None),
         (4, "q4", "HYBRID", "ids", None), (5, "q5", "SQL", None, "boom")],
        "query_id int, query string, route string, sql_result string, error string",
    )
    fields = "query_id int, rank int, name string, city string, state string, categories string, review_stars string, business_stars string, text string, score double"
    hits = spark.createDataFrame(
        [(2, 2, "B", "c", "s", "k", "4", "4.5", "t2", 0.5), (2, 1, "A", "c", "s", "k", "5", "4.0", "y" * 300, 1.0),
         (4, 1, "C", "", "", "", "", "", "", 0.00012)], fields)
    got = {r["query_id"]: r for r in contexts(questions, hits).collect()}
    assert got[1]["context"] == "User question: q1\n\nSQL analysis results:\n10 rows" and got[1]["answer"] is None
    assert got[2]["context"] == (
        "User question: q2\n\nSemantic search results:\n"
        "1. A (c, s) — Business: 4.0★, Review: 5★, Categories: k\n   Review: \"" + "y" * 200 + "...\"\n   Relevance: 1.0\n"
        "2. B (c, s) — Business: 4.5★, Review: 4★, Categories: k\n   Review: \"t2...\"\n   Relevance: 0.5"
    )
    assert got[3]["answer"] == NO_HYBRID_TEXT + "\n\n---\nRouted as: HYBRID"
    assert "SQL analysis results:\nids\n\nSemantic search results:\n1. C" in got[4]["context"] and got[4]["context"].endswith("0.0001")
    assert got[5]["answer"] == ERROR_TEXT + "\n\n---\nRouted as: SQL"


def test_answers_follow_their_route(spark, search_space):
    points, queries, p, q = search_space
    named = p.withColumn("name", F.col("point_id")).withColumn("text", F.lit("t"))
    for column in ("city", "state", "categories", "review_stars", "business_stars"):
        named = named.withColumn(column, F.lit(None).cast("string"))
    routes = F.element_at(F.array(F.lit("SQL"), F.lit("VECTOR"), F.lit("HYBRID")), F.col("query_id") % 3 + 1)
    questions = q.select("query_id", F.lit("?").alias("query"), routes.alias("route"), "query_vector",
                         F.lit("x").alias("sql_result"), F.lit(None).cast("string").alias("error"))
    ids = spark.createDataFrame([(2, "e1"), (2, ""), (5, None), (1, "e1")], "query_id int, business_id string")
    got = {r["query_id"]: r for r in answer(named, questions, ids, 3, dims=8).collect()}
    assert [got[i]["hit_count"] for i in range(9)] == [0, 3, 3] * 3
    best = {i: [h[1] for h in brute_force(points, queries, 3, {i: ["e1"]} if i == 2 else None) if h[0] == i] for i in (1, 2, 5)}
    for i, names in best.items():
        assert all(f". {n} (, )" in got[i]["context"] for n in names)


def test_a_task_holds_one_call_of_vectors():
    texts = pd.Series(["some text", None, "other"] * 300)
    pieces = list(_vectors(iter([texts, texts[:0], texts[:5]]), HashingModel(), "document", 100))
    assert [len(p) for p in pieces] == [100] * 9 + [5]
    assert all(v.dtype == np.float32 and v.shape == (768,) for p in pieces for v in p)


def test_python_is_handed_few_long_texts_at_a_time(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    texts = spark.range(0, 4_000, 1, 1).select(F.repeat(F.lit("0123456789"), 1_000).alias("text"))
    assert max(r["n"] for r in texts.mapInArrow(sizes, "n long").collect()) <= 1_000
