"""Contracts, NDJSON, topics and layer tables."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratica.proofs import records
from stratica.sources import contracts as c
from stratica.sources import tables
from stratica.sources.ndjson import infer_ndjson, malformed, parse_records, read_ndjson
from stratica.sources.topics import read_topic, to_frames, write_topic
from stratica.session import work_folder


def test_layout_sizes():
    assert len(c.BUSINESS) == 56 and len(c.REVIEW) == 9
    assert len(c.typed_layout()) == 65 and len(c.PAYLOAD_FIELDS) == 17
    assert len(c.quarantine_layout()) == 12


def test_flatten_and_stringify(spark):
    df = spark.createDataFrame(
        [(1, (True, ("", float("nan"))), 3.0)], "id int, a struct<f:boolean,n:struct<t:string,d:double>>, x double"
    )
    row = c.stringify(c.flatten(df)).first().asDict()
    assert row == {"id": "1", "a_f": "True", "a_n_t": None, "a_n_d": None, "x": "3.0"}


def test_conform_and_compatibility(spark):
    df = spark.createDataFrame([("1", "drop")], "a string, z string")
    assert c.conform(df, c.strings("a", "b")).first().asDict() == {"a": "1", "b": None}
    assert c.backward_compatible(c.strings("a", "z"), c.strings("a", "b"))
    required = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType(), False)])
    assert not c.backward_compatible(c.strings("a"), required)
    assert not c.backward_compatible(c.strings("a"), T.StructType([T.StructField("a", T.LongType())]))


def test_describe_schema(spark):
    df = spark.createDataFrame([], "a int, b struct<x:string,y:array<int>>")
    rows = [tuple(r)[:2] for r in c.describe_schema(df).collect()]
    assert rows == [("a", "int"), ("b", "struct<x:string,y:array<int>>"), ("b.x", "string"), ("b.y", "array<int>")]


def test_ndjson_contract(spark, tmp_path):
    nested = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.StringType()),
                           T.StructField("attributes", c.strings("f", "s", "b"))])
    contract = c.strings("id", "n", "attributes_f", "attributes_s", "attributes_b", "absent")
    lines = [
        {"id": "a", "n": 3.0, "attributes": {"f": True, "s": "true", "b": ""}, "unknown": 1},
        {"id": "b", "n": 7, "attributes": None},
        {"id": "c", "attributes": {"f": False, "s": "None"}},
    ]
    path = tmp_path / "in.json"
    path.write_text("".join(json.dumps(line) + "\n" for line in lines))
    rows = [tuple(r) for r in read_ndjson(spark, str(path), nested, contract).orderBy("id").collect()]
    assert rows == [
        ("a", "3.0", "True", "true", None, None),
        ("b", "7", None, None, None, None),
        ("c", None, "False", "None", None, None),
    ]
    assert read_ndjson(spark, str(path), nested, contract, limit=2, partitions=2).count() == 2
    lines = spark.createDataFrame([('{"id": "1"}',), ('{"id": broken',), ("[1,2]",), ("7",)], "value string")
    with pytest.raises(Exception, match="malformed record"):
        parse_records(lines, nested).collect()
    assert parse_records(lines, nested, fail=False).count() == 1
    assert sorted(r["value"] for r in malformed(lines, nested).collect()) == ["7", "[1,2]", '{"id": broken']
    assert "attributes" in infer_ndjson(spark, str(path)).columns
    with pytest.raises(AnalysisException):
        read_ndjson(spark, str(tmp_path / "missing.json"), nested)


def test_topics_share_partitions(spark):
    at = work_folder(spark, "topics")
    rows = spark.range(200).select(F.concat(F.lit("k"), F.col("id") % 20).alias("k"), F.col("id").cast("string").alias("v"))
    write_topic(to_frames(rows, "k", "one", 1, 4), at)
    write_topic(to_frames(rows.distinct(), "k", "two", 2, 4), at)
    frames = spark.read.parquet(at)
    spread = frames.groupBy("key").agg(F.count_distinct("partition").alias("n")).agg(F.max("n")).first()[0]
    assert spread == 1 and frames.count() == 400
    stream = read_topic(spark, "one", at, max_files=1)
    query = stream.writeStream.format("memory").queryName("topic_one").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("topic_one").count() == 200


def test_layers_are_created_filled_and_dropped(spark):
    prefix = "t1_"
    names = tables.provision(spark, prefix, work_folder(spark, "layers"))
    assert tables.provision(spark, prefix) == names and len(names) == 4
    review = spark.createDataFrame([tuple("abcdefghi") + ("2024-01-01 00:00:00", "2024-01-01")], c.with_stamps(c.REVIEW))
    tables.append_by_position(review, f"{prefix}bronze.reviews")
    tables.append_by_name(review.select(*reversed(review.columns)), f"{prefix}bronze.reviews")
    table = f"{prefix}bronze.reviews"
    assert [tuple(r) for r in spark.table(table).distinct().collect()] == [tuple(review.first())]
    assert tables.ensure_dedup_view(spark, table, "review_id")
    assert not tables.ensure_dedup_view(spark, f"{prefix}bronze.none", "review_id")
    assert spark.table(f"{table}_deduped").columns == review.columns and spark.table(f"{table}_deduped").count() == 1
    assert tables.folder_bytes(spark.table(table)).first()[0] > 0
    tables.reset_sink(spark, table)
    assert not spark.catalog.tableExists(table)
    tables.reset(spark, "bronze", "silver", "gold", prefix=prefix)
    assert not spark.catalog.databaseExists(f"{prefix}bronze")
    assert tables.fresh_checkpoint("/x", "q") != tables.fresh_checkpoint("/x", "q")


def test_records_of_a_small_file_are_dealt_to_all_cores(spark):
    pieces = records.business_source(spark, "/root/testdata/sf0.01").select(F.spark_partition_id().alias("piece"))
    assert pieces.distinct().count() == spark.sparkContext.defaultParallelism > 1
