"""Scans, contracts and wire frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratica.functions.wire import decode_frames
from stratica.proofs import records
from stratica.proofs.registry import proof, table
from stratica.session import work_folder
from stratica.sources import contracts as c
from stratica.sources.ndjson import infer_ndjson, malformed, parse_records, read_ndjson, write_ndjson
from stratica.sources.topics import to_frames, write_topic


def _event_lines(spark: SparkSession, folder: str) -> str:
    """Events as NDJSON with their properties as a nested object."""
    at = work_folder(spark, "events-json")
    events = table(spark, folder, "events").select(
        "event_id", "event_type", "value", F.from_json("props", "k long").alias("props")
    )
    write_ndjson(events, at)
    return at


@proof(
    """SELECT event_id, event_type, value, CAST(props->>'$.k' AS BIGINT) AS props_k FROM events"""
)
def json_scan_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """Inferred scan of nested records, flattened."""
    return c.flatten(infer_ndjson(spark, _event_lines(spark, folder)))


@proof(
    """SELECT event_id, event_type, CAST(props->>'$.k' AS BIGINT) AS k
       FROM events ORDER BY event_id LIMIT 1000"""
)
def input_cap(spark: SparkSession, folder: str) -> DataFrame:
    """The input cap: the first N records in key order, with a nested field projected."""
    scanned = infer_ndjson(spark, _event_lines(spark, folder))
    return scanned.orderBy("event_id").limit(1000).select("event_id", "event_type", "props.k")


@proof("SELECT count(*) AS whole, count(*) - 7 AS capped FROM events")
def input_cap_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The scan's own cap, seven records below what the file holds; zero reads all."""
    at = _event_lines(spark, folder)
    nested = c.strings("event_id", "event_type")
    whole = read_ndjson(spark, at, nested).count()
    capped = read_ndjson(spark, at, nested, limit=whole - 7, partitions=4)
    return capped.agg(F.lit(whole).cast("long").alias("whole"), F.count(F.lit(1)).alias("capped"))


@proof(
    """SELECT event_id % 3 <> 0 AS kept, count(*) AS lines FROM events GROUP BY ALL"""
)
def ndjson_set_aside(spark: SparkSession, folder: str) -> DataFrame:
    """Broken lines and lines that are no object are set aside, the others are read."""
    nested = c.strings("event_id", "event_type")
    whole = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), "event_type"))
    broken = F.when(F.col("event_id") % 6 == 0, F.lit('{"event_id": broken')).otherwise(F.lit("[1, 2]"))
    lines = table(spark, folder, "events").select(
        F.when(F.col("event_id") % 3 == 0, broken).otherwise(whole).alias("value")
    )
    read = parse_records(lines, nested, fail=False).where("event_id IS NOT NULL AND event_type IS NOT NULL")
    counts = [
        rows.agg(F.count(F.lit(1)).alias("lines")).select(F.lit(kept).alias("kept"), "lines")
        for kept, rows in ((True, read), (False, malformed(lines, nested)))
    ]
    return counts[0].unionByName(counts[1])


@proof(
    """SELECT column_name AS path, CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
              ELSE 'timestamp_ntz' END AS type, (SELECT count(*) FROM orders) AS table_rows
       FROM duckdb_columns() WHERE table_name = 'orders'"""
)
def schema_report(spark: SparkSession, folder: str) -> DataFrame:
    """The schema tree of a table with its row count."""
    orders = table(spark, folder, "orders")
    counted = orders.agg(F.count(F.lit(1)).alias("table_rows")).first()["table_rows"]
    return c.describe_schema(orders).select("path", "type", F.lit(counted).alias("table_rows"))


@proof(records.expected_business_text())
def ndjson_contract_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Nested records through the 56-field all-string contract."""
    return records.landed(spark, folder)[0]


_TYPED = """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS c_name,
    CASE WHEN c_custkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal END AS c_acctbal,
    c_acctbal > 0 AS in_credit, c_mktsegment AS not_in_contract FROM customer"""


@proof(
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
              CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS c_name,
              CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_acctbal AS VARCHAR) END AS c_acctbal,
              CASE WHEN c_acctbal > 0 THEN 'True' ELSE 'False' END AS in_credit,
              CAST(NULL AS VARCHAR) AS not_in_source
       FROM customer"""
)
def stringify_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Typed rows as contract text; absent fields null, unknown ones dropped."""
    table(spark, folder, "customer").createOrReplaceTempView("customer")
    contract = c.strings("c_custkey", "c_name", "c_acctbal", "in_credit", "not_in_source")
    return c.conform(c.stringify(spark.sql(_TYPED)), contract)


def _varint_bytes(length: str) -> str:
    return f"(CASE WHEN {length} < 64 THEN 1 WHEN {length} < 8192 THEN 2 WHEN {length} < 1048576 THEN 3 ELSE 4 END)"


def _frame_bytes(*fields: str) -> str:
    each = (
        f"(CASE WHEN {f} IS NULL THEN 1 ELSE 1 + {_varint_bytes(f'octet_length(encode({f}))')} "
        f"+ octet_length(encode({f})) END)"
        for f in fields
    )
    return "5 + " + " + ".join(each)


@proof(
    f"""WITH rows AS (
          SELECT 'orders' AS topic, CAST(o_custkey AS VARCHAR) AS key,
                 {_frame_bytes("CAST(o_custkey AS VARCHAR)", "CAST(o_orderkey AS VARCHAR)", "o_orderstatus")} AS bytes
          FROM orders
          UNION ALL
          SELECT 'customers', CAST(c_custkey AS VARCHAR),
                 {_frame_bytes("CAST(c_custkey AS VARCHAR)", "nullif(c_mktsegment, 'BUILDING')")}
          FROM customer)
        SELECT topic, CAST(CAST('0x' || substr(md5(key), 1, 8) AS BIGINT) % 8 AS INTEGER) AS partition,
               count(*) AS frames, count(DISTINCT key) AS keys, CAST(sum(bytes) AS BIGINT) AS bytes
        FROM rows GROUP BY ALL"""
)
def topic_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Two topics keyed alike: equal keys land in equal partitions."""
    at = work_folder(spark, "topics")
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        "o_orderstatus",
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment"),
    )
    write_topic(to_frames(orders, "o_custkey", "orders", 1), at)
    write_topic(to_frames(customers, "c_custkey", "customers", 2), at)
    return (
        spark.read.parquet(at)
        .groupBy("topic", "partition")
        .agg(
            F.count(F.lit(1)).alias("frames"),
            F.count_distinct("key").alias("keys"),
            F.sum(F.octet_length("value")).alias("bytes"),
        )
    )


@proof(
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(lang, 'fr') AS lang, source, text FROM documents"""
)
def bronze_decode(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts through the wire format and back."""
    contract = c.strings("doc_id", "lang", "source", "text")
    rows = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.nullif(F.col("lang"), F.lit("fr")).alias("lang"),
        "source",
        "text",
    )
    return decode_frames(to_frames(rows, "doc_id", "documents", 7), contract)
