"""Layer tables: provisioning, scans, appends, views and reset."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratica.operators.dedup import latest_by
from stratica.sources import contracts

MAX_FILES_PER_TRIGGER = 5

# Tables of each layer and their partition columns.
LAYERS: dict[str, dict[str, tuple[T.StructType, list[str]]]] = {
    "bronze": {
        "businesses": (contracts.with_stamps(contracts.BUSINESS), ["ingestion_date"]),
        "reviews": (contracts.with_stamps(contracts.REVIEW), ["ingestion_date"]),
    },
    "silver": {
        "reviews": (contracts.typed_layout(), ["state", "ingestion_date"]),
        "quarantine": (contracts.quarantine_layout(), ["ingestion_date"]),
    },
    "gold": {},
}


def table_ddl(table: str, schema: T.StructType, partitions: list[str]) -> str:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{by}"


def provision(
    spark: SparkSession,
    prefix: str = "",
    location: str | None = None,
    layers: dict[str, dict[str, tuple[T.StructType, list[str]]]] = LAYERS,
) -> list[str]:
    """Create the layers' databases and tables where missing; returns the table names."""
    names = []
    for layer, tables in layers.items():
        database = f"{prefix}{layer}"
        at = f" LOCATION '{location}/{database}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")
        for name, (schema, partitions) in tables.items():
            spark.sql(table_ddl(f"{database}.{name}", schema, partitions))
            names.append(f"{database}.{name}")
    return names


def reset(spark: SparkSession, *layers: str, prefix: str = "") -> None:
    """Drop layers with everything in them. Queries restart from a :func:`fresh_checkpoint`."""
    for layer in layers:
        spark.sql(f"DROP DATABASE IF EXISTS {prefix}{layer} CASCADE")


def reset_sink(spark: SparkSession, table: str) -> None:
    """Drop a sink's dedup view and table."""
    spark.sql(f"DROP VIEW IF EXISTS {table}_deduped")
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def fresh_checkpoint(root: str, query: str) -> str:
    return f"{root.rstrip('/')}/{query}-{uuid.uuid4().hex}"


def append_by_position(df: DataFrame, table: str) -> None:
    """Append in the table's column order, partition columns last."""
    df.write.mode("append").insertInto(table)


def append_by_name(df: DataFrame, table: str) -> None:
    """Append matching columns by name whatever their order."""
    df.select(df.sparkSession.table(table).columns).write.mode("append").insertInto(table)


def read_table_stream(
    spark: SparkSession, table: str, max_files: int = MAX_FILES_PER_TRIGGER
) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", max_files).table(table)


def read_folder_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int = MAX_FILES_PER_TRIGGER
) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def analytics_view(df: DataFrame, name: str, key: str | list[str], order: list, total: bool = False) -> DataFrame:
    """Register the latest row of each key as the only relation SQL questions see.

    Ties of the order fall to a hash of the row. Where the order is known to be ``total`` (up to identical copies),
    questions read only the key, the order and the columns they name.
    """
    view = latest_by(df, key, order, total=total)
    view.createOrReplaceTempView(name)
    return view


def ensure_dedup_view(
    spark: SparkSession, table: str, key: str, order: str = "ingestion_timestamp DESC"
) -> bool:
    """Create ``<table>_deduped`` over a table; False when the table does not exist yet.

    Ties of the order fall to a hash of the row, so the view does not change from one reading to the next.
    """
    if not spark.catalog.tableExists(table):
        return False
    ties = ", ".join(f"`{c}`" for c in spark.table(table).columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {table}_deduped AS SELECT * EXCEPT (_row) FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}, xxhash64({ties}) DESC) AS _row FROM {table}) WHERE _row = 1"
    )
    return True


def guarded(df: DataFrame, order: list, limit: int = 50) -> DataFrame:
    """The result-size guard of ad-hoc questions: 50 rows, 200 when ids feed a hybrid search."""
    return df.orderBy(*order).limit(limit)


def folder_bytes(df: DataFrame) -> DataFrame:
    """Bytes of the files behind a file-based frame; reads no data columns."""
    files = df.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    ).distinct()
    return files.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
