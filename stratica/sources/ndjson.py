"""Newline-delimited JSON scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratica.sources.contracts import conform, leaves


def infer_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """Scan with a schema inferred from every record; nested structs are kept."""
    return spark.read.option("samplingRatio", "1.0").json(path)


def _as_booleans(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField(f.name, _as_booleans(f.dataType) if isinstance(f.dataType, T.StructType) else T.BooleanType())
            for f in schema
        ]
    )


_BROKEN = "_broken_line"


def _text_reading(line: str, nested: T.StructType) -> Column:
    """The record as text; a line that is no JSON object stands whole in the field ``_BROKEN``."""
    with_rest = T.StructType([*nested.fields, T.StructField(_BROKEN, T.StringType())])
    return F.from_json(line, with_rest, {"columnNameOfCorruptRecord": _BROKEN})


def malformed(lines: DataFrame, nested: T.StructType, line: str = "value") -> DataFrame:
    """The lines that are no JSON object of the given layout, to be set aside."""
    return lines.where(~_is_object(line) | _text_reading(line, nested)[_BROKEN].isNotNull())


def _is_object(line: str) -> Column:
    return F.col(line).rlike(r"^\s*\{")


def parse_records(lines: DataFrame, nested: T.StructType, line: str = "value", fail: bool = True) -> DataFrame:
    """Flat all-string columns of JSON records with the given nested layout.

    Numbers keep the text they were written with. JSON booleans are spelled ``True``/``False``;
    a second, boolean-typed reading tells them from the strings "true"/"false", and is made of
    records that hold a bare ``true`` or ``false`` only. Each reading is one column of an inner projection,
    so a record is not parsed once per field.

    A line that is no JSON object fails the job; with ``fail=False`` it is left out, for
    :func:`malformed` to give.
    """
    bare = F.col(line).rlike(r"[:\[,]\s*(true|false)\b")
    parsed = lines.select(
        line, _text_reading(line, nested).alias("text"), F.when(bare, F.from_json(line, _as_booleans(nested))).alias("flag")
    )
    broken = ~_is_object(line) | F.col(f"text.{_BROKEN}").isNotNull()
    stop = F.raise_error(F.concat(F.lit("malformed record: "), F.left(F.col(line), F.lit(200)))).cast("boolean")
    parsed = parsed.where(F.when(broken, stop if fail else F.lit(False)).otherwise(True))
    columns = []
    for name, _, _ in leaves(nested):
        path = ".".join(f"`{step}`" for step in leaf_path(name, nested))
        text, flag = F.col(f"text.{path}"), F.col(f"flag.{path}")
        columns.append(F.coalesce(F.initcap(flag.cast("string")), F.nullif(text, F.lit(""))).alias(name))
    return parsed.select(columns)


def leaf_path(flat: str, nested: T.StructType, sep: str = "_") -> list[str]:
    """Field names leading to the leaf of this flat name."""
    for f in nested.fields:
        if f.name == flat:
            return [f.name]
        if isinstance(f.dataType, T.StructType) and flat.startswith(f.name + sep):
            rest = leaf_path(flat[len(f.name + sep):], f.dataType, sep)
            if rest:
                return [f.name, *rest]
    return []


def first_rows(rows: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows in the order of the scan, each split keeping its share.

    The rows are scanned twice, once to be counted per split; only the counts, a row per split, are brought together.
    """
    split, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    counts = placed.groupBy(split.alias("_split")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    shares = counts.select("_split", (F.lit(limit) - before).alias("_share")).where("_share > 0")
    kept = placed.withColumn("_split", split).join(F.broadcast(shares), "_split").where(place < F.col("_share"))
    return kept.select(*[F.col(f"`{c}`") for c in rows.columns])


def read_ndjson(
    spark: SparkSession,
    path: str,
    nested: T.StructType,
    contract: T.StructType | None = None,
    limit: int = 0,
    partitions: int | None = None,
    fail: bool = True,
) -> DataFrame:
    """Records as flat contract rows, all strings. ``limit`` 0 reads everything.

    A limit is shared out to the file splits (see :func:`first_rows`); ``partitions`` deals lines out before they are parsed.
    Malformed records fail the job, or are left out with ``fail=False`` (see :func:`malformed`).

    A missing path fails when the job is planned. Which rows a limit keeps follows file order,
    as it does in the source; order by a key first where that has to be repeatable.
    """
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    if limit:
        lines = first_rows(lines, limit)
    if partitions:
        lines = lines.repartition(partitions)
    records = parse_records(lines, nested, fail=fail)
    return conform(records, contract) if contract else records


def write_ndjson(df: DataFrame, path: str) -> None:
    """Rows as one JSON object per line."""
    df.write.mode("overwrite").json(path)
