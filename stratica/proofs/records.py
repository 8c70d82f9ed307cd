"""Business and review records composed from the given tables.

Every customer becomes a business and every order a review, one row each. Messy attribute text is
a function of the key, so the clean value each text stands for is known. The raw text is written
in SQL both engines understand; ``expected_*`` states the clean values for the comparison only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratica.proofs.registry import table, views
from stratica.sources import contracts as c
from stratica.sources.ndjson import read_ndjson, write_ndjson
from stratica.session import work_folder

BUSINESS_AT = "2024-01-01 06:00:00"
REVIEW_AT = "2024-01-02 18:30:00"

# Raw text and the value it stands for, by remainder of the key.
_FLAG = [("'True'", "true"), ("'False'", "false"), ("'None'", "NULL"), ("NULL", "NULL")]
_PARKING_TEXT = [
    "'{''garage'': False, ''street'': True, ''validated'': False, ''lot'': False, ''valet'': False}'",
    "'{u''valet'': False, u''garage'': None, u''street'': None, u''lot'': None, u''validated'': False}'",
    "'None'",
    "'{}'",
    "'garage: yes'",
]
_PARKING_VALUE = {
    "garage": ["false", "NULL"],
    "street": ["true", "NULL"],
    "validated": ["false", "false"],
    "lot": ["false", "NULL"],
    "valet": ["false", "false"],
}
_MUSIC_TEXT = [
    "'{''dj'': False}'",
    "'{u''dj'': True, ''background_music'': False, ''no_music'': False, ''jukebox'': True, "
    "''live'': True, ''video'': None, u''karaoke'': False}'",
    "NULL",
    "'None'",
]
_MUSIC_VALUE = {
    "dj": ["false", "true"],
    "background_music": ["NULL", "false"],
    "no_music": ["NULL", "false"],
    "jukebox": ["NULL", "true"],
    "live": ["NULL", "true"],
    "video": ["NULL", "NULL"],
    "karaoke": ["NULL", "false"],
}
_WORDS = {
    "Alcohol": ["full_bar", "beer_and_wine", "none"],
    "NoiseLevel": ["quiet", "average", "loud"],
    "RestaurantsAttire": ["casual", "dressy", "formal"],
    "Smoking": ["no", "outdoor", "yes"],
    "WiFi": ["free", "no", "paid"],
}
_PRICE = [("'1'", "1"), ("'2'", "2"), ("'3'", "3"), ("'4'", "4"), ("'None'", "NULL"), ("NULL", "NULL")]
_HOURS = [("'0:0-0:0'", "NULL"), ("'11:0-21:0'", "'11:0-21:0'"), ("NULL", "NULL")]


def _case(remainder: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values) if v != "NULL")
    return f"CASE {remainder} {arms} END" if arms else "NULL"


def _word_texts(words: list[str]) -> list[str]:
    a, b, d = words
    return [f"'u''{a}'''", f"'''{b}'''", "'None'", "'bareword'", f"'\"{d}\"'", "NULL"]


def _word_values(words: list[str]) -> list[str]:
    a, b, d = words
    return [f"'{a}'", f"'{b}'", "NULL", "NULL", f"'{d}'", "NULL"]


def _attribute_text() -> dict[str, str]:
    texts = {a: "NULL" for a in c.ATTRIBUTES}
    for i, a in enumerate(c.FLAG_ATTRIBUTES):
        texts[a] = _case(f"(c_custkey + {i}) % 4", [raw for raw, _ in _FLAG])
    texts["BusinessParking"] = _case("c_custkey % 5", _PARKING_TEXT)
    texts["Music"] = _case("c_custkey % 4", _MUSIC_TEXT)
    for i, (a, words) in enumerate(_WORDS.items()):
        texts[a] = _case(f"(c_custkey + {i}) % 6", _word_texts(words))
    texts["RestaurantsPriceRange2"] = _case("c_custkey % 6", [raw for raw, _ in _PRICE])
    return {a: f"CAST({text} AS STRING)" for a, text in texts.items()}


def _hours_text() -> dict[str, str]:
    return {d: _case(f"(c_custkey + {i + 2}) % 3", [raw for raw, _ in _HOURS]) for i, d in enumerate(c.WEEKDAYS)}


def _named_struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in fields.items()) + ")"


# Flat columns; numbers are numbers, as they are in the source files.
_BUSINESS_COLUMNS = {
    "business_id": "CAST(c_custkey AS STRING)",
    "name": "c_name",
    "address": "CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat('Street ', CAST(c_custkey % 100 AS STRING)) END",
    "city": "n_name",
    "state": "r_name",
    "postal_code": "CAST(10000 + c_custkey % 90000 AS STRING)",
    "latitude": "c_acctbal",
    "longitude": "0 - c_acctbal",
    "stars": "CAST(2 + c_custkey % 9 AS DOUBLE) / 2",
    "review_count": "c_custkey % 1000",
    "is_open": "CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END",
    "categories": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE concat('Shops, ', c_mktsegment) END",
}
_BUSINESS_FROM = (
    "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)
_REVIEW_COLUMNS = {
    "review_id": "CAST(o_orderkey AS STRING)",
    "user_id": "concat('u', CAST(o_custkey % 97 AS STRING))",
    "business_id": "CAST(o_custkey AS STRING)",
    "stars": "CAST(1 + o_orderkey % 5 AS DOUBLE)",
    "useful": "o_orderkey % 7",
    "funny": "o_orderkey % 3",
    "cool": "o_orderkey % 2",
    "text": "concat(o_orderpriority, ' order in state ', o_orderstatus)",
    "date": "CAST(o_orderdate AS STRING)",
}


def business_source(spark: SparkSession, folder: str) -> DataFrame:
    """Nested business records, as the source file holds them.

    Customers are dealt out first: a small file comes as one piece, and its records would be composed, parsed and cleaned in one task.
    """
    views(spark, folder, "nation", "region")
    dealt = table(spark, folder, "customer").repartition(spark.sparkContext.defaultParallelism)
    dealt.createOrReplaceTempView("customer")
    flat = ", ".join(f"{e} AS {n}" for n, e in _BUSINESS_COLUMNS.items())
    return spark.sql(
        f"SELECT {flat}, {_named_struct(_attribute_text())} AS attributes, "
        f"{_named_struct(_hours_text())} AS hours FROM {_BUSINESS_FROM}"
    )


def review_source(spark: SparkSession, folder: str) -> DataFrame:
    views(spark, folder, "orders")
    return spark.sql("SELECT " + ", ".join(f"{e} AS {n}" for n, e in _REVIEW_COLUMNS.items()) + " FROM orders")


def landed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both record types written as NDJSON and scanned back through their contracts."""
    at = work_folder(spark, "ndjson")
    write_ndjson(business_source(spark, folder), f"{at}/businesses")
    write_ndjson(review_source(spark, folder), f"{at}/reviews")
    return (
        read_ndjson(spark, f"{at}/businesses", c.BUSINESS_NESTED, c.BUSINESS),
        read_ndjson(spark, f"{at}/reviews", c.REVIEW, c.REVIEW),
    )


def _raw(source: DataFrame, contract: T.StructType, at: str) -> DataFrame:
    rows = c.conform(c.stringify(c.flatten(source)), contract)
    return rows.select("*", F.lit(at).alias(c.STAMP), F.lit(at[:10]).alias(c.STAMP_DATE))


def raw_businesses(spark: SparkSession, folder: str) -> DataFrame:
    """Raw business rows with a fixed stamp."""
    return _raw(business_source(spark, folder), c.BUSINESS, BUSINESS_AT)


def raw_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(review_source(spark, folder), c.REVIEW, REVIEW_AT)


def raw_layer(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return raw_businesses(spark, folder), raw_reviews(spark, folder)


# --- What the comparison SQL expects -----------------------------------------------------------


def expected_business_text() -> str:
    """The 56 contract columns as text."""
    columns = dict(_BUSINESS_COLUMNS)
    columns["address"] = f"nullif({columns['address']}, '')"
    columns |= {f"attributes_{a}": t for a, t in _attribute_text().items()}
    columns |= {f"hours_{d}": t for d, t in _hours_text().items()}
    body = ", ".join(f"CAST({e} AS VARCHAR) AS {n}" for n, e in columns.items())
    return f"SELECT {body} FROM {_BUSINESS_FROM}"


def expected_businesses() -> str:
    """The typed business columns, and the key to join on."""
    values = {
        "business_id": "CAST(c_custkey AS VARCHAR)",
        "name": "c_name",
        "address": f"nullif({_BUSINESS_COLUMNS['address']}, '')",
        "city": "n_name",
        "state": "r_name",
        "postal_code": _BUSINESS_COLUMNS["postal_code"],
        "business_stars": "CAST((2 + c_custkey % 9) / 2.0 AS FLOAT)",
        "review_count": "CAST(c_custkey % 1000 AS INTEGER)",
        "is_open": "c_custkey % 3 <> 0",
        "categories": _BUSINESS_COLUMNS["categories"],
    }
    for i, name in enumerate(c.FLAG_ATTRIBUTES.values()):
        values[name] = f"CAST({_case(f'(c_custkey + {i}) % 4', [v for _, v in _FLAG])} AS BOOLEAN)"
    for key, name in c.PARKING_KEYS.items():
        values[name] = f"CAST({_case('c_custkey % 5', _PARKING_VALUE[key])} AS BOOLEAN)"
    for key, name in c.MUSIC_KEYS.items():
        values[name] = f"CAST({_case('c_custkey % 4', _MUSIC_VALUE[key])} AS BOOLEAN)"
    for i, (a, words) in enumerate(_WORDS.items()):
        values[c.TEXT_ATTRIBUTES[a]] = _case(f"(c_custkey + {i}) % 6", _word_values(words))
    values["restaurants_price_range"] = f"CAST({_case('c_custkey % 6', [v for _, v in _PRICE])} AS INTEGER)"
    for i, d in enumerate(c.WEEKDAYS):
        values[c.HOURS[d]] = _case(f"(c_custkey + {i + 2}) % 3", [v for _, v in _HOURS])
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in values.items()) + f" FROM {_BUSINESS_FROM}"


def expected_reviews() -> str:
    return (
        "SELECT CAST(o_custkey AS VARCHAR) AS business_id, CAST(o_orderkey AS VARCHAR) AS review_id, "
        "'u' || CAST(o_custkey % 97 AS VARCHAR) AS user_id, CAST(1 + o_orderkey % 5 AS INTEGER) AS review_stars, "
        "CAST(o_orderkey % 7 AS INTEGER) AS useful, CAST(o_orderkey % 3 AS INTEGER) AS funny, "
        "CAST(o_orderkey % 2 AS INTEGER) AS cool, o_orderpriority || ' order in state ' || o_orderstatus AS text, "
        "o_orderdate AS date FROM orders"
    )


def expected_silver(business_where: str = "true") -> str:
    return (
        f"WITH b AS ({expected_businesses()}), r AS ({expected_reviews()}) "
        f"SELECT b.*, r.* EXCLUDE (business_id), TIMESTAMP '{REVIEW_AT}' AS ingestion_timestamp, "
        f"DATE '{REVIEW_AT[:10]}' AS ingestion_date FROM b JOIN r ON b.business_id = r.business_id "
        f"WHERE {business_where}"
    )
