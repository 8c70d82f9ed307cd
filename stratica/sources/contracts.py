"""All-string contracts of the raw layer and the typed layout of the layers above it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratica.functions.clean import as_text


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# --- Field names of the two record types (fixed values) ---------------------------------------

BUSINESS_FIELDS = (
    "business_id name address city state postal_code latitude longitude stars review_count "
    "is_open categories"
).split()

ATTRIBUTES = (
    "AcceptsInsurance Alcohol Ambience BYOB BYOBCorkage BestNights BikeParking "
    "BusinessAcceptsBitcoin BusinessAcceptsCreditCards BusinessParking ByAppointmentOnly Caters "
    "CoatCheck Corkage DogsAllowed DriveThru GoodForDancing GoodForKids GoodForMeal "
    "HairSpecializesIn HappyHour HasTV Music NoiseLevel Open24Hours OutdoorSeating "
    "RestaurantsAttire RestaurantsCounterService RestaurantsDelivery RestaurantsGoodForGroups "
    "RestaurantsPriceRange2 RestaurantsReservations RestaurantsTableService RestaurantsTakeOut "
    "Smoking WheelchairAccessible WiFi"
).split()

WEEKDAYS = "Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split()

REVIEW_FIELDS = "review_id user_id business_id stars useful funny cool text date".split()

# Raw attribute -> typed column (fixed values).
FLAG_ATTRIBUTES = {
    "BikeParking": "bike_parking",
    "BusinessAcceptsBitcoin": "business_accepts_bitcoin",
    "BusinessAcceptsCreditCards": "business_accepts_credit_cards",
    "ByAppointmentOnly": "by_appointment_only",
    "BYOB": "byob",
    "Caters": "caters",
    "DogsAllowed": "dogs_allowed",
    "DriveThru": "drive_thru",
    "GoodForDancing": "good_for_dancing",
    "GoodForKids": "good_for_kids",
    "HappyHour": "happy_hour",
    "HasTV": "has_tv",
    "Open24Hours": "open_24_hours",
    "OutdoorSeating": "outdoor_seating",
    "RestaurantsDelivery": "restaurants_delivery",
    "RestaurantsGoodForGroups": "restaurants_good_for_groups",
    "RestaurantsReservations": "restaurants_reservations",
    "RestaurantsTableService": "restaurants_table_service",
    "RestaurantsTakeOut": "restaurants_take_out",
    "WheelchairAccessible": "wheelchair_accessible",
}
PARKING_KEYS = {k: f"parking_{k}" for k in ("garage", "street", "validated", "lot", "valet")}
MUSIC_KEYS = {
    "dj": "music_dj",
    "background_music": "music_background",
    "no_music": "music_no_music",
    "jukebox": "music_jukebox",
    "live": "music_live",
    "video": "music_video",
    "karaoke": "music_karaoke",
}
TEXT_ATTRIBUTES = {
    "Alcohol": "alcohol",
    "NoiseLevel": "noise_level",
    "RestaurantsAttire": "restaurants_attire",
    "Smoking": "smoking",
    "WiFi": "wifi",
}
PRICE_ATTRIBUTE = {"RestaurantsPriceRange2": "restaurants_price_range"}
HOURS = {day: f"hours_{day.lower()}" for day in WEEKDAYS}

# Fields carried beside a vector and the fields its text is built from (fixed values).
EMBEDDED_FIELDS = ["name", "categories", "text"]
PAYLOAD_FIELDS = (
    "review_id business_id name city state categories business_stars review_stars review_count "
    "is_open alcohol noise_level wifi outdoor_seating restaurants_price_range text date"
).split()

# Columns every layer adds.
STAMP, STAMP_DATE = "ingestion_timestamp", "ingestion_date"

BUSINESS = strings(
    *BUSINESS_FIELDS, *[f"attributes_{a}" for a in ATTRIBUTES], *[f"hours_{d}" for d in WEEKDAYS]
)
REVIEW = strings(*REVIEW_FIELDS)

# The same business record as it is nested in the source file.
BUSINESS_NESTED = T.StructType(
    [T.StructField(n, T.StringType()) for n in BUSINESS_FIELDS]
    + [T.StructField("attributes", strings(*ATTRIBUTES)), T.StructField("hours", strings(*WEEKDAYS))]
)


def with_stamps(contract: T.StructType) -> T.StructType:
    return T.StructType(contract.fields + strings(STAMP, STAMP_DATE).fields)


def typed_layout() -> T.StructType:
    """Columns of the typed, joined table; the two partition columns come last."""

    def fields(dtype: T.DataType, *names: str) -> list[T.StructField]:
        return [T.StructField(n, dtype) for n in names]

    text, flag, whole = T.StringType(), T.BooleanType(), T.IntegerType()
    return T.StructType(
        fields(text, "business_id", "name", "address", "city", "postal_code")
        + fields(T.FloatType(), "business_stars")
        + fields(whole, "review_count")
        + fields(flag, "is_open")
        + fields(text, "categories")
        + fields(flag, *FLAG_ATTRIBUTES.values(), *PARKING_KEYS.values(), *MUSIC_KEYS.values())
        + fields(text, *TEXT_ATTRIBUTES.values())
        + fields(whole, *PRICE_ATTRIBUTE.values())
        + fields(text, *HOURS.values(), "review_id", "user_id")
        + fields(whole, "review_stars", "useful", "funny", "cool")
        + fields(text, "text")
        + fields(T.TimestampType(), "date", STAMP)
        + fields(text, "state")
        + fields(T.DateType(), STAMP_DATE)
    )


def quarantine_layout(raw: T.StructType = REVIEW) -> T.StructType:
    return T.StructType(
        raw.fields
        + [
            T.StructField("reason", T.StringType()),
            T.StructField("quarantine_timestamp", T.TimestampType()),
            T.StructField(STAMP_DATE, T.StringType()),
        ]
    )


def leaves(schema: T.StructType, sep: str = "_", _path: tuple[str, ...] = ()) -> list[tuple[str, Column, T.DataType]]:
    """``(flat name, column, type)`` of every leaf of a nested schema; arrays are leaves."""
    found = []
    for field in schema.fields:
        path = (*_path, field.name)
        if isinstance(field.dataType, T.StructType):
            found += leaves(field.dataType, sep, path)
        else:
            column = F.col(".".join(f"`{p}`" for p in path))
            found.append((sep.join(path), column, field.dataType))
    return found


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested structs as top-level columns named by their joined path."""
    return df.select([column.alias(name) for name, column, _ in leaves(df.schema, sep)])


def stringify(df: DataFrame) -> DataFrame:
    """Every column as contract text; null, blank and NaN become null."""
    return df.select([as_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Exactly the contract's columns: a missing one is null, an unknown one is dropped."""
    present = set(df.columns)
    return df.select(
        [
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in contract
        ]
    )


def backward_compatible(old: T.StructType, new: T.StructType) -> bool:
    """Can readers of ``new`` read rows written with ``old``?

    Dropped fields are ignored, added ones must accept null, shared ones keep their type.
    """
    written = {f.name: f.dataType for f in old}
    return all(f.dataType == written[f.name] if f.name in written else f.nullable for f in new)


def describe_schema(df: DataFrame) -> DataFrame:
    """The schema tree as rows ``(path, type, nullable)``, containers included."""

    def walk(schema: T.StructType, prefix: str):
        for f in schema.fields:
            yield f"{prefix}{f.name}", f.dataType.simpleString(), f.nullable
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, f"{prefix}{f.name}.")

    return df.sparkSession.createDataFrame(
        list(walk(df.schema, "")), "path string, type string, nullable boolean"
    )
