"""Predicates compiled from plain dictionaries: attribute filters and facet selections."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratica.sources.contracts import HOURS, WEEKDAYS

# How each filter field is compared (fixed values). "contains" is case-sensitive.
BUSINESS_FILTERS = {
    "name": "contains",
    "city": "string",
    "state": "string",
    "categories": "contains",
    "restaurants_price_range": "int",
    "noise_level": "string",
    "alcohol": "string",
    "wifi": "string",
    "outdoor_seating": "bool",
    "is_open": "bool",
    "business_stars": "float",
    "review_stars": "int",
}


@dataclass
class CompiledFilter:
    """A conjunction, or None when no usable condition was given, and the fields left out."""

    predicate: Column | None
    skipped: list[str] = field(default_factory=list)

    def apply(self, df: DataFrame) -> DataFrame:
        return df if self.predicate is None else df.where(self.predicate)


def _as_bool(value: Any) -> bool:
    if isinstance(value, bool):
        return value
    text = str(value).strip().lower()
    if text in ("true", "1"):
        return True
    if text in ("false", "0"):
        return False
    raise ValueError(f"not a boolean: {value!r}")


def _same_number(c: Column, value: float) -> Column:
    """Equality in the column's own precision: a FLOAT 4.3 is not the DOUBLE 4.3."""
    return F.when(F.typeof(c) == "float", c == F.lit(value).cast("float")).otherwise(c == F.lit(value))


_COMPARE = {
    "contains": lambda c, v: c.contains(str(v)),
    "string": lambda c, v: c == str(v),
    "int": lambda c, v: c == int(v),
    "float": lambda c, v: _same_number(c, float(v)),
    "bool": lambda c, v: c == _as_bool(v),
}


def compile_filter(filters: dict[str, Any], spec: dict[str, str] = BUSINESS_FILTERS) -> CompiledFilter:
    """AND of one comparison per field. Empty values mean "no condition"; fields that are unknown
    or whose value does not fit are skipped and named in the result."""
    conditions, skipped = [], []
    for name, value in filters.items():
        if value is None or (isinstance(value, str) and value == ""):
            continue
        try:
            conditions.append(_COMPARE[spec[name]](F.col(name), value))
        except (KeyError, ValueError, TypeError):
            skipped.append(name)
    return CompiledFilter(reduce(lambda a, b: a & b, conditions) if conditions else None, skipped)


@dataclass(frozen=True)
class Choice:
    """One selectable value: a comparison on a column. ``present`` tests for not null."""

    column: str
    kind: str
    value: Any = None

    def predicate(self) -> Column:
        if self.kind == "present":
            return F.col(self.column).isNotNull()
        return _COMPARE[self.kind](F.col(self.column), self.value)


@dataclass(frozen=True)
class FreeChoice:
    """A group whose values are open-ended and all compare with one column."""

    column: str
    kind: str

    def choice(self, value: Any) -> Choice:
        return Choice(self.column, self.kind, value)


# Selectable labels per group and what they mean (fixed values).
BUSINESS_FACETS: dict[str, FreeChoice | dict[str, Choice]] = {
    "cities": FreeChoice("city", "string"),
    "categories": FreeChoice("categories", "contains"),
    "ambiance": {
        "Full Bar": Choice("alcohol", "string", "full_bar"),
        "Beer & Wine": Choice("alcohol", "string", "beer_and_wine"),
        "Quiet": Choice("noise_level", "string", "quiet"),
        "Loud": Choice("noise_level", "string", "loud"),
        "Free WiFi": Choice("wifi", "string", "free"),
        "No Smoking": Choice("smoking", "string", "no"),
    },
    "price": {"$" * n: Choice("restaurants_price_range", "int", n) for n in (1, 2, 3, 4)},
    "amenities": {
        "Outdoor Seating": Choice("outdoor_seating", "bool", True),
        "Delivery": Choice("restaurants_delivery", "bool", True),
        "Good for Kids": Choice("good_for_kids", "bool", True),
        "Reservations": Choice("restaurants_reservations", "bool", True),
        "Good for Groups": Choice("restaurants_good_for_groups", "bool", True),
        "Dogs Allowed": Choice("dogs_allowed", "bool", True),
    },
    "parking": {
        "Garage": Choice("parking_garage", "bool", True),
        "Street": Choice("parking_street", "bool", True),
        "Validated": Choice("parking_validated", "bool", True),
        "Lot": Choice("parking_lot", "bool", True),
        "Valet": Choice("parking_valet", "bool", True),
    },
    "music": {
        "DJ": Choice("music_dj", "bool", True),
        "Background": Choice("music_background", "bool", True),
        "No Music": Choice("music_no_music", "bool", True),
        "Jukebox": Choice("music_jukebox", "bool", True),
        "Live": Choice("music_live", "bool", True),
        "Video": Choice("music_video", "bool", True),
        "Karaoke": Choice("music_karaoke", "bool", True),
    },
    "hours": {day: Choice(HOURS[day], "present") for day in WEEKDAYS},
    "more": {
        "Bike Parking": Choice("bike_parking", "bool", True),
        "Credit Cards": Choice("business_accepts_credit_cards", "bool", True),
        "Bitcoin": Choice("business_accepts_bitcoin", "bool", True),
        "Drive Thru": Choice("drive_thru", "bool", True),
        "Has TV": Choice("has_tv", "bool", True),
        "Table Service": Choice("restaurants_table_service", "bool", True),
        "Take Out": Choice("restaurants_take_out", "bool", True),
        "Wheelchair Accessible": Choice("wheelchair_accessible", "bool", True),
        "Open 24 Hours": Choice("open_24_hours", "bool", True),
        "By Appointment Only": Choice("by_appointment_only", "bool", True),
        "BYOB": Choice("byob", "bool", True),
    },
}


def facet_predicate(
    selections: dict[str, list], facets: dict[str, FreeChoice | dict[str, Choice]] = BUSINESS_FACETS
) -> Column | None:
    """OR among the choices of one column, AND across columns and groups."""
    by_column: dict[tuple[str, str], list[Column]] = {}
    for group, values in selections.items():
        facet = facets[group]
        for value in values:
            choice = facet.choice(value) if isinstance(facet, FreeChoice) else facet[value]
            by_column.setdefault((group, choice.column), []).append(choice.predicate())
    alternatives = [reduce(lambda a, b: a | b, options) for options in by_column.values()]
    return reduce(lambda a, b: a & b, alternatives) if alternatives else None


def facet_filter(
    df: DataFrame,
    selections: dict[str, list],
    facets: dict[str, FreeChoice | dict[str, Choice]] = BUSINESS_FACETS,
) -> DataFrame:
    predicate = facet_predicate(selections, facets)
    return df if predicate is None else df.where(predicate)
