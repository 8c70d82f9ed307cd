"""Raw text to typed values. Every function maps a string Column to a Column and never raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that stands for "nothing" in the source records (fixed values).
NONE_TEXT = "None"
CLOSED_HOURS = "0:0-0:0"

# Digits with an optional fraction, between characters the cast trims (<= U+0020).
_NUMBER = r"^[\x00-\x20]*([+-]?[0-9]*)(\.?)[0-9]*[\x00-\x20]*$"
_BARE_SIGN = r"^[+-]?$"


def bool_text(c: Column) -> Column:
    """``True``/``False`` spelled exactly so; anything else is null."""
    return F.when(c == "True", F.lit(True)).when(c == "False", F.lit(False))


def flag_text(c: Column) -> Column:
    """``1``/``0``; anything else is null."""
    return F.when(c == "1", F.lit(True)).when(c == "0", F.lit(False))


def lenient_int(c: Column) -> Column:
    """Integer part of a plain decimal number; null for other text and on overflow.

    The same result as a cast with ANSI mode off, whatever the session's mode.
    """
    whole = F.regexp_extract(c, _NUMBER, 1)
    fraction_only = F.regexp_extract(c, _NUMBER, 2) == "."
    return F.when(
        c.rlike(_NUMBER),
        F.when(whole.rlike(_BARE_SIGN), F.when(fraction_only, F.lit(0))).otherwise(
            whole.try_cast("int")
        ),
    )


def lenient_float(c: Column) -> Column:
    return c.try_cast("float")


def sentinel_null(c: Column, sentinel: str) -> Column:
    return F.nullif(c, F.lit(sentinel))


def sentinel_int(c: Column) -> Column:
    return lenient_int(sentinel_null(c, NONE_TEXT))


def open_hours(c: Column) -> Column:
    """Opening hours of one day, null on a closed day."""
    return sentinel_null(c, CLOSED_HOURS)


def timestamp_or_null(c: Column) -> Column:
    return c.try_cast("timestamp")


def blank_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def decimal_float_text(c: Column) -> Column:
    """A double spelled in shortest decimal form: ``4.5``, ``12345678.9``, ``1e+16``, ``5e-05``."""
    size = F.abs(c)
    spelled = c.cast("string")
    # some JVMs spell a few doubles with more digits than they need
    fifteen = F.format_string("%.14e", c)
    digits = F.when((F.length(spelled) > 17) & (fifteen.try_cast("double") == c), fifteen).otherwise(spelled)
    plain = F.regexp_replace(
        digits.try_cast("decimal(38,20)").cast("string"), r"(\.[0-9]+?)0+$", "$1"
    )
    exponent = F.regexp_extract(digits, r"[eE][+-]?0*([0-9]+)$", 1)
    scientific = F.concat(
        F.regexp_extract(digits, r"^(-?[0-9]+(?:\.[0-9]*[1-9])?)", 1),
        F.when(digits.rlike("[eE]-"), F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.length(exponent) < 2, F.lpad(exponent, 2, "0")).otherwise(exponent),
    )
    return (
        F.when(c == 0, F.when(c.cast("string") == "-0.0", F.lit("-0.0")).otherwise(F.lit("0.0")))
        .when((size >= 1e-4) & (size < 1e16), plain)
        .when(size == float("inf"), F.when(c > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .otherwise(scientific)
    )


def as_text(c: Column, dtype: T.DataType) -> Column:
    """One typed value as contract text: null, blank and NaN become null."""
    if isinstance(dtype, T.StringType):
        return blank_null(c)
    if isinstance(dtype, T.BooleanType):
        return F.initcap(c.cast("string"))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), decimal_float_text(c.cast("double")))
    return c.cast("string")
