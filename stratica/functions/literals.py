"""Native parsing of the literal syntax found inside text attributes.

The source writes values such as ``{'garage': False, u'street': True}`` or ``u'full_bar'``.
Both are read with JVM regular expressions, so cleaning stays inside one codegen stage.
Containers may nest to any depth. Every escape of the syntax is read but character names (``\\N{...}``); those, cut-off
ones and halves of a surrogate pair give null and show up in :func:`unparsed`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratica.functions.clean import NONE_TEXT, decimal_float_text

_SINGLE = r"'[^'\\\n]*(?:\\[\s\S][^'\\\n]*)*'"
_DOUBLE = r'"[^"\\\n]*(?:\\[\s\S][^"\\\n]*)*"'
_TEXT = rf"[uU]?(?:{_SINGLE}|{_DOUBLE})"
_FLOAT = r"[+-]?(?:[0-9]+\.[0-9]*|\.[0-9]+)"
_INT = r"[+-]?(?:0+|[1-9][0-9]*)"
_NUMBER = rf"(?:{_FLOAT}(?:[eE][+-]?[0-9]+)?|{_INT})"
_ATOM = rf"(?:{_TEXT}|{_NUMBER}|True|False|None)"


def _sequence(item: str, opening: str, closing: str) -> str:
    return rf"{opening}\s*(?:{item}(?:\s*,\s*{item})*\s*,?\s*)?{closing}"


_ATOM_PAIR = rf"{_ATOM}\s*:\s*{_ATOM}"
_VALUE = (
    rf"(?:{_ATOM}|{_sequence(_ATOM, '[(]', '[)]')}|"
    rf"{_sequence(_ATOM, '[\\[]', '[\\]]')}|{_sequence(_ATOM_PAIR, '[{]', '[}]')})"
)
# A container without containers in it. Replaced by a mark, level by level, it lets deeper dicts be read; a mark
# may stand for a value or an item but not for a key.
_MARK = "\x01"
_ITEM = rf"(?:{_ATOM}|{_MARK})"
_INNERMOST = "|".join(
    (_sequence(_ITEM, "[(]", "[)]"), _sequence(_ITEM, r"[\[]", r"[\]]"), _sequence(_ITEM, "[{]", "[}]"),
     _sequence(rf"{_ATOM}\s*:\s*{_ITEM}", "[{]", "[}]"))
)
_PAIR = rf"({_ATOM})\s*:\s*({_VALUE})"
_DICT = rf"^[ \t]*{_sequence(rf'{_ATOM}\s*:\s*{_VALUE}', '[{]', '[}]')}\s*$"

_QUOTED = rf"^[ \t]*[uU]?({_SINGLE}|{_DOUBLE})\s*$"
# The one-letter escapes.
_ESCAPES = {"'": "'", '"': '"', "\\": "\\", "\n": "", "a": "\x07", "b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}
_TOKEN = r"\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\[0-7]{1,3}|\\[\s\S]|[^\\]+"


def _unescaped(body: Column) -> Column:
    """The text behind the escapes, by tokens of the literal; null where one stands for no character.

    A backslash before any other letter stands for itself, as in the syntax.
    """
    letters = F.create_map(*[F.lit(v) for pair in _ESCAPES.items() for v in pair])

    def character(number: Column) -> Column:
        whole = F.lpad(F.hex(number), 8, "0")
        fits = (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        return F.when(fits, F.decode(F.unhex(whole), "UTF-32"))

    def read(token: Column) -> Column:
        rest, letter = F.substring(token, 3, 8), F.substring(token, 2, 1)
        return (
            F.when(~token.startswith("\\"), token)
            .when(token.rlike(r"^\\[0-7]"), character(F.conv(F.substring(token, 2, 3), 8, 10).cast("long")))
            .when(letter.isin("x", "u", "U") & (F.length(token) > 2), character(F.conv(rest, 16, 10).cast("long")))
            .when(letter.isin("x", "u", "U", "N"), F.lit(None))
            .otherwise(F.coalesce(F.try_element_at(letters, letter), token))
        )

    tokens = F.transform(F.regexp_extract_all(body, F.lit(_TOKEN), 0), read)
    return F.when(~F.exists(tokens, lambda t: t.isNull()), F.array_join(tokens, ""))


def _without_quotes(text: Column) -> Column:
    body = F.regexp_replace(text, r"""^[uU]?['"]|['"]$""", "")
    return F.when(body.contains("\\"), F.coalesce(_unescaped(body), body)).otherwise(body)


def _flattened(c: Column) -> Column:
    """A dict literal with an empty list for every nested container; other text comes out as no dict."""
    inside = F.regexp_extract(c, r"(?s)^[ \t]*\{(.*)\}\s*$", 1)
    levels = F.length(inside) - F.length(F.regexp_replace(inside, r"[(\[{]", ""))
    closed = F.aggregate(
        F.sequence(F.lit(1), levels), inside, lambda text, _: F.regexp_replace(text, _INNERMOST, _MARK)
    )
    usable = (inside != "") & (levels > 0) & ~inside.contains(_MARK)
    return F.when(usable, F.concat(F.lit("{"), F.replace(closed, F.lit(_MARK), F.lit("[]")), F.lit("}")))


def bool_dict(c: Column) -> Column:
    """``map<string,boolean>`` of the boolean entries of a dict literal, null if it is not one.

    A repeated key takes its last value, and only then are non-boolean values dropped. Nested values count
    as values of their key only.
    """
    flat = F.when(c.rlike(_DICT), c).otherwise(_flattened(c))
    return F.transform(F.array(flat), _flat_bool_dict)[0]


def _flat_bool_dict(c: Column) -> Column:
    keys = F.transform(
        F.regexp_extract_all(c, F.lit(_PAIR), 1),
        lambda k: F.when(k.rlike(rf"^{_TEXT}$"), _without_quotes(k)).otherwise(k),
    )
    found = F.arrays_zip(keys.alias("key"), F.regexp_extract_all(c, F.lit(_PAIR), 2).alias("raw"))

    def booleans(entries: Column) -> Column:
        last = F.when(F.size(F.array_distinct(entries["key"])) == F.size(entries), entries).otherwise(
            F.filter(
                entries,
                lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["key"] == e["key"]),
            )
        )
        return F.transform(
            F.filter(last, lambda e: e["raw"].isin("True", "False")),
            lambda e: F.struct(e["key"].alias("key"), (e["raw"] == "True").alias("value")),
        )

    # the entries are read once and bound: spelled out at each use they would be read four times
    return F.when(c.rlike(_DICT), F.map_from_entries(F.transform(F.array(found), booleans)[0]))


def literal_text(c: Column) -> Column:
    """The text a scalar literal stands for: ``u'none'`` is ``none``; bare words are null."""
    quoted = F.regexp_extract(c, _QUOTED, 1)
    body = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    bare = F.regexp_extract(c, r"^[ \t]*(.*?)\s*$", 1)
    integer = F.regexp_replace(F.regexp_replace(bare, r"^\+|(?<=^-)0+$", ""), r"^-?0*$", "0")
    return (
        F.when(
            c.rlike(_QUOTED),
            F.when(body.contains("\\"), _unescaped(body)).otherwise(body),
        )
        .when(bare.isin("True", "False"), bare)
        .when(bare.rlike(rf"^{_INT}$"), integer)
        .when(
            bare.rlike(rf"^{_FLOAT}(?:[eE][+-]?[0-9]+)?$"),
            decimal_float_text(bare.try_cast("double")),
        )
    )


def unparsed(df: DataFrame, key: str, dicts: list[str] = (), scalars: list[str] = ()) -> DataFrame:
    """Rows ``(key, field, raw)`` for every attribute whose text could not be parsed."""
    failures = [
        F.when(F.col(name).isNotNull() & (F.col(name) != NONE_TEXT) & parse(F.col(name)).isNull(),
               F.struct(F.lit(name).alias("field"), F.col(name).alias("raw")))
        for parse, names in ((bool_dict, dicts), (literal_text, scalars))
        for name in names
    ]
    if not failures:
        raise ValueError("name at least one field to check")
    found = F.filter(F.array(*failures), lambda f: f.isNotNull())
    return df.select(key, F.explode(found).alias("failure")).select(key, "failure.*")


def entries_as_columns(c: Column, names: dict[str, str]) -> list[Column]:
    """One column per known key of a map; a missing key is null."""
    return [F.try_element_at(c, F.lit(key)).alias(column) for key, column in names.items()]
