"""Column functions against truth tables and against Python's own implementations."""

import ast
import math
import uuid

import pytest
from pyspark.sql import functions as F

from stratica.functions import clean, text, wire
from stratica.functions.identity import uuid5
from stratica.functions.literals import bool_dict, literal_text, unparsed
from stratica.functions.vectors import cosine, has_dims
from stratica.sources.contracts import strings


def column(spark, values, make, dtype="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {dtype}")
    return [r[1] for r in df.select("i", make(F.col("v")).alias("o")).orderBy("i").collect()]


def test_booleans_flags_and_sentinels(spark):
    values = ["True", "False", "None", None, "true", "u'True'", "1", "0"]
    assert column(spark, values, clean.bool_text) == [True, False] + [None] * 6
    assert column(spark, values, clean.flag_text) == [None] * 6 + [True, False]
    assert column(spark, ["0:0-0:0", "11:0-21:0", None], clean.open_hours) == [None, "11:0-21:0", None]
    assert column(spark, ["None", "2", "x", None], clean.sentinel_int) == [None, 2, None, None]
    assert column(spark, ["", "a", None], clean.blank_null) == [None, "a", None]


NUMBERS = [
    "4.0", " 4.9 ", "abc", "1e2", ".5", "4.", "+4", "-4.7", ".", "+.", "-.5", "+", "-", "", "99999999999",
    "2147483647.9", "4.99999999999999", "1.2.3", "\t5\n", "\x015", "5 5", "--5", "0x10", "1d", "2147483648",
    "-2147483648.5", "-2147483649", "007", None,
]


def test_lenient_numbers_equal_the_lenient_cast(spark):
    whole = column(spark, NUMBERS, clean.lenient_int)
    fraction = column(spark, NUMBERS, clean.lenient_float)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert whole == column(spark, NUMBERS, lambda c: c.cast("int"))
        assert fraction == column(spark, NUMBERS, lambda c: c.cast("float"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert whole[:4] == [4, 4, None, None]


def test_timestamps_never_raise(spark):
    values = column(spark, ["2024-01-02 03:04:05", "soon", None], clean.timestamp_or_null)
    assert str(values[0]) == "2024-01-02 03:04:05" and values[1:] == [None, None]


def test_float_text_equals_python_spelling(spark):
    values = [0.0, -0.0, 1.0, 4.5, 0.1, 1e-4, 5e-05, 1.5e-7, 123456.789, 12345678.9, 1e15, 1e16, 1.25e22, -2.5e-10,
              0.7312, 1 / 3, 2e300]
    assert column(spark, values, clean.decimal_float_text, "double") == [str(v) for v in values]


DICTS = [
    "{'garage': False, 'street': True, 'validated': False, 'lot': False, 'valet': False}",
    "{u'valet': False, u'garage': None, u'street': None, u'lot': None, u'validated': False}",
    "{'dj': False}", "None", None, "{}", "  {'a': True}", "{'a': True,}", "{'a': True, 'a': None}",
    "{'a': True, 'a': False}", "{'a': 'x, {y}: True', \"b\": True}", "{1: True, 'n': 2.5}", "junk", "{'a': yes}",
    "[True]", "'text'", "{'a': {'x': True}, 'b': False}", "{'a': [1, 2], 'b': True}", "{'a' True}", "{'a': True",
    "{'it\\'s': True}", "", "{'a': True} extra", "{'garage': True, 'x': {'y': {'z': 1}}}", "{'a': [(1, {'b': [True]})], 'c': False, }",
    "{'a': {'b': {'c': }}, 'd': True}", "{'a': {'b': {'c': 1}}, 'd' True}", "{{'a': True}: True}", "{'k': {'a', 'b', ('c', (1, ))}, 'd': True}",
]


def python_dict(value):
    try:
        parsed = ast.literal_eval(value)
    except Exception:
        return None
    return {str(k): v for k, v in parsed.items() if isinstance(v, bool)} if isinstance(parsed, dict) else None


def test_dict_literals_equal_python(spark):
    assert column(spark, DICTS, bool_dict) == [python_dict(v) for v in DICTS]


LITERALS = [
    "u'full_bar'", "'none'", "None", None, "bare", "", "1", "-5", "+7", "2.5", "True", '"two words"', "'it\\'s'",
    "'back\\\\slash'", "'line\\nbreak'", " 'lead'", "'trail' ", "''", "'open", "00", "'a\"b'", "\"a'b\"", "-0", "0",
]


def test_scalar_literals_equal_python(spark):
    def python_text(value):
        try:
            parsed = ast.literal_eval(value)
        except Exception:
            return None
        return None if parsed is None else str(parsed)

    assert column(spark, LITERALS, literal_text) == [python_text(v) for v in LITERALS]


def test_unparsed_text_is_reported(spark):
    df = spark.createDataFrame(
        [("a", "{'x': True}", "bare"), ("b", "junk", "'ok'"), ("c", "None", None)], "id string, d string, s string"
    )
    found = {tuple(r) for r in unparsed(df, "id", dicts=["d"], scalars=["s"]).collect()}
    assert found == {("a", "s", "bare"), ("b", "d", "junk")}


def test_uuid5_equals_python(spark):
    names = ["abc", "", "größer ★", "x" * 1000]
    assert column(spark, names, uuid5) == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]


def python_frame(values, schema_id):
    body = bytearray()
    for v in values:
        if v is None:
            body.append(0)
            continue
        raw = v.encode()
        body.append(2)
        n = len(raw) << 1
        while n > 127:
            body.append(n & 127 | 128)
            n >>= 7
        body.append(n)
        body += raw
    return bytes([0]) + schema_id.to_bytes(4, "big") + bytes(body)


def test_frames_round_trip(spark):
    rows = [("a", None, ""), (None, None, None), ("é" * 31, "x" * 64, "y" * 8191), ("z" * 8192, "k" * 2_000_000, "★")]
    df = spark.createDataFrame(rows, "p string, q string, r string")
    frames = df.select(wire.encode_frame([F.col(c) for c in df.columns], 258).alias("value"))
    assert [bytes(r[0]) for r in frames.collect()] == [python_frame(r, 258) for r in rows]
    assert [tuple(r) for r in wire.decode_frames(frames, strings("p", "q", "r")).collect()] == rows


def test_malformed_frames_fail(spark):
    frames = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x01\x02\x0aab"),)], "value binary")
    with pytest.raises(Exception, match="malformed frame"):
        wire.decode_frames(frames, strings("p")).collect()


def test_embedding_text_keeps_empty_places(spark):
    df = spark.createDataFrame([("A", None, "t")], "a string, b string, c string")
    assert df.select(text.embedding_text(F.col("a"), F.col("b"), F.col("c"))).first()[0] == "A |  | t"


def test_routes(spark):
    replies = ['{"route": "sql"}', '{"route": "Vector"}', '{"route": "X"}', "bad", '{"route": 3}', None, "{}",
               '{"route":"SQL"} trailing', "{'route':'sql'}", '{"route":"SQL"},{"route":"SQL"}']
    assert column(spark, replies, text.route_of) == ["SQL", "VECTOR"] + ["HYBRID"] * 8


def test_content_text(spark):
    contents = ["  plain \n", '[{"type":"text","text":"a"},{"type":"x"},{"text":"b "}]', "[not json", "[]",
                '[{"text":"a"},"plain",{"text":"b"}]']
    assert column(spark, contents, text.content_text) == ["plain", "a\nb", "[not json", "", "a\nb"]


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    scores = [r[0] for r in df.select(cosine(F.col("a"), F.col("b"))).collect()]
    assert math.isclose(scores[0], 0.8) and scores[1] == 0.0
    checks = spark.createDataFrame([([1.0],), (None,), ([1.0, 2.0],)], "v array<float>").select(has_dims(F.col("v"), 2))
    assert [r[0] for r in checks.collect()] == [False, False, True]
