"""Exact JSON / cast semantics."""
import pytest
from pyspark.sql import functions as F

from tessera.functions.json import (is_single_json_document, json_value, safe_timestamp, strict_cast,
                                    string_array)


def _one(spark, text, expr):
    return spark.createDataFrame([(text,)], "p string").select(expr).first()[0]


@pytest.mark.parametrize("doc,path,expected", [
    ('{"a":{"b":1}}', "$.a", None),          # object -> NULL
    ('{"a":[1,2]}', "$.a", None),            # array -> NULL
    ('{"a":"[x"}', "$.a", "[x"),             # a string that looks like an array is a scalar
    ('{"a":"{y"}', "$.a", "{y"),
    ('{"a":null}', "$.a", None),             # JSON null
    ('{"b":1}', "$.a", None),                # missing
    ('{"a":{"b":7}}', "$.a.b", "7"),         # nested scalar
    ('{"a":65000.0}', "$.a", "65000.0"),     # number text kept
    ('{"a":1,"a":2}', "$.a", "1"),           # duplicate keys: first wins (E3)
])
def test_json_value_scalar_guard(spark, doc, path, expected):
    assert _one(spark, doc, json_value("p", path)) == expected


def test_strict_cast_refuses_fractional_integer(spark):
    with pytest.raises(Exception, match="cannot cast"):
        _one(spark, "65000.0", strict_cast("p", "bigint"))
    with pytest.raises(Exception, match="cannot cast"):
        _one(spark, "abc", strict_cast("p", "double"))
    assert _one(spark, "65000", strict_cast("p", "bigint")) == 65000
    assert _one(spark, None, strict_cast("p", "double")) is None


@pytest.mark.parametrize("text,ok", [
    ("2026-06-26T12:00:00.123Z", True), ("2026-06-26T12:00:00+00:00", True), ("2026-06-26 12:00:00", True),
    ("nope", False), ("2026", False), ("12:00", False), (None, False),
])
def test_safe_timestamp(spark, text, ok):
    v = _one(spark, text, safe_timestamp("p"))
    assert (v is not None) == ok


def test_safe_timestamp_offset_moves_to_next_utc_day(spark):
    v = _one(spark, "2026-06-26T23:30:00-05:00", F.to_date(safe_timestamp("p")))
    assert str(v) == "2026-06-27"


@pytest.mark.parametrize("doc,expected", [
    ('{"categories":["a",null,"b"]}', ["a", "b"]),
    ('{"categories":[]}', []),
    ('{"x":1}', []),                         # missing -> empty, never NULL
    ('{"categories":"a"}', []),              # not an array
    ('{"categories":"[\\"a\\"]"}', []),      # a string holding array text is still a string
    ('{"categories":{"a":1}}', []),
])
def test_string_array(spark, doc, expected):
    assert _one(spark, doc, string_array("p", "$.categories")) == expected


@pytest.mark.parametrize("text,ok", [
    ('{"k":1}', True), ("[1,2]", True), ('"s"', True), ("3", True), ("null", True), ('{"a":1,"a":2}', True),
    ('{"k":1}}', False), ('{"k":1} x', False), ('{"k":1}{"k":2}', False), ("[1]]", False), ('{"k":', False),
    ("", False), ("nope", False), ('{"k":1', False), ("[1,", False), (None, False),
])
def test_is_single_json_document(spark, text, ok):
    assert _one(spark, text, is_single_json_document("p")) is ok
