"""Lines and bodies are read once where they are good, with the verdicts of the plain forms."""
import json

import pytest
from pyspark.sql import functions as F

from tessera.functions.json import is_single_json_document
from tessera.sources import load as LD
from tessera.sources import shape as S
from tessera.sources.schemas import RAW_SCHEMAS, required_fields

T = '"ingestion_time":"2031-03-09T07:45:30+00:00"'
CANDLE = '{%s,"coin_id":"kelp","open_time":"2031-03-09T04:00:00+00:00","open":1,"high":2.5,"low":%s,"close":1}'
LINES = [
    "{%s,\"payload\":{\"id\":\"a]\"}}" % T, "{%s,\"payload\":[1]}}" % T, "{%s,\"payload\":1}]" % T, "{%s,\"payload\":1},0]" % T,
    "{%s,\"payload\":null}" % T, "{%s}" % T, "{\"payload\":1}", "{\"ingestion_time\":null,\"payload\":1}",
    "{\"ingestion_time\":\"soon\",\"payload\":1}", "{%s,\"payload\":\"a\tb\"}" % T, "{%s,\"payload\":1,\"payload\":null}" % T,
    "{%s,\"ingestion_time\":null}" % T, "{%s,\"extra\":1}" % T, "{%s,\"payload\":1} x" % T, "{%s,\"payload\":NaN}" % T,
    "{'ingestion_time':'2031-03-09T07:45:30Z'}", "[]", "1", "null", "", " ", "{", "}", "[{}", "{}{}", '"x"', None,
    CANDLE % (T, "0.5"), CANDLE % (T, "null"), CANDLE % (T, '"abc"'), CANDLE % (T, '"NaN"'), CANDLE % (T, "[1]"),
    CANDLE % (T, "1") + "]", CANDLE % ('"ingestion_time":7', "1"), (CANDLE % (T, "1")).replace('"kelp"', '""'),
    (CANDLE % (T, "1")).replace('"coin_id":"kelp",', ""), (CANDLE % (T, "1")).replace('"close":1', '"close":1,"close":"x"'),
]


def single(v):
    as_item = F.json_array_length(F.concat(F.lit("["), v, F.lit("]"))) == 1
    as_value = F.array_size(F.json_object_keys(F.concat(F.lit('{"x":'), v, F.lit("}")))) == 1
    return v.isNotNull() & F.coalesce(as_item, F.lit(False)) & F.coalesce(as_value, F.lit(False))


def plain_checks(v, schema):
    keys = F.json_object_keys(v)
    well_formed = single(v) & keys.isNotNull()
    unknown = F.array_size(F.array_except(F.coalesce(keys, F.array().cast("array<string>")),
                                          F.array(*[F.lit(n) for n in schema.fieldNames()]))) > 0
    missing, bad = F.lit(False), F.lit(False)
    for f in schema.fields:
        one = F.from_json(v, schema)[f.name]
        there = F.get_json_object(v, f"$.{f.name}").isNotNull()
        if f.name in required_fields(schema):
            missing = missing | (one.isNull() & ~there)
        bad = bad | (there & one.isNull())
    return [~well_formed, well_formed & unknown, well_formed & missing, well_formed & bad, F.from_json(v, schema).cast("string")]


@pytest.mark.parametrize("table", ["coin_markets", "coin_ohlc"])
def test_the_verdict_on_a_line_is_that_of_reading_it_member_by_member(spark, table):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string").repartition(2)
    plain = lines.select("value", *plain_checks(F.col("value"), RAW_SCHEMAS[table]))
    ours = LD._line_checks(lines, RAW_SCHEMAS[table]).select("value", "__malformed", "__unknown", "__missing", "__bad_type",
                                                             F.col("__row").cast("string"))
    assert sorted(map(repr, map(tuple, ours.collect()))) == sorted(map(repr, map(tuple, plain.collect())))


def test_a_line_is_parsed_as_a_whole(spark):
    """One parse with the whole schema; a member is looked up on its own only where its typed value is missing."""
    plan = LD.strict_rows(spark.createDataFrame([("{}",)], "value string"), "coin_ohlc")._jdf.queryExecution().optimizedPlan().toString()
    assert "StructField(close,DoubleType,true)" in plan
    assert "from_json(StructField(close,DoubleType,true)," not in plan
    for before in plan.split("get_json_object(")[:-1]:
        assert before.endswith(("THEN isnull(", "THEN isnotnull("))


def test_single_documents(spark):
    texts = [*LINES, "[1]", "[1]]", "[[1]", "1]", "1],[2", "1}", "{}]", "{}}", "{}]}", "{}}]", "[{}]}]"]
    df = spark.createDataFrame([(x,) for x in texts], "value string")
    for r in df.select("value", is_single_json_document("value").alias("ours"), single(F.col("value")).alias("plain")).collect():
        assert r["ours"] == r["plain"], r["value"]


def test_items_keep_their_json(spark):
    bodies = ["[]", '[{"a":1},{"b":[2]}]', '[{"a":"{"},null]', '["{x}",{"a":1}]', "['{x}',{\"a\":1}]", '["\\u007bx}",{"a":1}]', '[{"a":"b\\"c"}]',
              '[1,"1",true,"true",null]', '[{"a":1}] x', '{"a":1}', "[{]", None, '"x"', '[[1],{"a":1.50}]', '[{"a":1.50,"b":null}]']
    b = F.col("body")
    df = spark.createDataFrame([(x,) for x in bodies], "body string")

    def item(text, value):
        quoted = F.to_json(F.array(text))
        return F.when(F.schema_of_variant(value) == "STRING", quoted.substr(F.lit(2), F.length(quoted) - 2)).otherwise(text)

    plain = F.when(F.json_array_length(b).isNotNull(), F.zip_with(F.from_json(b, "array<string>"), F.from_json(b, "array<variant>"),
                                                                  item)).otherwise(F.array(b))
    for r in df.select("body", S.document_items("body").alias("ours"), plain.alias("plain")).collect():
        assert r["ours"] == r["plain"], r["body"]


BODIES = ["[]", "[[1000,1,2,0.5,1]]", "[[1000,1,2,0.5,1,9],[2000,1,2,0.5,1,\"x\"]]", '[[1000,"1",2,0.5,1]]', "[[1000,1,2,0.5,1],[2000,1,2,0.5,\"NaN\"]]",
          "[[1000,1,2,0.5]]", "[[1000,1,2,0.5,null]]", "[[1000,1,2,0.5,1],null]", "[[1000,1,2,0.5,1]]]", "[[1000,1,2,0.5,1]] x", "{}", "null", "",
          None, '[[1000,1,2,0.5,"x"]]', "[1]", '{"error":"x"}', "[[1000,1,2,0.5,1],[]]"]


@pytest.mark.parametrize("body", BODIES)
def test_candle_bodies_are_judged_as_by_their_items(spark, body):
    df = spark.createDataFrame([("kelp", body)], "coin_id string, body string").withColumn("ingestion_time", F.lit(0).cast("timestamp"))
    error = df.select(S._candle_error(F.col("body"))).first()[0]
    if error is not None:
        with pytest.raises(Exception, match="candles of coin kelp"):
            S.ohlc_rows(df).collect()
    else:
        want = df.select(F.explode(F.from_json("body", "array<array<double>>")).alias("c")).collect()
        got = [tuple(r)[3:] for r in S.ohlc_rows(df).collect()]
        assert repr(got) == repr([tuple(r["c"][1:5]) for r in want]) and len(got) <= len(json.loads(body))
