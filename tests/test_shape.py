"""Shaping of response bodies: documents, candles, envelopes, prices, news."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tessera.functions.json import cast_number, iso_utc, json_value, strict_cast
from tessera.sources import shape as S

RUN = dt.datetime(2031, 3, 9, 7, 45, 30, tzinfo=dt.timezone.utc)


def bodies(spark, *texts, **extra):
    rows = [(i, RUN, t, *extra.values()) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "rid int, ingestion_time timestamp, body string" + "".join(f", {k} string" for k in extra))


def payloads(spark, text):
    return [r["payload"] for r in S.document_rows(bodies(spark, text)).collect()]


@pytest.mark.parametrize("text,want", [
    ('[{"sku":"p-7"},{"sku":"p-8"}]', ['{"sku":"p-7"}', '{"sku":"p-8"}']),
    ('{"open_markets":31}', ['{"open_markets":31}']),
    ("[]", []),
    ('[null,{"sku":"q"}]', [None, '{"sku":"q"}']),
    ('[{"w":12.0}]', ['{"w":12.0}']),                                    # number text stays as it came
    ('["a","12","[1]","{\\"k\\":2}","q\\"q",3,true]', ['"a"', '"12"', '"[1]"', '"{\\"k\\":2}"', '"q\\"q"', "3", "true"]),
])
def test_items_of_a_body_become_documents(spark, text, want):
    assert payloads(spark, text) == want


def test_a_row_carries_the_time_of_its_run(spark):
    assert S.document_rows(bodies(spark, "[1]")).first()["ingestion_time"] == RUN.replace(tzinfo=None)


def test_run_ids_are_drawn_once_a_run(spark):
    ids = []
    for _ in range(2):                      # two runs in the same second
        got = {(r["run_id"], r["ingestion_time"]) for r in S.stamp_run(spark.range(50), RUN).collect()}
        assert len(got) == 1
        ids += got
    assert ids[0][0] != ids[1][0] and ids[0][1] == ids[1][1]
    assert S.stamp_run(spark.range(1), RUN, "my-run").first()["run_id"] == "my-run"


def candles(spark, text):
    return S.ohlc_rows(bodies(spark, text, coin_id="kelp"))


def test_candles_are_typed(spark):
    r = candles(spark, "[[1930809600000, 7, 9.5, 6.25, 8, 1, 2]]").select("*", iso_utc("open_time").alias("t")).first()
    assert (r["coin_id"], r["open"], r["high"], r["low"], r["close"]) == ("kelp", 7.0, 9.5, 6.25, 8.0)
    assert r["t"] == "2031-03-09T08:00:00+00:00"
    assert candles(spark, "[]").count() == 0


BAD = ["[[1930809600000,1,2,3]]", '{"error":"slow down"}', "[[1930809600000,1,2,3,4]", '[[1930809600000,1,"n/a",3,4]]',
       "[[1930809600000,1,null,3,4]]", "[7]", "null", None, "<html>"]


@pytest.mark.parametrize("text", BAD)
def test_a_body_that_is_no_list_of_candles_fails(spark, text):
    with pytest.raises(Exception, match="candles of coin kelp"):
        candles(spark, text).collect()


def test_quarantine_keeps_the_good_and_lists_the_bad(spark):
    good, bad = S.ohlc_quarantine(bodies(spark, "[[1930809600000,1,2,3,4],[1930824000000,4,5,6,7]]", *BAD, coin_id="kelp"))
    assert sorted(r["close"] for r in good.collect()) == [4.0, 7.0]
    assert bad.count() == len(BAD) and bad.where("error is null or coin_id <> 'kelp'").count() == 0


def test_envelopes(spark):
    df = bodies(spark, '{"data":{"n":5},"x":1}')
    assert df.select(S.unwrap_envelope("body", "data")).first()[0] == '{"n":5}'
    with pytest.raises(Exception, match="no member 'coins'"):
        df.select(S.unwrap_envelope("body", "coins")).collect()
    listed = bodies(spark, '{"coins":[{"item":{"id":"kelp"}},{"item":{"id":"moss"}}]}')
    rows = S.document_rows(listed.withColumn("body", S.unwrap_envelope("body", "coins")))
    assert [r[0] for r in rows.select(json_value("payload", "$.item.id")).collect()] == ["kelp", "moss"]


def test_lines_keep_nulls_and_any_script(spark):
    df = spark.createDataFrame([("häßlich 漢", None), (None, 4)], "a string, b int")
    assert [r["value"] for r in S.to_ndjson_lines(df).collect()] == ['{"a":"häßlich 漢","b":null}', '{"a":null,"b":4}']
    assert S.to_ndjson_lines(df.limit(0)).count() == 0


def test_trimmed_documents(spark):
    rows = [('{"id":"k","rank":12.0,"big":[{"a":1}],"name":"say \\"hi\\"","tags":["t",null],"gone":null}',),
            ('["no object"]',), ("not json",), (None,), ("{}",)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, payload string")
    got = {r["i"]: r["payload"] for r in S.trim_documents(df, ("id", "name", "rank", "tags", "gone", "absent")).collect()}
    assert got == {0: '{"id":"k","name":"say \\"hi\\"","rank":12.0,"tags":["t",null],"gone":null}', 1: None, 2: None,
                   3: None, 4: "{}"}


def test_prices_and_failed_answers(spark):
    df = bodies(spark, '{"kelp":{"usd":3.5,"usd_24h_vol":70,"chf":3},"moss":{"usd":1}}', '{"kelp":{"usd":3.5}', '{"error":"quota"}',
                "[1]", None, "{}")
    rows = S.simple_price_rows(df, keep=("rid",)).collect()
    assert {(r["coin_id"], r["currency"], r["measure"], r["value"]) for r in rows if r["rid"] == 0} == {
        ("kelp", "usd", "price", 3.5), ("kelp", "usd", "24h_vol", 70.0), ("kelp", "chf", "price", 3.0),
        ("moss", "usd", "price", 1.0)}
    errors = {r["rid"]: r["error"] for r in rows if r["rid"] > 0}
    assert errors == {1: S.MALFORMED, 2: "quota", 3: "not a price object", 4: S.MALFORMED}
    assert all(r["coin_id"] is None and r["value"] is None for r in rows if r["rid"] > 0)


def article(i, site="desk"):
    return {"title": f"headline {i}", "url": f"https://n.invalid/{i}", "news_site": site, "author": "staff"}


def test_news_pages_and_failed_answers(spark):
    many = json.dumps([article(i, "" if i == 1 else "desk") for i in range(40)])
    df = bodies(spark, many, json.dumps({"data": [article(0, None)]}), '{"status":"ok"}', many + "]", '{"error":"down"}', '"text"')

    def page(n):
        got = {}
        for r in S.news_articles(df, n, keep=("rid",)).collect():
            got.setdefault(r["rid"], []).append(r)
        return got

    for n, want in ((5, 5), (30, 30), (None, 40)):                      # as many as asked for
        got = page(n)
        assert len(got[0]) == want and sorted(r["pos"] for r in got[0]) == list(range(want))
        assert {r["source"] for r in got[0]} == {"desk", "staff"} and [r["source"] for r in got[1]] == ["staff"]
        assert 2 not in got
        assert [[r["error"] for r in got[i]] for i in (3, 4, 5)] == [[S.MALFORMED], ["down"], ["neither a list nor an object"]]


def test_iso_text_of_an_instant(spark):
    times = [RUN, RUN.replace(microsecond=90), dt.datetime(1957, 10, 4, 19, 28, 34, 125000, tzinfo=dt.timezone.utc)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t timestamp")
    assert [r[1] for r in sorted(df.select("i", iso_utc("t")).collect())] == [
        "2031-03-09T07:45:30+00:00", "2031-03-09T07:45:30.000090+00:00", "1957-10-04T19:28:34.125000+00:00"]


def test_bodies_are_scanned_back_with_their_context(spark, tmp_path):
    df = bodies(spark, "[[1930809600000,1,2,3,4]]", "[[1930809600000,5,6,7,8]]", coin_id="kelp")
    S.write_responses(df, str(tmp_path), "coin_ohlc", keep=("rid", "coin_id", "ingestion_time"))
    back = S.read_responses(spark, str(tmp_path / "coin_ohlc"), "rid int, coin_id string, ingestion_time timestamp")
    assert sorted(r["close"] for r in S.ohlc_rows(back).collect()) == [4.0, 8.0]
    (tmp_path / "one.json").write_text('{"data":\n {"n": 1}}\n')
    whole = S.read_responses(spark, str(tmp_path / "one.json"), wholetext=True).first()
    assert whole["source_file"].endswith("one.json") and json.loads(whole["body"]) == {"data": {"n": 1}}


@pytest.mark.parametrize("text,to,want", [("1.5", "double", 1.5), (" -2e3 ", "double", -2000.0), ("1.5d", "double", None),
                                          ("2f", "double", None), ("7L", "bigint", None), ("7.0", "bigint", None),
                                          ("+7", "bigint", 7), (".5", "double", 0.5), ("", "double", None), ("inf", "double", float("inf"))])
def test_numbers(spark, text, to, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(cast_number("t", to)).first()[0] == want
    if want is None:
        with pytest.raises(Exception, match="cannot cast"):
            df.select(strict_cast("t", to)).collect()
