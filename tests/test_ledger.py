"""The file as the unit of refusal, retries that replace, versions that several writers keep."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tessera.sources import landing as L
from tessera.sources import load as LD
from tessera.sources.files import paths
from tessera.sources.ingest import ingest_run
from tessera.streaming import incremental as ST

T0 = dt.datetime(2026, 6, 26, 12, 0, 0)
SCHEMA = "ingestion_time timestamp, payload string"


def docs(spark, ids, day=0, price=1):
    return spark.createDataFrame([(T0 + dt.timedelta(days=day), json.dumps({"id": c, "current_price": price})) for c in ids], SCHEMA)


def bad_file(spark, land, day="2026-06-27", endpoint="coin_markets"):
    line = '{"ingestion_time":"2026-06-27T12:00:00+00:00","payload":{"id":"z"},"extra":1}'
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(f"{land}/{endpoint}/dt={day}/run=bad")


def test_a_bad_file_costs_its_own_rows_only(spark, tmp_path):
    land, raw, ck = str(tmp_path / "land"), str(tmp_path / "raw"), str(tmp_path / "ck")
    L.land_run(docs(spark, "ab").coalesce(1), land, "coin_markets", "one")
    bad_file(spark, land)
    L.land_run(docs(spark, "c", 2).coalesce(1), land, "coin_markets", "two")
    assert ST.incremental_load(spark, land, "coin_markets", raw, ck) == 3
    L.land_run(docs(spark, "d", 3).coalesce(1), land, "coin_markets", "three")
    assert ST.incremental_load(spark, land, "coin_markets", raw, ck) == 1          # the bad file stops no later run
    ledger = {r["file"].split("run=")[1].split("/")[0]: r for r in LD.read_ledger(spark, LD.ledger_path(raw)).collect()}
    assert set(ledger) == {"one", "bad", "two", "three"}
    assert not ledger["bad"]["accepted"] and ledger["bad"]["n_unknown_field"] == 1 and '"extra":1' in ledger["bad"]["first_bad"]
    assert ledger["one"]["accepted"] and ledger["one"]["n_rows"] == 2 and ledger["one"]["first_bad"] is None
    # a stream without its checkpoint loads nothing twice
    assert ST.incremental_load(spark, land, "coin_markets", raw, str(tmp_path / "ck2")) == 0
    assert LD.read_raw(spark, raw).count() == 4 and LD.read_ledger(spark, LD.ledger_path(raw)).count() == 4


def test_batch_loads_by_file_and_a_repeated_load_replaces_itself(spark, tmp_path):
    land, raw = str(tmp_path / "land"), str(tmp_path / "raw")
    L.land_run(docs(spark, "ab").coalesce(1), land, "coin_markets", "one")
    bad_file(spark, land)
    lines = LD.read_lines(spark, f"{land}/coin_markets")
    for _ in range(2):
        assert LD.load_files(lines, "coin_markets", raw, "x") == LD.FileLoad("x", 2, 1, 1, 0)
    assert LD.load_files(lines, "coin_markets", raw, "y") == LD.FileLoad("y", 0, 0, 0, 2)
    assert LD.read_raw(spark, raw).count() == 2
    # rows whose ledger entry was never written go
    LD.append_raw(docs(spark, "q"), raw, "stream-lost-0")
    assert LD.drop_uncommitted(spark, raw) == ["stream-lost-0"] and LD.read_raw(spark, raw).count() == 2


def test_a_file_that_is_all_bad_leaves_no_raw_table(spark, tmp_path):
    land, raw = str(tmp_path / "land"), str(tmp_path / "raw")
    bad_file(spark, land)
    result = LD.load_files(LD.read_lines(spark, f"{land}/coin_markets"), "coin_markets", raw)
    assert (result.rows, result.accepted, result.refused) == (0, 0, 1) and not paths(spark, f"{raw}/dt=*")


def test_a_bad_file_does_not_stop_a_snapshot(spark, tmp_path):
    land, snap, ck = str(tmp_path / "land"), str(tmp_path / "snap"), str(tmp_path / "ck")
    L.land_run(docs(spark, "ab").coalesce(1), land, "coin_markets", "one")
    bad_file(spark, land)
    ST.materialize_latest(spark, land, "coin_markets", snap, ck)
    L.land_run(docs(spark, "c", 2).coalesce(1), land, "coin_markets", "two")
    ST.materialize_latest(spark, land, "coin_markets", snap, ck)
    assert {r["coin_id"] for r in ST.read_snapshot(spark, snap).collect()} == {"a", "b", "c"}
    assert LD.read_ledger(spark, f"{snap}/_ledger").where("not accepted").count() == 1


def test_a_retry_with_fewer_days_or_none_replaces_the_run(spark, tmp_path):
    land, raw = str(tmp_path / "land"), str(tmp_path / "raw")
    two = docs(spark, "a").unionByName(docs(spark, "b", 1))
    assert L.land_run(two, land, "trending", "r1").rows == 2
    again = L.land_run(docs(spark, "a"), land, "trending", "r1")
    assert again.rows == 1 and again.uri.endswith("dt=2026-06-26/run=r1") and L.replay(spark, land, "trending").count() == 1
    assert L.land_run(docs(spark, "x", 5), land, "trending", "r2").rows == 1
    none = L.land_run(two.limit(0), land, "trending", "r1")
    assert none.rows == 0 and none.uri is None and L.landing_inventory(spark, land, "trending").count() == 1
    LD.append_raw(two, raw, "r1")
    LD.append_raw(docs(spark, "b", 1), raw, "r1")
    assert [r["payload"] for r in LD.read_raw(spark, raw).collect()] == [r["payload"] for r in docs(spark, "b").collect()]


def test_a_run_whose_endpoint_is_empty_on_retry_loads_nothing_of_the_first_attempt(spark, tmp_path):
    land, raw = str(tmp_path / "land"), str(tmp_path / "raw")
    full = {"coin_markets": spark.createDataFrame([('[{"id":"a"},{"id":"b"}]',)], "body string"),
            "trending": spark.createDataFrame([('{"coins":[{"item":{"id":"a"}}]}',)], "body string")}
    first = ingest_run(spark, full, "hourly", T0, land, raw, "r")
    assert first.rows == {"coin_markets": 2, "market_global": 0, "trending": 1}
    less = {"coin_markets": spark.createDataFrame([('[{"id":"a"}]',)], "body string"),
            "trending": spark.createDataFrame([('{"coins":[]}',)], "body string")}
    second = ingest_run(spark, less, "hourly", T0, land, raw, "r")
    assert second.rows == {"coin_markets": 1, "market_global": 0, "trending": 0} and set(second.uris) == {"coin_markets"}
    assert LD.read_raw(spark, f"{raw}/coin_markets").count() == 1
    assert not paths(spark, f"{raw}/trending/dt=*/load=*") and not paths(spark, f"{land}/trending/dt=*/run=*")
    third = ingest_run(spark, {}, "hourly", T0, land, raw, "r")
    assert not any(third.rows.values()) and not paths(spark, f"{raw}/coin_markets/dt=*/load=*")


# ------------------------------------------------------------ snapshots
def prices(spark, snap):
    return {r["coin_id"]: json.loads(r["payload"])["current_price"] for r in ST.read_snapshot(spark, snap).collect()}


def test_two_writers_lose_no_batch(spark, tmp_path):
    snap = str(tmp_path / "snap")
    ST.merge_latest_batch(spark, snap, docs(spark, "abcdefgh"), "a", 0)
    other = lambda: ST.merge_latest_batch(spark, snap, docs(spark, "abz", 2, 3), "b", 0)
    version = ST.merge_latest_batch(spark, snap, docs(spark, "bcy", 1, 2), "a", 1, before_commit=other)
    assert version == 2 and ST.current_version(spark, snap) == 2
    assert prices(spark, snap) == {"a": 3, "b": 3, "c": 2, "d": 1, "e": 1, "f": 1, "g": 1, "h": 1, "y": 2, "z": 3}
    # both batches are known: neither is merged again
    assert ST.merge_latest_batch(spark, snap, docs(spark, "a", 9, 9), "b", 0) == 2 and prices(spark, snap)["a"] == 3


def test_a_manifest_is_created_once(spark, tmp_path):
    snap = str(tmp_path / "snap")
    ST.merge_latest_batch(spark, snap, docs(spark, "a"), "a", 0)
    before = sorted(paths(spark, f"{snap}/_manifest/v=0000000000/*"))
    state = ST._Manifest(spark, snap, 0)
    assert state.commit(spark, snap, 0, "late") is False
    assert sorted(paths(spark, f"{snap}/_manifest/v=0000000000/*")) == before and not paths(spark, f"{snap}/_manifest/_late")


@pytest.mark.parametrize("keep", [1, 2])
def test_old_versions_go_and_answers_stay(spark, tmp_path, keep):
    snap = str(tmp_path / "snap")
    for i, ids in enumerate(["abcdefgh", "ab", "abc", "h"]):
        ST.merge_latest_batch(spark, snap, docs(spark, ids, i, i), "a", i)
    before, kept = prices(spark, snap), ST._versions(spark, snap)[-keep:]
    older = [sorted(map(str, ST.read_snapshot(spark, snap, v).collect())) for v in kept]
    spark.range(1).write.parquet(f"{snap}/v=0000000004/w=atwork/part=p1")          # a writer that has not committed
    gone = ST.remove_old_versions(spark, snap, keep)
    assert gone and prices(spark, snap) == before and ST._versions(spark, snap) == kept
    assert [sorted(map(str, ST.read_snapshot(spark, snap, v).collect())) for v in kept] == older
    left = {p for p in paths(spark, f"{snap}/v=*/w=*/part=*") if "atwork" not in p}
    named = {p for v in kept for p in ST._part_paths(snap, ST._Manifest(spark, snap, v).parts)}
    assert {p.split("snap/")[1] for p in left} == {p.split("snap/")[1] for p in named} and paths(spark, f"{snap}/v=*/w=atwork/*")
    assert ST.remove_old_versions(spark, snap, keep) == []
    ST.merge_latest_batch(spark, snap, docs(spark, "a", 9, 9), "a", 9)
    assert prices(spark, snap)["a"] == 9


def test_the_change_feed_is_the_difference_of_the_versions(spark, tmp_path):
    snap = str(tmp_path / "snap")
    ST.merge_latest_batch(spark, snap, docs(spark, "abcd", 5, 1), "a", 0)
    v1 = ST.merge_latest_batch(spark, snap, docs(spark, "be", 6, 2), "a", 1)
    v2 = ST.merge_latest_batch(spark, snap, docs(spark, "ca", 1, 7), "a", 2)       # older than what is held: no change
    feed = {r["coin_id"]: r["change"] for r in ST.snapshot_changes(spark, snap, 0, v1).collect()}
    assert feed == {"b": "update", "e": "insert"}
    assert ST.snapshot_changes(spark, snap, v1, v2).count() == 0 and ST.snapshot_changes(spark, snap, v2).count() == 0
    back = {r["coin_id"]: r["change"] for r in ST.snapshot_changes(spark, snap, v2, 0).collect()}
    assert back == {"b": "update", "e": "delete"}


def test_daily_candles_are_made_anew_for_touched_days_only(spark, tmp_path):
    from tessera.plans import curated
    from tessera.plans import questions as Q

    snap, daily = str(tmp_path / "snap"), str(tmp_path / "daily")

    def candles(run_day, days, close):
        rows = [(T0 + dt.timedelta(days=run_day), "k", T0 + dt.timedelta(days=d, hours=4 * h), 1.0, 2.0 + h, 0.5, close + h)
                for d in days for h in range(3)]
        return spark.createDataFrame(rows, "ingestion_time timestamp, coin_id string, open_time timestamp, open double, high double, "
                                           "low double, close double")

    seen = None
    for i, (run_day, days, close) in enumerate([(1, [0, 1], 1.0), (2, [1, 2], 5.0), (3, [3], 9.0)]):
        batch = candles(run_day, days, close)
        seen = batch if seen is None else seen.unionByName(batch)
        ST.merge_latest_batch(spark, snap, batch, "q", i, "coin_ohlc")
        assert ST.materialize_daily_candles(spark, snap, daily) == i
        want = Q.daily_candles(curated.ohlc_timeseries(seen))
        assert sorted(map(str, ST.read_daily_candles(spark, daily).collect())) == sorted(map(str, want.collect()))
    assert list(ST.snapshot_parts(spark, daily).values()) == [0, 1, 1, 2]          # the first day was made once
    assert ST.materialize_daily_candles(spark, snap, daily) == 2 and ST.read_daily_candles(spark, str(tmp_path / "none")) is None


# ------------------------------------------------------------ frames
def series(spark):
    rows = [("hot", T0 + dt.timedelta(hours=4 * i), float((i * 7919) % 101) if i % 50 else None) for i in range(900)]
    rows += [(c, T0 + dt.timedelta(hours=4 * i * (k + 1)), float((i * 31 + k) % 17)) for k, c in enumerate("abc") for i in range(25)]
    rows += [(None, T0 + dt.timedelta(days=i), float(-i)) for i in range(5)]
    return spark.createDataFrame(rows, "coin_id string, open_time timestamp, close double")


@pytest.mark.parametrize("how", ["max", "min", "sum", "count"])
def test_running_equals_the_plain_window(spark, how):
    from pyspark.sql import Window

    from tessera.operators.series import running

    df = series(spark)
    w = Window.partitionBy("coin_id").orderBy("open_time").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("x", getattr(F, how)("close").over(w))
    ours = running(df, ["coin_id"], "open_time", "close", "x", how)
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("size,block", [(1, 4), (7, 8), (7, 3), (42, 64), (42, 4096)])
def test_moving_frame_equals_the_plain_window(spark, size, block):
    from pyspark.sql import Window

    from tessera.operators.series import moving_frame

    df = series(spark)
    w = Window.partitionBy("coin_id").orderBy("open_time").rowsBetween(1 - size, 0)
    made = {"m": F.max("close"), "n": F.count("close"), "s": F.sum("close")}
    plain = df.select("*", *[c.over(w).alias(k) for k, c in made.items()])
    ours = moving_frame(df, ["coin_id"], "open_time", size, block=block, **made)
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))


def test_no_frame_holds_a_whole_series(spark):
    from tessera.plans import questions as Q

    df = series(spark).withColumn("high", F.col("close"))
    for plan in (Q.running_high(df), Q.drawdown(df), Q.moving_average(df)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        windows = [ln for ln in text.splitlines() if "windowspecdefinition(coin_id" in ln]
        # windows over rows are keyed by (coin, bucket or block); those keyed by the coin alone run over buckets
        assert windows and all("__bucket" in ln or "__group" in ln for ln in windows)


def test_trend_and_gaps(spark):
    from tessera.plans import questions as Q

    rows = [("up", T0 + dt.timedelta(days=i), 5.0 + 2 * i) for i in range(4)] + [("one", T0, 1.0), ("flat", T0, 3.0), ("flat", T0 + dt.timedelta(hours=12), 3.0)]
    df = spark.createDataFrame(rows, "coin_id string, open_time timestamp, close double")
    got = {r["coin_id"]: (r["n_candles"], r["change_per_day"], r["trend"]) for r in Q.price_trend(df).collect()}
    assert got == {"up": (4, 2.0, "up"), "one": (1, None, None), "flat": (2, 0.0, "flat")}
    gaps = sorted((r["coin_id"], r["gap_start"], r["gap_end"], r["n_missing"]) for r in Q.candle_gaps(df).collect())
    h = dt.timedelta(hours=1)
    assert gaps[0] == ("flat", T0 + 4 * h, T0 + 8 * h, 2) and len(gaps) == 4 and gaps[1] == ("up", T0 + 4 * h, T0 + 20 * h, 5)


# ------------------------------------------------------------ errors per member
def test_a_wrong_member_is_an_error_row_and_its_siblings_stay(spark):
    from tessera.sources import shape as S

    def price_rows(body):
        return sorted((r["coin_id"] or "", r["metric"] or "", r["value"], r["error"]) for r in S.simple_price_rows(
            spark.createDataFrame([(body,)], "body string")).collect())

    assert price_rows('{"btc":{"usd":"abc","eur":2}}') == [("btc", "eur", 2.0, None), ("btc", "usd", None, "not a number")]
    assert price_rows('{"btc":{"usd":null,"eur":1.5},"eth":5}') == [("btc", "eur", 1.5, None), ("btc", "usd", None, None),
                                                                     ("eth", "", None, "not an object of figures")]
    assert price_rows('{"btc":{"usd":[1],"eur":"2"}}') == [("btc", "eur", None, "not a number"), ("btc", "usd", None, "not a number")]
    assert price_rows("{}") == [] and price_rows('{"btc":{}}') == []
    assert price_rows("[1]") == [("", "", None, "not a price object")]

    def news(body):
        return [(r["pos"], r["title"], r["error"]) for r in S.news_articles(spark.createDataFrame([(body,)], "body string"), None)
                .orderBy("pos").collect()]

    for body in ('{"data":{"title":"t"}}', '{"data":null}', '{"data":"[1]"}', '{"data":3}'):
        assert news(body) == [(None, None, "data is no list")], body
    assert news('["x",{"title":"t"},null,"{}"]') == [(0, None, "not an article"), (1, "t", None), (2, None, "not an article"), (3, None, "not an article")]
    assert news('{"status":"ok"}') == [] and news("[]") == [] and news('{"data":[]}') == []
