"""Curated views: latest-per-key semantics, ties, NULL keys, strictness, plans."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tessera.plans import curated as V

T0 = dt.datetime(2026, 6, 26, 12, 0, 0)


def _raw(spark, docs):
    rows = [(T0 + dt.timedelta(hours=h), json.dumps(d) if not isinstance(d, str) else d) for h, d in docs]
    return spark.createDataFrame(rows, "ingestion_time timestamp, payload string").withColumn(
        "dt", F.to_date("ingestion_time"))


def test_latest_prices_newest_document_per_coin(spark):
    raw = _raw(spark, [(0, {"id": "bitcoin", "current_price": 1, "market_cap_rank": 1}),
                       (2, {"id": "bitcoin", "current_price": 3, "market_cap_rank": 1}),
                       (1, {"id": "eth", "current_price": 2, "market_cap_rank": 2, "last_updated": "nope"})])
    got = {r["coin_id"]: r for r in V.latest_prices(raw).collect()}
    assert got["bitcoin"]["current_price_usd"] == 3.0
    assert got["eth"]["last_updated"] is None          # SAFE.TIMESTAMP
    assert isinstance(got["eth"]["market_cap_rank"], int)


def test_strict_price_fails_but_lenient_gives_null(spark):
    raw = _raw(spark, [(0, {"id": "x", "current_price": "abc"})])
    with pytest.raises(Exception, match="cannot cast"):
        V.latest_prices(raw).collect()
    assert V.latest_prices(raw, strict=False).first()["current_price_usd"] is None


def test_bad_old_version_does_not_fail_the_view(spark):
    # the cast applies to the surviving (newest) document only, as in the reference
    raw = _raw(spark, [(0, {"id": "x", "current_price": "abc"}), (1, {"id": "x", "current_price": 5})])
    assert V.latest_prices(raw).first()["current_price_usd"] == 5.0


def test_ties_are_deterministic_and_null_ids_form_one_row(spark):
    docs = [(0, {"id": "a", "current_price": p}) for p in (1, 2, 3)] + [(0, {"current_price": 9}), (1, {"x": 1})]
    raw = _raw(spark, docs)
    first = sorted(map(tuple, V.latest_prices(raw).select("coin_id", "current_price_usd").collect()), key=str)
    again = sorted(map(tuple, V.latest_prices(raw.orderBy(F.rand(7))).select("coin_id", "current_price_usd")
                       .collect()), key=str)
    assert first == again
    assert len([r for r in first if r[0] is None]) == 1


def test_dim_coin_categories_never_null(spark):
    raw = _raw(spark, [(0, {"id": "a", "categories": ["l1", None]}), (0, {"id": "b"}),
                       (0, {"id": "c", "categories": "x"}), (0, {"id": "d", "market_cap_rank": 3})])
    got = {r["coin_id"]: r["categories"] for r in V.dim_coin(raw).collect()}
    assert got == {"a": ["l1"], "b": [], "c": [], "d": []}


def test_ohlc_timeseries_keeps_newest_version(spark):
    rows = [(T0, "b", T0, 1.0, 2.0, 0.5, 1.5), (T0 + dt.timedelta(days=1), "b", T0, 1.0, 2.0, 0.5, 1.7)]
    raw = spark.createDataFrame(rows, "ingestion_time timestamp, coin_id string, open_time timestamp, "
                                      "open double, high double, low double, close double")
    out = V.ohlc_timeseries(raw).collect()
    assert len(out) == 1 and out[0]["close"] == 1.7 and "ingestion_time" not in out[0].asDict()


def test_market_global_daily_last_document_of_each_day(spark):
    raw = _raw(spark, [(0, {"active_cryptocurrencies": 1, "total_market_cap": {"usd": 5},
                            "market_cap_percentage": {"btc": 50.0}}),
                       (3, {"active_cryptocurrencies": 2, "total_market_cap": {"usd": [6]},
                            "market_cap_percentage": {"btc": 51.0, "eth": 10}}),
                       (13, {"active_cryptocurrencies": 3})])
    got = {str(r["day"]): r for r in V.market_global_daily(raw).collect()}
    assert got["2026-06-26"]["active_cryptocurrencies"] == 2
    assert got["2026-06-26"]["total_market_cap_usd"] is None     # array at a scalar path
    assert got["2026-06-27"]["active_cryptocurrencies"] == 3


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_plan_has_partial_window_group_limit(spark):
    raw = _raw(spark, [(0, {"id": "a"})])
    plan = _plan(V.latest_prices(raw))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_day_filter_prunes_partitions_through_the_window(spark, tmp_path):
    raw = _raw(spark, [(h, {"active_cryptocurrencies": h}) for h in (0, 30, 60)])
    raw.write.partitionBy("dt").parquet(str(tmp_path / "g"))
    view = V.market_global_daily(spark.read.parquet(str(tmp_path / "g")))
    q = view.where(F.col("day") == F.lit("2026-06-27").cast("date"))
    assert "PartitionFilters: [isnotnull(dt" in _plan(q) and "2026-06-27" in _plan(q).split("PartitionFilters")[1][:200]
    assert q.count() == 1


def test_parametrised_view_binds_the_table_name(spark):
    _raw(spark, [(0, {"id": "a", "current_price": 1})]).createOrReplaceTempView("raw_markets_t")
    assert V.parametrised_view(spark, "latest_prices", "raw_markets_t").count() == 1


def test_trending_latest_is_the_newest_run(spark):
    raw = _raw(spark, [(0, {"item": {"id": "old", "market_cap_rank": 1}}),
                       (5, {"item": {"id": "pepe", "market_cap_rank": 30}}),
                       (5, {"item": {"id": "wif", "market_cap_rank": 40}})])
    assert sorted(r["coin_id"] for r in V.trending_latest(raw).collect()) == ["pepe", "wif"]


def test_as_of_latest_snapshot_drops_coins_that_left_the_listing(spark):
    raw = _raw(spark, [(0, {"id": "gone", "current_price": 1, "market_cap_rank": 1}),
                       (5, {"id": "btc", "current_price": 2, "market_cap_rank": 1}),
                       (5, {"id": "eth", "current_price": 3, "market_cap_rank": 2})])
    assert V.latest_prices(raw).count() == 3
    assert sorted(r["coin_id"] for r in V.latest_prices(raw, as_of_latest_snapshot=True).collect()) == ["btc", "eth"]
