"""Question catalogue and series operators."""
import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.series import previous_value
from tessera.plans import questions as Q


def test_top_n_nulls_last_and_ties_by_id(spark):
    p = spark.createDataFrame([("b", 1), ("a", 1), ("c", None), ("d", 2)], "coin_id string, market_cap_rank bigint")
    for c in ("symbol", "name", "current_price_usd", "market_cap_usd"):
        p = p.withColumn(c, F.lit(None).cast("string"))
    assert [r["coin_id"] for r in Q.top_n_by_rank(p, 4).collect()] == ["a", "b", "d", "c"]


def test_previous_value_equals_plain_lag(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for coin in ("a", "b", "c"):
        times = sorted(rnd.sample(range(0, 24 * 30), 120))         # gaps of several days included
        rows += [(coin, base + dt.timedelta(hours=h), float(rnd.randint(1, 99))) for h in times]
    df = spark.createDataFrame(rows, "coin_id string, open_time timestamp, close double")
    ours = previous_value(df, ["coin_id"], "open_time", "close", "prev")
    plain = df.withColumn("prev", F.lag("close").over(Window.partitionBy("coin_id").orderBy("open_time")))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


def test_price_lookup_trims_and_collapses_repeats(spark):
    p = spark.createDataFrame([("3", 1.0), ("14", 2.0), ("159", 3.0), ("7", 4.0)], "coin_id string, current_price_usd double")
    for c in ("market_cap_usd", "total_volume_usd", "price_change_pct_24h"):
        p = p.withColumn(c, F.lit(0.0))
    got = Q.price_lookup(p, "3, 14,159, 3,, nope").collect()
    assert sorted(r["coin_id"] for r in got) == ["14", "159", "3"]


def test_coin_last_week_is_anchored_on_the_data(spark):
    base = dt.datetime(2020, 1, 1)
    rows = [("a", base + dt.timedelta(days=d), 1.0, 1.0, 1.0, 1.0) for d in range(20)]
    df = spark.createDataFrame(rows, "coin_id string, open_time timestamp, open double, high double, low double, close double")
    assert Q.coin_last_week(df, 7).count() == 7


def test_daily_candles_resample(spark):
    base = dt.datetime(2024, 6, 26)
    rows = [("a", base + dt.timedelta(hours=4 * i), float(i), float(i) + 2, float(i) - 1, float(i) + 1) for i in range(6)]
    df = spark.createDataFrame(rows, "coin_id string, open_time timestamp, open double, high double, low double, close double")
    r = Q.daily_candles(df).first()
    assert (r["open"], r["high"], r["low"], r["close"], r["n_candles"]) == (0.0, 7.0, -1.0, 6.0, 6)


def test_daily_fan_out_only_for_top_n_coins(spark):
    # the daily run fetches candles and metadata only for the N largest coins
    prices = spark.createDataFrame([(f"coin{i}", float(1000 - i)) for i in range(10)], "coin_id string, market_cap_usd double")
    base = dt.datetime(2024, 6, 26)
    candles = spark.createDataFrame([(f"coin{i}", base, 1.0) for i in range(10)], "coin_id string, open_time timestamp, close double")
    picked = Q.top_n_candles(prices, candles, 2)
    assert sorted(r["coin_id"] for r in picked.collect()) == ["coin0", "coin1"]


def test_compare_coins_wide_pivot(spark):
    base = dt.datetime(2024, 6, 26)
    rows = [(c, base + dt.timedelta(days=d), 1.0, 1.0, 1.0, float(10 * (d + 1) * k))
            for k, c in ((1, "btc"), (2, "eth"), (3, "sol")) for d in range(3)]
    df = spark.createDataFrame(rows, "coin_id string, open_time timestamp, open double, high double, low double, close double")
    wide = Q.compare_coins(df, ["btc", "eth"], wide=True).orderBy("day").collect()
    assert [r["btc"] for r in wide] == [100.0, 200.0, 300.0] and wide[0]["eth"] == 100.0
    assert "sol" not in wide[0].asDict()


def test_stamp_run_is_one_literal_per_run(spark):
    from tessera.sources.shape import stamp_run

    df = stamp_run(spark.range(5), dt.datetime(2026, 6, 26, 12, 0), None)
    assert df.select("ingestion_time", "run_id").distinct().count() == 1
    assert df.first()["run_id"].isalnum()


def test_price_change_bucket_width_does_not_change_the_answer(spark):
    base = dt.datetime(2024, 6, 26)
    rows = [("a", base + dt.timedelta(minutes=37 * i), float(i % 13 + 1)) for i in range(300)]
    df = spark.createDataFrame(rows, "coin_id string, open_time timestamp, close double")
    by_day = sorted(map(tuple, Q.price_change(df, "day").collect()))
    by_hour = sorted(map(tuple, Q.price_change(df, "hour").collect()))
    assert by_day == by_hour and sum(1 for r in by_day if r[3] is None) == 1


def test_category_count_is_zero_not_minus_one_without_ansi(spark):
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        p = spark.createDataFrame([("a", "A", 1.0, 1)], "coin_id string, name string, current_price_usd double, market_cap_rank bigint")
        d = spark.createDataFrame([("b", "B", ["x"])], "coin_id string, name string, categories array<string>")
        assert Q.prices_with_dim(p, d).first()["n_categories"] == 0
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)


def _candles_from_zero(spark):
    base = dt.datetime(2024, 6, 26)
    rows = [(coin, base + dt.timedelta(days=d), p, p, p, p) for coin, prices in (("nil", [0.0, 0.0, 5.0]), ("one", [2.0, 0.0, 1.0]),
            ("low", [-0.0, 3.0]), ("flat", [0.0])) for d, p in enumerate(prices)]
    rows.append(("none", base, None, None, None, None))
    return spark.createDataFrame(rows, "coin_id string, open_time timestamp, open double, high double, low double, close double")


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", prev)


def test_the_index_over_a_first_close_of_zero(spark, ansi):
    """The oracle's division: infinite over 0, NaN for 0 / 0."""
    index = {}
    for r in Q.compare_coins(_candles_from_zero(spark)).orderBy("coin_id", "day").collect():
        index.setdefault(r["coin_id"], []).append(repr(r["index_100"]))
    assert index == {"nil": ["nan", "nan", "inf"], "one": ["100.0", "0.0", "50.0"], "low": ["nan", "-inf"], "flat": ["nan"],
                     "none": ["None"]}


def test_the_change_of_a_series_that_opens_at_zero(spark, ansi):
    change = {r["coin_id"]: repr(r["change_pct"]) for r in Q.price_range(_candles_from_zero(spark)).collect()}
    assert change == {"nil": "inf", "one": "-50.0", "low": "-inf", "flat": "nan", "none": "None"}
