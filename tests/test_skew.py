"""Hot keys: one coin holding a third (or more) of all rows."""
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.latest import latest_by
from tessera.operators.series import previous_value
from tessera.plans import questions as Q

BASE = dt.datetime(2024, 1, 1)


def _skewed_candles(spark, n_hot=3000, n_cold=40, coins=30):
    rows = [("hot", BASE + dt.timedelta(hours=4 * i), float(i % 97 + 1)) for i in range(n_hot)]
    for c in range(coins):
        rows += [(f"c{c}", BASE + dt.timedelta(hours=4 * i), float((i * c) % 89 + 1)) for i in range(n_cold)]
    df = spark.createDataFrame(rows, "coin_id string, open_time timestamp, close double")
    return df.withColumn("open", F.col("close")).withColumn("high", F.col("close")).withColumn("low", F.col("close"))


def test_previous_value_exact_under_a_hot_coin(spark):
    df = _skewed_candles(spark).select("coin_id", "open_time", "close")
    ours = previous_value(df, ["coin_id"], "open_time", "close", "prev")
    plain = df.withColumn("prev", F.lag("close").over(Window.partitionBy("coin_id").orderBy("open_time")))
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def test_no_window_is_keyed_by_the_coin_alone(spark):
    df = _skewed_candles(spark)
    plan = Q.volatility(df)._jdf.queryExecution().executedPlan().toString()
    # the per-row windows are keyed by (coin, bucket); only the bucket-level carry is keyed by coin
    row_windows = [ln for ln in plan.splitlines() if "lag(close" in ln and "windowspecdefinition(coin_id" in ln]
    assert row_windows and all("__bucket" in ln for ln in row_windows)


def test_latest_by_hot_key_shuffles_one_row_per_map_task(spark):
    rows = [("hot", BASE + dt.timedelta(minutes=i), i) for i in range(20000)] + [("cold", BASE, 1)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v long").repartition(8)
    out = latest_by(df, ["k"], [F.desc("t")], [F.desc("v")])
    assert {r["k"]: r["v"] for r in out.collect()} == {"hot": 19999, "cold": 1}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange")   # partial limit sits below the exchange


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 50), st.integers(0, 9)), min_size=1, max_size=60))
def test_latest_by_ignores_input_order(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int, v int")
    a = latest_by(df, ["k"], [F.desc("t")], [F.desc("v")]).collect()
    b = latest_by(df.orderBy(F.rand(11)), ["k"], [F.desc("t")], [F.desc("v")]).collect()
    expect = {}
    for k, t, v in rows:
        if k not in expect or (t, v) > expect[k]:
            expect[k] = (t, v)
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) == sorted((k, t, v) for k, (t, v) in expect.items())
