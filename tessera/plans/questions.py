"""The question catalogue (Q1–Q12, T2) as parametrised DataFrame functions.

The reference lets an LLM write SQL for these questions; here each one is a
named function over the curated views. Relative dates are anchored on the
data ("last week" = the last 7 days *of the data*), never on the clock, so
answers are reproducible (H9).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.json import format_figure
from ..operators.series import moving_frame, previous_value, resample_daily, running

PRICE_COLUMNS = ("coin_id", "symbol", "name", "current_price_usd", "market_cap_usd", "market_cap_rank")


# ------------------------------------------------------------------- Q1
def top_n_by_rank(prices: DataFrame, n: int = 5) -> DataFrame:
    """Top N by market cap rank (1 = largest). NULL ranks last; equal ranks
    (stale coins) ordered by coin id. Planned as TakeOrderedAndProject: each
    task keeps its own top N, no full sort."""
    return prices.orderBy(F.asc_nulls_last("market_cap_rank"), F.asc("coin_id")).limit(n).select(*PRICE_COLUMNS)


def formatted_top(prices: DataFrame, n: int = 5, decimals: int = 2) -> DataFrame:
    """Q1 for presentation: figures with grouping separators."""
    top = top_n_by_rank(prices, n)
    return top.select("coin_id", "market_cap_rank",
                      format_figure("current_price_usd", decimals).alias("price_usd"),
                      format_figure("market_cap_usd", decimals).alias("market_cap_usd"))


# ------------------------------------------------------------------- S14
def top_ids(prices: DataFrame, n: int) -> DataFrame:
    """Ids of the ``n`` largest coins by market cap (the daily run's list)."""
    return prices.orderBy(F.desc("market_cap_usd"), "coin_id").limit(n).select("coin_id")


def top_n_candles(prices: DataFrame, ohlc: DataFrame, n: int) -> DataFrame:
    """Candles of the ``n`` largest coins only (the daily fan-out). Spark
    broadcasts the id list if it is small; ``n`` is the caller's."""
    return ohlc.join(top_ids(prices, n), "coin_id", "left_semi")


def top_n_metadata(prices: DataFrame, dim: DataFrame, n: int) -> DataFrame:
    """Metadata of the ``n`` largest coins only (the daily fan-out)."""
    return dim.join(top_ids(prices, n), "coin_id", "left_semi")


# ------------------------------------------------------------------- S13
def markets_page(prices: DataFrame, per_page: int = 20, page: int = 1) -> DataFrame:
    """One page of the market listing, largest market cap first. A far page
    sorts all rows before it; ``markets_after`` does not."""
    ordered = prices.orderBy(F.desc_nulls_last("market_cap_usd"), "coin_id")
    return ordered.offset((page - 1) * per_page).limit(per_page).select("coin_id", "market_cap_usd", "market_cap_rank")


def markets_after(prices: DataFrame, market_cap_usd: float, coin_id: str, per_page: int = 20) -> DataFrame:
    """The page that follows the row with this market cap and id (keyset
    paging: each task keeps one page, however far the listing has come)."""
    cap = F.col("market_cap_usd")
    after = (cap < F.lit(market_cap_usd)) | ((cap == F.lit(market_cap_usd)) & (F.col("coin_id") > F.lit(coin_id))) | cap.isNull()
    return markets_page(prices.where(after), per_page)


# ------------------------------------------------------------------- Q2 / Q3 / Q10
def _coin_categories(dim: DataFrame) -> DataFrame:
    """(coin, category) pairs; a category that a coin lists twice counts once."""
    return dim.select("coin_id", F.explode(F.array_distinct("categories")).alias("category"))


def category_counts(dim: DataFrame) -> DataFrame:
    """Q2: categories and the number of distinct coins in each."""
    return _coin_categories(dim).groupBy("category").agg(F.count("coin_id").alias("n_coins"))


def coins_in_category(dim: DataFrame, category: str) -> DataFrame:
    """Q3: coins tagged with ``category`` (array_contains, no explode)."""
    return dim.where(F.array_contains("categories", category)).select("coin_id", "symbol", "name", "market_cap_rank")


def category_dominance(dim: DataFrame, prices: DataFrame) -> DataFrame:
    """Q10: which categories dominate — by coin count and by summed market cap.

    ``coin_share`` divides by the number of coins with metadata, a one-row
    aggregate evaluated as a scalar sub-query (no cross join, no global
    window). Rows are returned ordered by dominance.
    """
    per = (_coin_categories(dim).join(prices.select("coin_id", "market_cap_usd"), "coin_id", "left")
           .groupBy("category")
           .agg(F.count("coin_id").alias("n_coins"),
                F.round(F.sum("market_cap_usd"), 2).alias("market_cap_usd")))
    total = dim.select(F.count("coin_id")).scalar()             # one row per coin
    return (per.withColumn("coin_share", F.round(F.col("n_coins") / total, 6))
               .orderBy(F.desc("n_coins"), F.desc_nulls_last("market_cap_usd"), "category"))


# ------------------------------------------------------------------- Q4
def coin_last_week(ohlc: DataFrame, days: int = 7, coin_ids: Sequence[str] | None = None) -> DataFrame:
    """Q4: candles of the last ``days`` days of each coin's data.

    The anchor is the newest candle of that coin (the data's "now"). Anchors
    come from a grouped max (one row per coin, map-side combined) joined
    back, so a hot coin is never one window task. The join strategy is
    decided by AQE from the *measured* size of the anchor table: broadcast
    under ``spark.sql.adaptive.autoBroadcastJoinThreshold``, otherwise a
    sort-merge join whose hot keys AQE's skew join splits. Both branches
    share the de-duplication exchange (exchange reuse), so the raw candles
    are scanned and shuffled once.
    """
    src = ohlc if coin_ids is None else ohlc.where(F.col("coin_id").isin(list(coin_ids)))
    anchors = src.groupBy("coin_id").agg(F.max("open_time").alias("anchor"))
    joined = src.join(anchors, "coin_id")
    return (joined.where(F.col("open_time") > F.col("anchor") - F.expr(f"INTERVAL {int(days)} DAYS"))
                  .select("coin_id", "open_time", "open", "high", "low", "close"))


# ------------------------------------------------------------------- Q5
def price_ratio(a: Column, b: Column) -> Column:
    """``a / b`` of doubles as IEEE has it, in every ANSI mode: over a price of 0
    it is infinite (0 / 0: NaN), where ``/`` fails the job or gives NULL."""
    return F.when(b == 0, a * F.pow(b, F.lit(-1.0))).otherwise(a / b)


def price_range(ohlc: DataFrame) -> DataFrame:
    """Q5: max/min, first open, last close and change over each coin's series.

    A series that opens at 0 has an infinite change (NaN if it closes at 0).
    """
    agg = ohlc.groupBy("coin_id").agg(
        F.max("high").alias("max_high"), F.min("low").alias("min_low"),
        F.min_by("open", "open_time").alias("first_open"), F.max_by("close", "open_time").alias("last_close"),
        F.min("open_time").alias("first_open_time"), F.max("open_time").alias("last_open_time"),
        F.count(F.lit(1)).alias("n_candles"))
    return agg.withColumn("change_pct", F.round((price_ratio(F.col("last_close"), F.col("first_open")) - 1) * 100, 6))


def price_change(ohlc: DataFrame, bucket: str = "day") -> DataFrame:
    """Candle-to-candle change of the close (lag over each series).

    ``bucket`` sizes the skew-safe lag's window groups (``day`` holds six
    4-hour candles; use ``hour`` for dense irregular series).
    """
    x = previous_value(ohlc, ["coin_id"], "open_time", "close", "prev_close",
                       bucket=F.date_trunc(bucket, "open_time"))
    return x.select("coin_id", "open_time", "close", "prev_close",
                    F.round(F.col("close") - F.col("prev_close"), 9).alias("change"))


def volatility(ohlc: DataFrame, bucket: str = "day") -> DataFrame:
    """Q5: sample standard deviation of simple returns per coin.

    Returns with a zero or missing previous close are left out; ``bucket``
    as in ``price_change``.
    """
    x = previous_value(ohlc, ["coin_id"], "open_time", "close", "prev_close",
                       bucket=F.date_trunc(bucket, "open_time"))
    r = x.where(F.col("prev_close").isNotNull() & (F.col("prev_close") != 0)) \
         .select("coin_id", (F.col("close") / F.col("prev_close") - 1).alias("ret"))
    return r.groupBy("coin_id").agg(F.count(F.lit(1)).alias("n_returns"),
                                    F.round(F.stddev_samp("ret"), 9).alias("volatility"))


def running_high(ohlc: DataFrame, bucket: str = "day") -> DataFrame:
    """The highest high so far at each candle, and whether this candle set it."""
    b = F.date_trunc(bucket, "open_time")
    x = running(ohlc.select("coin_id", "open_time", "high"), ["coin_id"], "open_time", "high", "running_high", "max", b)
    x = previous_value(x, ["coin_id"], "open_time", "running_high", "before", b)
    new = F.coalesce(F.col("running_high") > F.col("before"), F.col("running_high").isNotNull())
    return x.select("coin_id", "open_time", "high", "running_high", new.alias("new_high"))


def drawdown(ohlc: DataFrame, bucket: str = "day") -> DataFrame:
    """How far each close is below the highest close so far (a share, 0 at a peak)."""
    x = running(ohlc.select("coin_id", "open_time", "close"), ["coin_id"], "open_time", "close", "peak", "max",
                F.date_trunc(bucket, "open_time"))
    return x.withColumn("drawdown", F.when(F.col("peak") != 0, F.round(F.col("close") / F.col("peak") - 1, 9)))


def moving_average(ohlc: DataFrame, n: int = 42, bucket: str = "day") -> DataFrame:
    """Mean and spread of the last ``n`` closes at each candle (42: a week of 4-hour candles)."""
    x = moving_frame(ohlc.select("coin_id", "open_time", "close"), ["coin_id"], "open_time", n, F.date_trunc(bucket, "open_time"),
                     mean=F.avg("close"), spread=F.stddev_samp("close"), n_candles=F.count("close"))
    return x.select("coin_id", "open_time", "close", F.round("mean", 9).alias("moving_average"),
                    F.round("spread", 6).alias("moving_volatility"), "n_candles")


def price_trend(ohlc: DataFrame) -> DataFrame:
    """Q5: straight line through each coin's closes: change per day, fit (R squared) and direction.

    A grouped aggregate of co-moments, which Spark merges from partial ones
    around their means, so a hot coin is combined before the shuffle and
    epoch-sized times lose no digits. A coin with one candle has no line.
    """
    days = F.unix_micros("open_time") / 86_400_000_000
    line = ohlc.where(F.col("close").isNotNull()).groupBy("coin_id").agg(
        F.count(F.lit(1)).alias("n_candles"), F.regr_slope("close", days).alias("slope"), F.regr_r2("close", days).alias("r2"))
    slope = F.round("slope", 6)
    return line.select("coin_id", "n_candles", slope.alias("change_per_day"), F.round("r2", 6).alias("fit"),
                       F.when(slope > 0, "up").when(slope < 0, "down").when(slope == 0, "flat").alias("trend"))


# ------------------------------------------------------------------- Q6
def daily_candles(ohlc: DataFrame) -> DataFrame:
    """Q6: the "daily" candles the prompts promise, resampled from 4-hour rows."""
    return resample_daily(ohlc)


# ------------------------------------------------------------------- Q7
def dominance_latest(global_daily: DataFrame) -> DataFrame:
    """Q7: BTC/ETH dominance on the newest day of data."""
    return (global_daily.orderBy(F.desc("day")).limit(1)
            .select("day", "btc_dominance_pct", "eth_dominance_pct", "total_market_cap_usd",
                    "active_cryptocurrencies"))


def macro_trend(global_daily: DataFrame) -> DataFrame:
    """Q7: the macro series by day with the change of total market cap
    against the previous available day. One row per calendar day: a plain lag."""
    x = global_daily.withColumn("prev_market_cap", F.lag("total_market_cap_usd").over(Window.orderBy("day")))
    return x.select("day", "total_market_cap_usd", "btc_dominance_pct",
                    F.round(F.col("total_market_cap_usd") - F.col("prev_market_cap"), 2).alias("market_cap_change"))


# ------------------------------------------------------------------- Q8 / Q9
def prices_with_dim(prices: DataFrame, dim: DataFrame) -> DataFrame:
    """Q8: every priced coin with its metadata (left join: many coins have
    no metadata). Both views are already hash-partitioned by ``coin_id``
    by their de-duplication window, so the join adds no shuffle."""
    d = dim.select("coin_id", "categories", F.col("name").alias("dim_name"))
    return (prices.join(d, "coin_id", "left")
                  .select("coin_id", "name", "current_price_usd", "market_cap_rank",
                          F.coalesce(F.array_size("categories"), F.lit(0)).alias("n_categories"), "categories"))


def candles_with_dim(ohlc: DataFrame, dim: DataFrame) -> DataFrame:
    """Q8: daily series of coins that have metadata, with name and tags.
    The dimension side is one row per coin; AQE broadcasts it when its
    measured size allows."""
    daily = resample_daily(ohlc)
    d = dim.select("coin_id", "name", F.array_size("categories").alias("n_categories"))
    return daily.join(d, "coin_id").select("coin_id", "name", "day", "close", "n_categories")


def volume_by_category(prices: DataFrame, dim: DataFrame) -> DataFrame:
    """Q9: 24h volume summed per category; ``prices`` has one row per coin."""
    cats = _coin_categories(dim)
    vol = cats.join(prices.select("coin_id", "total_volume_usd"), "coin_id")
    return vol.groupBy("category").agg(F.count("coin_id").alias("n_coins"),
                                       F.round(F.sum("total_volume_usd"), 2).alias("total_volume_usd"))


# ------------------------------------------------------------------- Q11
def compare_coins(ohlc: DataFrame, coin_ids: Sequence[str] | None = None, wide: bool = False) -> DataFrame:
    """Q11: daily closes side by side on a common scale (first close = 100).

    With ``coin_ids`` the comparison is restricted to those coins; the first
    close per coin is a grouped aggregate joined back (strategy chosen by
    AQE from the measured size, as in ``coin_last_week``). Over a first close
    of 0 the index is infinite (NaN on days that close at 0). ``wide=True``
    pivots to one row per day and one ``index_100`` column per coin; the
    pivot values are the given ids, so Spark runs no job to discover them.
    """
    if wide and not coin_ids:
        raise ValueError("wide comparison needs the coin ids (pivot columns)")
    daily = resample_daily(ohlc if coin_ids is None else ohlc.where(F.col("coin_id").isin(list(coin_ids))))
    first = daily.groupBy("coin_id").agg(F.min_by("close", "day").alias("first_close"))
    long = (daily.join(first, "coin_id")
                 .select("coin_id", "day", "close",
                         F.round(price_ratio(F.col("close"), F.col("first_close")) * 100, 6).alias("index_100")))
    if not wide:
        return long
    return long.groupBy("day").pivot("coin_id", list(coin_ids)).agg(F.first("index_100"))


# ------------------------------------------------------------------- Q12
def candle_coverage(ohlc: DataFrame) -> DataFrame:
    """Q12: candles, days and date range per coin (data-quality check)."""
    return ohlc.groupBy("coin_id").agg(
        F.count(F.lit(1)).alias("n_candles"),
        F.countDistinct(F.to_date("open_time")).alias("n_days"),
        F.min("open_time").alias("first_open_time"), F.max("open_time").alias("last_open_time"))


def candle_gaps(ohlc: DataFrame, step_hours: int = 4, bucket: str = "day") -> DataFrame:
    """Q12: the gaps in each coin's series: first and last missing candle and how many are missing.

    The candle before comes from the skew-safe lag (islands inside a bucket,
    joined at the bucket bounds), so no window group holds a whole coin.
    """
    step = F.expr(f"INTERVAL {int(step_hours)} HOURS")
    x = previous_value(ohlc.select("coin_id", "open_time"), ["coin_id"], "open_time", "open_time", "before",
                       bucket=F.date_trunc(bucket, "open_time"))
    slots = F.expr(f"(unix_millis(open_time) - unix_millis(before)) div {int(step_hours) * 3_600_000}")
    return (x.withColumn("n_missing", slots - 1).where("n_missing > 0")
             .select("coin_id", (F.col("before") + step).alias("gap_start"), (F.col("open_time") - step).alias("gap_end"), "n_missing"))


# ------------------------------------------------------------------- T2
def split_ids(ids: Column | str) -> Column:
    """``"a, b,c"`` -> ``["a", "b", "c"]`` (trimmed, empty items dropped)."""
    c = F.lit(ids) if isinstance(ids, str) else ids
    return F.filter(F.transform(F.split(c, ","), lambda s: F.trim(s)), lambda s: s != "")


def price_lookup(prices: DataFrame, requests: DataFrame | str, request_col: str = "coin_ids",
                 request_key: str = "request_id") -> DataFrame:
    """Price, cap, 24h volume and 24h change of the named coins.

    ``requests`` is either one comma list (``"bitcoin,ethereum"``) or a
    DataFrame with one comma list per request. Repeated ids collapse, like
    the keys of the API's answer; unknown ids give no row. USD only.
    """
    if isinstance(requests, str):
        req = prices.sparkSession.range(1).select(F.lit(0).cast("bigint").alias(request_key),
                                                  F.lit(requests).alias(request_col))
    else:
        req = requests
    wanted = req.select(request_key, F.explode(F.array_distinct(split_ids(F.col(request_col)))).alias("coin_id"))
    return wanted.join(prices, "coin_id").select(
        request_key, "coin_id", "current_price_usd", "market_cap_usd", "total_volume_usd", "price_change_pct_24h")
