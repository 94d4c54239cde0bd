"""Reference-shaped raw inputs derived from the driver's test tables (§7.3).

The test data is not market data, so each raw table is *derived by Spark*
from a base table; its size grows with the base table. Every rule here is
a pure column expression (or a bounded group), so an oracle can compute
the expected answer from the base columns without parsing JSON.

* coin_markets  <- events   (one market document per event; coin = user)
* market_global <- events   (nested document per event; some non-scalar
                             and null members on purpose)
* trending      <- events   (hourly runs; run time = hour of the event)
* coin_metadata <- part     (two parts are two versions of one coin; the
                             categories member missing / not an array /
                             empty / with null and repeated items depending
                             on p_type)
* coin volumes  <- lineitem (a line trades the coin of its part)
* coin_ohlc     <- events   (4-hour candles; every candle ingested by two
                             daily runs: provisional close first, final
                             close the day after)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_utc

# Fixed values of the fixture rules.
CANDLE_MS = 4 * 3600 * 1000          # 4-hour candles
RUN_HOUR_OFFSET = 6                   # daily job runs at 06:00 UTC
METADATA_EPOCH_S = 1704067200         # 2024-01-01T00:00:00Z
RUN_TS = "2026-06-26T12:00:00Z"       # stamp of the one-run backfill


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; pins the session zone to UTC first (all day and
    epoch arithmetic of the fixtures is UTC, H4)."""
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _utc(ts: str = "ts") -> Column:
    # events.ts is timestamp_ntz; with the session zone pinned to UTC the
    # cast keeps the wall clock, i.e. the instant is read as UTC.
    return F.col(ts).cast("timestamp")


def _with_dt(df: DataFrame) -> DataFrame:
    return df.withColumn("dt", F.to_date("ingestion_time"))


def _num(c: Column) -> Column:
    """A double rendered as a JSON number."""
    return c.cast("double").cast("string")


# ---------------------------------------------------------------- markets
def market_document() -> Column:
    """Market document of one event (columns of ``events``)."""
    return F.to_json(F.struct(
        F.col("user_id").cast("string").alias("id"),
        F.col("event_type").alias("symbol"),
        F.concat(F.lit("Coin "), F.col("user_id").cast("string")).alias("name"),
        F.col("value").alias("current_price"),
        (F.col("value") * 1000).alias("market_cap"),
        (F.floor("value") + 1).alias("market_cap_rank"),
        (F.col("value") * 10).alias("total_volume"),
        (F.col("value") - 250).alias("price_change_percentage_24h"),
        F.when(F.col("event_type") != "view", F.col("user_id").cast("double") * 1000000.0)
         .alias("circulating_supply"),
        F.when(F.col("event_type") == "error", F.lit("nope"))
         .otherwise(F.date_format(_utc(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("last_updated"),
    ))


def raw_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return _with_dt(ev.select(_utc().alias("ingestion_time"), market_document().alias("payload")))


# ----------------------------------------------------------------- global
def global_document() -> Column:
    v = F.col("value")
    volume = F.when(F.col("event_type") == "click", F.concat(F.lit("["), _num(v * 1e6), F.lit("]"))) \
              .otherwise(_num(v * 1e6))
    eth = F.when(F.col("event_type") == "view", F.lit("null")).otherwise(_num(v / 20))
    return F.concat(
        F.lit('{"active_cryptocurrencies":'), F.col("event_id").cast("string"),
        F.lit(',"total_market_cap":{"usd":'), _num(v * 1e9), F.lit("}"),
        F.lit(',"total_volume":{"usd":'), volume, F.lit("}"),
        F.lit(',"market_cap_percentage":{"btc":'), _num(v / 10), F.lit(',"eth":'), eth, F.lit("}}"),
    )


def raw_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return _with_dt(ev.select(_utc().alias("ingestion_time"), global_document().alias("payload")))


# --------------------------------------------------------------- trending
def raw_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    doc = F.to_json(F.struct(F.struct(
        F.col("user_id").cast("string").alias("id"),
        F.concat(F.lit("Coin "), F.col("user_id").cast("string")).alias("name"),
        (F.floor("value") + 1).alias("market_cap_rank"),
        F.col("value").alias("score"),
    ).alias("item")))
    return _with_dt(ev.select(F.date_trunc("hour", _utc()).alias("ingestion_time"), doc.alias("payload")))


# --------------------------------------------------------------- metadata
def part_coin(key: str) -> Column:
    """The coin of a part: two parts in a row are two versions of one coin."""
    return F.expr(f"cast(({key} + 1) div 2 as string)")


def line_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traded volume per coin from all order lines (exact decimals)."""
    lines = table(spark, sf_dir, "lineitem")
    return (lines.groupBy(part_coin("l_partkey").alias("coin_id"))
                 .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("total_volume_usd")))


def metadata_document() -> Column:
    words = F.split(F.col("p_name"), " ")  # two words; F.get gives NULL past the end
    base = F.to_json(F.struct(
        part_coin("p_partkey").alias("id"),
        F.lower(F.col("p_brand")).alias("symbol"),
        F.col("p_name").alias("name"),
        F.col("p_size").cast("bigint").alias("market_cap_rank"),
        # subtrees the metadata call turns off; kept here so trimming has work
        F.struct(F.struct(F.col("p_retailprice").alias("usd")).alias("current_price")).alias("market_data"),
        F.array(F.struct(F.col("p_brand").alias("base"), F.lit("USD").alias("target"))).alias("tickers"),
        F.struct(F.col("p_name").alias("en")).alias("localization"),
    ))
    t = F.col("p_type")
    cats = (F.when(t == "ECONOMY", F.lit(""))                                   # member missing
             .when(t == "LARGE", F.concat(F.lit(',"categories":"'), t, F.lit('"')))   # not an array
             .when(t == "SMALL", F.lit(',"categories":[]'))                      # empty
             .when(t == "PROMO", F.concat(F.lit(',"categories":'),
                                          F.to_json(F.array(F.get(words, 1), F.lit(None).cast("string"), F.col("p_brand"),
                                                              F.get(words, 1)))))
             .otherwise(F.concat(F.lit(',"categories":'), F.to_json(F.array(t, F.get(words, 0))))))
    # splice the categories member in before the closing brace
    return F.concat(base.substr(F.lit(1), F.length(base) - 1), cats, F.lit("}"))


def raw_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return _with_dt(part.select(
        F.timestamp_seconds(F.lit(METADATA_EPOCH_S) + F.col("p_partkey") * 60).alias("ingestion_time"),
        metadata_document().alias("payload"),
    ))


# ---------------------------------------------------------------- candles
def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-hour candles per user from events (open/close by time)."""
    ev = table(spark, sf_dir, "events")
    return (ev.withColumn("bucket_ms", F.expr(f"unix_millis(cast(ts as timestamp)) div {CANDLE_MS} * {CANDLE_MS}"))
              .groupBy("user_id", "bucket_ms")
              .agg(F.min_by("value", "ts").alias("open"), F.max("value").alias("high"),
                   F.min("value").alias("low"), F.max_by("value", "ts").alias("close"))
              .withColumn("candle_day", F.to_date(F.timestamp_millis("bucket_ms"))))


def ohlc_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One OHLC API body per (coin, daily run): ``[[ms,o,h,l,c],…]``.

    The run of day R returns the candles of days R-2 and R-1; candles of
    day R-1 are still forming (close = open), those of R-2 are final.
    Groups are bounded (≤ 12 candles), so ``collect_list`` is safe.
    """
    c = candles(spark, sf_dir)
    versions = F.explode(F.array(
        F.struct(F.date_add("candle_day", 1).alias("run_day"), F.col("open").alias("c")),
        F.struct(F.date_add("candle_day", 2).alias("run_day"), F.col("close").alias("c")),
    ))
    text = F.concat(F.lit("["), F.col("bucket_ms").cast("string"), F.lit(","),
                    _num(F.col("open")), F.lit(","), _num(F.col("high")), F.lit(","),
                    _num(F.col("low")), F.lit(","), _num(F.col("v.c")), F.lit("]"))
    rows = c.select("user_id", "bucket_ms", "open", "high", "low", versions.alias("v")) \
            .select(F.col("user_id").cast("string").alias("coin_id"), F.col("v.run_day").alias("run_day"),
                    F.struct(F.col("bucket_ms"), text.alias("t")).alias("k"))
    return (rows.groupBy("coin_id", "run_day")
                .agg(F.sort_array(F.collect_list("k")).alias("ks"))
                .select("coin_id",
                        (F.col("run_day").cast("timestamp") + F.expr(f"INTERVAL {RUN_HOUR_OFFSET} HOURS"))
                        .alias("ingestion_time"),
                        F.concat(F.lit("["), F.concat_ws(",", F.col("ks.t")), F.lit("]")).alias("body")))


def raw_ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .shape import ohlc_rows
    return _with_dt(ohlc_rows(ohlc_bodies(spark, sf_dir)))


RAW_BUILDERS = {
    "coin_markets": raw_markets,
    "market_global": raw_global,
    "trending": raw_trending,
    "coin_metadata": raw_metadata,
    "coin_ohlc": raw_ohlc,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}


