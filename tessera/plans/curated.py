"""Curated "latest version" views over the raw tables (V1–V5, V7).

Each view is a function ``raw DataFrame -> DataFrame`` (never materialised
by default; see ``streaming.incremental`` for the incremental snapshot).

Plan shape, per view: scan raw -> project the key (one JSON extraction) ->
partial WindowGroupLimit -> Exchange hashpartitioning(key) -> final
WindowGroupLimit -> Window -> Filter(rn = 1) -> parse the remaining members
of the *surviving* documents only. The document text crosses the shuffle
but only the per-partition newest row of each key does, so history length
barely changes the shuffle volume (O2, O4, O5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import cast_number, json_value, safe_timestamp, strict_cast, string_array
from ..operators.latest import latest_by
from ..sources.load import newest_day


def _latest_documents(raw: DataFrame, key_path: str = "$.id", key: str = "coin_id") -> DataFrame:
    docs = raw.select("ingestion_time", "payload", json_value("payload", key_path).alias(key))
    return latest_by(docs, [key], [F.desc("ingestion_time")], tie_break=[F.desc("payload")])


def latest_prices(raw_markets: DataFrame, strict: bool = True, as_of_latest_snapshot: bool = False) -> DataFrame:
    """V1: newest market document per coin, typed.

    Newest row *per coin*, not the newest snapshot: a coin that left the
    listing keeps its old price and rank. ``as_of_latest_snapshot=True``
    keeps only coins present in the newest run (H6; the newest run time is
    a scalar sub-query). ``strict`` (default) fails the query on a
    non-numeric price like a plain CAST; ``strict=False`` turns it into
    NULL. ``last_updated`` is always lenient (SAFE.TIMESTAMP).
    """
    cast = strict_cast if strict else cast_number
    p = "payload"
    latest = _latest_documents(raw_markets)
    if as_of_latest_snapshot:
        latest = latest.where(F.col("ingestion_time") == raw_markets.select(F.max("ingestion_time")).scalar())
    return latest.select(
        "coin_id",
        json_value(p, "$.symbol").alias("symbol"),
        json_value(p, "$.name").alias("name"),
        cast(json_value(p, "$.current_price"), "double").alias("current_price_usd"),
        cast(json_value(p, "$.market_cap"), "double").alias("market_cap_usd"),
        cast(json_value(p, "$.market_cap_rank"), "bigint").alias("market_cap_rank"),
        cast(json_value(p, "$.total_volume"), "double").alias("total_volume_usd"),
        cast(json_value(p, "$.price_change_percentage_24h"), "double").alias("price_change_pct_24h"),
        cast(json_value(p, "$.circulating_supply"), "double").alias("circulating_supply"),
        safe_timestamp(json_value(p, "$.last_updated")).alias("last_updated"),
        "ingestion_time",
    )


def dim_coin(raw_metadata: DataFrame, strict: bool = True) -> DataFrame:
    """V2: newest metadata document per coin; categories without NULLs,
    never NULL itself (missing / not an array -> empty array)."""
    cast = strict_cast if strict else cast_number
    p = "payload"
    return _latest_documents(raw_metadata).select(
        "coin_id",
        json_value(p, "$.symbol").alias("symbol"),
        json_value(p, "$.name").alias("name"),
        cast(json_value(p, "$.market_cap_rank"), "bigint").alias("market_cap_rank"),
        string_array(p, "$.categories").alias("categories"),
        F.col("ingestion_time").alias("metadata_ingested_at"),
    )


def ohlc_timeseries(raw_ohlc: DataFrame) -> DataFrame:
    """V3: newest version of each candle ``(coin_id, open_time)``.

    ``coin_id`` and ``open_time`` are REQUIRED in the raw table; stating it
    as a filter (a no-op on loaded data) lets the optimizer know the keys
    are never NULL, so queries that use the series twice (anchor + join
    back, lag carry) get identical sub-plans and reuse one exchange instead
    of computing the series twice.
    """
    keyed = raw_ohlc.where(F.col("coin_id").isNotNull() & F.col("open_time").isNotNull())
    latest = latest_by(keyed, ["coin_id", "open_time"], [F.desc("ingestion_time")],
                       tie_break=[F.desc("close"), F.desc("open"), F.desc("high"), F.desc("low")])
    return latest.select("coin_id", "open_time", "open", "high", "low", "close")


def market_global_daily(raw_global: DataFrame, strict: bool = True) -> DataFrame:
    """V4: last global document of each UTC day.

    The window is partitioned by the stored partition column ``dt``
    (= DATE(ingestion_time)), so a filter on the day prunes partitions
    through the window (O3).
    """
    cast = strict_cast if strict else cast_number
    p = "payload"
    src = raw_global if "dt" in raw_global.columns else raw_global.withColumn("dt", F.to_date("ingestion_time"))
    latest = latest_by(src.select("dt", "ingestion_time", "payload"), ["dt"],
                       [F.desc("ingestion_time")], tie_break=[F.desc("payload")])
    return latest.select(
        F.col("dt").alias("day"),
        cast(json_value(p, "$.active_cryptocurrencies"), "bigint").alias("active_cryptocurrencies"),
        cast(json_value(p, "$.total_market_cap.usd"), "double").alias("total_market_cap_usd"),
        cast(json_value(p, "$.total_volume.usd"), "double").alias("total_volume_usd"),
        cast(json_value(p, "$.market_cap_percentage.btc"), "double").alias("btc_dominance_pct"),
        cast(json_value(p, "$.market_cap_percentage.eth"), "double").alias("eth_dominance_pct"),
        "ingestion_time",
    )


def trending_latest(raw_trending: DataFrame) -> DataFrame:
    """V7: the coins of the newest trending run (rows at max ingestion_time).

    The newest day comes from the stored ``dt`` alone and prunes both other
    scans: the newest run is sought within that day.
    """
    day = raw_trending.where(F.col("dt") == newest_day(raw_trending))
    runs = day.where(F.col("ingestion_time") == day.select(F.max("ingestion_time")).scalar())
    p = "payload"
    return runs.select(
        json_value(p, "$.item.id").alias("coin_id"),
        json_value(p, "$.item.name").alias("name"),
        strict_cast(json_value(p, "$.item.market_cap_rank"), "bigint").alias("market_cap_rank"),
        strict_cast(json_value(p, "$.item.score"), "double").alias("score"),
        "ingestion_time",
    )


VIEW_BUILDERS = {
    "latest_prices": ("coin_markets", latest_prices),
    "dim_coin": ("coin_metadata", dim_coin),
    "ohlc_timeseries": ("coin_ohlc", ohlc_timeseries),
    "market_global_daily": ("market_global", market_global_daily),
    "trending_latest": ("trending", trending_latest),
}


def parametrised_view(spark: SparkSession, view: str, raw_table: str) -> DataFrame:
    """V5: a view over a raw table *named at run time*.

    The table name goes through ``IDENTIFIER(:raw)`` as a bound parameter —
    no SQL text is pasted together.
    """
    src, build = VIEW_BUILDERS[view]
    raw = spark.sql("SELECT * FROM IDENTIFIER(:raw)", args={"raw": raw_table})
    return build(raw)

