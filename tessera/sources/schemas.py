"""Declared schemas of the raw layer and the curated views (§1.2)."""

from __future__ import annotations

from pyspark.sql import types as T

# Endpoint names (their raw tables are called alike) and the ingestion modes.
OHLC_TABLE = "coin_ohlc"
MODES = {
    "hourly": ("coin_markets", "market_global", "trending"),
    "daily": ("coin_ohlc", "coin_metadata"),
    "all": ("coin_markets", "market_global", "trending", "coin_ohlc", "coin_metadata"),
}

# Raw document row: ingestion_time REQUIRED, payload JSON text.
DOCUMENT = T.StructType([
    T.StructField("ingestion_time", T.TimestampType(), False),
    T.StructField("payload", T.StringType(), True),
])

# Raw candle row.
CANDLE = T.StructType([
    T.StructField("ingestion_time", T.TimestampType(), False),
    T.StructField("coin_id", T.StringType(), False),
    T.StructField("open_time", T.TimestampType(), False),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
])

RAW_SCHEMAS = {
    "coin_markets": DOCUMENT,
    "market_global": DOCUMENT,
    "trending": DOCUMENT,
    "coin_metadata": DOCUMENT,
    "coin_ohlc": CANDLE,
}


def required_fields(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


# Live-price lookup (T1): coin -> metric -> figure.
LIVE_PRICE = T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))
