"""DuckDB oracle SQL for every registered query.

Each oracle recomputes the answer from the driver's *base columns* with
the fixture rules of ``tessera.sources.fixtures`` written out in SQL — it
never parses the JSON documents the Spark side builds and reads back, so
the document, cast and de-duplication code is what gets tested.
"""

from __future__ import annotations

# ---------------------------------------------------------------- CTEs
PRICES = """
WITH m AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
), latest_prices AS (
  SELECT CAST(user_id AS VARCHAR) AS coin_id, event_type AS symbol, 'Coin ' || CAST(user_id AS VARCHAR) AS name,
         value AS current_price_usd, value * 1000 AS market_cap_usd,
         CAST(floor(value) AS BIGINT) + 1 AS market_cap_rank, value * 10 AS total_volume_usd,
         value - 250 AS price_change_pct_24h,
         CASE WHEN event_type <> 'view' THEN CAST(user_id AS DOUBLE) * 1000000.0 END AS circulating_supply,
         CASE WHEN event_type <> 'error' THEN ts END AS last_updated, ts AS ingestion_time
  FROM m WHERE rn = 1
)"""

DIM = """
WITH p AS (
  SELECT *, row_number() OVER (PARTITION BY (p_partkey + 1) // 2 ORDER BY p_partkey DESC) AS rn FROM part
), dim_coin AS (
  SELECT CAST((p_partkey + 1) // 2 AS VARCHAR) AS coin_id, lower(p_brand) AS symbol, p_name AS name,
         CAST(p_size AS BIGINT) AS market_cap_rank,
         CASE WHEN p_type IN ('ECONOMY', 'LARGE', 'SMALL') THEN CAST([] AS VARCHAR[])
              WHEN p_type = 'PROMO' THEN [split_part(p_name, ' ', 2), p_brand, split_part(p_name, ' ', 2)]
              ELSE [p_type, split_part(p_name, ' ', 1)] END AS categories,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(p_partkey) AS metadata_ingested_at
  FROM p WHERE rn = 1
)"""

CANDLES = """
WITH c AS (
  SELECT user_id, (epoch_ms(ts) // 14400000) * 14400000 AS ms,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close
  FROM events GROUP BY 1, 2
)"""

OHLC = CANDLES + """, ohlc_timeseries AS (
  SELECT CAST(user_id AS VARCHAR) AS coin_id, epoch_ms(ms) AS open_time, open, high, low, close FROM c
)"""

GLOBAL = """
WITH g AS (
  SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events
), market_global_daily AS (
  SELECT CAST(ts AS DATE) AS day, event_id AS active_cryptocurrencies, value * 1e9 AS total_market_cap_usd,
         CASE WHEN event_type = 'click' THEN NULL ELSE value * 1e6 END AS total_volume_usd,
         value / 10 AS btc_dominance_pct,
         CASE WHEN event_type = 'view' THEN NULL ELSE value / 20 END AS eth_dominance_pct,
         ts AS ingestion_time
  FROM g WHERE rn = 1
)"""

DAILY = """, daily AS (
  SELECT coin_id, CAST(open_time AS DATE) AS day, arg_min(open, open_time) AS open, max(high) AS high,
         min(low) AS low, arg_max(close, open_time) AS close, count(*) AS n_candles
  FROM ohlc_timeseries GROUP BY 1, 2)"""

CATEGORIES = """
  CASE WHEN p_type = 'ECONOMY' OR p_type = 'LARGE' OR p_type = 'SMALL' THEN CAST([] AS VARCHAR[])
       WHEN p_type = 'PROMO' THEN [split_part(p_name, ' ', 2), p_brand, split_part(p_name, ' ', 2)]
       ELSE [p_type, split_part(p_name, ' ', 1)] END"""

ISO = ("strftime({t}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({t}) % 1000000 <> 0 "
       "THEN '.' || lpad(CAST(epoch_us({t}) % 1000000 AS VARCHAR), 6, '0') ELSE '' END || '+00:00'")


def _with(*ctes: str) -> str:
    """Chain CTE blocks (each starts with WITH) into one WITH list."""
    out = ctes[0]
    for c in ctes[1:]:
        out += ",\n" + c.strip()[len("WITH "):]
    return out


def _market_rows(ts: str = "ts") -> str:
    return f"SELECT {ts} AS ingestion_time, CAST(user_id AS VARCHAR) AS coin_id, value AS current_price_usd"


ORACLES: dict[str, str] = {}
o = ORACLES

# ---------------------------------------------------------------- views
o["latest_prices"] = PRICES + "\nSELECT * FROM latest_prices"
o["dim_coin"] = DIM + "\nSELECT * FROM dim_coin"
o["ohlc_timeseries"] = OHLC + "\nSELECT * FROM ohlc_timeseries"
o["market_global_daily"] = GLOBAL + "\nSELECT * FROM market_global_daily"
o["trending_latest"] = """
SELECT CAST(user_id AS VARCHAR) AS coin_id, 'Coin ' || CAST(user_id AS VARCHAR) AS name,
       CAST(floor(value) AS BIGINT) + 1 AS market_cap_rank, value AS score,
       date_trunc('hour', ts) AS ingestion_time
FROM events WHERE date_trunc('hour', ts) = (SELECT max(date_trunc('hour', ts)) FROM events)"""
o["parametrised_view"] = o["latest_prices"]
o["materialized_ohlc"] = o["ohlc_timeseries"]
o["materialized_latest"] = PRICES + """
SELECT coin_id, current_price_usd, market_cap_rank, ingestion_time FROM latest_prices"""

# ---------------------------------------------------------------- window / functions
o["latest_per_key"] = """
SELECT user_id, event_type, event_id, value, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""
o["json_value"] = """
SELECT event_id, json_extract_string(props, '$.k') AS k_text, CAST(NULL AS VARCHAR) AS root_value FROM events"""
o["strict_cast"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value AS price,
       CASE WHEN event_type NOT IN ('view', 'click') THEN value END AS guarded FROM events"""
o["safe_timestamp"] = """
SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE ts END AS parsed FROM events"""
o["string_array"] = f"""
SELECT TIMESTAMP '2024-01-01 00:00:00' + to_minutes(p_partkey) AS ingestion_time, {CATEGORIES} AS categories
FROM part"""
o["iso_utc"] = f"SELECT event_id, {ISO.format(t='ts')} AS iso FROM events"

# ---------------------------------------------------------------- shaping / sources / sinks
o["document_rows"] = """
SELECT CASE WHEN event_type = 'error' THEN ts ELSE max(ts) OVER (PARTITION BY event_id // 8) END AS ingestion_time,
       CAST(user_id AS VARCHAR) AS coin_id, value AS current_price_usd
FROM events"""
o["unwrap_envelope"] = "SELECT event_id AS active_cryptocurrencies, value AS btc_dominance_pct FROM events"
o["ohlc_rows"] = CANDLES + """
SELECT CAST(CAST(epoch_ms(ms) AS DATE) + v AS TIMESTAMP) + INTERVAL 6 HOUR AS ingestion_time,
       CAST(user_id AS VARCHAR) AS coin_id, epoch_ms(ms) AS open_time, open, high, low,
       CASE WHEN v = 1 THEN open ELSE close END AS close
FROM c, (VALUES (1), (2)) AS t(v)"""
o["responses_scan"] = o["ohlc_rows"]
o["trim_payload"] = """
SELECT TIMESTAMP '2024-01-01 00:00:00' + to_minutes(p_partkey) AS ingestion_time,
       '{"id":"' || (p_partkey + 1) // 2 || '","symbol":"' || lower(p_brand) || '","name":"' || p_name
       || '","market_cap_rank":' || p_size
       || CASE p_type WHEN 'ECONOMY' THEN ''
                      WHEN 'LARGE' THEN ',"categories":"LARGE"'
                      WHEN 'SMALL' THEN ',"categories":[]'
                      WHEN 'PROMO' THEN ',"categories":["' || split_part(p_name, ' ', 2) || '",null,"' || p_brand || '","' || split_part(p_name, ' ', 2) || '"]'
                      ELSE ',"categories":["' || p_type || '","' || split_part(p_name, ' ', 1) || '"]' END
       || '}' AS payload
FROM part"""
o["ndjson_roundtrip"] = """
SELECT event_id, user_id, event_type, value, CASE WHEN event_type <> 'view' THEN event_type END AS note FROM events"""
o["landing_path"] = """
SELECT h AS ingestion_time, substr(md5(CAST(h AS VARCHAR)), 1, 8) AS run_id,
       'trending/dt=' || strftime(h, '%Y-%m-%d') || '/' || strftime(h, '%Y%m%dT%H%M%S') || '_'
       || substr(md5(CAST(h AS VARCHAR)), 1, 8) || '.ndjson' AS path
FROM (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events)"""
o["landing_counts"] = """
SELECT CAST(ts AS DATE) AS dt, count(*) AS n_rows, count(DISTINCT hour(ts) % 3) AS n_runs
FROM events GROUP BY 1"""
o["strict_load_report"] = """
SELECT CAST(ts AS DATE) AS dt, count(*) AS n_rows,
       count(*) FILTER (WHERE event_type = 'purchase' AND value < 2) AS n_malformed,
       count(*) FILTER (WHERE event_type = 'click' AND value > 450) AS n_unknown_field,
       count(*) FILTER (WHERE event_type = 'view' AND value < 5) AS n_missing_required,
       count(*) FILTER (WHERE event_type = 'signup' AND value < 5) AS n_bad_type,
       count(*) FILTER (WHERE (event_type = 'purchase' AND value < 2) OR (event_type = 'click' AND value > 450)
                           OR (event_type IN ('view', 'signup') AND value < 5)) = 0 AS accepted
FROM events GROUP BY 1"""
o["raw_day_counts"] = "SELECT CAST(ts AS DATE) AS dt, count(*) AS n_rows FROM events GROUP BY 1"
o["mode_summary"] = CANDLES + """, counts AS (
  SELECT CAST(ts AS DATE) AS run_day, e.endpoint, count(*) AS n
  FROM events, (VALUES ('coin_markets'), ('market_global'), ('trending')) AS e(endpoint) GROUP BY 1, 2
  UNION ALL
  SELECT CAST(epoch_ms(ms) AS DATE) + v AS run_day, 'coin_ohlc', count(*) FROM c, (VALUES (1), (2)) AS t(v) GROUP BY 1
  UNION ALL
  SELECT CAST(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(p_partkey) AS DATE), 'coin_metadata', count(*)
  FROM part GROUP BY 1
), runs AS (SELECT DISTINCT run_day FROM counts)
SELECT r.run_day, e.endpoint, coalesce(c.n, 0) AS rows
FROM runs r CROSS JOIN (VALUES ('coin_markets'), ('market_global'), ('trending'), ('coin_ohlc'), ('coin_metadata')) AS e(endpoint)
LEFT JOIN counts c ON c.run_day = r.run_day AND c.endpoint = e.endpoint"""
o["ingest_run_summary"] = CANDLES + """
SELECT 'coin_markets' AS endpoint, count(*) AS rows FROM events
UNION ALL SELECT 'market_global', count(*) FROM events
UNION ALL SELECT 'trending', count(*) FROM events
UNION ALL SELECT 'coin_ohlc', 2 * count(*) FROM c
UNION ALL SELECT 'coin_metadata', count(*) FROM part"""
o["markets_page"] = PRICES + """
SELECT coin_id, market_cap_usd, market_cap_rank FROM latest_prices
ORDER BY market_cap_usd DESC, coin_id LIMIT 20 OFFSET 40"""
o["top_ids"] = PRICES + """
SELECT coin_id FROM latest_prices ORDER BY market_cap_usd DESC, coin_id LIMIT 5"""
o["top_n_candles"] = _with(PRICES, OHLC) + """
SELECT * FROM ohlc_timeseries
WHERE coin_id IN (SELECT coin_id FROM latest_prices ORDER BY market_cap_usd DESC, coin_id LIMIT 5)"""
o["replay"] = "SELECT ts AS ingestion_time, CAST(ts AS DATE) AS dt, CAST(user_id AS VARCHAR) AS coin_id, " \
              "value AS current_price_usd FROM events"
o["retention"] = """
SELECT dt, CASE WHEN dt > (SELECT max(CAST(ts AS DATE)) FROM events) - 10 THEN 'keep' ELSE 'expire' END AS action
FROM (SELECT DISTINCT CAST(ts AS DATE) AS dt FROM events)"""
o["incremental_load"] = o["replay"]
o["raw_peek"] = _market_rows() + " FROM events ORDER BY ts DESC LIMIT 5"

# ---------------------------------------------------------------- questions
o["top_n_by_rank"] = PRICES + """
SELECT coin_id, symbol, name, current_price_usd, market_cap_usd, market_cap_rank FROM latest_prices
ORDER BY market_cap_rank ASC NULLS LAST, coin_id LIMIT 5"""
o["formatted_top"] = PRICES + """, top AS (
  SELECT * FROM latest_prices ORDER BY market_cap_rank ASC NULLS LAST, coin_id LIMIT 5)
SELECT coin_id, market_cap_rank, format('{:,.2f}', current_price_usd) AS price_usd,
       format('{:,.2f}', market_cap_usd) AS market_cap_usd FROM top"""
o["category_counts"] = DIM + """
SELECT category, count(*) AS n_coins
FROM (SELECT DISTINCT coin_id, unnest(categories) AS category FROM dim_coin) GROUP BY category"""
o["coins_in_category"] = DIM + """
SELECT coin_id, symbol, name, market_cap_rank FROM dim_coin WHERE list_contains(categories, 'MEDIUM')"""
o["coin_last_week"] = OHLC + """
SELECT coin_id, open_time, open, high, low, close FROM (
  SELECT *, max(open_time) OVER (PARTITION BY coin_id) AS anchor FROM ohlc_timeseries)
WHERE open_time > anchor - INTERVAL 7 DAY"""
o["price_range"] = OHLC + """
SELECT coin_id, max(high) AS max_high, min(low) AS min_low, arg_min(open, open_time) AS first_open,
       arg_max(close, open_time) AS last_close, min(open_time) AS first_open_time,
       max(open_time) AS last_open_time, count(*) AS n_candles,
       round((arg_max(close, open_time) / arg_min(open, open_time) - 1) * 100, 6) AS change_pct
FROM ohlc_timeseries GROUP BY coin_id"""
o["price_change"] = OHLC + """
SELECT coin_id, open_time, close, prev_close, round(close - prev_close, 9) AS change FROM (
  SELECT *, lag(close) OVER (PARTITION BY coin_id ORDER BY open_time) AS prev_close FROM ohlc_timeseries)"""
o["volatility"] = OHLC + """
SELECT coin_id, count(*) AS n_returns, round(stddev_samp(ret), 9) AS volatility FROM (
  SELECT coin_id, close / prev_close - 1 AS ret FROM (
    SELECT *, lag(close) OVER (PARTITION BY coin_id ORDER BY open_time) AS prev_close FROM ohlc_timeseries)
  WHERE prev_close IS NOT NULL AND prev_close <> 0)
GROUP BY coin_id"""
o["daily_candles"] = OHLC + DAILY + "\nSELECT * FROM daily"
o["dominance_latest"] = GLOBAL + """
SELECT day, btc_dominance_pct, eth_dominance_pct, total_market_cap_usd, active_cryptocurrencies
FROM market_global_daily ORDER BY day DESC LIMIT 1"""
o["macro_trend"] = GLOBAL + """
SELECT day, total_market_cap_usd, btc_dominance_pct,
       round(total_market_cap_usd - lag(total_market_cap_usd) OVER (ORDER BY day), 2) AS market_cap_change
FROM market_global_daily"""
o["prices_with_dim"] = _with(PRICES, DIM) + """
SELECT p.coin_id, p.name, p.current_price_usd, p.market_cap_rank,
       coalesce(len(d.categories), 0) AS n_categories, d.categories
FROM latest_prices p LEFT JOIN dim_coin d USING (coin_id)"""
o["candles_with_dim"] = _with(OHLC, DIM) + DAILY + """
SELECT c.coin_id, d.name, c.day, c.close, len(d.categories) AS n_categories
FROM daily c JOIN dim_coin d USING (coin_id)"""
o["volume_by_category"] = _with(PRICES, DIM) + """
SELECT category, count(DISTINCT coin_id) AS n_coins, round(sum(total_volume_usd), 2) AS total_volume_usd
FROM (SELECT DISTINCT coin_id, unnest(categories) AS category FROM dim_coin) c JOIN latest_prices USING (coin_id)
GROUP BY category"""
o["category_dominance"] = _with(PRICES, DIM) + """
SELECT category, count(DISTINCT coin_id) AS n_coins, round(sum(market_cap_usd), 2) AS market_cap_usd,
       round(count(DISTINCT coin_id) / (SELECT count(DISTINCT coin_id) FROM dim_coin), 6) AS coin_share
FROM (SELECT DISTINCT coin_id, unnest(categories) AS category FROM dim_coin) c LEFT JOIN latest_prices USING (coin_id)
GROUP BY category"""
o["compare_coins"] = OHLC + DAILY + """
SELECT coin_id, day, close,
       round(close / first_value(close) OVER (PARTITION BY coin_id ORDER BY day) * 100, 6) AS index_100
FROM daily"""
o["candle_coverage"] = OHLC + """
SELECT coin_id, count(*) AS n_candles, count(DISTINCT CAST(open_time AS DATE)) AS n_days,
       min(open_time) AS first_open_time, max(open_time) AS last_open_time
FROM ohlc_timeseries GROUP BY coin_id"""

# ---------------------------------------------------------------- tools
o["simple_price_rows"] = """
SELECT event_id, NULL AS coin_id, NULL AS metric, NULL AS currency, NULL AS measure, CAST(NULL AS DOUBLE) AS value,
       CASE event_id % 50 WHEN 7 THEN 'malformed JSON document' ELSE 'rate limit' END AS error
FROM events WHERE event_id % 50 IN (7, 8)
UNION ALL
SELECT event_id, CAST(user_id AS VARCHAR), 'usd', 'usd', 'price', NULL, 'not a number' FROM events WHERE event_id % 50 = 9
UNION ALL
SELECT event_id, CAST(user_id AS VARCHAR), 'eur', 'eur', 'price', value * 0.9, NULL FROM events WHERE event_id % 50 = 9
UNION ALL
SELECT event_id, 'other', NULL, NULL, NULL, NULL, 'not an object of figures' FROM events WHERE event_id % 50 = 9
UNION ALL
SELECT event_id, CAST(user_id AS VARCHAR) AS coin_id, m.metric, m.currency, m.measure,
       CASE m.metric WHEN 'usd' THEN value WHEN 'usd_market_cap' THEN value * 1000
                     WHEN 'usd_24h_vol' THEN value * 10 WHEN 'usd_24h_change' THEN value - 250
                     ELSE value * 0.9 END AS value, NULL AS error
FROM events, (VALUES ('usd', 'usd', 'price'), ('usd_market_cap', 'usd', 'market_cap'),
                     ('usd_24h_vol', 'usd', '24h_vol'), ('usd_24h_change', 'usd', '24h_change'),
                     ('eur', 'eur', 'price')) AS m(metric, currency, measure)
WHERE event_id % 50 NOT IN (7, 8, 9)"""
o["price_lookup"] = PRICES + """
SELECT r.request_id, p.coin_id, p.current_price_usd, p.market_cap_usd, p.total_volume_usd, p.price_change_pct_24h
FROM (SELECT DISTINCT c_custkey AS request_id, CAST(k AS VARCHAR) AS coin_id
      FROM customer, unnest([c_custkey, c_nationkey]) AS t(k)) r
JOIN latest_prices p USING (coin_id)"""
o["news_articles"] = """
WITH d AS (SELECT doc_id, lang, source, string_split(text, chr(10)) AS lines FROM documents
      WHERE doc_id % 50 NOT IN (7, 8, 9, 10, 11, 12)),
a AS (SELECT doc_id, lang, source, unnest(lines) AS title, generate_subscripts(lines, 1) - 1 AS pos FROM d)
SELECT doc_id, pos, title, lang AS description,
       'https://news.invalid/' || doc_id || '/' || pos AS url,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_hours(doc_id), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS published_at,
       CASE WHEN lang = 'fr' THEN 'desk-fr' ELSE source END AS source, NULL AS error
FROM a WHERE pos < 25
UNION ALL
SELECT doc_id, NULL, NULL, NULL, NULL, NULL, NULL,
       CASE doc_id % 50 WHEN 7 THEN 'malformed JSON document' WHEN 8 THEN 'rate limit' ELSE 'data is no list' END
FROM documents WHERE doc_id % 50 IN (7, 8, 10, 11)
UNION ALL
SELECT doc_id, p, CASE WHEN p = 1 THEN lang END, NULL, NULL, NULL, NULL, CASE WHEN p <> 1 THEN 'not an article' END
FROM documents, (VALUES (0), (1), (2)) AS x(p) WHERE doc_id % 50 = 12"""
o["bad_payloads"] = """
SELECT ts AS ingestion_time,
       CASE WHEN event_type IN ('purchase', 'signup', 'click') THEN NULL ELSE CAST(user_id AS VARCHAR) END AS coin_id,
       CASE WHEN event_type IN ('purchase', 'signup') THEN 'malformed JSON document'
            WHEN event_type = 'click' THEN 'missing id'
            ELSE 'non-numeric price at $.current_price' END AS error
FROM events WHERE value < 2 AND event_type IN ('purchase', 'signup', 'click', 'view')"""
o["adhoc_readonly"] = PRICES + """
SELECT coin_id, current_price_usd, market_cap_rank FROM latest_prices ORDER BY market_cap_rank, coin_id LIMIT 10"""

# ---------------------------------------------------------------- runs, defects, daily fan-out, bulk
o["materialized_dim"] = o["dim_coin"]
o["materialized_global"] = o["market_global_daily"]
o["materialized_trending"] = o["trending_latest"]
o["document_items"] = """
SELECT event_id, unnest([CAST(event_id AS VARCHAR), '"' || event_type || '"', NULL, '"[x"', '"{\\"a\\":1}"',
                         '{"id":"' || event_type || '"}']) AS payload FROM events"""
o["ohlc_quarantine"] = CANDLES + """, b AS (
  SELECT user_id, CAST(CAST(epoch_ms(ms) AS DATE) + v AS TIMESTAMP) + INTERVAL 6 HOUR AS ingestion_time, count(*) AS n
  FROM c, (VALUES (1), (2)) AS t(v) GROUP BY 1, 2)
SELECT CAST(user_id AS VARCHAR) AS coin_id, ingestion_time, CASE WHEN user_id % 7 IN (0, 1, 2) THEN 0 ELSE n END AS n_candles,
       CASE user_id % 7 WHEN 0 THEN 'malformed JSON document' WHEN 1 THEN 'not a list of candles'
                        WHEN 2 THEN 'short candle or a figure that is no number' END AS error
FROM b"""
o["landed_runs"] = """
SELECT CAST(user_id AS VARCHAR) AS coin_id, 'coin_markets/dt=2026-06-26/run=20260626T120000_0a1b2c3d' AS folder,
       '0a1b2c3d' AS run_id, TIMESTAMP '2026-06-26 12:00:00' AS ingestion_time, (SELECT count(*) FROM events) AS run_rows
FROM events"""
o["strict_candle_report"] = CANDLES + """, s AS (
  SELECT CAST(epoch_ms(ms) AS DATE) AS dt, (ms // 14400000) % 50 AS slot FROM c)
SELECT dt, count(*) AS n_rows, count(*) FILTER (WHERE slot = 3) AS n_malformed, count(*) FILTER (WHERE slot = 1) AS n_unknown_field,
       count(*) FILTER (WHERE slot = 2) AS n_missing_required, count(*) FILTER (WHERE slot = 0) AS n_bad_type,
       count(*) FILTER (WHERE slot < 4) = 0 AS accepted
FROM s GROUP BY 1"""
o["markets_after"] = o["markets_page"]
o["top_n_metadata"] = _with(PRICES, DIM) + """
SELECT * FROM dim_coin
WHERE coin_id IN (SELECT coin_id FROM latest_prices ORDER BY market_cap_usd DESC, coin_id LIMIT 5)"""
o["expired_landing"] = """
SELECT CAST(ts AS DATE) AS dt, count(*) AS n_rows FROM events
WHERE CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM events) - 10 GROUP BY 1"""
o["bulk_volume_by_category"] = DIM + """, v AS (
  SELECT CAST((l_partkey + 1) // 2 AS VARCHAR) AS coin_id, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS vol
  FROM lineitem GROUP BY 1)
SELECT category, count(*) AS n_coins, CAST(sum(vol) AS DOUBLE) AS total_volume_usd
FROM (SELECT DISTINCT coin_id, unnest(categories) AS category FROM dim_coin) c JOIN v USING (coin_id) GROUP BY category"""

# ---------------------------------------------------------------- ledger, versions, frames, trend, gaps
o["load_ledger"] = """
WITH e AS (
  SELECT CAST(ts AS DATE) AS dt, day(ts) % 3 = 0 AND ((event_type = 'purchase' AND value < 2) OR (event_type = 'click' AND value > 450)
         OR (event_type IN ('view', 'signup') AND value < 5)) AS bad FROM events)
SELECT dt, count(*) AS n_rows, count(*) FILTER (WHERE bad) AS n_bad, count(*) FILTER (WHERE bad) = 0 AS accepted,
       count(*) FILTER (WHERE bad) > 0 AS has_sample, CASE WHEN count(*) FILTER (WHERE bad) = 0 THEN count(*) ELSE 0 END AS n_loaded
FROM e GROUP BY dt"""
o["materialized_two_writers"] = o["materialized_latest"]
o["snapshot_parts_left"] = OHLC + """
SELECT CAST(open_time AS DATE) AS part, 1 AS n_copies, count(*) AS n_rows FROM ohlc_timeseries GROUP BY 1"""
o["snapshot_changes"] = """
WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS dt FROM events),
cut AS (SELECT dt FROM days ORDER BY dt OFFSET (SELECT 2 * (count(*) - 1) // 3 FROM days) LIMIT 1),
b AS (SELECT user_id, arg_max(value, ts) AS v FROM events WHERE CAST(ts AS DATE) <= (SELECT dt FROM cut) GROUP BY 1),
a AS (SELECT user_id, arg_max(value, ts) AS v, max(CAST(ts AS DATE)) > (SELECT dt FROM cut) AS touched FROM events GROUP BY 1)
SELECT CAST(a.user_id AS VARCHAR) AS coin_id, CASE WHEN b.user_id IS NULL THEN 'insert' ELSE 'update' END AS change,
       b.v AS before_price, a.v AS after_price
FROM a LEFT JOIN b USING (user_id) WHERE touched"""
o["running_high"] = OHLC + """, h AS (
  SELECT coin_id, open_time, high, max(high) OVER (PARTITION BY coin_id ORDER BY open_time) AS running_high FROM ohlc_timeseries)
SELECT *, coalesce(running_high > lag(running_high) OVER (PARTITION BY coin_id ORDER BY open_time), true) AS new_high FROM h"""
o["drawdown"] = OHLC + """, h AS (
  SELECT coin_id, open_time, close, max(close) OVER (PARTITION BY coin_id ORDER BY open_time) AS peak FROM ohlc_timeseries)
SELECT *, CASE WHEN peak <> 0 THEN round(close / peak - 1, 9) END AS drawdown FROM h"""
o["moving_average"] = OHLC + """
SELECT coin_id, open_time, close, round(avg(close) OVER w, 9) AS moving_average, round(stddev_samp(close) OVER w, 6) AS moving_volatility,
       count(close) OVER w AS n_candles
FROM ohlc_timeseries WINDOW w AS (PARTITION BY coin_id ORDER BY open_time ROWS BETWEEN 41 PRECEDING AND CURRENT ROW)"""
o["price_trend"] = OHLC + """, t AS (
  SELECT coin_id, count(*) AS n_candles, round(regr_slope(close, epoch_us(open_time) / 86400000000), 6) AS slope,
         round(regr_r2(close, epoch_us(open_time) / 86400000000), 6) AS fit
  FROM ohlc_timeseries GROUP BY coin_id)
SELECT coin_id, n_candles, slope AS change_per_day, fit, CASE WHEN slope > 0 THEN 'up' WHEN slope < 0 THEN 'down' WHEN slope = 0 THEN 'flat' END AS trend
FROM t"""
o["candle_gaps"] = OHLC + """, g AS (
  SELECT coin_id, open_time, lag(open_time) OVER (PARTITION BY coin_id ORDER BY open_time) AS before FROM ohlc_timeseries)
SELECT coin_id, before + INTERVAL 4 HOUR AS gap_start, open_time - INTERVAL 4 HOUR AS gap_end,
       (epoch_ms(open_time) - epoch_ms(before)) // 14400000 - 1 AS n_missing
FROM g WHERE epoch_ms(open_time) - epoch_ms(before) > 14400000"""
o["materialized_daily_candles"] = o["daily_candles"]
o["responses_wholetext"] = """
SELECT CAST(max(ts) OVER (PARTITION BY event_id // 64) AS DATE) AS dt, CAST(user_id AS VARCHAR) AS coin_id, value AS current_price_usd
FROM events"""
