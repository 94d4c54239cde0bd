"""Registered queries: one per operator of the inventory.

Each entry is ``(spark, sf_dir) -> DataFrame``. All of them read the
driver's tables under ``sf_dir`` (or data Spark derives from them), so the
work grows with the tables. Entries that exercise sinks (landing files,
raw tables, streams) write under the session's shared checkpoint folder
and return a DataFrame read back from what they wrote.

Timestamps leave as ``timestamp_ntz`` (what a zone-less oracle shows);
integers leave as ``bigint``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.json import (cast_number, iso_utc, json_value, safe_timestamp, strict_cast, string_array)
from .operators.latest import latest_by
from .plans import adhoc as A
from .plans import curated as V
from .plans import questions as Q
from .plans.quality import bad_payloads
from .session import ensure_utc, shared_dir
from .sources import fixtures as FX
from .sources import landing as L
from .sources import load as LD
from .sources import shape as S
from .sources.ingest import ingest_run
from .streaming import incremental as ST

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered questions.
TOP_N = 5
PAGE_SIZE, PAGE = 20, 3
LAST_DAYS = 7
RETENTION_DAYS = 10
NEWS_PER_PAGE = 25
CATEGORY = "MEDIUM"
METADATA_MEMBERS = ("id", "symbol", "name", "market_cap_rank", "categories")
ADHOC_SQL = ("SELECT coin_id, current_price_usd, market_cap_rank FROM latest_prices "
             "ORDER BY market_cap_rank, coin_id LIMIT 10")


def ntz(df: DataFrame) -> DataFrame:
    """Timestamps -> timestamp_ntz, ints -> bigint (oracle-comparable)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ------------------------------------------------------------ inputs
def _events(s, d):
    ensure_utc(s)
    return FX.table(s, d, "events")


def prices(s, d):
    ensure_utc(s)
    return V.latest_prices(FX.raw_markets(s, d))


def dim(s, d):
    ensure_utc(s)
    return V.dim_coin(FX.raw_metadata(s, d))


def ohlc(s, d):
    ensure_utc(s)
    return V.ohlc_timeseries(FX.raw_ohlc(s, d))


def global_daily(s, d):
    ensure_utc(s)
    return V.market_global_daily(FX.raw_global(s, d))


# Where the raw tables of (application, data) are stored: written once, read by many queries.
_STORED: dict[tuple[str, str, str], str] = {}


def stored(s, d, endpoint: str) -> DataFrame:
    """A raw table as stored: Parquet by day."""
    ensure_utc(s)
    at = (s.sparkContext.applicationId, d, endpoint)
    if at not in _STORED:
        path = shared_dir(s, "stored", endpoint)
        LD.append_raw(FX.RAW_BUILDERS[endpoint](s, d).drop("dt"), path)
        _STORED[at] = path
    return LD.read_raw(s, _STORED[at])


def _view(name: str) -> Query:
    src, build = V.VIEW_BUILDERS[name]
    return lambda s, d: (ensure_utc(s), ntz(build(FX.RAW_BUILDERS[src](s, d))))[1]


def _lookup_requests(s, d):
    # one lookup request per customer: its key, its nation's key, and its key
    # again (repeats collapse)
    c = FX.table(s, d, "customer")
    k = F.col("c_custkey").cast("string")
    return c.select(F.col("c_custkey").alias("request_id"),
                    F.concat_ws(", ", k, F.col("c_nationkey").cast("string"), k).alias("coin_ids"))


def _market_fields(df: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(F.col("ingestion_time"), *keep, json_value(payload, "$.id").alias("coin_id"),
                     strict_cast(json_value(payload, "$.current_price"), "double").alias("current_price_usd"))


# ------------------------------------------------------------ functions (F)
def q_json_value(s, d):
    ev = _events(s, d)
    return ev.select("event_id", json_value("props", "$.k").alias("k_text"), json_value("props", "$").alias("root_value"))


def q_strict_cast(s, d):
    ev = _events(s, d).select("event_id", "event_type", "value", "props", FX.market_document().alias("doc"))
    # Java's type suffixes are no numbers
    suffix = F.when(F.col("event_type") == "view", F.lit("d")).when(F.col("event_type") == "click", F.lit("f")).otherwise("")
    return (ev.withColumn("text", F.concat(F.col("value").cast("string"), suffix))
              .select("event_id", strict_cast(json_value("props", "$.k"), "bigint").alias("k"),
                      strict_cast(json_value("doc", "$.current_price"), "double").alias("price"),
                      cast_number("text", "double").alias("guarded")))


def q_safe_timestamp(s, d):
    ev = _events(s, d)
    t = F.col("ts").cast("timestamp")
    text = (F.when(F.col("event_type") == "error", F.lit("nope"))
             .when(F.col("event_type") == "view", F.lit("2026"))
             .when(F.col("event_type") == "signup", iso_utc(t))
             .otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")))
    return ntz(ev.select("event_id", safe_timestamp(text).alias("parsed")))


def q_string_array(s, d):
    raw = FX.raw_metadata(s, d)
    return ntz(raw.select("ingestion_time", string_array("payload", "$.categories").alias("categories")))


def q_iso_utc(s, d):
    return _events(s, d).select("event_id", iso_utc(F.col("ts").cast("timestamp")).alias("iso"))


def q_latest_per_key(s, d):
    ev = _events(s, d)
    return ntz(latest_by(ev, ["user_id", "event_type"], [F.desc("ts")], tie_break=[F.desc("event_id")])
               .select("user_id", "event_type", "event_id", "value", "ts"))


# ------------------------------------------------------------ shaping (S)
def q_document_rows(s, d):
    ev = _events(s, d)
    doc = FX.market_document()
    x = ev.select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), doc.alias("doc"),
                  F.expr("event_id div 8").alias("bucket"))
    # list responses (bounded: 8 events each); error events come as single objects
    lists = (x.groupBy("bucket")
              .agg(F.max("ts").alias("ingestion_time"),
                   F.sort_array(F.collect_list(F.when(F.col("event_type") != "error",
                                                      F.struct("event_id", "doc")))).alias("items"))
              .select("ingestion_time", F.concat(F.lit("["), F.concat_ws(",", F.col("items.doc")), F.lit("]"))
                      .alias("body")))
    singles = x.where(F.col("event_type") == "error").select(F.col("ts").alias("ingestion_time"), F.col("doc").alias("body"))
    rows = S.document_rows(lists.unionByName(singles))
    return ntz(_market_fields(rows))


def q_unwrap_envelope(s, d):
    ev = _events(s, d)
    body = F.to_json(F.struct(F.struct(F.col("event_id").alias("active_cryptocurrencies"),
                                       F.struct(F.col("value").alias("btc")).alias("market_cap_percentage"))
                              .alias("data")))
    inner = ev.select(S.unwrap_envelope(body, "data").alias("doc"))
    return inner.select(strict_cast(json_value("doc", "$.active_cryptocurrencies"), "bigint").alias("active_cryptocurrencies"),
                        strict_cast(json_value("doc", "$.market_cap_percentage.btc"), "double").alias("btc_dominance_pct"))


def q_document_items(s, d):
    """Items of mixed kinds: numbers, strings (some that look like JSON), null and objects keep their kind."""
    ev = _events(s, d)
    kind = F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))
    body = F.concat(F.lit("["), F.col("event_id").cast("string"), F.lit(","), kind, F.lit(',null,"[x","{\\"a\\":1}",{"id":'),
                    kind, F.lit("}]"))
    rows = S.document_rows(ev.select("event_id", F.col("ts").cast("timestamp").alias("ingestion_time"), body.alias("body")),
                           keep=("event_id",))
    return rows.select("event_id", "payload")


def q_ohlc_rows(s, d):
    return ntz(FX.raw_ohlc(s, d).drop("dt"))


def q_ohlc_quarantine(s, d):
    """Bodies that are no list of candles, as rows; the others' candles are counted beside them."""
    coin = F.col("coin_id").cast("bigint") % 7
    body = (F.when(coin == 0, F.concat("body", F.lit("x"))).when(coin == 1, F.lit('{"error":"rate limit"}'))
             .when(coin == 2, F.regexp_replace("body", r"^\[\[(\d+),[^,]*", '[[$1,"n/a"')).otherwise(F.col("body")))
    good, bad = S.ohlc_quarantine(FX.ohlc_bodies(s, d).withColumn("body", body))
    counts = good.groupBy("coin_id", "ingestion_time").agg(F.count(F.lit(1)).alias("n_candles"))
    rows = counts.withColumn("error", F.lit(None).cast("string")).unionByName(bad.withColumn("n_candles", F.lit(0).cast("long")))
    return ntz(rows.select("coin_id", "ingestion_time", "n_candles", "error"))


def q_responses_scan(s, d):
    """S1 -> S4 from files: OHLC bodies landed one per line, scanned back
    with their context, then shaped into candle rows."""
    ensure_utc(s)
    root = shared_dir(s, "responses")
    S.write_responses(FX.ohlc_bodies(s, d), root, "coin_ohlc", keep=("coin_id", "ingestion_time"))
    bodies = S.read_responses(s, f"{root}/coin_ohlc", "coin_id string, ingestion_time timestamp")
    return ntz(S.ohlc_rows(bodies))


def q_responses_wholetext(s, d):
    """S1 from raw bodies, one per file (lists of at most 64 market documents), shaped into rows with the day of their file."""
    ev = _events(s, d)
    x = ev.select(F.expr("event_id div 64").alias("b"), F.col("ts").cast("timestamp").alias("ts"),
                  F.struct("event_id", FX.market_document().alias("doc")).alias("k"))
    bodies = x.groupBy("b").agg(F.max("ts").alias("ingestion_time"), F.sort_array(F.collect_list("k")).alias("ks")).select(
        "ingestion_time", F.concat(F.lit("["), F.concat_ws(",", F.col("ks.doc")), F.lit("]")).alias("body"))
    root = shared_dir(s, "responses")
    S.write_response_files(bodies, root, "coin_markets")
    read = S.read_responses(s, f"{root}/coin_markets", wholetext=True)
    rows = S.document_rows(read.withColumn("ingestion_time", F.col("dt").cast("timestamp")), keep=("dt",))
    return _market_fields(rows, keep=("dt",)).drop("ingestion_time")


def q_trim_payload(s, d):
    raw = FX.raw_metadata(s, d)
    return ntz(S.trim_documents(raw.select("ingestion_time", "payload"), METADATA_MEMBERS))


def q_simple_price_rows(s, d):
    ev = _events(s, d)
    v = F.col("value")
    metrics = F.create_map(F.lit("usd"), v, F.lit("usd_market_cap"), v * 1000, F.lit("usd_24h_vol"), v * 10,
                           F.lit("usd_24h_change"), v - 250, F.lit("eur"), v * 0.9)
    good = F.to_json(F.create_map(F.col("user_id").cast("string"), metrics))
    kind = F.col("event_id") % 50
    some = F.concat(F.lit('{"'), F.col("user_id").cast("string"), F.lit('":{"usd":"abc","eur":'), (v * 0.9).cast("string"),
                    F.lit('},"other":5}'))                              # one figure and one coin are wrong, one figure stays
    body = (F.when(kind == 7, F.concat(good, F.lit("x"))).when(kind == 8, F.lit('{"error":"rate limit"}'))
             .when(kind == 9, some).otherwise(good))
    return S.simple_price_rows(ev.select("event_id", body.alias("body")), keep=("event_id",))


def q_news_articles(s, d):
    docs = FX.table(s, d, "documents")
    lines = F.split(F.col("text"), "\n")
    published = iso_utc(F.timestamp_seconds(F.lit(FX.METADATA_EPOCH_S) + F.col("doc_id") * 3600))
    articles = F.transform(lines, lambda line, i: F.struct(
        line.alias("title"), F.col("lang").alias("description"),
        F.concat(F.lit("https://news.invalid/"), F.col("doc_id").cast("string"), F.lit("/"), i.cast("string")).alias("url"),
        published.alias("published_at"),
        F.when(F.col("lang") == "fr", F.lit("")).otherwise(F.col("source")).alias("news_site"),
        F.concat(F.lit("desk-"), F.col("lang")).alias("author")))
    arr = F.to_json(articles)
    body = (F.when(F.col("lang") == "en", F.concat(F.lit('{"data":'), arr, F.lit("}")))
             .otherwise(arr))
    kind = F.col("doc_id") % 50
    body = (F.when(kind == 7, F.concat(body, F.lit("]"))).when(kind == 8, F.lit('{"error":"rate limit"}'))
             .when(kind == 9, F.lit('{"status":"ok"}')).when(kind == 10, F.lit('{"data":{"title":"t"}}'))
             .when(kind == 11, F.lit('{"data":null}'))
             .when(kind == 12, F.concat(F.lit('["x",{"title":"'), F.col("lang"), F.lit('"},"{}"]'))).otherwise(body))
    out = S.news_articles(docs.select("doc_id", body.alias("body")), NEWS_PER_PAGE, keep=("doc_id",))
    return ntz(out)


def q_ndjson_roundtrip(s, d):
    ev = _events(s, d)
    rows = ev.select("event_id", "user_id", "event_type", "value",
                     F.when(F.col("event_type") != "view", F.col("event_type")).alias("note"))
    path = shared_dir(s, "ndjson")
    S.to_ndjson_lines(rows).write.mode("overwrite").text(path)
    back = s.read.schema(rows.schema).json(path)
    return back


def q_landing_path(s, d):
    raw = FX.raw_trending(s, d)
    runs = raw.select("ingestion_time").distinct()
    rid = F.substring(F.md5(F.col("ingestion_time").cast("string")), 1, 8)     # a backfill names its runs by their time
    return ntz(runs.select("ingestion_time", rid.alias("run_id"),
                           L.landing_path("trending", "ingestion_time", rid).alias("path")))


def _landed(s, d, endpoint: str, runs: int = 1) -> str:
    """The endpoint's rows landed by a number of runs (by the hour of the row)."""
    root = shared_dir(s, "landing")
    rows = stored(s, d, endpoint).drop("dt")
    for i in range(runs):
        L.land_run(rows.where(F.hour("ingestion_time") % runs == i), root, endpoint, f"20260626T12000{i}_backfill")
    return root


def q_landing_counts(s, d):
    return L.landing_inventory(s, _landed(s, d, "trending", 3), "trending")


def q_landed_runs(s, d):
    """Every landed line of a run with the folder, run and time it carries; the run is written twice, as a retry does."""
    ev = _events(s, d)
    bodies = ev.select(F.concat(F.lit("["), FX.market_document(), F.lit("]")).alias("body"))
    land, raw = shared_dir(s, "landing"), shared_dir(s, "raw")
    ts = dt.datetime.fromisoformat(FX.RUN_TS)
    for _ in range(2):
        run = ingest_run(s, {"coin_markets": bodies}, "hourly", ts, land, raw, "0a1b2c3d")
    lines = s.read.text(run.uris["coin_markets"]).select("value", F.col("_metadata.file_path").alias("file"))
    return ntz(lines.select(
        json_value("value", "$.payload.id").alias("coin_id"),
        F.regexp_extract("file", r"([^/]*/dt=[^/]*/run=[^/]*)/[^/]*$", 1).alias("folder"), F.lit(run.run_id).alias("run_id"),
        F.get_json_object("value", "$.ingestion_time").cast("timestamp").alias("ingestion_time"),
        F.lit(run.rows["coin_markets"]).cast("bigint").alias("run_rows")))


def q_replay(s, d):
    root, path = _landed(s, d, "coin_markets", 2), shared_dir(s, "raw")
    L.land_run(stored(s, d, "coin_markets").drop("dt").where(F.hour("ingestion_time") % 2 == 1), root, "coin_markets",
               "20260626T120001_backfill")                              # a retry
    LD.append_raw(stored(s, d, "coin_markets").drop("dt").limit(1000), path)     # what the rebuild replaces
    LD.rebuild_raw(s, root, "coin_markets", path)
    return ntz(_market_fields(LD.read_raw(s, path), keep=("dt",)))


def q_raw_day_counts(s, d):
    return LD.raw_day_counts(stored(s, d, "coin_markets"))


def q_retention(s, d):
    return L.retention(L.landed_days(s, _landed(s, d, "coin_markets"), "coin_markets"), RETENTION_DAYS)


def q_expired_landing(s, d):
    root = _landed(s, d, "coin_markets")
    L.expire_landing(s, root, "coin_markets", RETENTION_DAYS)
    return L.landing_inventory(s, root, "coin_markets").select("dt", "n_rows")


def _load_batch_lines(s, d, defects=None) -> DataFrame:
    """Landed market lines with defects: unknown member, missing required
    value, trailing garbage — each on a data-defined set of events (only where
    ``defects`` holds, if given)."""
    ev = _events(s, d)
    t = F.col("ts").cast("timestamp")
    doc = FX.market_document()
    et, v = F.col("event_type"), F.col("value")
    good = F.concat(F.lit('{"ingestion_time":"'), iso_utc(t), F.lit('","payload":'), doc, F.lit("}"))
    line = (F.when((et == "click") & (v > 450), F.concat(F.lit('{"extra":1,'), good.substr(F.lit(2), F.length(good))))
             .when((et == "view") & (v < 5), F.concat(F.lit('{"payload":'), doc, F.lit("}")))
             .when((et == "purchase") & (v < 2), F.concat(good, F.lit(" x")))
             .when((et == "signup") & (v < 5), F.concat(F.lit('{"ingestion_time":"soon","payload":'), doc, F.lit("}")))
             .otherwise(good))
    if defects is not None:
        line = F.when(defects, line).otherwise(good)
    return ev.select(line.alias("value"), F.to_date(t).alias("dt"))


def q_strict_load_report(s, d):
    path = shared_dir(s, "landing", "coin_markets")
    _load_batch_lines(s, d).write.mode("overwrite").partitionBy("dt").text(path)
    lines = s.read.text(path)
    return LD.strict_load_report(lines, "coin_markets", batch="dt")


def q_strict_candle_report(s, d):
    """Landed candle lines with a defect of each kind, per day of the candle."""
    c = FX.candles(s, d)
    slot = F.expr(f"bucket_ms div {FX.CANDLE_MS}") % 50
    when = iso_utc(F.timestamp_millis("bucket_ms"))
    open_ = F.when(slot == 0, F.lit('"abc"')).when(slot == 4, F.lit("null")).otherwise(F.col("open").cast("string"))
    coin = F.when(slot == 2, F.lit("")).otherwise(F.concat(F.lit('"coin_id":"'), F.col("user_id").cast("string"), F.lit('",')))
    line = F.concat(F.lit('{"ingestion_time":"'), when, F.lit('",'), coin, F.lit('"open_time":"'), when, F.lit('","open":'), open_,
                    F.when(slot == 1, F.lit(',"volume":1')).otherwise(""), F.lit(',"close":'), F.col("close").cast("string"),
                    F.lit("}"), F.when(slot == 3, F.lit("}")).otherwise(""))
    return LD.strict_load_report(c.select(line.alias("value"), F.col("candle_day").alias("dt")), "coin_ohlc", batch="dt")


def q_ingest_run_summary(s, d):
    """S12 end to end: one 'all' run over responses derived from the whole
    tables — shaped, landed and strictly loaded per endpoint."""
    ev = _events(s, d)
    doc = FX.market_document()
    bucketed = ev.select(F.expr("event_id div 8").alias("b"), F.struct("event_id", doc.alias("doc")).alias("k"))
    markets = (bucketed.groupBy("b").agg(F.sort_array(F.collect_list("k")).alias("ks"))
                       .select(F.concat(F.lit("["), F.concat_ws(",", F.col("ks.doc")), F.lit("]")).alias("body")))
    glob = ev.select(F.concat(F.lit('{"data":'), FX.global_document(), F.lit("}")).alias("body"))
    trending = FX.raw_trending(s, d).select(F.concat(F.lit('{"coins":['), F.col("payload"), F.lit("]}")).alias("body"))
    ohlc_bodies = FX.ohlc_bodies(s, d).select("coin_id", "body")
    meta = FX.raw_metadata(s, d).select(F.col("payload").alias("body"))
    responses = {"coin_markets": markets, "market_global": glob, "trending": trending,
                 "coin_ohlc": ohlc_bodies, "coin_metadata": meta}
    run = ingest_run(s, responses, "all", dt.datetime.fromisoformat(FX.RUN_TS), shared_dir(s, "landing"), shared_dir(s, "raw"))
    return s.createDataFrame(sorted(run.rows.items()), "endpoint string, rows bigint")


def q_mode_summary(s, d):
    ensure_utc(s)
    return LD.mode_summary(FX.raw_tables(s, d), "all").withColumnRenamed("run", "run_day")


def q_load_ledger(s, d):
    """Files of one day each, every third day with defects, in two scheduled
    runs: what the ledger says of each day's file, and the rows of it in the
    raw table after a third run that has lost its checkpoint."""
    root, raw = shared_dir(s, "landing"), shared_dir(s, "raw")
    good = _load_batch_lines(s, d, F.dayofmonth(F.to_date(F.col("ts").cast("timestamp"))) % 3 == 0)
    late = F.dayofmonth("dt") > 15
    for part, checkpoint in ((good.where(~late), "a"), (good.where(late), "a"), (None, "b")):
        if part is not None:
            part.repartition("dt").write.mode("append").partitionBy("dt").text(f"{root}/coin_markets")
        ST.incremental_load(s, root, "coin_markets", raw, f"{raw}_checkpoint_{checkpoint}")
    bad = sum(F.col(c) for c in ("n_malformed", "n_unknown_field", "n_missing_required", "n_bad_type"))
    ledger = LD.read_ledger(s, LD.ledger_path(raw)).select(
        F.regexp_extract("file", r"dt=([0-9-]+)", 1).cast("date").alias("dt"), "n_rows", bad.alias("n_bad"), "accepted",
        F.col("first_bad").isNotNull().alias("has_sample"))
    loaded = LD.raw_day_counts(LD.read_raw(s, raw)).withColumnRenamed("n_rows", "n_loaded")
    return ledger.join(loaded, "dt", "left").withColumn("n_loaded", F.coalesce("n_loaded", F.lit(0)).cast("long"))


# ------------------------------------------------------------ paging / top ids
def q_markets_page(s, d):
    return Q.markets_page(prices(s, d), PAGE_SIZE, PAGE)


def q_markets_after(s, d):
    p = prices(s, d)
    before = Q.markets_page(p, PAGE_SIZE, PAGE - 1).collect()
    if not before:                       # the listing ended earlier
        return Q.markets_page(p, PAGE_SIZE, PAGE)
    return Q.markets_after(p, before[-1]["market_cap_usd"], before[-1]["coin_id"], PAGE_SIZE)


def q_top_n_candles(s, d):
    return ntz(Q.top_n_candles(prices(s, d), ohlc(s, d), TOP_N))


def q_raw_peek(s, d):
    return ntz(_market_fields(LD.raw_peek(stored(s, d, "coin_markets"), 5)))


def q_trending_latest(s, d):
    return ntz(V.trending_latest(stored(s, d, "trending")))


def q_dominance_latest(s, d):
    raw = stored(s, d, "market_global")
    newest = raw.where(F.col("dt") == LD.newest_day(raw))             # the one day the answer needs
    return ntz(Q.dominance_latest(V.market_global_daily(newest)))


def q_bulk_volume(s, d):
    per = Q.volume_by_category(FX.line_volumes(s, d), dim(s, d))
    return ntz(per.withColumn("total_volume_usd", F.col("total_volume_usd").cast("double")))


# ------------------------------------------------------------ views (V)
def q_parametrised_view(s, d):
    ensure_utc(s)
    FX.raw_markets(s, d).createOrReplaceTempView("raw_coin_markets")
    return ntz(V.parametrised_view(s, "latest_prices", "raw_coin_markets"))


def _stream_landing(s, d, endpoint: str = "coin_markets") -> tuple[str, list[DataFrame]]:
    """One raw table in three slices of whole days (three scheduled runs)."""
    raw = stored(s, d, endpoint)
    days = sorted(r["dt"] for r in raw.select("dt").distinct().collect())
    cuts = [days[i * (len(days) - 1) // 3] for i in (1, 2)]
    day = F.col("dt")
    slices = [day <= F.lit(cuts[0]), (day > F.lit(cuts[0])) & (day <= F.lit(cuts[1])), day > F.lit(cuts[1])]
    return shared_dir(s, "landing"), [raw.where(c).drop("dt") for c in slices]


def _materialized(s, d, endpoint: str) -> DataFrame:
    ensure_utc(s)
    root, slices = _stream_landing(s, d, endpoint)
    snap, ckpt = shared_dir(s, "snapshot"), shared_dir(s, "ckpt")
    for part in slices:
        L.write_landing(part, root, endpoint)
        ST.materialize_latest(s, root, endpoint, snap, ckpt)
    return ST.read_snapshot(s, snap)


def q_materialized_latest(s, d):
    latest = V.latest_prices(_materialized(s, d, "coin_markets"))
    return ntz(latest.select("coin_id", "current_price_usd", "market_cap_rank", "ingestion_time"))


def q_materialized_ohlc(s, d):
    return ntz(V.ohlc_timeseries(_materialized(s, d, "coin_ohlc")))


def q_materialized_two_writers(s, d):
    """Two writers keep one snapshot: the second merges and commits while the
    first stands before its commit, with parts in common; a third batch follows."""
    ensure_utc(s)
    _, slices = _stream_landing(s, d)
    snap = shared_dir(s, "snapshot")
    half = [slices[0].where(F.hour("ingestion_time") % 2 == i) for i in (0, 1)]
    ST.merge_latest_batch(s, snap, slices[1], "a", 0)
    ST.merge_latest_batch(s, snap, half[0], "a", 1, before_commit=lambda: ST.merge_latest_batch(s, snap, half[1], "b", 0))
    ST.merge_latest_batch(s, snap, slices[2], "b", 1)
    latest = V.latest_prices(ST.read_snapshot(s, snap))
    return ntz(latest.select("coin_id", "current_price_usd", "market_cap_rank", "ingestion_time"))


def q_materialized_daily(s, d):
    """Daily candles kept beside a candle snapshot over three batches."""
    ensure_utc(s)
    _, slices = _stream_landing(s, d, "coin_ohlc")
    snap, daily = shared_dir(s, "snapshot"), shared_dir(s, "daily")
    for i, part in enumerate(slices):
        ST.merge_latest_batch(s, snap, part, "a", i, "coin_ohlc")
        ST.materialize_daily_candles(s, snap, daily)
    return ntz(ST.read_daily_candles(s, daily))


def q_snapshot_parts_left(s, d):
    """Parts of a candle snapshot on disk after old versions were removed: each once, with its rows."""
    ensure_utc(s)
    _, slices = _stream_landing(s, d, "coin_ohlc")
    snap = shared_dir(s, "snapshot")
    for i, part in enumerate(slices):
        ST.merge_latest_batch(s, snap, part, "a", i, "coin_ohlc")
    ST.remove_old_versions(s, snap, keep=1)
    rows = s.read.option("recursiveFileLookup", "true").parquet(f"{snap}/v=*")
    left = rows.select(F.regexp_extract("_metadata.file_path", r"part=([0-9-]+)", 1).cast("date").alias("part"),
                       F.regexp_extract("_metadata.file_path", r"(w=[0-9a-f]+)", 1).alias("w"))
    return left.groupBy("part").agg(F.countDistinct("w").alias("n_copies"), F.count(F.lit(1)).alias("n_rows"))


def q_snapshot_changes(s, d):
    """Change feed of the last of three batches: per coin, what happened and both prices."""
    ensure_utc(s)
    _, slices = _stream_landing(s, d)
    snap = shared_dir(s, "snapshot")
    versions = [ST.merge_latest_batch(s, snap, part, "a", i) for i, part in enumerate(slices)]
    price = [strict_cast(json_value(f"{c}.payload", "$.current_price"), "double").alias(f"{c}_price") for c in ("before", "after")]
    return ST.snapshot_changes(s, snap, versions[1], versions[2]).select("coin_id", "change", *price)


def _materialized_view(name: str) -> Query:
    src, build = V.VIEW_BUILDERS[name]
    return lambda s, d: ntz(build(_materialized(s, d, src)))


def q_incremental_load(s, d):
    ensure_utc(s)
    root, slices = _stream_landing(s, d)
    raw_path, ckpt = shared_dir(s, "raw"), shared_dir(s, "ckpt")
    for part in slices:
        L.write_landing(part, root, "coin_markets")
        ST.incremental_load(s, root, "coin_markets", raw_path, ckpt)
    ST.incremental_load(s, root, "coin_markets", raw_path, ckpt)   # nothing new: adds 0
    return ntz(_market_fields(LD.read_raw(s, raw_path), keep=("dt",)))


# ------------------------------------------------------------ tools (T)
def q_bad_payloads(s, d):
    ev = _events(s, d)
    doc = FX.market_document()
    et, v = F.col("event_type"), F.col("value")
    payload = (F.when((et == "purchase") & (v < 2), F.concat(doc, F.lit(" x")))
                .when((et == "signup") & (v < 2), F.concat(doc, F.lit("}")))
                .when((et == "click") & (v < 2), F.regexp_replace(doc, '"id":"[^"]*",', ""))
                .when((et == "view") & (v < 2), F.regexp_replace(doc, '"current_price":[^,]*', '"current_price":"abc"'))
                .otherwise(doc))
    raw = ev.select(F.col("ts").cast("timestamp").alias("ingestion_time"), payload.alias("payload"))
    # quarantine scans a stored raw table (payload is a column there, not an
    # expression Catalyst would inline into every JSON probe)
    path = shared_dir(s, "raw", "coin_markets")
    LD.append_raw(raw, path)
    return ntz(bad_payloads(LD.read_raw(s, path), numeric_paths=("$.current_price",)))


def q_adhoc_readonly(s, d):
    ensure_utc(s)
    session = A.readonly_session(s, {
        "latest_prices": lambda x: V.latest_prices(FX.raw_markets(x, d)),
        "dim_coin": lambda x: V.dim_coin(FX.raw_metadata(x, d)),
        "ohlc_timeseries": lambda x: V.ohlc_timeseries(FX.raw_ohlc(x, d)),
        "market_global_daily": lambda x: V.market_global_daily(FX.raw_global(x, d)),
    })
    return ntz(A.adhoc_readonly(session, ADHOC_SQL))


QUERIES: dict[str, Query] = {
    # curated views
    "latest_prices": _view("latest_prices"),
    "dim_coin": _view("dim_coin"),
    "ohlc_timeseries": _view("ohlc_timeseries"),
    "market_global_daily": _view("market_global_daily"),
    "trending_latest": q_trending_latest,
    "parametrised_view": q_parametrised_view,
    "materialized_latest": q_materialized_latest,
    "materialized_ohlc": q_materialized_ohlc,
    "materialized_dim": _materialized_view("dim_coin"),
    "materialized_global": _materialized_view("market_global_daily"),
    "materialized_trending": _materialized_view("trending_latest"),
    "materialized_two_writers": q_materialized_two_writers,
    "materialized_daily_candles": q_materialized_daily,
    "snapshot_parts_left": q_snapshot_parts_left,
    "snapshot_changes": q_snapshot_changes,
    # window / functions
    "latest_per_key": q_latest_per_key,
    "json_value": q_json_value,
    "strict_cast": q_strict_cast,
    "safe_timestamp": q_safe_timestamp,
    "string_array": q_string_array,
    "iso_utc": q_iso_utc,
    # shaping, sources, sinks
    "document_rows": q_document_rows,
    "document_items": q_document_items,
    "unwrap_envelope": q_unwrap_envelope,
    "ohlc_rows": q_ohlc_rows,
    "ohlc_quarantine": q_ohlc_quarantine,
    "responses_scan": q_responses_scan,
    "responses_wholetext": q_responses_wholetext,
    "trim_payload": q_trim_payload,
    "ndjson_roundtrip": q_ndjson_roundtrip,
    "landing_path": q_landing_path,
    "landing_counts": q_landing_counts,
    "landed_runs": q_landed_runs,
    "strict_load_report": q_strict_load_report,
    "strict_candle_report": q_strict_candle_report,
    "load_ledger": q_load_ledger,
    "raw_day_counts": q_raw_day_counts,
    "mode_summary": q_mode_summary,
    "ingest_run_summary": q_ingest_run_summary,
    "markets_page": q_markets_page,
    "markets_after": q_markets_after,
    "top_ids": lambda s, d: Q.top_ids(prices(s, d), TOP_N),
    "top_n_candles": q_top_n_candles,
    "top_n_metadata": lambda s, d: ntz(Q.top_n_metadata(prices(s, d), dim(s, d), TOP_N)),
    "replay": q_replay,
    "retention": q_retention,
    "expired_landing": q_expired_landing,
    "incremental_load": q_incremental_load,
    "raw_peek": q_raw_peek,
    # question catalogue
    "top_n_by_rank": lambda s, d: ntz(Q.top_n_by_rank(prices(s, d), TOP_N)),
    "formatted_top": lambda s, d: ntz(Q.formatted_top(prices(s, d), TOP_N)),
    "category_counts": lambda s, d: ntz(Q.category_counts(dim(s, d))),
    "coins_in_category": lambda s, d: ntz(Q.coins_in_category(dim(s, d), CATEGORY)),
    "coin_last_week": lambda s, d: ntz(Q.coin_last_week(ohlc(s, d), LAST_DAYS)),
    "price_range": lambda s, d: ntz(Q.price_range(ohlc(s, d))),
    "price_change": lambda s, d: ntz(Q.price_change(ohlc(s, d))),
    "volatility": lambda s, d: ntz(Q.volatility(ohlc(s, d))),
    "running_high": lambda s, d: ntz(Q.running_high(ohlc(s, d))),
    "drawdown": lambda s, d: ntz(Q.drawdown(ohlc(s, d))),
    "moving_average": lambda s, d: ntz(Q.moving_average(ohlc(s, d))),
    "price_trend": lambda s, d: ntz(Q.price_trend(ohlc(s, d))),
    "daily_candles": lambda s, d: ntz(Q.daily_candles(ohlc(s, d))),
    "dominance_latest": q_dominance_latest,
    "macro_trend": lambda s, d: ntz(Q.macro_trend(global_daily(s, d))),
    "prices_with_dim": lambda s, d: ntz(Q.prices_with_dim(prices(s, d), dim(s, d))),
    "candles_with_dim": lambda s, d: ntz(Q.candles_with_dim(ohlc(s, d), dim(s, d))),
    "volume_by_category": lambda s, d: ntz(Q.volume_by_category(prices(s, d), dim(s, d))),
    "bulk_volume_by_category": q_bulk_volume,
    "category_dominance": lambda s, d: ntz(Q.category_dominance(dim(s, d), prices(s, d))),
    "compare_coins": lambda s, d: ntz(Q.compare_coins(ohlc(s, d))),
    "candle_coverage": lambda s, d: ntz(Q.candle_coverage(ohlc(s, d))),
    "candle_gaps": lambda s, d: ntz(Q.candle_gaps(ohlc(s, d))),
    # agent tools re-aimed as table operators
    "simple_price_rows": q_simple_price_rows,
    "price_lookup": lambda s, d: ntz(Q.price_lookup(prices(s, d), _lookup_requests(s, d))),
    "news_articles": q_news_articles,
    "bad_payloads": q_bad_payloads,
    "adhoc_readonly": q_adhoc_readonly,
}
