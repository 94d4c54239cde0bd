"""Response shaping: API bodies -> raw rows.

Input is a DataFrame of landed response bodies (JSON text), one row per
response, e.g. ``responses(endpoint, coin_id, ingestion_time, run_id, body)``.
Every function is a narrow transformation (explode / from_json / to_json),
so shaping never shuffles and parallelises over all landed bodies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import is_single_json_document, json_kind
from .landing import new_run_id

# Characters of a refused body shown in an error (diagnostics only; data is never cut).
SHOWN = 200
MALFORMED = "malformed JSON document"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ S1
def write_responses(responses: DataFrame, root: str, endpoint: str, keep: tuple[str, ...] = ()) -> None:
    """Land raw API bodies, one response per line, with their request
    context (``keep``: e.g. coin id, request time) as JSON members and the
    UTC day as directory. Bodies are embedded as JSON, not re-encoded."""
    ctx = F.to_json(F.struct(*keep)) if keep else F.lit("{}")
    line = F.concat(ctx.substr(F.lit(1), F.length(ctx) - 1),
                    F.lit(',"body":' if keep else '"body":'), F.col("body"), F.lit("}"))
    (responses.select(line.alias("value"), F.to_date("ingestion_time").alias("dt"))
              .hint("rebalance", "dt")
              .write.mode("append").partitionBy("dt").text(f"{root.rstrip('/')}/{endpoint}"))


def write_response_files(responses: DataFrame, root: str, endpoint: str) -> None:
    """Land raw API bodies as fetched: one file per response, nothing else in
    it, under the UTC day of ``ingestion_time``."""
    (responses.select(F.col("body").alias("value"), F.to_date("ingestion_time").alias("dt"))
              .write.mode("append").option("maxRecordsPerFile", 1).partitionBy("dt").text(f"{root.rstrip('/')}/{endpoint}"))


def read_responses(spark, path: str, context_schema: str = "", wholetext: bool = False) -> DataFrame:
    """Scan landed API bodies — one row per response.

    ``wholetext=True`` reads one response per file (a raw body as fetched;
    Spark packs small files into tasks) with the day of its folder, if any;
    otherwise one response per line as written by ``write_responses``, whose
    context members are typed by ``context_schema`` (DDL) and the body kept
    as JSON text. The source file is kept for lineage.
    """
    if wholetext:
        df = spark.read.text(path, wholetext=True)
        day = [c for c in ("dt",) if c in df.columns]
        return df.select(F.col("_metadata.file_path").alias("source_file"), F.rtrim("value", F.lit("\n")).alias("body"), *day)
    schema = ", ".join(x for x in (context_schema, "body string") if x)
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return df.withColumn("source_file", F.col("_metadata.file_path"))


# ------------------------------------------------------------------ S16
def stamp_run(responses: DataFrame, ts, run_id: str | None = None) -> DataFrame:
    """One time stamp and one run id for every row of a run.

    Both are literals fixed once for the run (never ``uuid()`` or
    ``current_timestamp()`` per row), so a retried task writes the same
    values; without ``run_id`` a random one is drawn.
    """
    return responses.withColumn("ingestion_time", F.lit(ts).cast("timestamp")).withColumn(
        "run_id", F.lit(run_id or new_run_id()))


# ------------------------------------------------------------------ S2
def unwrap_envelope(body: Column | str, member: str) -> Column:
    """``response["data"]`` / ``response["coins"]``: the member as JSON text.

    A body without the member is an error for that response (KeyError in a
    client); ``raise_error`` fires only on the offending row.
    """
    b = _col(body)
    inner = F.get_json_object(b, f"$.{member}")
    has = F.coalesce(F.array_contains(F.json_object_keys(b), member), F.lit(False))
    return F.when(has, inner).otherwise(
        F.raise_error(F.concat(F.lit(f"response has no member '{member}': "), F.substring(b, 1, SHOWN))))


# ------------------------------------------------------------------ S3
def document_items(body: Column | str) -> Column:
    """A JSON list -> its items as JSON text; any other value -> itself.

    ``json_array_length`` is NULL for non-arrays and 0 for ``[]`` (no rows).
    A JSON ``null`` item stays a row with a NULL payload; a string item keeps
    its quotes (items are JSON, so their kind decides, not their text).
    """
    b = _col(body)

    def item(text: Column, value: Column) -> Column:
        quoted = F.to_json(F.array(text))
        return F.when(F.schema_of_variant(value) == "STRING", quoted.substr(F.lit(2), F.length(quoted) - 2)).otherwise(text)

    texts = F.from_json(b, "array<string>")
    items = F.zip_with(texts, F.from_json(b, "array<variant>"), item)
    # no string of the body begins with a brace: items that do are objects, their text is their JSON
    plain = ~F.contains(b, F.lit('"{')) & ~F.contains(b, F.lit("'{")) & ~F.contains(b, F.lit("\\"))
    objects = plain & F.coalesce(F.forall(texts, lambda t: F.coalesce(F.startswith(t, F.lit("{")), F.lit(False))), F.lit(False))
    return F.when(F.json_array_length(b).isNotNull(), F.when(objects, texts).otherwise(items)).otherwise(F.array(b))


def document_rows(responses: DataFrame, body: str = "body", ts: str = "ingestion_time",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """One raw document row ``{ingestion_time, payload}`` per item (S3)."""
    return responses.select(*keep, F.col(ts).alias("ingestion_time"),
                            F.explode(document_items(body)).alias("payload"))


# ------------------------------------------------------------------ S4
def _candle_error(body: Column) -> Column:
    """Why a body is no list of candles; NULL for a good one (``[]`` included)."""
    candles = F.from_json(body, "array<string>")
    bad = F.exists(candles, lambda c: ~F.coalesce(
        (F.json_array_length(c) >= 5)
        & F.forall(F.slice(F.from_json(c, "array<double>"), 1, 5), lambda x: x.isNotNull()), F.lit(False)))
    return (F.when(~is_single_json_document(body), F.lit(MALFORMED))
             .when(body.isNull() | F.json_array_length(body).isNull(), F.lit("not a list of candles"))
             .when(F.json_array_length(body) == 0, F.lit(None).cast("string"))
             .when(candles.isNull() | bad, F.lit("short candle or a figure that is no number")))


def ohlc_rows(responses: DataFrame, body: str = "body", coin: str = "coin_id",
              ts: str = "ingestion_time") -> DataFrame:
    """``[[ms, o, h, l, c], …]`` -> typed candle rows.

    Integers or floats are accepted and extra items ignored. A body that is
    no list of candles (malformed, an error object, a candle of fewer than
    five items, a figure that is no number) fails the job, as it would fail a
    run; ``ohlc_quarantine`` lists such bodies instead. ``open_time`` is
    epoch milliseconds read as a UTC instant.
    """
    # typed once; a body whose candles all have their figures is good, the others are looked into
    b, typed = F.col("__body"), F.col("__typed")
    whole = F.forall(typed, lambda c: F.coalesce(sum((F.get(c, F.lit(i)).isNotNull().cast("int") for i in range(5)), F.lit(0)) == 5,
                                                 F.lit(False)))
    error = F.when(F.coalesce(whole, F.lit(False)) & is_single_json_document(b), F.lit(None)).otherwise(_candle_error(b))
    good = F.when(error.isNotNull(), F.raise_error(F.concat(
        F.lit("candles of coin "), F.coalesce(F.col("coin_id"), F.lit("?")), F.lit(": "), error, F.lit(": "),
        F.coalesce(F.substring(b, 1, SHOWN), F.lit("null"))))).otherwise(typed)
    c = F.col("__c")
    return (responses.select(F.col(ts).alias("ingestion_time"), F.col(coin).alias("coin_id"), F.col(body).alias("__body"),
                             F.from_json(F.col(body), "array<array<double>>").alias("__typed"))
                     .select("ingestion_time", "coin_id", F.explode(good).alias("__c"))
                     .select("ingestion_time", "coin_id", F.timestamp_millis(c[0].cast("bigint")).alias("open_time"),
                             c[1].alias("open"), c[2].alias("high"), c[3].alias("low"), c[4].alias("close")))


def ohlc_quarantine(responses: DataFrame, body: str = "body", coin: str = "coin_id",
                    ts: str = "ingestion_time") -> tuple[DataFrame, DataFrame]:
    """(candle rows of the good bodies, rows (ingestion_time, coin_id, error) of the others)."""
    marked = responses.withColumn("error", _candle_error(F.col(body)))
    bad = marked.where("error is not null").select(F.col(ts).alias("ingestion_time"), F.col(coin).alias("coin_id"), "error")
    return ohlc_rows(marked.where("error is null"), body, coin, ts), bad


# ------------------------------------------------------------------ S6
def to_ndjson_lines(df: DataFrame) -> DataFrame:
    """Compact JSON per row with null fields kept (one ``value`` per line).

    Writing the result with ``.write.text`` gives NDJSON; an empty input
    gives no lines (and callers write no file at all, S8).
    """
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


# ------------------------------------------------------------------ S15
def trim_documents(rows: DataFrame, keep: tuple[str, ...], payload: str = "payload") -> DataFrame:
    """``rows`` with the payload rebuilt from the wanted top-level members.

    The metadata call turns off the large subtrees (localization, tickers,
    market data, …); on landed full documents the same is a projection.
    Member text is kept as landed (numbers are not re-typed); strings are
    re-quoted, missing members stay missing, JSON null stays null. The
    document is parsed once for the kinds of its members and once, narrowly,
    for their text; the subtrees that go are never built.
    """
    narrow = ", ".join(f"`{k}` string" for k in keep)
    x = rows.withColumn("__v", F.try_parse_json(payload)).withColumn("__m", F.from_json(payload, narrow))
    parts = []
    for k in keep:
        raw = F.col("__m")[k]
        kind = F.schema_of_variant(F.try_variant_get("__v", f"$.{k}", "variant"))
        quoted = F.to_json(F.array(raw))
        as_json = (F.when(kind == "VOID", F.lit("null"))
                    .when(kind == "STRING", quoted.substr(F.lit(2), F.length(quoted) - 2))
                    .otherwise(raw))
        key = F.to_json(F.array(F.lit(k)))
        parts.append(F.when(kind.isNotNull(), F.concat(key.substr(F.lit(2), F.length(key) - 2), F.lit(":"), as_json)))
    is_object = F.schema_of_variant("__v").startswith("OBJECT")
    trimmed = F.when(is_object, F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")))
    return x.withColumn(payload, trimmed).drop("__v", "__m")


# ------------------------------------------------------------- T1, T3, T4
def _body_error(body: Column) -> Column:
    """A body that is no answer: malformed text, or an object with an ``error`` member; else NULL."""
    return (F.when(~is_single_json_document(body), F.lit(MALFORMED))
             .otherwise(F.get_json_object(body, "$.error")))


NOT_A_NUMBER = "not a number"
_NUMBER_KINDS = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL|TINYINT|SMALLINT|INT)"


def simple_price_rows(responses: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Live-price body ``{coin: {metric: number}}`` -> (coin_id, metric, value).

    Several currencies come as metric names (``usd``, ``usd_market_cap``,
    ``eur_24h_vol`` …); they are split into currency and measure. Failures are
    values: a failed answer is one row with ``error`` and nothing else, a coin
    without figures one row with its ``coin_id``, a figure that is no number a
    row with its coin and metric; all other figures of the answer stay. A JSON
    null is a figure without value. Each body is read once.
    """
    b = F.col(body)
    coins = F.from_json(b, "map<string,string>")
    error = F.coalesce(_body_error(b), F.when(F.json_object_keys(b).isNull() | coins.isNull(), F.lit("not a price object")))
    none = F.lit(None).cast("string")

    def row(coin: Column, metric: Column, value: Column, why: Column) -> Column:
        return F.struct(coin.alias("coin_id"), metric.alias("metric"), value.cast("double").alias("value"), why.alias("error"))

    def figures(coin: Column) -> Column:
        def figure(entry: Column) -> Column:
            kind = F.schema_of_variant(entry["value"])
            number = kind.rlike(_NUMBER_KINDS)
            value = F.when(number, F.try_variant_get(entry["value"], "$", "double"))
            return row(coin["key"], entry["key"], value, F.when(~number & (kind != "VOID"), F.lit(NOT_A_NUMBER)))

        metrics = F.when(F.json_object_keys(coin["value"]).isNotNull(), F.from_json(coin["value"], "map<string,variant>"))
        return F.coalesce(F.transform(F.map_entries(metrics), figure),
                          F.array(row(coin["key"], none, F.lit(None), F.lit("not an object of figures"))))

    rows = F.when(error.isNotNull(), F.array(row(none, none, F.lit(None), error))).otherwise(
        F.flatten(F.transform(F.map_entries(coins), figures)))
    x = responses.select(*keep, F.explode(rows).alias("__r")).select(*keep, "__r.*")
    cur = F.split(F.col("metric"), "_", 2)
    measure = F.when(F.col("metric").isNotNull(), F.coalesce(F.get(cur, 1), F.lit("price")))
    return x.select(*keep, "coin_id", "metric", cur[0].alias("currency"), measure.alias("measure"), "value", "error")


NOT_AN_ARTICLE = "not an article"


def news_articles(responses: DataFrame, per_page: int | None = 5, body: str = "body",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """News body -> its first ``per_page`` articles (None: all) per response.

    The body is a list or ``{"data": [...]}`` (absent -> no articles).
    ``source`` is ``news_site`` or else ``author``; empty text counts as
    absent, as Python's ``or`` does. Failures are values: a failed answer, or
    one whose ``data`` is no list, is one row with ``error`` and nothing else;
    an item that is no object is a row with its position, and its siblings
    stay. Each body is read once.
    """
    b = F.col(body)
    data = F.get_json_object(b, "$.data")
    listed = F.when(F.substring(data, 1, 1) == "[", json_kind(b, "$.data").startswith("ARRAY"))
    wrong = F.array_contains(F.json_object_keys(b), "data") & ~F.coalesce(listed, F.lit(False))
    error = F.coalesce(_body_error(b),
                       F.when(F.json_array_length(b).isNull() & F.json_object_keys(b).isNull(), F.lit("neither a list nor an object"))
                        .when(wrong, F.lit("data is no list")))
    text = F.when(F.json_array_length(b).isNotNull(), b).otherwise(data)
    items = F.when(text.isNotNull(), document_items(text))
    if per_page is not None:
        items = F.slice(items, 1, int(per_page))

    def row(pos: Column, article: Column, why: Column) -> Column:
        return F.struct(pos.cast("int").alias("pos"), article.cast("string").alias("article"), why.alias("error"))

    rows = F.when(error.isNotNull(), F.array(row(F.lit(None), F.lit(None), error))).otherwise(F.transform(
        items, lambda a, i: row(i, a, F.when(F.json_object_keys(a).isNull(), F.lit(NOT_AN_ARTICLE)))))
    x = responses.select(*keep, F.explode(rows).alias("__r")).select(*keep, "__r.*")
    a = F.when(F.col("error").isNull(), F.col("article"))

    def member(name: str) -> Column:
        return F.get_json_object(a, f"$.{name}")

    def present(c: Column) -> Column:
        return F.when(c != "", c)

    return x.select(*keep, "pos", *[member(n).alias(n) for n in ("title", "description", "url", "published_at")],
                    F.coalesce(present(member("news_site")), present(member("author"))).alias("source"), "error")
