"""One ingestion run: shape -> land -> strict load, per endpoint of a mode.

The caller hands over the run's API responses per endpoint (bodies already
landed or fetched elsewhere); the run stamps them with one time and run id
(S16), shapes them into raw rows (S3/S4), writes them once into the run's own
folder of the landing zone (S8) and strictly loads exactly that folder into
the day-partitioned raw table (S9/S10). Endpoints without rows report 0 and
load nothing. A retry with the same run id replaces the run's folder and its
part of the raw table, so nothing is doubled and nothing of the first attempt
stays, an endpoint that is now empty included. Rows are counted from the
loaded files' footers. The loop runs over at most five
endpoints on the driver; all row work is Spark's.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.json import json_value
from .landing import drop_run, land_run, new_run_id, run_name
from .load import drop_load, load_ndjson
from .schemas import MODES, OHLC_TABLE
from .shape import document_rows, ohlc_rows, stamp_run, unwrap_envelope

# The envelope member of the endpoints that wrap their answer.
ENVELOPES = {"market_global": "data", "trending": "coins"}


@dataclass
class RunResult:
    """What a run did: its id and name, rows and landing URI per endpoint."""

    run_id: str
    run: str
    rows: dict[str, int] = field(default_factory=dict)
    uris: dict[str, str] = field(default_factory=dict)


def shape_endpoint(responses: DataFrame, endpoint: str) -> DataFrame:
    """Raw rows of one endpoint from its stamped responses (``body`` JSON)."""
    if endpoint == OHLC_TABLE:
        return ohlc_rows(responses)
    member = ENVELOPES.get(endpoint)
    src = responses if member is None else responses.withColumn("body", unwrap_envelope("body", member))
    return document_rows(src)


def _restricted(responses: DataFrame, endpoint: str, ids: DataFrame | None) -> DataFrame:
    """The daily endpoints' responses of the coins in ``ids``."""
    if ids is None or endpoint not in MODES["daily"]:
        return responses
    if endpoint == OHLC_TABLE:
        return responses.join(ids, "coin_id", "left_semi")
    marked = responses.withColumn("__id", json_value("body", "$.id"))
    return marked.join(ids.withColumnRenamed("coin_id", "__id"), "__id", "left_semi").drop("__id")


def ingest_run(spark: SparkSession, responses: dict[str, DataFrame], mode: str, ts: dt.datetime,
               landing_root: str, raw_root: str, run_id: str | None = None,
               ids: DataFrame | None = None) -> RunResult:
    """Run ``mode`` over the given responses.

    ``responses[endpoint]`` has a ``body`` column (and ``coin_id`` for the
    candle endpoint). Missing endpoints count as empty. ``ids`` (a
    ``coin_id`` column, e.g. ``questions.top_ids``) restricts the daily
    endpoints, candles and metadata alike.
    """
    run_id = run_id or new_run_id()
    result = RunResult(run_id, run_name(ts, run_id))
    for endpoint in MODES[mode]:
        src, raw_path = responses.get(endpoint), f"{raw_root.rstrip('/')}/{endpoint}"
        result.rows[endpoint] = 0
        if src is None:
            drop_run(spark, landing_root, endpoint, result.run)
        else:
            rows = shape_endpoint(stamp_run(_restricted(src, endpoint, ids), ts, run_id), endpoint).drop("run_id")
            landed = land_run(rows, landing_root, endpoint, result.run, count=False)
            if landed.uri:
                result.uris[endpoint] = landed.uri
                result.rows[endpoint] = load_ndjson(spark, landed.uri, endpoint, raw_path, result.run)
                continue
        drop_load(spark, raw_path, result.run)                           # an earlier attempt may have had rows
    return result
