"""A run as a unit: one name, one folder, one load, however often it is tried."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tessera.plans import curated
from tessera.sources import landing as L
from tessera.sources import load as LD
from tessera.sources.ingest import ingest_run

AT = dt.datetime(2031, 3, 9, 7, 45, 30, tzinfo=dt.timezone.utc)
STAMP = "20310309T074530"


def answers(spark, coins=("kelp", "moss", "fern", "reed")):
    def frame(rows, schema="body string"):
        return spark.createDataFrame(rows, schema)

    return {
        "coin_markets": frame([(json.dumps([{"id": c, "current_price": i + 0.5} for i, c in enumerate(coins)]),)]),
        "market_global": frame([('{"data":{"active_cryptocurrencies":17}}',)]),
        "trending": frame([('{"coins":[]}',)]),
        "coin_ohlc": frame([(c, f"[[1930809600000,1,2,0.5,{i}],[1930824000000,1,2,0.5,{i}]]") for i, c in enumerate(coins)],
                           "coin_id string, body string"),
        "coin_metadata": frame([(json.dumps({"id": c, "categories": ["green"]}),) for c in coins]),
    }


def folders(root):
    return {e: str(root / e) for e in ("land", "raw")}


def test_all_endpoints_of_a_mode_report_rows_and_uris(spark, tmp_path):
    at = folders(tmp_path)
    run = ingest_run(spark, answers(spark), "all", AT, at["land"], at["raw"], "r-1")
    assert run.rows == {"coin_markets": 4, "market_global": 1, "trending": 0, "coin_ohlc": 8, "coin_metadata": 4}
    assert run.run == f"{STAMP}_r-1" and set(run.uris) == {e for e, n in run.rows.items() if n}
    for endpoint, uri in run.uris.items():
        assert uri.endswith(f"/{endpoint}/dt=2031-03-09/run={STAMP}_r-1") and spark.read.text(uri).count() == run.rows[endpoint]
    assert not (tmp_path / "raw" / "trending").exists() and not L.paths(spark, f"{at['land']}/trending/dt=*")


def test_a_retry_of_a_run_doubles_nothing(spark, tmp_path):
    at = folders(tmp_path)
    for _ in range(3):
        run = ingest_run(spark, answers(spark), "hourly", AT, at["land"], at["raw"], "r-1")
    other = ingest_run(spark, answers(spark, ("kelp",)), "hourly", AT, at["land"], at["raw"])      # the same second, another run
    assert other.run_id != run.run_id
    raw = LD.read_raw(spark, f"{at['raw']}/coin_markets")
    assert raw.count() == 5 and L.replay(spark, at["land"], "coin_markets").count() == 5
    assert LD.rebuild_raw(spark, at["land"], "coin_markets", f"{at['raw']}/coin_markets") == 5
    assert {r["coin_id"] for r in curated.latest_prices(LD.read_raw(spark, f"{at['raw']}/coin_markets")).collect()} == {
        "kelp", "moss", "fern", "reed"}
    days = {str(r["dt"]): (r["n_rows"], r["n_runs"]) for r in L.landing_inventory(spark, at["land"], "coin_markets").collect()}
    assert days == {"2031-03-09": (5, 2)}


def test_the_daily_endpoints_are_restricted_to_the_given_ids(spark, tmp_path):
    at = folders(tmp_path)
    ids = spark.createDataFrame([("moss",), ("reed",)], "coin_id string")
    run = ingest_run(spark, answers(spark), "all", AT, at["land"], at["raw"], ids=ids)
    assert run.rows["coin_markets"] == 4 and run.rows["coin_ohlc"] == 4 and run.rows["coin_metadata"] == 2
    got = LD.read_raw(spark, f"{at['raw']}/coin_ohlc").select("coin_id").distinct().collect()
    assert {r[0] for r in got} == {"moss", "reed"}


@pytest.mark.parametrize("endpoint,body,match", [("market_global", '{"status":"closed"}', "no member"),
                                                 ("coin_markets", "[{]", "refused"), ("coin_ohlc", '{"error":"x"}', "candles of coin")])
def test_a_bad_answer_fails_the_run_and_loads_nothing(spark, tmp_path, endpoint, body, match):
    at = folders(tmp_path)
    bad = spark.createDataFrame([("kelp", body)], "coin_id string, body string")
    with pytest.raises(Exception, match=match):
        ingest_run(spark, {endpoint: bad}, "all", AT, at["land"], at["raw"])
    assert not L.paths(spark, f"{at['raw']}/{endpoint}/dt=*")


def test_a_run_over_several_days(spark, tmp_path):
    rows = spark.range(48).select(F.timestamp_seconds(F.lit(1930780800) + F.col("id") * 3600).alias("ingestion_time"),
                                  F.lit("{}").alias("payload"))
    run = L.land_run(rows, str(tmp_path), "coin_markets", "one")
    assert run.rows == 48 and "dt=*" in run.uri and spark.read.text(run.uri).count() == 48
    gone = L.expire_landing(spark, str(tmp_path), "coin_markets", 1)
    left = [r["dt"] for r in L.landed_days(spark, str(tmp_path), "coin_markets").collect()]
    assert len(gone) >= 1 and len(left) == 1 and str(left[0]) > max(gone)
