"""Landing, strict load, replay, retention, modes and incremental loads."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tessera.operators.latest import latest_by
from tessera.functions.json import json_value
from tessera.sources import landing as L
from tessera.sources import load as LD
from tessera.streaming import incremental as ST

T0 = dt.datetime(2026, 6, 26, 12, 0, 0)


def _docs(spark, n, start=T0, hours=1):
    rows = [(start + dt.timedelta(hours=hours * i), json.dumps({"id": f"c{i % 3}", "current_price": i}, separators=(",", ":")))
            for i in range(n)]
    return spark.createDataFrame(rows, "ingestion_time timestamp, payload string")


def test_landing_path_layout(spark):
    df = spark.createDataFrame([(T0,)], "ts timestamp")
    assert df.select(L.landing_path("coin_markets", "ts", F.lit("ab12cd34"))).first()[0] == \
        "coin_markets/dt=2026-06-26/20260626T120000_ab12cd34.ndjson"


def test_empty_batch_writes_no_object(spark, tmp_path):
    assert L.write_landing(spark.createDataFrame([], "ingestion_time timestamp, payload string"),
                           str(tmp_path), "trending") == 0
    assert not [p for p in tmp_path.rglob("*") if p.is_file() and not p.name.startswith(("_", "."))]
    assert L.write_landing(_docs(spark, 3), str(tmp_path), "trending") == 3


def test_replay_equals_appended_rows(spark, tmp_path):
    docs = _docs(spark, 50)
    L.write_landing(docs, str(tmp_path), "coin_markets")
    back = L.replay(spark, str(tmp_path), "coin_markets").select("ingestion_time", "payload")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, docs.collect()))


def test_candle_landing_roundtrip(spark, tmp_path):
    rows = spark.createDataFrame([(T0, "b", T0, 1.0, 2.0, 0.5, None)],
                                 "ingestion_time timestamp, coin_id string, open_time timestamp, open double, "
                                 "high double, low double, close double")
    L.write_landing(rows, str(tmp_path), "coin_ohlc")
    back = L.replay(spark, str(tmp_path), "coin_ohlc").drop("dt").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in rows.collect()]


def test_retention_keeps_newest_days(spark):
    parts = spark.createDataFrame([(dt.date(2026, 6, d), 1) for d in range(1, 21)], "dt date, n_rows int")
    kept = [r["dt"].day for r in L.retention(parts, 10).where("action = 'keep'").collect()]
    assert sorted(kept) == list(range(11, 21))
    assert L.retention(parts, 0).where("action = 'expire'").count() == 0


def _lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


GOOD = '{"ingestion_time":"2026-06-26T12:00:00+00:00","payload":{"id":"x"}}'


def test_strict_load_report_counts_each_defect(spark):
    lines = _lines(spark, [GOOD, '{"ingestion_time":"2026-06-26T12:00:00+00:00","payload":{},"extra":1}',
                           '{"payload":{"id":"y"}}', GOOD + " x"])
    r = LD.strict_load_report(lines, "coin_markets").first()
    assert (r["n_rows"], r["n_unknown_field"], r["n_missing_required"], r["n_malformed"], r["accepted"]) == \
        (4, 1, 1, 1, False)
    assert LD.strict_load_report(_lines(spark, [GOOD]), "coin_markets").first()["accepted"] is True


def test_strict_load_refuses_whole_batch(spark, tmp_path):
    src = tmp_path / "in"
    _lines(spark, [GOOD, '{"payload":{}}']).write.text(str(src))
    with pytest.raises(Exception, match="refused"):
        LD.load_ndjson(spark, str(src), "coin_markets", str(tmp_path / "raw"))
    assert not (tmp_path / "raw").exists() or not list((tmp_path / "raw").rglob("*.parquet"))
    ok = tmp_path / "ok"
    _lines(spark, [GOOD, GOOD]).write.text(str(ok))
    assert LD.load_ndjson(spark, str(ok), "coin_markets", str(tmp_path / "raw")) == 2
    assert LD.read_raw(spark, str(tmp_path / "raw")).columns == ["ingestion_time", "payload", "dt"]


def test_mode_summary_expected_endpoints_and_zero(spark):
    one = _docs(spark, 2)
    raw = {"coin_markets": one, "market_global": one, "trending": one.limit(0),
           "coin_ohlc": one, "coin_metadata": one}
    hourly = {(r["endpoint"], r["rows"]) for r in LD.mode_summary(raw, "hourly").collect()}
    assert hourly == {("coin_markets", 2), ("market_global", 2), ("trending", 0)}
    assert {r["endpoint"] for r in LD.mode_summary(raw, "daily").collect()} == {"coin_ohlc", "coin_metadata"}


def test_incremental_load_second_run_adds_nothing(spark, tmp_path):
    land, raw, ck = str(tmp_path / "land"), str(tmp_path / "raw"), str(tmp_path / "ck")
    L.write_landing(_docs(spark, 10), land, "coin_markets")
    assert ST.incremental_load(spark, land, "coin_markets", raw, ck) == 10
    assert ST.incremental_load(spark, land, "coin_markets", raw, ck) == 0
    L.write_landing(_docs(spark, 5, start=T0 + dt.timedelta(days=2)), land, "coin_markets")
    assert ST.incremental_load(spark, land, "coin_markets", raw, ck) == 5
    assert spark.read.parquet(raw).count() == 15


def test_materialized_latest_equals_full_recompute(spark, tmp_path):
    land, snap, ck = str(tmp_path / "land"), str(tmp_path / "snap"), str(tmp_path / "ck")
    all_docs = []
    for k in range(3):
        part = _docs(spark, 7, start=T0 + dt.timedelta(days=k))
        all_docs.append(part)
        L.write_landing(part, land, "coin_markets")
        ST.materialize_latest(spark, land, "coin_markets", snap, ck)
    full = all_docs[0].unionByName(all_docs[1]).unionByName(all_docs[2]) \
        .select(json_value("payload", "$.id").alias("coin_id"), "ingestion_time", "payload")
    expect = latest_by(full, ["coin_id"], [F.desc("ingestion_time")], [F.desc("payload")])
    got = ST.read_snapshot(spark, snap).select("coin_id", "ingestion_time", "payload")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expect.collect()))


def test_latest_is_idempotent(spark):
    docs = _docs(spark, 9).select(json_value("payload", "$.id").alias("coin_id"), "ingestion_time", "payload")
    once = latest_by(docs, ["coin_id"], [F.desc("ingestion_time")], [F.desc("payload")])
    twice = latest_by(once, ["coin_id"], [F.desc("ingestion_time")], [F.desc("payload")])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_candle_snapshot_rewrites_only_touched_days(spark, tmp_path):
    land, snap, ck = str(tmp_path / "land"), str(tmp_path / "snap"), str(tmp_path / "ck")

    def candles(day, close):
        t = dt.datetime(2026, 6, day, 4, 0)
        return spark.createDataFrame([(t + dt.timedelta(hours=20), "btc", t, 1.0, 2.0, 0.5, close)],
                                     "ingestion_time timestamp, coin_id string, open_time timestamp, "
                                     "open double, high double, low double, close double")

    L.write_landing(candles(1, 1.0).unionByName(candles(2, 2.0)), land, "coin_ohlc")
    ST.materialize_latest(spark, land, "coin_ohlc", snap, ck)
    L.write_landing(candles(3, 3.0), land, "coin_ohlc")
    v = ST.materialize_latest(spark, land, "coin_ohlc", snap, ck)
    manifest = ST.snapshot_parts(spark, snap)
    assert manifest["2026-06-03"] == v and manifest["2026-06-01"] < v and manifest["2026-06-02"] < v
    closes = sorted(r["close"] for r in ST.read_snapshot(spark, snap).collect())
    assert closes == [1.0, 2.0, 3.0]


def test_scratch_space_lives_under_the_checkpoint_dir(spark):
    from tessera.session import shared_dir

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    p = shared_dir(spark, "probe")
    assert base and p.replace("file:", "").startswith(base.replace("file:", "").rstrip("/"))
    assert p != shared_dir(spark, "probe")          # a fresh folder per call


def test_landing_has_one_directory_per_utc_day(spark, tmp_path):
    n = L.write_landing(_docs(spark, 60, hours=2), str(tmp_path), "coin_markets")   # 5 days of runs
    days = sorted(p.name for p in (tmp_path / "coin_markets").iterdir() if p.name.startswith("dt="))
    assert n == 60 and days == [f"dt=2026-06-{d}" for d in range(26, 31)] + ["dt=2026-07-01"]


# ------------------------------------------------------------ nothing is lost in streams and snapshots
def test_a_file_older_than_any_other_is_loaded(spark, tmp_path):
    import os

    land, raw, ck = str(tmp_path / "land"), str(tmp_path / "raw"), str(tmp_path / "ck")
    L.land_run(_docs(spark, 4), land, "coin_markets", "new")
    assert ST.incremental_load(spark, land, "coin_markets", raw, ck) == 4
    L.land_run(_docs(spark, 3, start=T0 - dt.timedelta(days=90)), land, "coin_markets", "old")
    for f in (tmp_path / "land").rglob("run=old/*"):
        os.utime(f, (10 ** 9, 10 ** 9))                    # years before the newest file
    assert ST.incremental_load(spark, land, "coin_markets", raw, ck) == 3


def test_every_trigger_counts(spark, tmp_path):
    land, raw, ck = str(tmp_path / "land"), str(tmp_path / "raw"), str(tmp_path / "ck")
    for i in range(5):
        L.land_run(_docs(spark, 1, start=T0 + dt.timedelta(hours=i)).coalesce(1), land, "coin_markets", f"r{i}")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        assert ST.incremental_load(spark, land, "coin_markets", raw, ck, max_files_per_trigger=1) == 5
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_batch_and_stream_writers_see_each_other(spark, tmp_path):
    land, raw, ck = str(tmp_path / "land"), str(tmp_path / "raw"), str(tmp_path / "ck")
    L.land_run(_docs(spark, 2), land, "coin_markets")
    ST.incremental_load(spark, land, "coin_markets", raw, ck)
    LD.append_raw(_docs(spark, 3, start=T0 + dt.timedelta(days=1)), raw)
    assert LD.read_raw(spark, raw).count() == 5


def _slices(endpoint, spark):
    def documents(day, ids):
        t = T0 + dt.timedelta(days=day)
        doc = {"trending": lambda c: {"item": {"id": c, "name": c, "market_cap_rank": 1, "score": 0.5}},
               "market_global": lambda c: {"active_cryptocurrencies": len(c) + day}}.get(
                   endpoint, lambda c: {"id": c, "current_price": day, "categories": [c]})
        return [(t, json.dumps(doc(c))) for c in ids]

    if endpoint == "coin_ohlc":
        def rows(day, ids):
            t = T0 + dt.timedelta(days=day)
            return [(t, c, t - dt.timedelta(days=k), 1.0, 2.0, 0.5, float(day)) for c in ids for k in (0, 1)]
        schema = "ingestion_time timestamp, coin_id string, open_time timestamp, open double, high double, low double, close double"
    else:
        rows, schema = documents, "ingestion_time timestamp, payload string"
    return [spark.createDataFrame(rows(d, ids), schema) for d, ids in ((0, ["a", "bb", "ccc"]), (1, ["bb"]), (33, ["ccc", "dddd"]))]


@pytest.mark.parametrize("endpoint", ["coin_markets", "coin_metadata", "market_global", "trending", "coin_ohlc"])
def test_snapshot_equals_recompute_and_outlives_its_checkpoint(spark, tmp_path, endpoint):
    from tessera.plans import curated

    view = next(b for src, b in curated.VIEW_BUILDERS.values() if src == endpoint)
    land, snap = str(tmp_path / "land"), str(tmp_path / "snap")
    parts = _slices(endpoint, spark)
    for i, part in enumerate(parts):
        L.land_run(part, land, endpoint, f"r{i}")
        # the third run has lost its checkpoint: it reads everything again, with batch ids from 0
        ST.materialize_latest(spark, land, endpoint, snap, str(tmp_path / ("ck" if i < 2 else "new-ck")))
        seen = [p.withColumn("dt", F.to_date("ingestion_time")) for p in parts[:i + 1]]
        full = seen[0]
        for p in seen[1:]:
            full = full.unionByName(p)
        assert sorted(map(str, view(ST.read_snapshot(spark, snap)).collect())) == sorted(map(str, view(full).collect()))


def test_an_uncommitted_version_is_not_seen_and_a_broken_one_is_an_error(spark, tmp_path):
    land, snap, ck = str(tmp_path / "land"), str(tmp_path / "snap"), str(tmp_path / "ck")
    assert ST.current_version(spark, snap) is None and ST.read_snapshot(spark, snap) is None
    L.land_run(_docs(spark, 6), land, "coin_markets", "a")
    v = ST.materialize_latest(spark, land, "coin_markets", snap, ck)
    before = sorted(map(str, ST.read_snapshot(spark, snap).collect()))
    torn = tmp_path / "snap" / "_manifest" / f"v={v + 1:010d}"
    torn.mkdir()
    (torn / "part-0.json").write_text('{"kind":"part"')            # a crash while the next manifest was written
    assert ST.current_version(spark, snap) == v and sorted(map(str, ST.read_snapshot(spark, snap).collect())) == before
    L.land_run(_docs(spark, 2, start=T0 + dt.timedelta(days=4)), land, "coin_markets", "b")
    assert ST.materialize_latest(spark, land, "coin_markets", snap, ck) == v + 1
    assert ST.read_snapshot(spark, snap).count() == 3
    import shutil

    shutil.rmtree(tmp_path / "snap" / f"v={v + 1:010d}")          # data gone: never taken for an empty snapshot
    with pytest.raises(Exception):
        ST.read_snapshot(spark, snap).collect()


@pytest.mark.parametrize("line,column", [
    ('{"ingestion_time":"soon","coin_id":"a","open_time":"2026-06-26T12:00:00+00:00"}', "n_bad_type"),
    ('{"ingestion_time":"2026-06-26T12:00:00+00:00","coin_id":"a","open_time":"2026-06-26T12:00:00+00:00","open":"abc"}', "n_bad_type"),
    ('{"ingestion_time":"2026-06-26T12:00:00+00:00","coin_id":"a","open":1}', "n_missing_required"),
    ('{"ingestion_time":"2026-06-26T12:00:00+00:00","coin_id":"a","open_time":"2026-06-26T12:00:00+00:00","v":1}', "n_unknown_field"),
])
def test_strict_means_types_too(spark, tmp_path, line, column):
    good = '{"ingestion_time":"2026-06-26T12:00:00+00:00","coin_id":"a","open_time":"2026-06-26T12:00:00+00:00","open":null,"close":2}'
    r = LD.strict_load_report(_lines(spark, [good, line]), "coin_ohlc").first()
    assert r[column] == 1 and not r["accepted"]
    assert LD.strict_load_report(_lines(spark, [good]), "coin_ohlc").first()["accepted"]
    _lines(spark, [good, line]).write.text(str(tmp_path / "in"))
    with pytest.raises(Exception, match="refused"):
        LD.load_ndjson(spark, str(tmp_path / "in"), "coin_ohlc", str(tmp_path / "raw"))


def test_carry_of_a_series_with_a_null_key(spark):
    from tessera.operators.series import previous_value

    rows = [(None, T0 + dt.timedelta(days=i), float(i)) for i in range(3)] + [("a", T0 + dt.timedelta(days=i), 10.0 * i) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    got = sorted(((r["k"] or "", r["v"], r["p"]) for r in previous_value(df, ["k"], "t", "v", "p").collect()))
    assert got == [("", 0.0, None), ("", 1.0, 0.0), ("", 2.0, 1.0), ("a", 0.0, None), ("a", 10.0, 0.0), ("a", 20.0, 10.0)]


def test_a_repeated_category_counts_once(spark):
    from tessera.plans import questions as Q

    dim = spark.createDataFrame([("a", ["x", "x", "y"]), ("b", ["x"])], "coin_id string, categories array<string>")
    prices = spark.createDataFrame([("a", 5.0, 10.0), ("b", 1.0, 2.0)], "coin_id string, market_cap_usd double, total_volume_usd double")
    assert {tuple(r) for r in Q.volume_by_category(prices, dim).collect()} == {("x", 2, 12.0), ("y", 1, 10.0)}
    assert {tuple(r) for r in Q.category_dominance(dim, prices).collect()} == {("x", 2, 6.0, 1.0), ("y", 1, 5.0, 0.5)}
    assert {tuple(r) for r in Q.category_counts(dim).collect()} == {("x", 2), ("y", 1)}
