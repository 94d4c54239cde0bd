"""Incremental loads with Structured Streaming.

A file-stream source over the landing zone plays the scheduled job: every
trigger picks up only files it has not seen (tracked in the checkpoint),
checks each of them strictly, loads the good ones and names the others in a
ledger: a bad file costs its own rows and never stops a later run. ``trigger(availableNow=True)``
processes the backlog and stops, so a scheduler can run it like a batch job;
a second run without new files adds nothing.

Sinks are idempotent: a micro-batch is named by its query's id (kept in the
checkpoint, new with a new checkpoint) and its batch id. A raw load of that
name replaces itself; a snapshot remembers the newest batch of each query
that it holds. A file's age never matters: old files that are copied in late
are loaded like any other. Several writers may keep one snapshot: a version is
committed by creating its manifest where there is none, and who comes second
merges the parts that changed meanwhile once more.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import json_value
from ..operators.latest import latest_by
from ..operators.series import resample_daily
from ..sources.files import delete, paths, rename_new
from ..sources.load import commit_ledger, judge_files, load_files
from ..sources.schemas import RAW_SCHEMAS

# Backlog is consumed in bounded micro-batches (availableNow honours it).
MAX_FILES_PER_TRIGGER = 1000
# Longer than any file is old: the source must not skip late or back-filled files.
MAX_FILE_AGE = "365000d"


def _landing_stream(spark: SparkSession, landing_root: str, endpoint: str,
                    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> DataFrame:
    reader = (spark.readStream.format("text").option("recursiveFileLookup", "true")
              .option("maxFileAge", MAX_FILE_AGE))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(f"{landing_root.rstrip('/')}/{endpoint}")
    return lines.select("value", F.col("_metadata.file_path").alias("file"))


def _run_batches(rows: DataFrame, checkpoint: str, apply) -> None:
    """Run ``apply(batch, query id, batch id)`` over the backlog."""
    started, query = threading.Event(), []

    def each(df: DataFrame, batch_id: int) -> None:
        started.wait()
        apply(df, query[0].id, batch_id)

    q = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.append(q)
    started.set()
    q.awaitTermination()


def incremental_load(spark: SparkSession, landing_root: str, endpoint: str, raw_path: str,
                     checkpoint: str, max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                     ledger: str | None = None) -> int:
    """Load every not-yet-loaded landed file into the raw table.

    Returns the rows this run committed (0 when nothing is new). The file is
    the unit of refusal (``load.load_files``): refused files and why are in
    the ledger beside the raw table, the others of their batch are loaded. The
    ledger also keeps a stream that has lost its checkpoint from loading
    files again.
    """
    total = [0]

    def apply(df: DataFrame, query_id: str, batch_id: int) -> None:
        total[0] += load_files(df, endpoint, raw_path, f"stream-{query_id}-{batch_id:010d}", ledger).rows

    _run_batches(_landing_stream(spark, landing_root, endpoint, max_files_per_trigger), checkpoint, apply)
    return total[0]


# ------------------------------------------------------------------ V6
# Business key and tie-break of each raw table (the curated
# views' partitioning). Trending has none: its view shows the newest run.
SNAPSHOT_KEYS = {
    "coin_markets": (("coin_id",), ("payload",)),
    "coin_metadata": (("coin_id",), ("payload",)),
    "market_global": (("dt",), ("payload",)),
    "coin_ohlc": (("coin_id", "open_time"), ("close", "open", "high", "low")),
}
# Parts of a snapshot of documents, by a hash of the id.
DOCUMENT_PARTS = 16
_MANIFEST = "kind string, name string, version long, at string"


def _keyed(batch: DataFrame, endpoint: str) -> DataFrame:
    """Raw rows with their business key columns (documents: ``$.id``)."""
    if endpoint == "coin_ohlc":
        return batch.where(F.col("coin_id").isNotNull() & F.col("open_time").isNotNull())
    batch = batch.withColumn("dt", F.to_date("ingestion_time"))
    if endpoint in ("market_global", "trending"):
        return batch
    return batch.withColumn("coin_id", json_value("payload", "$.id"))


def _part(endpoint: str):
    """Snapshot part of a keyed row: candles by UTC day of the candle, the
    global series by month, documents by a hash of their id, one for the
    newest trending run. A batch rewrites only the parts it touches."""
    if endpoint == "coin_ohlc":
        return F.date_format("open_time", "yyyy-MM-dd")
    if endpoint == "market_global":
        return F.date_format("dt", "yyyy-MM")
    if endpoint == "trending":
        return F.lit("newest")
    return F.concat(F.lit("p"), F.pmod(F.xxhash64("coin_id"), F.lit(DOCUMENT_PARTS)).cast("string"))


def _version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version:010d}"


def _manifest_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/_manifest/v={version:010d}"


def _versions(spark: SparkSession, root: str) -> list[int]:
    done = paths(spark, f"{root.rstrip('/')}/_manifest/v=*/_SUCCESS")
    return sorted(int(p.rsplit("/", 2)[1][2:]) for p in done)


def current_version(spark: SparkSession, root: str) -> int | None:
    """The newest committed version: manifests are never replaced, and one
    counts once its write is committed. None only where there is none; any
    other trouble is raised."""
    return max(_versions(spark, root), default=None)


class _Manifest:
    """A committed version: where each part is (version that wrote it, folder),
    the newest batch applied of each query, the folders that derived parts
    were made from, and the writer; one row each."""

    def __init__(self, spark: SparkSession, root: str, version: int | None):
        self.parts: dict[str, tuple[int, str]] = {}
        self.queries: dict[str, int] = {}
        self.sources: dict[str, str] = {}
        self.writer: str | None = None
        rows = [] if version is None else spark.read.schema(_MANIFEST).json(_manifest_path(root, version)).collect()
        for r in rows:
            if r["kind"] == "part":
                self.parts[r["name"]] = (r["version"], r["at"] or f"v={r['version']:010d}")
            elif r["kind"] == "query":
                self.queries[r["name"]] = r["version"]
            elif r["kind"] == "source":
                self.sources[r["name"]] = r["at"]
            else:
                self.writer = r["name"]

    def commit(self, spark: SparkSession, root: str, version: int, writer: str) -> bool:
        """Create version's manifest; False where another writer's is there."""
        rows = ([("part", p, v, at) for p, (v, at) in sorted(self.parts.items())]
                + [("query", q, b, None) for q, b in sorted(self.queries.items())]
                + [("source", p, None, at) for p, at in sorted(self.sources.items())] + [("writer", writer, version, None)])
        mine, target = f"{root.rstrip('/')}/_manifest/_{writer}", _manifest_path(root, version)
        spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").json(mine)
        if paths(spark, target) and not paths(spark, f"{target}/_SUCCESS"):
            delete(spark, target)                    # torn: manifests come whole or not at all
        won = rename_new(spark, mine, target) and _Manifest(spark, root, version).writer == writer
        delete(spark, mine)
        return won


def snapshot_parts(spark: SparkSession, root: str) -> dict[str, int]:
    """The version that wrote each part of the current snapshot."""
    return {p: v for p, (v, _) in _Manifest(spark, root, current_version(spark, root)).parts.items()}


def _part_paths(root: str, parts: dict[str, tuple[int, str]]) -> list[str]:
    return [f"{root.rstrip('/')}/{at}/part={p}" for p, (_, at) in sorted(parts.items())]


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The newest raw rows, as of the current (or an earlier kept) version, with ``dt``
    as in the raw table. Feed it to the matching curated view function."""
    parts = _Manifest(spark, root, current_version(spark, root) if version is None else version).parts
    if not parts:
        return None
    df = spark.read.parquet(*_part_paths(root, parts))
    return df if "dt" in df.columns else df.withColumn("dt", F.to_date("ingestion_time"))


def _newest(both: DataFrame, endpoint: str) -> DataFrame:
    if endpoint == "trending":
        return both.where(F.col("ingestion_time") == both.select(F.max("ingestion_time")).scalar())
    keys, tie = SNAPSHOT_KEYS[endpoint]
    return latest_by(both, list(keys), [F.desc("ingestion_time")], tie_break=[F.desc(c) for c in tie])


def merge_latest_batch(spark: SparkSession, root: str, batch: DataFrame, query_id: str, batch_id: int,
                       endpoint: str = "coin_markets", before_commit: Callable[[], None] | None = None) -> int | None:
    """(touched parts of the snapshot) ∪ batch -> newest rows -> new version of
    those parts -> new manifest; returns the version that holds the batch.

    The batch is written once, by part; its folders say which parts it
    touches, and only those are read and written, in a folder of this writer.
    Readers see the new version when its manifest is committed, not before; a
    crash leaves the old one. If another writer takes the version's number
    first, the parts that it changed are merged again on top of its version
    and the next number is tried, so no batch is lost. A batch of a query that
    the snapshot already holds is skipped. ``before_commit`` is called once,
    between merging and committing.
    """
    current = current_version(spark, root)
    if _Manifest(spark, root, current).queries.get(query_id, -1) >= batch_id:
        return current
    writer = uuid.uuid4().hex[:12]
    at = f"v={0 if current is None else current + 1:010d}/w={writer}"
    folder = f"{root.rstrip('/')}/{at}"
    staged = f"{folder}/_batch"
    _keyed(batch, endpoint).withColumn("part", _part(endpoint)).write.partitionBy("part").parquet(staged)
    touched = [p.rsplit("part=", 1)[1] for p in paths(spark, f"{staged}/part=*")]    # days, months, or a fixed number
    merged_on: dict[str, tuple[int, str] | None] = {}
    while touched:
        current = current_version(spark, root)
        state = _Manifest(spark, root, current)
        if state.queries.get(query_id, -1) >= batch_id:
            break
        stale = [p for p in touched if p not in merged_on or merged_on[p] != state.parts.get(p)]
        if stale:
            both = spark.read.parquet(*[f"{staged}/part={p}" for p in stale])
            held = {p: state.parts[p] for p in stale if p in state.parts}
            if held:
                both = spark.read.parquet(*_part_paths(root, held)).select(*both.columns).unionByName(both)
            (_newest(both, endpoint).withColumn("part", _part(endpoint)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(folder))
            merged_on |= {p: state.parts.get(p) for p in stale}
        if before_commit:
            before_commit()
            before_commit = None
        version = 0 if current is None else current + 1
        state.parts |= dict.fromkeys(touched, (version, at))
        state.queries[query_id] = batch_id
        if state.commit(spark, root, version, writer):
            current = version
            break
    delete(spark, staged)
    return current


def snapshot_changes(spark: SparkSession, root: str, since: int, until: int | None = None,
                     endpoint: str = "coin_markets") -> DataFrame:
    """Change feed between two kept versions: the key columns, ``change``
    (insert, update or delete) and the rows ``before`` and ``after``.

    Only parts whose folder differs between the manifests are read; a row that
    a rewritten part holds unchanged is no change. Trending, which has no key,
    has no feed.
    """
    keys = list(SNAPSHOT_KEYS[endpoint][0])
    old = _Manifest(spark, root, since).parts
    new = _Manifest(spark, root, current_version(spark, root) if until is None else until).parts
    moved = {p for p in old.keys() | new.keys() if old.get(p) != new.get(p)}

    def rows(parts: dict, name: str) -> DataFrame | None:
        there = {p: parts[p] for p in moved if p in parts}
        if not there:
            return None
        df = spark.read.parquet(*_part_paths(root, there))
        return df.select(*keys, F.struct(*[c for c in df.columns if c not in keys]).alias(name))

    before, after = rows(old, "before"), rows(new, "after")
    if before is None and after is None:
        before = after = spark.read.parquet(*_part_paths(root, new)).limit(0)
        before, after = (df.select(*keys, F.struct(*[c for c in df.columns if c not in keys]).alias(n))
                         for df, n in ((before, "before"), (after, "after")))
    if before is None:
        before = after.select(*keys, F.col("after").alias("before")).limit(0)
    if after is None:
        after = before.select(*keys, F.col("before").alias("after")).limit(0)
    same = [F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys]
    both = before.alias("b").join(after.alias("a"), same, "full")
    change = F.when(F.col("before").isNull(), "insert").when(F.col("after").isNull(), "delete").otherwise("update")
    return (both.where(~F.col("before").eqNullSafe(F.col("after")))
                .select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys], change.alias("change"), "before", "after"))


def materialize_daily_candles(spark: SparkSession, candles_root: str, daily_root: str) -> int | None:
    """V6/Q6: daily candles kept beside a candle snapshot; returns their current version.

    A part of either is one UTC day. Only days whose part of the candle
    snapshot moved since they were last made (a new candle, or a provisional
    close that was replaced) are read and made anew; all others stay where
    they are. Read the result with ``read_daily_candles``.
    """
    writer = uuid.uuid4().hex[:12]
    while True:
        candles = _Manifest(spark, candles_root, current_version(spark, candles_root))
        current = current_version(spark, daily_root)
        state = _Manifest(spark, daily_root, current)
        moved = {p: place for p, place in candles.parts.items() if state.sources.get(p) != place[1]}
        if not moved:
            return current
        version = 0 if current is None else current + 1
        at = f"v={version:010d}/w={writer}"
        days = resample_daily(spark.read.parquet(*_part_paths(candles_root, moved)))
        (days.withColumn("part", F.date_format("day", "yyyy-MM-dd")).write.mode("overwrite").partitionBy("part")
             .parquet(f"{daily_root.rstrip('/')}/{at}"))
        state.parts |= dict.fromkeys(moved, (version, at))
        state.sources |= {p: place[1] for p, place in moved.items()}
        if state.commit(spark, daily_root, version, writer):
            return version


def read_daily_candles(spark: SparkSession, daily_root: str) -> DataFrame | None:
    """The kept daily candles, as ``questions.daily_candles`` gives them."""
    parts = _Manifest(spark, daily_root, current_version(spark, daily_root)).parts
    return spark.read.parquet(*_part_paths(daily_root, parts)) if parts else None


def remove_old_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete what only versions before the newest ``keep`` hold; returns the deleted part folders.

    Mark: every folder that a kept manifest names. Sweep: folders that older
    manifests name and no kept one does, then those manifests. Folders that no
    manifest names yet belong to writers at work and stay.
    """
    versions = _versions(spark, root)
    old, kept = versions[:-max(keep, 1)], versions[-max(keep, 1):]
    marked = {path for v in kept for path in _part_paths(root, _Manifest(spark, root, v).parts)}
    known = {path for v in old for path in _part_paths(root, _Manifest(spark, root, v).parts)}
    gone = sorted(known - marked)
    for path in gone:
        delete(spark, path)
    for v in old:
        delete(spark, _manifest_path(root, v))
    return gone


def materialize_latest(spark: SparkSession, landing_root: str, endpoint: str, snapshot_root: str,
                       checkpoint: str, max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> int | None:
    """V6: keep a materialised newest-rows snapshot of one raw table up to
    date from the landing stream; returns the current version. Bad files are
    refused one by one and named in the ledger inside the snapshot (``_ledger``)."""
    def apply(df: DataFrame, query_id: str, batch_id: int) -> None:
        load, ledger = f"stream-{query_id}-{batch_id:010d}", snapshot_root.rstrip("/") + "/_ledger"
        good, result = judge_files(df, endpoint, ledger, load)
        rows = good.select(F.from_json("value", RAW_SCHEMAS[endpoint]).alias("r")).select("r.*")
        if result.accepted:
            merge_latest_batch(df.sparkSession, snapshot_root, rows, query_id, batch_id, endpoint)
        commit_ledger(df.sparkSession, ledger, load)

    _run_batches(_landing_stream(spark, landing_root, endpoint, max_files_per_trigger), checkpoint, apply)
    return current_version(spark, snapshot_root)
