"""Landing zone: immutable NDJSON per endpoint, day and run.

Layout: ``<root>/<endpoint>/dt=YYYY-MM-DD/run=<YYYYMMDDTHHMMSS>_<run id>/part-….txt``.
A run is a unit: its folder is named by time and run id, written once, and
its URI is what the loader reads. Writing the same run again (a retry)
replaces its own folders and nothing else, so neither the landing zone nor a
replay of it ever holds a run twice. Each line is the reference-shaped row:
``{"ingestion_time": "<iso +00:00>", "payload": <the document itself>}``
(document rows) or the flat candle row.

Writes go through Spark's file commit protocol: a failed task is retried,
a failed job leaves no committed files. Row counts are read from the
committed files, never from metrics of the write.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import iso_utc
from .files import delete, paths, replace_folders
from .schemas import RAW_SCHEMAS


def new_run_id() -> str:
    """A random run id (two runs in one second never share it)."""
    return uuid.uuid4().hex[:12]


def run_name(ts: dt.datetime, run_id: str) -> str:
    """``<YYYYMMDDTHHMMSS>_<run id>``, the time in UTC (a time without zone is UTC)."""
    if ts.tzinfo is not None:
        ts = ts.astimezone(dt.timezone.utc)
    return f"{ts:%Y%m%dT%H%M%S}_{run_id}"


def run_stamp(ts: Column | str) -> Column:
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(t, "yyyyMMdd'T'HHmmss")


def landing_path(endpoint: Column | str, ts: Column | str, run_id: Column | str) -> Column:
    """``<endpoint>/dt=YYYY-MM-DD/<YYYYMMDDTHHMMSS>_<run_id>.ndjson``.

    ``endpoint`` is a literal name (str) or a Column; ``ts`` and ``run_id``
    are column names or Columns.
    """
    e = F.lit(endpoint) if isinstance(endpoint, str) else endpoint
    t = F.col(ts) if isinstance(ts, str) else ts
    r = F.col(run_id) if isinstance(run_id, str) else run_id
    return F.concat(e, F.lit("/dt="), F.date_format(t, "yyyy-MM-dd"), F.lit("/"), run_stamp(t), F.lit("_"), r,
                    F.lit(".ndjson"))


def document_lines(rows: DataFrame) -> DataFrame:
    """Raw document rows -> NDJSON line text with the document embedded as
    JSON (not as a quoted string); JSON ``null`` for a NULL payload."""
    line = F.concat(F.lit('{"ingestion_time":"'), iso_utc("ingestion_time"),
                    F.lit('","payload":'), F.coalesce(F.col("payload"), F.lit("null")), F.lit("}"))
    return rows.select(line.alias("value"), "ingestion_time")


def candle_lines(rows: DataFrame) -> DataFrame:
    cols = [iso_utc("ingestion_time").alias("ingestion_time"), "coin_id", iso_utc("open_time").alias("open_time"),
            "open", "high", "low", "close"]
    return rows.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"), "ingestion_time")


@dataclass(frozen=True)
class LandedRun:
    """One run of one endpoint: its name, the URI of its folders (a run over
    several days has one a day, hence the pattern; none if it has no rows),
    and its committed rows (None if they were not counted)."""

    endpoint: str
    run: str
    uri: str | None
    rows: int | None


def land_run(rows: DataFrame, root: str, endpoint: str, run: str | None = None, count: bool = True) -> LandedRun:
    """Write one run of an endpoint (S8); a retry with the same ``run`` replaces it.

    Rows land in their UTC day. Empty input leaves no folder; days of an
    earlier attempt that a retry does not have go, once the retry is
    committed. The count is that of the committed lines (a read of the text;
    ``count=False`` leaves it out).
    """
    run = run or run_name(dt.datetime.now(dt.timezone.utc), new_run_id())
    spark = rows.sparkSession
    lines = candle_lines(rows) if "open_time" in rows.columns else document_lines(rows)
    base = f"{root.rstrip('/')}/{endpoint}"

    def write() -> None:
        # REBALANCE: hash on the day, but AQE merges small days into one file
        # and splits a hot day over several tasks (O8, skew-safe)
        (lines.select("value", F.to_date("ingestion_time").alias("dt"), F.lit(run).alias("run"))
              .hint("rebalance", "dt")
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", "run").text(base))

    found = replace_folders(spark, f"{base}/dt=*/run={run}", write)
    uri = None if not found else found[0] if len(found) == 1 else f"{base}/dt=*/run={run}"
    return LandedRun(endpoint, run, uri, None if not count else spark.read.text(found).count() if found else 0)


def drop_run(spark: SparkSession, root: str, endpoint: str, run: str) -> None:
    """Remove a run's folders of one endpoint (a retry whose endpoint is now empty)."""
    for folder in paths(spark, f"{root.rstrip('/')}/{endpoint}/dt=*/run={run}"):
        delete(spark, folder)


def write_landing(rows: DataFrame, root: str, endpoint: str, run: str | None = None) -> int:
    """``land_run``, returning the rows only."""
    return land_run(rows, root, endpoint, run).rows


def read_landing(spark: SparkSession, root: str, endpoint: str, with_partitions: bool = True) -> DataFrame:
    """Read one endpoint's landing files with its declared schema (no inference)."""
    schema = RAW_SCHEMAS[endpoint]
    path = f"{root.rstrip('/')}/{endpoint}"
    df = spark.read.schema(schema).option("basePath", path).option("mode", "FAILFAST").json(path)
    if not with_partitions:
        return df.select(*schema.fieldNames())
    return df


def replay(spark: SparkSession, root: str, endpoint: str) -> DataFrame:
    """The raw rows of all landed files — no API call. The result equals
    what the loads produced (property-tested); ``load.rebuild_raw`` replaces
    a raw table with it."""
    df = read_landing(spark, root, endpoint)
    return df.select(*RAW_SCHEMAS[endpoint].fieldNames(), F.to_date("ingestion_time").alias("dt"))


def landing_inventory(spark: SparkSession, root: str, endpoint: str) -> DataFrame:
    """Rows and runs per landed day: lines are counted, not parsed; runs are folders."""
    path = f"{root.rstrip('/')}/{endpoint}"
    df = spark.read.option("basePath", path).text(path)
    return df.groupBy("dt").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("run").alias("n_runs"))


def landed_days(spark: SparkSession, root: str, endpoint: str) -> DataFrame:
    """Days of the landing zone from the folder listing alone (nothing is read)."""
    found = [p.rsplit("dt=", 1)[1] for p in paths(spark, f"{root.rstrip('/')}/{endpoint}/dt=*")]
    return spark.createDataFrame([(d,) for d in found], "dt string").select(F.col("dt").cast("date").alias("dt"))


def retention(partitions: DataFrame, days: int, as_of: Column | None = None) -> DataFrame:
    """Which day partitions to keep or expire after ``days`` days.

    ``days = 0`` keeps everything. The age is measured against ``as_of``
    (default: the newest landed day — the data's "today", never the clock).
    """
    ref = as_of if as_of is not None else partitions.select(F.max("dt")).scalar()
    if days <= 0:
        return partitions.withColumn("action", F.lit("keep"))
    keep = F.col("dt") > F.date_sub(ref, int(days))
    return partitions.withColumn("action", F.when(keep, F.lit("keep")).otherwise(F.lit("expire")))


def expire_landing(spark: SparkSession, root: str, endpoint: str, days: int, as_of: Column | None = None) -> list[str]:
    """Delete the landed days that ``retention`` expires; returns them (one name a day)."""
    old = retention(landed_days(spark, root, endpoint), days, as_of).where("action = 'expire'")
    gone = sorted(str(r["dt"]) for r in old.select("dt").collect())
    for day in gone:
        delete(spark, f"{root.rstrip('/')}/{endpoint}/dt={day}")
    return gone
