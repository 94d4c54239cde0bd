"""Strict raw loads, the raw day-partitioned tables and the run summary
(S9, S10, S12).

A strict load behaves like a warehouse NDJSON load with
``ignore_unknown_values=False``: an unknown member, a missing REQUIRED
value, a value of the wrong type or a malformed line refuses the *whole
batch*. Spark's JSON reader ignores unknown fields, relaxes NOT NULL and
turns wrong types into NULL, so all checks are explicit column expressions
(H3).

Raw tables are Parquet by ``dt`` (UTC day) and ``load``: every load, batch or
stream, writes its own part of each day and may write it again, so a retry
replaces itself and all writers' rows are visible to all readers.

Where many files arrive together, the file is the unit of refusal: a ledger
beside the raw table says of every file whether it was loaded or refused and
why, so that a bad file costs its own rows only and is never tried twice.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import is_single_json_document
from .files import delete, paths, rename_new, replace_folders
from .schemas import MODES, RAW_SCHEMAS, required_fields

#: Characters of a refused line or body shown in an error (diagnostics only; data is never cut).
SHOWN = 200


def _line_checks(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    allowed = F.array(*[F.lit(n) for n in schema.fieldNames()])
    v = F.col(value)
    well_formed = is_single_json_document(v) & F.json_object_keys(v).isNotNull()
    keys = F.json_object_keys(v)
    unknown = F.array_size(F.array_except(F.coalesce(keys, F.array().cast("array<string>")), allowed)) > 0
    # the mode is the default one: naming it keeps Spark from reading the line once a member
    parsed = F.from_json(v, schema, {"mode": "PERMISSIVE"})
    missing, bad_type = F.lit(False), F.lit(False)
    for name in schema.fieldNames():
        there = F.get_json_object(v, f"$.{name}").isNotNull()      # present and not JSON null
        # a typed member is there: the line is read again for the others only
        if name in required_fields(schema):
            missing = missing | F.when(parsed[name].isNull(), ~there).otherwise(False)
        bad_type = bad_type | F.when(parsed[name].isNull(), there).otherwise(False)
    return lines.select("*", parsed.alias("__row"),
                        (~well_formed).alias("__malformed"),
                        (well_formed & unknown).alias("__unknown"),
                        (well_formed & missing).alias("__missing"),
                        (well_formed & bad_type).alias("__bad_type"))


def strict_load_report(lines: DataFrame, table: str, batch: str | None = None,
                       value: str = "value") -> DataFrame:
    """Per batch: rows, malformed, unknown-member, missing-required and
    wrong-type counts, and whether the batch would be accepted (all zero).

    One aggregation pass; partial aggregation before the shuffle. By ``file``,
    the least bad line is given too (``first_bad``, cut for showing).
    """
    schema = RAW_SCHEMAS[table]
    chk = _line_checks(lines, schema, value)
    bad = F.col("__malformed") | F.col("__unknown") | F.col("__missing") | F.col("__bad_type")
    keys = [batch] if batch else []
    agg = chk.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("__malformed").alias("n_malformed"),
        F.count_if("__unknown").alias("n_unknown_field"),
        F.count_if("__missing").alias("n_missing_required"),
        F.count_if("__bad_type").alias("n_bad_type"),
        *([F.min(F.when(bad, F.substring(F.col(value), 1, SHOWN))).alias("first_bad")] if batch == "file" else []))
    ok = (F.col("n_malformed") + F.col("n_unknown_field") + F.col("n_missing_required") + F.col("n_bad_type")) == 0
    return agg.withColumn("accepted", ok)


def strict_rows(lines: DataFrame, table: str, value: str = "value") -> DataFrame:
    """Typed rows of a batch; any bad line fails the job (``raise_error``
    inline). Used on the write path so checking and loading are one pass;
    a failed job commits no file, so the batch is refused as a whole."""
    schema = RAW_SCHEMAS[table]
    chk = _line_checks(lines, schema, value)
    bad = F.col("__malformed") | F.col("__unknown") | F.col("__missing") | F.col("__bad_type")
    guarded = F.when(bad, F.raise_error(F.concat(F.lit(f"strict load of {table} refused: "),
                                                  F.substring(F.col(value), 1, SHOWN)))).otherwise(F.col("__row"))
    return chk.select(guarded.alias("r")).select("r.*")


def load_ndjson(spark: SparkSession, path: str, table: str, raw_path: str, load: str | None = None) -> int:
    """Strict load of landed NDJSON under ``path`` into the raw table at
    ``raw_path``, as its load ``load`` (a new name by default; a known one is
    replaced). A bad line fails it. Returns the rows, from the files' footers."""
    lines = spark.read.text(path).select("value")
    return loaded_rows(spark, raw_path, append_raw(strict_rows(lines, table), raw_path, load))


def append_raw(rows: DataFrame, raw_path: str, load: str | None = None) -> str:
    """Add rows to a raw table, by day of ``ingestion_time``; returns the load's name.

    Only the load's own part of each day is written; writing it again replaces
    the load, days that it no longer has included.
    """
    load = load or uuid.uuid4().hex[:12]
    df = rows.withColumn("dt", F.to_date("ingestion_time")).withColumn("load", F.lit(load))
    replace_folders(rows.sparkSession, f"{raw_path.rstrip('/')}/dt=*/load={load}", lambda: (
        df.hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("dt", "load").parquet(raw_path)))
    return load


def loaded_rows(spark: SparkSession, raw_path: str, load: str) -> int:
    """Committed rows of one load (Parquet footers; no column is read)."""
    found = paths(spark, f"{raw_path.rstrip('/')}/dt=*/load={load}")
    return spark.read.parquet(*found).count() if found else 0


def drop_load(spark: SparkSession, raw_path: str, load: str) -> None:
    """Remove one load from a raw table."""
    for folder in paths(spark, f"{raw_path.rstrip('/')}/dt=*/load={load}"):
        delete(spark, folder)


# ------------------------------------------------------------------ the file as unit
LEDGER = ("file string, n_rows long, n_malformed long, n_unknown_field long, n_missing_required long, n_bad_type long, "
          "accepted boolean, first_bad string, known boolean, load string")


@dataclass(frozen=True)
class FileLoad:
    """What a load by files did: rows and files it took, files it refused, files that other loads had."""

    load: str
    rows: int
    accepted: int
    refused: int
    known: int


def ledger_path(raw_path: str) -> str:
    """The ledger's place beside a raw table."""
    return raw_path.rstrip("/") + "_ledger"


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Every file that a load took or refused, with its counts; no row before the first load."""
    found = paths(spark, f"{ledger.rstrip('/')}/load=*")
    if not found:
        return spark.createDataFrame([], LEDGER).drop("known")
    return spark.read.schema(LEDGER).option("basePath", ledger).parquet(*found).where("known is null").drop("known")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of landed files with the file they stand in: (value, file)."""
    return spark.read.option("recursiveFileLookup", "true").text(path).select("value", F.col("_metadata.file_path").alias("file"))


def judge_files(lines: DataFrame, table: str, ledger: str, load: str) -> tuple[DataFrame, FileLoad]:
    """(lines of the accepted files, counts) of ``lines`` (value, file).

    Every file is checked as a whole (one aggregation); files that the ledger
    names under another load are left out. The verdicts are written beside the
    ledger and count once ``commit_ledger`` has given them their name.
    """
    spark = lines.sparkSession
    verdicts = strict_load_report(lines, table, "file").withColumn("load", F.lit(load))
    known = read_ledger(spark, ledger).where(F.col("load") != load).select("file").distinct().withColumn("known", F.lit(True))
    pending = f"{ledger.rstrip('/')}/_pending/load={load}"
    verdicts.drop("load").join(known, "file", "left").write.mode("overwrite").parquet(pending)
    judged = spark.read.parquet(pending)
    new = judged.where("known is null")
    n = judged.agg(F.sum(F.when(F.col("accepted") & F.col("known").isNull(), F.col("n_rows"))).alias("rows"),
                   F.count_if(F.col("accepted") & F.col("known").isNull()).alias("accepted"),
                   F.count_if(~F.col("accepted") & F.col("known").isNull()).alias("refused"), F.count_if("known").alias("known")).first()
    result = FileLoad(load, n["rows"] or 0, n["accepted"], n["refused"], n["known"])
    good = lines
    if result.refused or result.known:
        good = lines.join(new.where("accepted").select("file"), "file", "left_semi")
    return good, result


def commit_ledger(spark: SparkSession, ledger: str, load: str) -> None:
    """Name the pending verdicts of a load; a repeated load replaces its own."""
    pending, target = f"{ledger.rstrip('/')}/_pending/load={load}", f"{ledger.rstrip('/')}/load={load}"
    delete(spark, target)
    if not rename_new(spark, pending, target):
        raise RuntimeError(f"two writers use the load name {load}")


def load_files(lines: DataFrame, table: str, raw_path: str, load: str | None = None, ledger: str | None = None) -> FileLoad:
    """S9 by file: load every good file of ``lines`` (value, file) and refuse the others.

    A file with an unknown member, a missing REQUIRED value, a wrong type or a
    malformed line is refused as a whole and named in the ledger with its
    counts and its first bad line; the other files load. Files in the ledger
    are not loaded again, whoever loaded them; a load that is tried again
    under its name replaces itself. Files without a line have no entry.
    """
    spark = lines.sparkSession
    load = load or uuid.uuid4().hex[:12]
    ledger = ledger or ledger_path(raw_path)
    good, result = judge_files(lines, table, ledger, load)
    if result.accepted:
        append_raw(good.select(F.from_json("value", RAW_SCHEMAS[table]).alias("r")).select("r.*"), raw_path, load)
    else:
        drop_load(spark, raw_path, load)
    commit_ledger(spark, ledger, load)
    return result


def drop_uncommitted(spark: SparkSession, raw_path: str, ledger: str | None = None, prefix: str = "stream-") -> list[str]:
    """Remove loads named ``prefix…`` that no ledger entry names: a crash left
    them between rows and ledger. Run it before a stream that has lost its
    checkpoint, while no other one runs; returns their names."""
    ledger = ledger or ledger_path(raw_path)
    named = {p.rsplit("load=", 1)[1] for p in paths(spark, f"{ledger}/load=*")}
    there = {p.rsplit("load=", 1)[1] for p in paths(spark, f"{raw_path.rstrip('/')}/dt=*/load={prefix}*")}
    for load in sorted(there - named):
        drop_load(spark, raw_path, load)
    return sorted(there - named)


def read_raw(spark: SparkSession, raw_path: str) -> DataFrame:
    """A raw table with its day ``dt``."""
    return spark.read.parquet(raw_path).drop("load")


def rebuild_raw(spark: SparkSession, landing_root: str, table: str, raw_path: str) -> int:
    """Replace a raw table with a strict load of all landed files; returns its rows."""
    lines = spark.read.text(f"{landing_root.rstrip('/')}/{table}").select("value")
    rows = strict_rows(lines, table).withColumn("dt", F.to_date("ingestion_time")).withColumn("load", F.lit("rebuilt"))
    rows.hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .partitionBy("dt", "load").parquet(raw_path)
    return read_raw(spark, raw_path).count()


def raw_day_counts(raw: DataFrame) -> DataFrame:
    """Rows per day partition of a raw table."""
    return raw.groupBy("dt").agg(F.count(F.lit(1)).alias("n_rows"))


def newest_day(raw: DataFrame) -> Column:
    """The newest stored day, as a scalar sub-query that prunes partitions."""
    return raw.select(F.max("dt")).scalar()


def raw_peek(raw: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` newest rows, reading only as many newest days as hold them."""
    left, since = n, None
    for r in raw_day_counts(raw).orderBy(F.desc("dt")).collect():      # one row a day
        since, left = r["dt"], left - r["n_rows"]
        if left <= 0:
            break
    src = raw if since is None else raw.where(F.col("dt") >= F.lit(since))
    ties = [F.desc(c) for c in ("payload", "close", "coin_id") if c in raw.columns]
    return src.orderBy(F.desc("ingestion_time"), *ties).limit(n)


def mode_summary(raw: dict[str, DataFrame], mode: str = "all", run: Column | None = None) -> DataFrame:
    """Rows per (run, endpoint) for the endpoints of ``mode``.

    Every expected endpoint gets a row for every run, 0 when it produced
    nothing. All endpoints are counted in one grouped pass; the counts of a
    run then fill the expected list (a literal array) without a join.
    """
    endpoints = MODES[mode]
    rows = None
    for e in endpoints:
        # default run = UTC day; the stored partition column when present
        # (no per-row computation, only the partition value is read)
        day = F.col("dt") if "dt" in raw[e].columns else F.to_date("ingestion_time")
        part = raw[e].select((run if run is not None else day).alias("run"), F.lit(e).alias("endpoint"))
        rows = part if rows is None else rows.unionByName(part)
    counts = rows.groupBy("run", "endpoint").agg(F.count(F.lit(1)).alias("n"))
    by_run = counts.groupBy("run").agg(F.map_from_entries(F.collect_list(F.struct("endpoint", "n"))).alias("m"))
    return (by_run.select("run", "m", F.explode(F.array(*[F.lit(e) for e in endpoints])).alias("endpoint"))
                  .select("run", "endpoint", F.coalesce(F.col("m")[F.col("endpoint")], F.lit(0)).cast("bigint").alias("rows")))
