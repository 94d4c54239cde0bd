"""Session helpers: UTC guard, shared (cluster-visible) scratch space, defaults."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. Time zone is a correctness requirement
# (DATE(ingestion_time) is a UTC day); the rest are scale defaults.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "tessera",
                  checkpoint_dir: str | None = None) -> SparkSession:
    """Session for the bench (a cluster brings its own); scratch tables go to
    ``checkpoint_dir``, in local mode a fresh private folder by default."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    b = (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
          .config("spark.driver.memory", "16g")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if checkpoint_dir is None and is_local(master):
        checkpoint_dir = tempfile.mkdtemp(prefix="tessera-ckpt-")
    if checkpoint_dir:
        b = b.config("spark.checkpoint.dir", checkpoint_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is none)."""
    return master == "local" or master.startswith("local[")


def ensure_utc(spark: SparkSession) -> None:
    """All day boundaries are UTC days; pin the session zone (H4)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset
    and Spark runs in local mode (tests) is a private folder created and
    registered; on a cluster an unset value is an error, never a
    machine-local fallback.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not is_local(sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="tessera-ckpt-")
        sc.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), "tessera", *parts, uuid.uuid4().hex[:12]])
