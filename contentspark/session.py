"""Session helpers.

Cluster jobs get their session from the caller; these helpers only fill in
settings that are unset (tests, bench, local runs) and never override what a
cluster already configured.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on for correct results (NTZ timestamps compared in
# UTC, AQE for skew and partition coalescing).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "contentspark") -> SparkSession:
    """Return the active session or build a local one for tests and bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_conf(active)
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Set the settings results depend on (time zone) when the session lacks them."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster's shared folder). Where it is
    unset, a local session gets a scratch folder; on a cluster that is an error,
    for executors would each write to their own disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="contentspark-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d


def written(df, name: str):
    """``df`` written once as Parquet under the shared folder and read back (lineage ends there)."""
    import uuid

    path = os.path.join(checkpoint_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
