"""What the operators share: reading tables, tables in the shared folder, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contentspark.sources.tables import load  # noqa: F401  (used by the query module)

# Rows of a key-only table up to which a join broadcasts it (a long key takes
# some 40 bytes in the hash table, so 20 MB); larger ones are joined by a shuffle.
BROADCAST_ROWS = 500_000

# Documents in an Arrow batch: texts are wide rows, and a batch is held several times over
# (JVM buffer, Python strings, arrays), so batches are kept to some megabytes.
TEXT_BATCH_ROWS = 1000

# Fixed value: white space of the text contracts (space, tab to carriage return).
SPACE_RUN = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Unset, a local session gets a scratch folder; on a cluster that is an error,
    for executors cannot see each other's local folders.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="contentspark-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Sets the Arrow batch size for rows with texts, unless the session has one of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":  # Spark's default
        spark.conf.set(key, str(TEXT_BATCH_ROWS))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_key(keys: DataFrame, rows: int | None = None) -> DataFrame:
    """``keys`` for the build side of a join: broadcast only if its counted rows are few."""
    n = keys.count() if rows is None else rows
    return F.broadcast(keys) if n <= BROADCAST_ROWS else keys


def whole_text(name: str = "text") -> Column:
    """The text, with null counting as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def one_space(text: Column) -> Column:
    """``text`` with each run of white space replaced by one space."""
    return F.regexp_replace(text, SPACE_RUN, " ")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
