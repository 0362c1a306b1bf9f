"""Global positions of rows in an order, without a task that sees all rows of a group.

Rows are range-partitioned and sorted; a row's position is its number within its partition
plus the rows that earlier partitions hold. Only a row per partition and group meets a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentspark.llm.common import BROADCAST_ROWS, materialize, shuffle_partitions


def positions(df: DataFrame, group: str, order: list[Column], label: str, rows: int | None = None) -> DataFrame:
    """``df`` with index (from 0) and size (rows) within ``group``, a column without nulls.

    ``order`` has to tell rows apart, or rows that tie have to be interchangeable. ``rows`` is the
    number of rows for each task (default: the session's number of partitions).
    """
    n = shuffle_partitions(df.sparkSession) if rows is None else max(1, -(-df.count() // rows))
    line = df.repartitionByRange(n, F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    line = materialize(line.withColumns({
        "_part": F.spark_partition_id(),
        "_nr": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), label)
    parts = line.groupBy(group, "_part").agg(F.min("_nr").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = materialize(parts.select(
        group, "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("size")), f"{label}-parts")
    few = parts.count() <= BROADCAST_ROWS
    return line.join(F.broadcast(parts) if few else parts, [group, "_part"]).withColumn(
        "index", F.col("_nr") - F.col("_first") + F.col("_before")).drop("_part", "_nr", "_first", "_before")
