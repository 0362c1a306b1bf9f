"""Global ranks and prefix sums without a task that sees all rows of a group.

Rows are range-partitioned by (group, order) and sorted where they are; a row's rank is its number
within its partition plus the rows that earlier partitions hold for the group. Only one row per
partition and group meets a window, so a query with most of all hits, or a table with one group,
is spread over every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentspark.session import written

_ROW = (1 << 33) - 1  # monotonically_increasing_id: the row's number within its partition
FEW = 100_000  # rows of a whole table that a window may see in one task


def ranked(df: DataFrame, group: list[str], order: list[Column], name: str = "rank", sums: dict[str, Column] | None = None,
           rows: int | None = None) -> DataFrame:
    """``df`` with ``name``: the rank (from 1) within ``group`` by ``order``, which has to tell rows apart.

    ``sums``: further columns, each the sum of a column over the rows before this one in its group.
    ``group`` columns may not be null. The sorted rows are written to the shared folder. ``rows``, the
    table's number of rows where it is known: up to :data:`FEW` are ranked by a plain window.
    """
    sums = sums or {}
    keys = [F.col(g) for g in group]
    if rows is not None and rows <= FEW:
        line = Window.partitionBy(*group).orderBy(*order)
        earlier = line.rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({name: F.row_number().over(line).cast("long"),
                               **{s: F.coalesce(F.sum(c).over(earlier), F.lit(0)) for s, c in sums.items()}})
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = df.withColumns({f"_add_{s}": c for s, c in sums.items()}) if sums else df
    line = line.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
    line = written(line.withColumns({"_part": F.spark_partition_id(),
                                     "_nr": F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW))}), f"sorted-{name}")
    parts = line.groupBy(*group, "_part").agg(
        F.min("_nr").alias("_first"), F.count(F.lit(1)).alias("_rows"), *[F.sum(f"_add_{s}").alias(f"_sum_{s}") for s in sums])
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    parts = parts.select(*group, "_part", "_first", offset("_rows").alias("_before"),
                         *[offset(f"_sum_{s}").alias(f"_before_{s}") for s in sums])
    out = line.join(parts, [*group, "_part"]).withColumn(name, F.col("_nr") - F.col("_first") + F.col("_before") + 1)
    if sums:
        here = Window.partitionBy(*group, "_part").orderBy("_nr").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumns({s: F.coalesce(F.sum(f"_add_{s}").over(here), F.lit(0)) + F.col(f"_before_{s}") for s in sums})
    drop = ["_part", "_nr", "_first", "_before", *[f"_add_{s}" for s in sums], *[f"_before_{s}" for s in sums]]
    return out.drop(*drop)
