"""Id-list filters given as tables (FLT-5, SNK-2, SNK-3).

When the id list is data rather than a literal, IN / NOT IN become semi / anti
joins: Spark broadcasts the id side when AQE measures it small and otherwise
shuffles both sides on the key; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ids_in(df: DataFrame, ids: DataFrame, key: str, ids_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs in ``ids`` (left semi join)."""
    k = ids.select(F.col(ids_key or key).alias(key)).filter(F.col(key).isNotNull())
    return df.join(k, key, "left_semi")


def ids_not_in(df: DataFrame, ids: DataFrame, key: str, ids_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` does not occur in ``ids`` (left anti join)."""
    k = ids.select(F.col(ids_key or key).alias(key)).filter(F.col(key).isNotNull())
    return df.join(k, key, "left_anti")
