"""Source scans and eligibility (SRC-1..7).

Whole-table jobs never page: filters go to the Parquet scan and Spark splits
the files. Paging operators exist for parity with the source API and compile
to ``TakeOrderedAndProject`` (top-k) plans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentspark.operators.sorting import total_count


def eligible_posts(posts: DataFrame, types: list[str], statuses: list[str], include_ids=None,
                   exclude_ids=None, allow_password: bool = False) -> DataFrame:
    """SRC-1: public types and statuses, no password, include/exclude ids."""
    cond = F.col("post_type").isin(types) & F.col("post_status").isin(statuses)
    if not allow_password:
        cond = cond & (F.coalesce(F.col("post_password"), F.lit("")) == "")
    if include_ids:
        cond = cond & F.col("id").isin(list(include_ids))
    if exclude_ids:
        cond = cond & ~F.col("id").isin(list(exclude_ids))
    return posts.filter(cond)


def id_range_page(df: DataFrame, id_col: str, lower: int | None = None, upper: int | None = None,
                  size: int | None = None) -> DataFrame:
    """SRC-2: ids in [lower, upper], descending; with ``size`` one keyset page of them. Next page: upper = last id - 1."""
    cond = F.lit(True)
    if lower is not None:
        cond = cond & (F.col(id_col) >= lower)
    if upper is not None:
        cond = cond & (F.col(id_col) <= upper)
    page = df.filter(cond).orderBy(F.col(id_col).desc())
    return page if size is None else page.limit(size)


def offset_page(df: DataFrame, order: list[Column], offset: int, number: int) -> tuple[DataFrame, Column]:
    """SRC-3: offset/number page plus total (0 when the offset is past the end)."""
    page = df.orderBy(*order).offset(offset).limit(number)
    n = total_count(df)
    total = F.when(n <= F.lit(offset), F.lit(0).cast("bigint")).otherwise(n)
    return page, total


def term_scan(terms: DataFrame, taxonomies: list[str], hide_empty: bool = False) -> DataFrame:
    """SRC-4: terms of the public taxonomies (``hide_empty`` False by default)."""
    out = terms.filter(F.col("taxonomy").isin(taxonomies))
    return out.filter(F.col("count") > 0) if hide_empty else out


def comment_scan(comments: DataFrame, posts: DataFrame, comment_types: list[str] | None = None,
                 post_types: list[str] | None = None, post_statuses: tuple[str, ...] = ("publish",)) -> DataFrame:
    """SRC-5: approved comments whose parent post has an allowed type and status.

    The post side is reduced to (id) before the join so only keys are shuffled.
    """
    c = comments.filter(F.col("comment_approved") == "1")
    if comment_types:
        c = c.filter(F.col("comment_type").isin(comment_types))
    p = posts.filter(F.col("post_status").isin(list(post_statuses)))
    if post_types:
        p = p.filter(F.col("post_type").isin(post_types))
    return c.join(p.select(F.col("id").alias("comment_post_ID")), "comment_post_ID", "left_semi")


def eligible_counts(posts: DataFrame) -> DataFrame:
    """SRC-6: objects per type x status, passworded ones excluded (partial aggregation map-side)."""
    return (posts.filter(F.coalesce(F.col("post_password"), F.lit("")) == "")
            .groupBy("post_type", "post_status").agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def change_action(changes: DataFrame, eligible: Column) -> DataFrame:
    """SRC-7: a change of an eligible object is an upsert, otherwise a delete."""
    return changes.withColumn("op", F.when(eligible, F.lit("upsert")).otherwise(F.lit("delete")))
