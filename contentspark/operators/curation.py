"""Curated results (CUR-1..4).

Pinning (CUR-1) without a per-query loop and without a task that sees all hits of a query. Organic
ranks come from a range-partitioned sort (:func:`ranks.ranked`). The i-th pinned position p_i of a
query (ascending) stands before organic rank q_i = p_i - i + 1; so the ranks up to the last q_i are
merged with the pins, by a second sort of just these few rows, and every later rank moves by
the number of pins. Pins beyond the results follow them without a gap; pins that share a position
take neighbouring ones, the smaller doc_id first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contentspark.operators.ranks import ranked
from contentspark.session import written


def pin(organic: DataFrame, pointers: DataFrame, query_key: str = "query", queries: DataFrame | None = None) -> DataFrame:
    """CUR-1/CUR-2: merge organic hits (query_id, query, doc_id, score) with pointers
    (search_term, doc_id, position) whose term equals the query case-insensitively.
    ``queries``: (query_id, query), where the hits' texts come from; a text is then read once, not per hit.

    Pinned documents leave the organic order (and are added when they did not
    match: CUR-2). Output: (query_id, doc_id, position, pinned).
    """
    texts = organic if queries is None else queries.join(organic.select("query_id").distinct(), "query_id", "left_semi")
    queries = texts.select("query_id", F.lower(F.trim(F.col(query_key))).alias("qkey")).distinct()
    p = pointers.select(F.lower(F.trim(F.col("search_term"))).alias("qkey"), "doc_id", "position")
    pins = queries.join(p, "qkey").select("query_id", "doc_id", "position")
    # Windows over the pins of one query: pointers are written by hand, never derived from the hits.
    order = Window.partitionBy("query_id").orderBy("position", "doc_id")
    pins = pins.withColumn("i", F.row_number().over(order))
    pins = written(pins.withColumn("before", F.max(F.col("position") - F.col("i") + 1).over(order)), "pins")
    per_query = pins.groupBy("query_id").agg(F.max("before").alias("last"), F.count(F.lit(1)).alias("pins"))

    rest = organic.select("query_id", "doc_id", "score").join(pins.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")
    rest = ranked(rest, ["query_id"], [F.col("score").desc(), F.col("doc_id").asc()], "r").join(per_query, "query_id", "left")
    moved = F.coalesce(F.col("r") >= F.col("last"), F.lit(True))
    later = rest.filter(moved).select(
        "query_id", "doc_id", (F.col("r") + F.coalesce("pins", F.lit(0))).alias("position"), F.lit(False).alias("pinned"))
    merged = rest.filter(~moved).select("query_id", "doc_id", F.col("r").cast("long").alias("at"), F.lit(False).alias("pinned"), F.lit(0).alias("i"))
    merged = merged.unionByName(pins.select("query_id", "doc_id", F.col("before").cast("long").alias("at"), F.lit(True).alias("pinned"), "i"))
    merged = ranked(merged, ["query_id"], [F.col("at").asc(), F.col("pinned").desc(), F.col("i").asc()], "position")
    return later.unionByName(merged.select("query_id", "doc_id", "position", "pinned"))


def organic_only(organic: DataFrame) -> DataFrame:
    """CUR-3: the preview without pointers: organic order only."""
    return ranked(organic, ["query_id"], [F.col("score").desc(), F.col("doc_id").asc()], "position")


def clean_pointers(pointers: DataFrame, posts: DataFrame, page_size: int | None = None) -> DataFrame:
    """CUR-4: keep pointers to published documents, at positions within a page if its size is given."""
    live = posts.filter(F.col("post_status") == "publish").select(F.col("id").alias("doc_id"))
    kept = pointers.filter(F.col("position") >= 1)
    if page_size is not None:
        kept = kept.filter(F.col("position") <= page_size)
    return kept.join(live, "doc_id", "left_semi")


def rekey(pointers: DataFrame, renames: DataFrame) -> DataFrame:
    """CUR-4: pointers follow a renamed search term (renames: old_term, new_term)."""
    r = renames.select(F.lower(F.col("old_term")).alias("k"), "new_term")
    return (pointers.join(r, F.lower(pointers.search_term) == r.k, "left")
            .select(F.coalesce("new_term", "search_term").alias("search_term"), "doc_id", "position"))


def restore(pointers: DataFrame, removed: DataFrame, posts: DataFrame) -> DataFrame:
    """CUR-4: pointers plus those of ``removed`` whose document is published again.

    A restored pointer takes its old position if no other pointer of its term holds that by now.
    """
    live = posts.filter(F.col("post_status") == "publish").select(F.col("id").alias("doc_id"))
    back = (removed.join(live, "doc_id", "left_semi")
            .join(pointers.select("search_term", "doc_id"), ["search_term", "doc_id"], "left_anti")
            .join(pointers.select("search_term", "position"), ["search_term", "position"], "left_anti"))
    return pointers.select("search_term", "doc_id", "position").unionByName(back.select("search_term", "doc_id", "position"))


def pointer_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """CUR-4: (search_term, doc_id, op, position) with op insert / update / delete (full outer join)."""
    o = old.select("search_term", "doc_id", F.col("position").alias("old_pos"))
    n = new.select("search_term", "doc_id", F.col("position").alias("new_pos"))
    j = o.join(n, ["search_term", "doc_id"], "full_outer")
    op = (F.when(F.col("old_pos").isNull(), "insert").when(F.col("new_pos").isNull(), "delete")
          .when(F.col("old_pos") != F.col("new_pos"), "update"))
    return (j.withColumn("op", op).filter(F.col("op").isNotNull())
            .select("search_term", "doc_id", "op", F.coalesce("new_pos", "old_pos").alias("position")))
