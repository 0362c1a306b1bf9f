"""Hierarchies (HIER-1..5): closures, descendant counts, trees, comment threads.

Everything is read from the intervals of one Euler tour (:mod:`intervals`): descendants are a range of
pre-order places, counts over descendants are differences of sums, levels and threads come with
the tour. Tables of n rows give n rows, whatever the depth; pairs of node and ancestor are made only
where pairs are what is asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentspark.operators.intervals import pairs_below, tour
from contentspark.session import written


def closure(nodes: DataFrame, id_col: str = "term_id", parent_col: str = "parent") -> DataFrame:
    """HIER-1: (id, ancestor, depth) for every ancestor of every node (depth 1 = parent).

    Its rows are the pairs themselves (for a chain, the square of its length); counts, covers and
    threads do not need it. The nodes of a cycle have each other as ancestors, never themselves.
    """
    walk = written(tour(nodes, id_col, parent_col), "tour")
    pairs = pairs_below(walk)
    cuts = walk.filter("cut IS NOT NULL").select(F.col("id").alias("root"), F.col("cut").alias("id"))
    if cuts.isEmpty():
        return pairs
    # Behind a cycle's root stands the rest of the cycle: the root's former parent and what is above that.
    behind = cuts.select("id").distinct()
    behind = pairs_below(walk, among=behind).unionByName(behind.select("id", F.col("id").alias("ancestor"), F.lit(0).alias("depth")))
    behind = cuts.join(behind, "id").select("root", "ancestor", "depth")
    around = walk.select("id", "root", "level").join(behind, "root").filter("id != ancestor").select(
        "id", "ancestor", (F.col("level") + 1 + F.col("depth")).alias("depth"))
    return pairs.unionByName(around.join(pairs.select("id", "ancestor"), ["id", "ancestor"], "left_anti"))


def with_hierarchy(terms: DataFrame, id_col: str = "term_id", parent_col: str = "parent", ancestors: bool = True) -> DataFrame:
    """DOC-15 / HIER-2 / HIER-3: terms plus place, descendant totals and padded count.

    ``level``, ``pre`` and ``n_descendants`` place a term: its descendants have the ``pre`` after its own,
    ``n_descendants`` of them. ``children_count`` = sum of the descendants' object counts;
    ``padded_count`` = own count + children_count. ``ancestors`` adds the sorted array of a
    term's ancestors, as many as the term is deep.
    """
    walk = tour(terms, id_col, parent_col, sums={"children_count": F.col("count")})
    walk = written(walk, "tour") if ancestors else walk  # read twice only with them
    h = walk.select(F.col("id").alias(id_col), "level", "pre", (F.col("size") - 1).alias("n_descendants"), "children_count")
    out = terms.join(h, id_col).withColumn("padded_count", (F.col("count") + F.col("children_count")).cast("bigint"))
    if not ancestors:
        return out
    above = pairs_below(walk).groupBy(F.col("id").alias(id_col)).agg(F.array_sort(F.collect_list("ancestor")).alias("ancestors"))
    return out.join(above, id_col, "left").withColumn("ancestors", F.coalesce("ancestors", F.array().cast("array<bigint>")))


def tree(terms: DataFrame, sort_key: str = "name", id_col: str = "term_id", parent_col: str = "parent",
         descending: bool = False, path: bool = True) -> DataFrame:
    """HIER-4: (id, level, position[, path]): the pre-order flattening, siblings by ``sort_key``, then id.

    ``position`` counts from 0. ``path`` holds one sort token per level, so that a lexicographic array order
    is the tree order: ascending names are their own tokens, otherwise a token is the number among
    the table's rows in sibling order. Leave it out for deep trees.
    """
    key = F.col(sort_key) if sort_key == "count" else F.lower(F.col(sort_key).cast("string"))
    walk = tour(terms, id_col, parent_col, [(key, descending)])
    walk = written(walk, "tour") if path else walk
    out = walk.select(F.col("id").alias(id_col), "level", F.col("pre").alias("position"))
    if not path:
        return out
    if descending or sort_key == "count":
        sibling = F.row_number().over(_siblings(walk))
        tokens = walk.select("id", F.lpad(sibling.cast("string"), 12, "0").alias("tok"))
    else:
        tokens = terms.select(F.col(id_col).alias("id"), F.concat(key, F.lit("\u0001"), F.lpad(F.col(id_col).cast("string"), 20, "0")).alias("tok"))
    steps = pairs_below(walk).unionByName(walk.select("id", F.col("id").alias("ancestor"), F.lit(0).alias("depth")))
    steps = steps.join(tokens.withColumnRenamed("id", "ancestor"), "ancestor")
    paths = steps.groupBy(F.col("id").alias(id_col)).agg(F.transform(F.array_sort(F.collect_list(
        F.struct((-F.col("depth")).alias("d"), "tok"))), lambda x: x["tok"]).alias("path"))
    return out.join(paths, id_col)


def _siblings(walk: DataFrame):
    from pyspark.sql import Window

    return Window.partitionBy("parent").orderBy("pre")


def thread(comments: DataFrame, roots: DataFrame | None = None, id_col: str = "comment_ID",
           parent_col: str = "comment_parent", order_col: str = "comment_date_gmt") -> DataFrame:
    """HIER-5: a comment set with all its descendants.

    Returns (id, root, level, position); ``roots`` defaults to top-level comments (parent 0). Threaded order =
    order by position (replies by date, then id); flat order = by the caller's sort.
    """
    walk = written(tour(comments, id_col, parent_col, [(F.col(order_col), False)]), "tour")
    if roots is None:
        top = comments.filter(F.col(parent_col) == 0).select(F.col(id_col).alias("root"))
        below = walk.join(top, "root", "left_semi").select("id", "root", "level", F.col("pre").alias("position"))
        return below.withColumnRenamed("id", id_col)
    start = roots.select(F.col(id_col).alias("id")).distinct()
    pairs = pairs_below(walk, of=start).select("id", F.col("ancestor").alias("root"), F.col("depth").alias("level"))
    own = walk.join(start, "id", "left_semi").select("id", F.col("id").alias("root"), F.lit(0).alias("level"))
    return pairs.unionByName(own).join(walk.select("id", F.col("pre").alias("position")), "id").withColumnRenamed("id", id_col)
