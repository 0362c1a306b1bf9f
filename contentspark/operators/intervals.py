"""Hierarchies as intervals: the Euler tour of a forest, by list ranking (HIER-1..5).

Each node is entered and left once on a walk around its tree. The walk is a linked list of twice as
many elements as nodes: an entry is followed by the first child's entry or the node's own exit,
an exit by the next sibling's entry or the parent's exit; it ends with the root's exit. Ranking
the list (sums from each element to the end of its list) gives, for every node at once, its place in
pre-order, its level, its root, and the size and sums of its subtree: descendants are the
places between ``pre`` and ``pre + size``, and nothing grows with the depth.

List ranking: elements chosen by hash (about ``BASE`` of all) split the list. Each element jumps
along the list, doubling its reach each round, until it meets a chosen one; the list of
the chosen elements, whose number is bounded, is ranked in one task, and each element adds what its
chosen one knows. A table of up to ``BASE`` elements needs no jumps.

Defined results: a parent of null, 0, the node itself, or one that is not in the table makes a root.
Nodes of a cycle: the link from its smallest id to that node's parent is cut (``cut``), so
the smallest id is the root. Repeated ids are counted once. Siblings are in the given order, then by id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentspark.operators.ranks import ranked
from contentspark.session import written

BASE = 1 << 18  # elements of a list that one task ranks


def _rank_base(sums: list[str]):
    """Sums to the end of each list, and the end's value, of all elements (e, next, sums) of one task."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("e")
        e, after = rows["e"].to_numpy(), rows["next"].to_numpy()
        n = len(e)
        at = np.minimum(np.searchsorted(e, after), n - 1)
        at = np.where(after < 0, n, np.where(e[at] == after, at, np.arange(n)))  # what leads to a cycle outside goes nowhere
        at = np.append(at, n)
        end = np.append(np.where(after < 0, after, 0), 0)
        totals = [np.append(rows[s].to_numpy(), 0) for s in sums]
        for _ in range(n.bit_length() + 1):
            for t in totals:
                t += t[at]
            end = np.where(at < n, end[at], end)
            at = at[at]
        ended = at[:n] == n  # others stand on a cycle, or before one
        return pd.DataFrame({"e": e, "end": np.where(ended, end[:n], 0), **{s: t[:n] for s, t in zip(sums, totals)}})

    return run


def rank_list(elements: DataFrame, sums: list[str], n: int) -> DataFrame:
    """(e, end, sums) of linked lists (e, next, sums): each sum from the element to its list's end, inclusive.

    ``next`` is an element or, for the last one, a negative number, which is the list's ``end``. Elements
    that never reach an end (cycles) have end 0. All columns are whole numbers; e is positive, and there are ``n``.
    """
    base_type = "e long, end long, " + ", ".join(f"{s} long" for s in sums)
    rank_all = lambda rows: rows.groupBy().applyInPandas(_rank_base(sums), base_type)
    step = -(-n // BASE)
    if step <= 1:
        return rank_all(elements)
    chosen = lambda e: F.pmod(F.xxhash64(e), F.lit(step)) == 0
    open_ = lambda: (F.col("next") >= 0) & ~chosen(F.col("next"))
    rows, limit = written(elements, "list-elements"), math.ceil(math.log2(n)) + 1
    for _ in range(limit):  # a walk that has not met a chosen element by then is on a small cycle
        ahead = rows.select(F.col("e").alias("next"), F.col("next").alias("_next"), *[F.col(s).alias(f"_{s}") for s in sums])
        moved = rows.filter(open_()).join(ahead, "next").select("e", F.col("_next").alias("next"),
                                                               *[(F.col(s) + F.col(f"_{s}")).alias(s) for s in sums])
        rows = written(rows.filter(~open_()).unionByName(moved), "list-round")
        if rows.filter(open_()).isEmpty():
            break
    known = rank_all(rows.filter(chosen(F.col("e")) & ~open_())).select(
        F.col("e").alias("next"), F.col("end").alias("_end"), *[F.col(s).alias(f"_{s}") for s in sums])
    found = rows.join(known, "next", "left")
    return found.select("e", F.when(F.col("next") < 0, F.col("next")).otherwise(F.coalesce("_end", F.lit(0))).alias("end"),
                        *[(F.col(s) + F.when(F.col("next") < 0, 0).otherwise(F.coalesce(f"_{s}", F.lit(0)))).alias(s) for s in sums])


def _cycle_cuts(nodes: DataFrame) -> DataFrame:
    """(id): the smallest node of each cycle among nodes (id, parent) none of which has a root."""
    n = nodes.count()
    rows = nodes.select("id", F.col("parent").alias("up"), F.col("id").alias("least"))
    for _ in range(math.ceil(math.log2(n + 1)) + 1):
        ahead = rows.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("least").alias("_least"))
        rows = written(rows.join(ahead, "up").select("id", F.col("_up").alias("up"), F.least("least", "_least").alias("least")), "cycle-round")
    # After n steps or more every walk stands on a cycle, and all nodes of cycles are reached.
    on_cycle = rows.select(F.col("up").alias("id")).distinct()
    return rows.join(on_cycle, "id", "left_semi").filter("least = id").select("id")


def tour(nodes: DataFrame, id_col: str = "term_id", parent_col: str = "parent", order: list[tuple[Column, bool]] | None = None,
         sums: dict[str, Column] | None = None) -> DataFrame:
    """(id, parent, root, level, pre, size, <sums>, cut) of every node.

    ``order``: (column, descending) pairs that siblings are sorted by.
    ``pre``: place in pre-order, from 0, trees in the order of their roots; ``size``: nodes of the subtree,
    itself included; ``sums``: whole-number columns summed over the node's descendants, itself not
    included. ``parent`` is null for roots; ``cut`` is the parent a cycle's root would have.
    """
    sums = sums or {}
    own = nodes.select(F.col(id_col).cast("long").alias("id"), F.col(parent_col).cast("long").alias("up"),
                       *[o.alias(f"_o{i}") for i, (o, _) in enumerate(order or [])],
                       *[F.coalesce(c.cast("long"), F.lit(0)).alias(f"s_{s}") for s, c in sums.items()]).dropDuplicates(["id"])
    own = written(own, "tour-nodes")
    ids = own.select(F.col("id").alias("up"), F.lit(True).alias("_held"))
    up = F.when(F.col("_held") & (F.col("up") != 0) & (F.col("up") != F.col("id")), F.col("up"))
    own = own.join(ids, "up", "left").withColumn("parent", up).drop("_held", "up").withColumn("cut", F.lit(None).cast("long"))
    n = own.count()
    found = _walk(own, [d for _, d in order or []], list(sums), n)
    lost = found.filter("root IS NULL").select("id")
    if not lost.isEmpty():
        cuts = _cycle_cuts(written(own.join(lost, "id", "left_semi").select("id", "parent"), "cycle-nodes")).withColumn("_cut", F.lit(True))
        own = own.join(cuts, "id", "left").withColumns({
            "cut": F.when(F.col("_cut"), F.col("parent")), "parent": F.when(F.col("_cut").isNull(), F.col("parent"))}).drop("_cut")
        found = _walk(written(own, "tour-uncycled"), [d for _, d in order or []], list(sums), n)
    return found


def _walk(own: DataFrame, descending: list[bool], sums: list[str], n: int) -> DataFrame:
    """The tour of nodes (id, parent, cut, _o<i>, s_<sum>); root is null for nodes on or below a cycle."""
    order = [F.col(f"_o{i}").desc() if d else F.col(f"_o{i}").asc() for i, d in enumerate(descending)]
    # One sort gives siblings neighbouring numbers, in order; roots come first and in order, too.
    line = ranked(own, [], [F.col("parent").asc_nulls_first(), *order, F.col("id")], "nr", rows=n)
    line = written(line.drop(*[f"_o{i}" for i in range(len(descending))]), "tour-line")
    after = line.select((F.col("nr") - 1).alias("nr"), F.col("parent").alias("_next_parent"))
    child = line.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.min("nr").alias("_child"))
    parent = line.select(F.col("id").alias("parent"), F.col("nr").alias("_parent_nr"))
    links = line.join(after, "nr", "left").join(child, "id", "left").join(parent, "parent", "left")
    enter, leave = 2 * F.col("nr"), 2 * F.col("nr") + 1
    sibling = F.col("_next_parent").isNotNull() & (F.col("_next_parent") == F.col("parent"))
    after_exit = (F.when(F.col("parent").isNull(), -F.col("nr")).when(sibling, 2 * (F.col("nr") + 1)).otherwise(2 * F.col("_parent_nr") + 1))
    zero = F.lit(0).cast("long")
    carried = ["steps", "entered", *[f"s_{s}" for s in sums]]
    first = F.struct(enter.alias("e"), F.coalesce(2 * F.col("_child"), leave).alias("next"), F.lit(1).cast("long").alias("steps"),
                     F.lit(1).cast("long").alias("entered"), *[F.col(f"s_{s}") for s in sums])
    last = F.struct(leave.alias("e"), after_exit.alias("next"), F.lit(1).cast("long").alias("steps"), zero.alias("entered"),
                    *[zero.alias(f"s_{s}") for s in sums])
    elements = links.select(F.explode(F.array(first, last)).alias("x")).select("x.*")
    # Both elements of a node in one row: sums over its subtree are differences of sums to the end.
    got = rank_list(elements, carried, 2 * n).groupBy(F.expr("e div 2").alias("nr")).agg(
        F.max("end").alias("_end"), *[F.sum(F.when(F.col("e") % 2 == 0, F.col(c))).alias(f"{c}_in") for c in carried],
        *[F.sum(F.when(F.col("e") % 2 == 1, F.col(c))).alias(f"{c}_out") for c in carried])
    got = line.join(got, "nr").withColumns({
        "size": F.col("entered_in") - F.col("entered_out"), "_root": F.when(F.col("_end") < 0, -F.col("_end"))})
    got = written(got, "tour-ranked")
    roots = ranked(got.filter("parent IS NULL").select("nr", F.col("id").alias("root"), "size", "steps_in", "entered_in"),
                   [], [F.col("nr")], "_r", {"earlier": F.col("size")}, rows=n)
    roots = roots.select(F.col("nr").alias("_root"), "root", "earlier", F.col("steps_in").alias("_steps"), F.col("entered_in").alias("_entered"))
    got = got.join(roots, "_root", "left")
    inside = F.col("_entered") - F.col("entered_in")      # nodes of the tree entered before this one
    steps = F.col("_steps") - F.col("steps_in")           # elements of the tree's walk before this one
    return got.select(
        "id", "parent", "root", (2 * inside - steps).cast("int").alias("level"), (F.col("earlier") + inside).alias("pre"), "size",
        *[(F.col(f"s_{s}_in") - F.col(f"s_{s}_out") - F.col(f"s_{s}")).alias(s) for s in sums], "cut")


def _blocks(low: Column, high: Column, levels: int) -> Column:
    """The aligned blocks (level, number) of a power of two that make up the places low to high - 1."""
    def at(x: Column) -> Column:
        width = F.call_function("shiftleft", F.lit(1).cast("long"), x)
        a, b = F.ceil(low / width).cast("long"), F.floor(high / width).cast("long")
        return F.array_compact(F.array(F.when((a < b) & (a % 2 == 1), F.struct(x.alias("level"), a.alias("number"))),
                                       F.when((a < b) & (b % 2 == 1), F.struct(x.alias("level"), (b - 1).alias("number")))))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at))


def pairs_below(walk: DataFrame, of: DataFrame | None = None, among: DataFrame | None = None) -> DataFrame:
    """(id, ancestor, depth) of all pairs of a :func:`tour`, or of the ancestors ``of`` (id) and the nodes ``among`` (id).

    Equi-joins on the aligned blocks that an interval is made of, so the work is the pairs themselves plus a
    logarithm of rows per node; nothing compares all nodes with all intervals.
    """
    n = walk.count()
    levels = max(1, n).bit_length()
    above = walk.filter("size > 1")
    above = above if of is None else above.join(of.select("id").distinct(), "id", "left_semi")
    nodes = walk if among is None else walk.join(among.select("id").distinct(), "id", "left_semi")
    parts = above.select(F.col("id").alias("ancestor"), F.col("level").alias("_level"), F.explode(
        _blocks(F.col("pre") + 1, F.col("pre") + F.col("size"), levels)).alias("b")).select("ancestor", "_level", "b.level", "b.number")
    places = nodes.select("id", F.col("level").alias("_own"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda x: F.struct(
        x.alias("level"), F.call_function("shiftright", F.col("pre"), x).alias("number")))).alias("b")).select("id", "_own", "b.level", "b.number")
    return parts.join(places, ["level", "number"]).select("id", "ancestor", (F.col("_own") - F.col("_level")).alias("depth"))


def covered(walk: DataFrame, of: DataFrame) -> DataFrame:
    """(id): the nodes below any of the nodes ``of`` (id), once each: one sort and a prefix sum."""
    tops = walk.join(of.select("id").distinct(), "id", "left_semi").filter("size > 1")
    marks = tops.select(F.lit(None).cast("long").alias("id"), F.explode(F.array(
        F.struct((F.col("pre") + 1).alias("at"), F.lit(1).alias("d")),
        F.struct((F.col("pre") + F.col("size")).alias("at"), F.lit(-1).alias("d")))).alias("m")).select("id", "m.at", "m.d")
    line = marks.unionByName(walk.select("id", F.col("pre").alias("at"), F.lit(0).alias("d")))
    line = ranked(line, [], [F.col("at"), F.col("id").asc_nulls_first(), F.col("d")], "r", {"deep": F.col("d")}, rows=walk.count() + 2 * tops.count())
    return line.filter("id IS NOT NULL AND deep > 0").select("id")
