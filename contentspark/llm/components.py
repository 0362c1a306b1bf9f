"""Connected components of an edge table: alternating large-star and small-star rounds.

Every round is two grouped minima, each met with the edges again. A hub's edges would meet
its minimum in one task, so nodes with many edges are taken apart: there are at most
``HUBS`` of them (twice the edges divided by the threshold), their minima are broadcast,
and only the other nodes, whose edges are few, are joined by a shuffle. Each half round is
written to the shared folder, so a lost executor repeats half a round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentspark.llm.common import materialize

HUB_EDGES = 500  # edges of a node that make it a hub, at least
HUBS = 100_000   # hubs there can be, so that their table is small enough to broadcast


def _with_least(edges: DataFrame, node: str, other: str, total: int, label: str) -> DataFrame:
    """``edges`` with m, the smallest ``other`` of each ``node``; ``total`` is their number or more."""
    least = materialize(edges.groupBy(node).agg(F.min(other).alias("m"), F.count("*").alias("n")), f"{label}-least")
    hub = F.col("n") > max(HUB_EDGES, total // HUBS)
    hubs = F.broadcast(least.where(hub).select(node, "m"))
    rest = least.where(~hub).select(node, "m")
    return edges.join(hubs, node).unionByName(edges.join(hubs, node, "left_anti").join(rest, node))


def _large_star(e: DataFrame, total: int, label: str) -> DataFrame:
    both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
        e.select(F.col("v").alias("x"), F.col("u").alias("y")))
    met = _with_least(both, "x", "y", 2 * total, label)
    return met.where("y > x").select(F.col("y").alias("u"), F.least("x", "m").alias("v")).distinct()


def _small_star(e: DataFrame, total: int, label: str) -> DataFrame:
    met = _with_least(e, "u", "v", total, label)
    # Besides its other neighbours, a node itself is tied to its smallest one (the row where v is m).
    return met.select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"),
                      F.col("m").alias("v")).distinct()


def connected_components(edges: DataFrame, a: str, b: str, label: str) -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of its component.

    Edges with a null end and loops are left out.
    """
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e, before = materialize(e, f"{label}-edges"), None
    while True:
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)).first()
        if now == before:
            break
        before, total = now, now[0]
        large = materialize(_large_star(e, total, label), f"{label}-large")
        e = materialize(_small_star(large, total, label), f"{label}-small")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
