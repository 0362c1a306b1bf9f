"""Euler tours and list ranking against plain walks: deep chains, wide trees, cycles, forced jumps."""

import random

import pytest
from pyspark.sql import functions as F

from contentspark.operators import hierarchy as H
from contentspark.operators import intervals as I
from contentspark.operators import ranks as R
from contentspark.streaming import sync as SY


def frame(spark, rows):
    return spark.createDataFrame([(i, p, f"n{(i or 0) % 7}", (i or 0) % 5) for i, p in rows], "term_id long, parent long, name string, count long")


def forest(n, seed, wide=False):
    rng = random.Random(seed)
    ids = rng.sample(range(1, 10 * n), n)
    rows = [(ids[0], 0)]
    for k in range(1, n):
        up = 0 if rng.random() < 0.02 else ids[rng.randrange(max(0, k - (k if wide else 3)), k)]
        rows.append((ids[k], up))
    return rows


def plain(rows):
    """id -> (level, root, pre, size, descendants' count)."""
    ids = {i for i, _ in rows}
    children = {}
    for i, p in rows:
        children.setdefault(p if p in ids else 0, []).append(i)
    for c in children.values():
        c.sort(key=lambda i: (f"n{i % 7}", i))
    out, place, stack = {}, 0, [(r, 0, r) for r in reversed(children.get(0, []))]
    order = []
    while stack:
        i, level, root = stack.pop()
        out[i] = [level, root, place, 1, 0]
        order.append(i)
        place += 1
        stack += [(c, level + 1, root) for c in reversed(children.get(i, []))]
    up = dict(rows)
    for i in reversed(order):
        if up[i] in out:
            out[up[i]][3] += out[i][3]
            out[up[i]][4] += out[i][4] + i % 5
    return {i: tuple(v) for i, v in out.items()}


def walked(spark, rows):
    w = I.tour(frame(spark, rows), order=[(F.lower("name"), False)], sums={"below": F.col("count")})
    return {r.id: (r.level, r.root, r.pre, r.size, r.below) for r in w.collect()}


@pytest.mark.parametrize("base", [1 << 18, 40])
@pytest.mark.parametrize("rows", [forest(300, 1), forest(300, 2, wide=True), [(i, i - 1) for i in range(1, 400)], [(5, 0)], [(5, 9), (6, 5)]])
def test_tour(spark, monkeypatch, rows, base):
    monkeypatch.setattr(I, "BASE", base)
    if base < 1000:
        monkeypatch.setattr(R, "FEW", 10)
    assert walked(spark, rows) == plain(rows)


def test_chain_of_100000(spark):
    """Output linear in n: a row per node, no pairs."""
    n = 100_000
    chain = spark.range(1, n + 1).select(F.col("id").alias("term_id"), (F.col("id") - 1).alias("parent"), F.lit("x").alias("name"),
                                         F.lit(1).cast("long").alias("count"))
    h = H.with_hierarchy(chain, ancestors=False)
    assert h.count() == n
    assert h.filter("level != term_id - 1 OR n_descendants != 100000 - term_id OR children_count != n_descendants OR pre != level").isEmpty()


def test_pairs_and_covers(spark, monkeypatch):
    rows = forest(200, 3)
    up = {i: p for i, p in rows}
    above = {}
    for i in up:
        a, d = up[i], 1
        while a:
            above[(i, a)] = d
            a, d = up[a], d + 1
    walk = I.tour(frame(spark, rows))
    assert {(r.id, r.ancestor): r.depth for r in I.pairs_below(walk).collect()} == above
    some = [i for i, _ in rows[::9]]
    of = spark.createDataFrame([(i,) for i in some], "id long")
    assert {(r.id, r.ancestor): r.depth for r in I.pairs_below(walk, of=of).collect()} == {k: d for k, d in above.items() if k[1] in some}
    assert {(r.id, r.ancestor): r.depth for r in I.pairs_below(walk, among=of).collect()} == {k: d for k, d in above.items() if k[0] in some}
    assert sorted(r.id for r in I.covered(walk, of).collect()) == sorted({i for i, a in above if a in some})
    changed = of.withColumnRenamed("id", "term_id")
    want = set(some) | {i for i, a in above if a in some} | {a for i, a in above if i in some}
    assert sorted(r.term_id for r in SY.hierarchy_cascade(changed, frame(spark, rows)).collect()) == sorted(want)


@pytest.mark.parametrize("base", [1 << 18, 3])
def test_cycles_are_cut_at_their_smallest_id(spark, monkeypatch, base):
    monkeypatch.setattr(I, "BASE", base)
    rows = [(1, 2), (2, 1), (3, 2), (4, 4), (5, 0), (9, 7), (7, 8), (8, 9), (6, 8), (10, 99), (11, None)]
    got = {r.id: (r.parent, r.root, r.level, r.size, r.cut) for r in I.tour(frame(spark, rows)).collect()}
    assert got == {1: (None, 1, 0, 3, 2), 2: (1, 1, 1, 2, None), 3: (2, 1, 2, 1, None), 4: (None, 4, 0, 1, None), 5: (None, 5, 0, 1, None),
                   7: (None, 7, 0, 4, 8), 9: (7, 7, 1, 3, None), 8: (9, 7, 2, 2, None), 6: (8, 7, 3, 1, None),
                   10: (None, 10, 0, 1, None), 11: (None, 11, 0, 1, None)}


def test_empty(spark):
    assert I.tour(frame(spark, [])).count() == 0 and H.closure(frame(spark, [])).count() == 0


def test_threads_below_given_comments(spark):
    import datetime as dt

    day = lambda d: dt.datetime(2020, 1, d)
    c = spark.createDataFrame([(1, 0, day(1)), (2, 1, day(3)), (3, 1, day(2)), (4, 3, day(4)), (5, 0, day(1))],
                              "comment_ID long, comment_parent long, comment_date_gmt timestamp_ntz")
    whole = H.thread(c).orderBy("position").collect()
    assert [(r.comment_ID, r.root, r.level) for r in whole] == [(1, 1, 0), (3, 1, 1), (4, 1, 2), (2, 1, 1), (5, 5, 0)]
    some = H.thread(c, c.filter("comment_ID IN (1, 3)")).collect()
    assert sorted((r.root, r.comment_ID, r.level) for r in some) == [(1, 1, 0), (1, 2, 1), (1, 3, 1), (1, 4, 2), (3, 3, 0), (3, 4, 1)]
