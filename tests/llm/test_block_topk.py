"""Top-k search against brute force: ties, signs, pruning, large numbers, vectors that take no part."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from contentspark.llm import block_topk as op

SCHEMA = "vec_id long, embedding array<float>, rank int, block string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "clash") for i, v in rows], SCHEMA)


def cut(x):
    return max(-2**63, min(2**63 - 1, x))


def brute(rows, every=100, k=10):
    ok = [(i, [cut(math.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in ok:
        if i % every == 0:
            queries[i] = min(v, queries.get(i, v))
    out = []
    for q, v in queries.items():
        found = sorted((-cut(sum(a * b for a, b in zip(v, w))), i) for i, w in ok if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def vectors(n, seed=1, width=6, ties=False):
    rng = random.Random(seed)
    value = (lambda: rng.choice([-0.5, 0.0, 0.5])) if ties else (lambda: rng.uniform(-1, 1))
    return [(i, [value() for _ in range(width)]) for i in range(n)]


ODD = [(1000, None), (1001, [None, 1.0]), (1100, [float("nan")]), (1200, [float("inf"), 0.0]), (None, [1.0]), (1300, []),
       (1400, [0.25]), (1500, [3e38, -3e38, 1.0]), (1600, [1e30] * 3), (1700, [0.1] * 9), (100, [0.5, 0.5]), (100, [0.5, 0.5])]


@pytest.mark.parametrize("rows", [vectors(700), vectors(700, ties=True), vectors(120) + ODD, vectors(5), ODD, [(0, [1.0])],
                                  [(i, [0.5, 0.25]) for i in range(300)]])
def test_against_brute_force(spark, rows):
    got = sorted(map(tuple, op.top_k(frame(spark, rows), F.col("vec_id") % 100 == 0).collect()))
    assert got == brute(rows)


def test_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_ROWS", 7)
    monkeypatch.setattr(op, "RANGE_ROWS", 90)
    monkeypatch.setattr(op, "BATCH_QUERIES", 3)
    rows = vectors(600, 9)
    got = sorted(map(tuple, op.top_k(frame(spark, rows), F.col("vec_id") % 20 == 0, k=4).collect()))
    assert got == brute(rows, 20, 4)


def test_empty(spark):
    assert op.top_k(frame(spark, []), F.col("vec_id") % 100 == 0).count() == 0


def test_pruning_skips_blocks():
    rng = np.random.default_rng(3)
    blocks = []
    for b in range(20):  # each block has its own direction
        m = rng.integers(-20, 20, (50, 20)).astype(np.int64)
        m[:, b] += 1000
        blocks.append((np.arange(50) + 50 * b, m, m.max(axis=0), m.min(axis=0)))
    q = np.eye(20, dtype=np.int64)[:5] * 500
    rows, scored = op.search_tile(blocks, np.arange(5) + 5000, q, 10)
    assert scored < 5 * 20 / 4 and len(rows) == 50
    every = np.concatenate([b[1] for b in blocks])
    for i in range(5):
        assert sorted((s for x, _, s in rows if x == 5000 + i), reverse=True) == sorted(every @ q[i], reverse=True)[:10]
