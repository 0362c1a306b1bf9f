"""Connected components against union-find: random graphs, chains, hubs, loops and nulls."""

import random

import pytest

from contentspark.llm import components as op


def plain(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return sorted((x, find(x)) for x in root)


def graphs():
    rng = random.Random(2)
    yield [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    yield [(i, i + 1) for i in range(90)] + [(200, 150), (150, 199)]
    yield [(0, i) for i in range(1, 700)] + [(900, i) for i in range(600, 650)] + [(5000 + i, 900) for i in range(600)]
    yield [(1, 1), (None, 2), (3, None), (5, 4), (4, 5), (5, 4)]
    yield []


@pytest.mark.parametrize("edges", list(graphs()))
@pytest.mark.parametrize("hub", [500, 3])
def test_components(spark, monkeypatch, edges, hub):
    monkeypatch.setattr(op, "HUB_EDGES", hub)
    df = spark.createDataFrame(edges, "a long, b long")
    got = sorted(tuple(r) for r in op.connected_components(df, "a", "b", "test").collect())
    assert got == plain(edges)
