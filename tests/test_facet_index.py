"""Bitmap facets against plain sets: selections, own filters, dense and rare values, odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from contentspark.operators import facet_index as FI


def table(spark, n=9000, seed=1):
    rng = random.Random(seed)
    rows = [(i * 7 - 50, rng.choice(["red", "red", "blue", None]), rng.sample([f"t{k}" for k in range(40)], rng.randrange(4)) + ["all"],
             rng.randrange(100)) for i in range(n)]
    rows += [(10**9, "red", None, 5), (10**9 + 1, None, ["t1", "t1", None], None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, colour string, tags array<string>, price int")
    index = FI.FacetIndex.build(df, "id", {"colour": F.array("colour"), "tags": F.col("tags")}, {"price": F.col("price")})
    return rows, index


def values(row):
    return {("colour", row[1])} - {("colour", None)} | {("tags", t) for t in row[2] or [] if t is not None}


def plain(rows, selected, match, of=None):
    chosen = {(f, v) for f, vals in selected.items() for v in vals}
    test = (lambda h: chosen <= h) if match == "all" else (lambda h: not chosen or bool(chosen & h))
    return [r for r in rows if test(values(r))]


@pytest.fixture(scope="module")
def built(spark):
    return table(spark)


@pytest.mark.parametrize("match", ["all", "any"])
@pytest.mark.parametrize("selected", [{"colour": ["red"]}, {"colour": ["red", "blue"], "tags": ["t3"]}, {"tags": ["t1", "t2"]}, {"tags": ["nowhere"]},
                                      {"tags": ["all"]}])
def test_documents_and_counts(built, selected, match):
    rows, index = built
    got = sorted(r.id for r in index.documents(index.mask_of_selection(selected, match)).collect())
    assert got == sorted(r[0] for r in plain(rows, selected, match))
    counts = {(r.facet, r.value): r.doc_count for r in index.counts_ignoring_own(["colour", "tags"], selected, match, F.col("price") > 30).collect()}
    want = {}
    for facet in ("colour", "tags"):
        of = selected if match == "all" else {k: v for k, v in selected.items() if k != facet}
        for r in plain(rows, of, match):
            if r[3] is not None and r[3] > 30:
                for f, v in values(r):
                    if f == facet:
                        want[(f, v)] = want.get((f, v), 0) + 1
    assert counts == want


def test_no_selection_and_no_filter(built):
    rows, index = built
    got = {(r.facet, r.value): r.doc_count for r in index.counts_ignoring_own(["colour", "tags"], {}, "any").collect()}
    assert got[("tags", "all")] == len(rows) - 2 and got[("colour", "red")] == sum(r[1] == "red" for r in rows)


def test_empty_table(spark):
    index = FI.FacetIndex.build(spark.createDataFrame([], "id long, c string"), "id", {"c": F.array("c")})
    assert index.counts_ignoring_own(["c"], {"c": ["x"]}, "any").count() == 0
    assert index.documents(index.mask_of_selection({"c": ["x"]})).count() == 0
