"""Ranked search against brute force: pruning, many segments and groups, ties, repeated ids, nulls."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from contentspark.llm import geometric_search as op

DOCS = "doc_id long, text string, row long, id int, words string, score double"
ITEMS = "item_id long, text string, row long, q int"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(TERM, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    tok = [(i, Counter(terms(t))) for i, t in docs]
    used = [(i, c, c.total()) for i, c in tok if c]
    N, L = len(used), sum(n for _, _, n in used)
    df = Counter(w for _, c, _ in used for w in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in used:
            m = 75 + 25 * n * N // L
            s = sum(times * math.floor(1000 * math.log((2 * N + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m))
                    for w, times in Counter(terms(text)).items() if c[w])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def check(spark, docs, items, k=20):
    d = spark.createDataFrame([(i, t, 1, 2, "clash", 0.0) for i, t in docs], DOCS)
    q = spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEMS)
    got = sorted(map(tuple, op.search(d, q, k).collect()), key=str)
    assert got == brute(docs, items, k)
    return got


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    zipf = [1 / (i + 1) for i in range(400)]
    text = lambda m: " ".join(rng.choices(words, zipf, k=m))
    docs = [(i * 3, text(rng.choice([1, 5, 30, 200]))) for i in range(n)]
    docs += [(n * 3 + i, docs[i % 5][1]) for i in range(40)]  # copies tie
    items = [(i, text(rng.choice([1, 3, 12, 40]))) for i in range(15)]
    return docs, items + [(99, docs[3][1] + " w1 w1 W1, É")]


def test_against_brute_force(spark):
    check(spark, *corpus(500))


def test_small_segments_groups_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(op, "SEGMENT_ROWS", 40)
    monkeypatch.setattr(op, "GROUP_POSTINGS", 30)
    monkeypatch.setattr(op, "FIRST_BLOCKS", 2)
    docs, items = corpus(200, 5)
    check(spark, docs, items[:6] + items[-1:], k=3)


def test_vocabulary_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(op, "BROADCAST_ROWS", 0)
    check(spark, *corpus(150, 7))


def test_odd_rows(spark):
    docs = [(5, "Alpha beta"), (5, "alpha, BETA"), (None, "alpha beta"), (7, None), (8, ""), (9, "..."), (1, "é alpha" + " x" * 30_000),
            (2, "É alpha"), (3, "alpha\x00beta"), (4, "gamma-delta_gamma"), (None, None)]
    items = [(1, "alpha"), (1, "beta beta É é"), (None, "gamma"), (2, None), (3, "nowhere"), (4, " "), (5, "x alpha delta " * 40)]
    check(spark, docs, items)
    check(spark, docs, items, k=2)


def test_empty(spark):
    docs, items = corpus(5)
    assert check(spark, [], items) == [] == check(spark, docs, [])
    assert check(spark, [(1, None)], items) == []


def test_blocks_follow_similarity_and_bounds_hold():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(4, op.SKETCH)).astype(np.float32)
    of = rng.integers(0, 4, 640)
    sketches = centres[of] + rng.normal(scale=0.05, size=(640, op.SKETCH)).astype(np.float32)
    label = op.cluster(sketches / np.linalg.norm(sketches, axis=1, keepdims=True))
    assert all(len(set(of[label == x])) == 1 for x in set(label)) and np.bincount(label).max() <= op.BLOCK
    counts, most = np.array([[3, 1 << 40]]), np.array([[1 << 40, 1 << 20], [7, 0]])
    assert op.products(counts, most).tolist() == [[3 * (1 << 40) + (1 << 60), 21]]


def test_most_blocks_are_skipped(spark):
    """Documents about one topic each: a query's threshold closes nearly all blocks of other topics."""
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choices([f"t{i % 30}x{j}" for j in range(20)] + ["the", "of"], k=40))) for i in range(3000)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, "the t4x1 t4x2 t4x3 of t4x4")], "item_id long, text string")
    opened = []
    plain = op._scored
    op._scored = lambda f, b, s, label: opened.append((label, b.select("q", op.F.explode("docs")).distinct().count())) or plain(f, b, s, label)
    try:
        op.search(rows, items).collect()
    finally:
        op._scored = plain
    assert dict(opened)["rank-open"] < 300
