"""N-gram join: gram sets and classes against brute force, chunked parts, edge cases."""

import random
import re

import numpy as np
import pyarrow as pa

from contentspark.llm import ngram_join as op


def sets_of(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = {}
    for i, t in rows:
        if i is not None and sets_of(t):
            sets.setdefault(frozenset(sets_of(t)), []).append(i)
    reps = {min(v): s for s, v in sets.items()}
    ids = sorted(reps)
    links = {i: [j for j in ids if j != i and len(reps[i] & reps[j]) >= 0.8 * len(reps[i] | reps[j])] for i in ids}
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            m = min([root[i], *(root[j] for j in links[i])])
            changed |= m != root[i]
            root[i] = m
    out = []
    for i, t in rows:
        s = frozenset(sets_of(t))
        if i is None or not s:
            out.append((i, i, i, 1, 0))
        else:
            rep = min(sets[s])
            out.append((i, root[rep], rep, len(sets[s]), len(links[rep])))
    return out


def key(r):
    return tuple((x is None, x) for x in r)


def corpus(n=60, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, base = [], []
    for i in range(n):
        if base and rng.random() < 0.5:
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.choice([3, 30, 120, 400]))]
        base.append(w)
        rows.append((i, " ".join(w)))
    return rows


EDGES = [(900, None), (901, ""), (902, "  \n"), (903, "One two"), (904, "one  TWO"), (None, "one two"),
         (905, "a b c d e"), (905, "a b c d e"), (906, "é " * 9), (907, "x" * 100_000), (908, "y z " * 30_000)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "b") for i, t in rows], "doc_id long, text string, rep int, part string")


def test_gram_sets_match_tuples():
    texts = [t for _, t in corpus() + EDGES]
    found = list(op.gram_sets(pa.array(texts, pa.string()).slice(2)))
    assert [len(f) for f in found] == [len(sets_of(t)) for t in texts[2:]]
    again = list(op.gram_sets(pa.array([texts[7]])))[0]
    assert (again == found[5]).all()


def test_banding_reaches_recall():
    bands, rows = op.banding(0.8, 0.999, 150)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= 150


def test_intersections():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 500, k).astype(np.uint64)) for k in (1, 40, 200, 300)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = op.intersections(sets[:2], sets[2:])
    assert (got == np.array(want)[:2, 2:]).all()
    both = op.intersections(sets, None)
    assert all(both[i][j] == want[i][j] for i in range(4) for j in range(4) if i != j)


def test_classes_against_brute_force(spark):
    rows = corpus() + EDGES
    got = sorted((tuple(r) for r in op.near_classes(frame(spark, rows)).collect()), key=key)
    assert got == sorted(brute(rows), key=key)


def test_parts_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(op, "CHUNK_GRAMS", 300)
    rows = [(i, t) for i, (_, t) in enumerate([r for r in corpus(40, 8) if len(r[1]) > 300] * 2)]
    got = sorted((tuple(r) for r in op.near_classes(frame(spark, rows)).collect()), key=key)
    assert got == sorted(brute(rows), key=key)


def test_one_of_each_class_and_empty(spark):
    rows = corpus(30) + EDGES
    kept = sorted((r.doc_id for r in op.one_of_each_class(frame(spark, rows)).collect()), key=lambda x: (x is None, x))
    want = sorted((i for i, c, *_ in brute(rows) if i == c), key=lambda x: (x is None, x))
    assert kept == want
    assert op.near_classes(frame(spark, [])).count() == 0


def test_texts_that_share_an_id_stay_unless_another_stands_for_them(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(3, a), (7, a + " z"), (7, b), (9, b + " y"), (None, a), (None, None), (11, None), (11, "")]
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], "doc_id long, text string, rep int, _near string")
    got = sorted(((r.doc_id, r.text) for r in op.one_of_each_class(docs).collect()), key=str)
    assert got == sorted([(3, a), (7, b), (None, a), (None, None), (11, None), (11, "")], key=str)
