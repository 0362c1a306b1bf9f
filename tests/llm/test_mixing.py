"""Mixing: water-filled targets and seats against plain loops, totals near the targets, odd rows."""

import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from contentspark.llm import mixing as op

SCHEMA = "doc_id long, text string, source string, n_chars long, size string, rank int, key string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, len(t or ""), "clash", 1, "k") for i, t, s in rows], SCHEMA)


def plain_targets(sizes):
    """{source: target}: share out by weight, cap, share the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: op.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, done = Fraction(3, 2) * sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in done]
        rest, all_weights = total - sum(done.values()), sum(weight[s] for s in left)
        share = {s: rest * weight[s] / all_weights for s in left}
        over = [s for s in left if share[s] > 2 * sizes[s]]
        if not over:
            return done | share
        done |= {s: Fraction(2 * sizes[s]) for s in over}


def plain_seats(weights, total, most):
    won = [0] * len(weights)
    for _ in range(total):
        i = max((i for i in range(len(won)) if won[i] < most[i]),
                key=lambda i: (Fraction(weights[i]) / (2 * won[i] + 1), -i))
        won[i] += 1
    return won


ODD = [(1, None, "a"), (2, "", "a"), (None, "one two", None), (None, "one two", None), (3, " \t", "empty"),
       (4, "x " * 30_000, "B"), (5, "w" * 100_000, "é"), (5, "two words", "é"), (6, "a b c", "a"), (6, "a b c", "a")]


def corpus(n=400, seed=5):
    rng = random.Random(seed)
    return [(100 + i, " ".join(["word"] * rng.choice([1, 5, 50, 300])), "hot" if i % 3 == 0 else f"s{rng.randrange(9)}")
            for i in range(n)]


@pytest.mark.parametrize("rows", [corpus(), corpus(60) + ODD, ODD, [(1, "a", "s")]])
def test_targets_and_taken(spark, rows):
    got = op.mix(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert sorted(r.size for r in got) == sorted(len(re.findall(op.WORD, t or "")) for _, t, _ in rows)
    source = {}
    for _, t, s in rows:
        source[s] = source.get(s, 0) + len(re.findall(op.WORD, t or ""))
    want = plain_targets(source)
    assert sorted({r.target for r in got}) == pytest.approx(sorted({float(x) for x in want.values()}))
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    by = {}
    for r in got:
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    block = max(1, min(op.BLOCK_WORDS, sum(source.values()) // (len(source) * op.SOURCE_BLOCKS)))
    for (size, target), taken in by.items():
        same = sum(v == size for v in source.values())
        assert abs(sum(taken) - same * target) <= same * (1.5 * block + 2)


def test_empty_and_rerun(spark):
    assert op.mix(frame(spark, [])).count() == 0
    rows = corpus(120)
    one, two = (sorted(map(tuple, op.mix(frame(spark, r)).collect())) for r in (rows, rows[::-1]))
    assert one == two


def test_reruns_agree_where_ids_sources_and_sizes_tie(spark):
    """Rows that differ in their text alone, in two orders: the same rows take the same words."""
    rows = [(5 if i % 2 else None, f"only{i} " + "word " * 99, "s") for i in range(60)] + [(i, "a b", "t") for i in range(20)]
    out = []
    for given in (rows, rows[::-1]):
        got = op.mix(frame(spark, given)).select("doc_id", "text_hash", "taken").collect()
        out.append(sorted(map(str, got)))
    assert out[0] == out[1] and len(set(out[0])) > 60


def test_rows_without_ids_fill_all_shards(spark, monkeypatch):
    monkeypatch.setattr(op, "SHARD_ROWS", 50)
    rows = [(None, f"only{i} a b", "s") for i in range(2000)]
    sizes = [r["count"] for r in op._taken(frame(spark, rows), op.BLOCK_WORDS)[0].groupBy("shard").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 110


def test_shards_and_seats(spark, monkeypatch):
    monkeypatch.setattr(op, "SHARD_ROWS", 10)
    rows = corpus(300)
    got = op.mix(frame(spark, rows)).collect()
    hot = [r for r in got if r.doc_id % 3 == 1]
    assert abs(sum(r.taken for r in hot) - hot[0].target) <= 3 * op.BLOCK_WORDS


@pytest.mark.parametrize("seed", range(4))
def test_sainte_lague(spark, seed):
    rng = random.Random(seed)
    weights = [rng.choice([1, 3, 10, 55, 700]) for _ in range(12)]
    most = [2 * w for w in weights]
    total = rng.randrange(1, int(1.9 * sum(weights)))
    items = spark.createDataFrame([(i, float(w), m, total) for i, (w, m) in enumerate(zip(weights, most))],
                                  "item int, w double, most long, total long")
    got = [r.seats for r in op.sainte_lague(items, [], F.col("item")).orderBy("item").collect()]
    assert got == plain_seats(weights, total, most) and sum(got) == total


def test_mixed_rows_hold_the_words_taken(spark):
    rows = corpus(150) + ODD
    docs = frame(spark, rows)
    plan = op.mix(docs).collect()
    out = op.mixed(docs).collect()
    words = sum(len(re.findall(op.WORD, r.text or "")) for r in out)
    assert abs(words - sum(r.taken for r in plan)) <= 4
    assert all(r.n_chars == len(r.text) for r in out) and out[0].__fields__ == docs.columns


def picked_rows(docs):
    """The rows (doc_id, text) that the seats and picked blocks of ``docs`` ask for, cut out by plain loops."""
    lines, cut = (x.collect() for x in op._taken(docs, op.BLOCK_WORDS))
    picked = {}
    for b in cut:
        if b.picked:
            picked.setdefault((b.key, b.shard), set()).update(range(b.lo, b.hi))
    by_hash = {r.h: r.text for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    want, beyond = [], 0
    for r in lines:
        text, got = by_hash[r.text_hash] or "", picked.get((r.key, r.shard), set())
        spans = [m.span() for m in re.finditer(op.WORD, text)]
        taken = [k for k in range(r.size) if r.start + k in got]
        assert len(taken) == r.extra
        if r.size:
            want += [(r.doc_id, by_hash[r.text_hash])] * (r.full + (len(taken) == r.size))
        if len(taken) < r.size:
            starts = [k for k in taken if k - 1 not in taken]
            ends = [k for k in taken if k + 1 not in taken]
            want += [(r.doc_id, text[spans[a][0]:spans[b][1]]) for a, b in zip(starts, ends)]
            beyond += bool(taken) and max(taken) >= len(taken)
    return want, beyond


def test_mixed_cuts_the_picked_words_out_of_the_text(spark):
    rng = random.Random(8)
    rows = [(i, "".join(f"w{i}_{k}{rng.choice([' ', '  ', chr(9), chr(10)])}" for k in range(rng.choice([3, 700, 4000]))),
             f"s{i % 3}") for i in range(24)] + [(1, "a\tb c " * 90, "s0")] * 3
    docs = frame(spark, rows)
    want, beyond = picked_rows(docs)
    assert beyond > 3
    assert sorted((r.doc_id, r.text) for r in op.mixed(docs).collect()) == sorted(want)
