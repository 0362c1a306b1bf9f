"""Bit-sliced SimHash links against brute force: all pairs, deep splits, chunks, dense balls, ties, nulls."""

import random
import re

import numpy as np
import pytest
import xxhash

from contentspark.llm import bitslice_simhash as op

SCHEMA = "doc_id long, text string, fp int, mask string, root int, lang string"


def plain_print(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    h = [xxhash.xxh64(" ".join(words[i:i + 4]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints):
    """Smallest member of every print's component, all pairs compared."""
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    p = sorted(root)
    for i, a in enumerate(p):
        for b in p[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in p}


def brute(rows):
    prints = [plain_print(t) for _, t in rows]
    root = components(set(prints))
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return sorted(((i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(rows, prints)), key=str)


def check(spark, rows):
    df = spark.createDataFrame([(i, t, 1, "clash", 2, None) for i, t in rows], SCHEMA)
    got = op.near_components(df).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    return got


def texts(n, seed=2):
    """Random texts, each with a few copies in which single words are changed."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["É", "Ünï", "A", "the"]
    rows = []
    while len(rows) < n:
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 4, 30, 120]))]
        for _ in range(rng.randint(1, 4)):
            rows.append((len(rows), rng.choice([" ", "  ", "\n", "\v"]).join(base)))
            base = list(base)
            base[rng.randrange(len(base))] = rng.choice(words)
    return rows


def test_against_brute_force(spark):
    got = check(spark, texts(300))
    assert any(r["component_id"] != r["doc_id"] for r in got)


def test_odd_rows(spark):
    check(spark, [(5, None), (3, ""), (None, " \t\n"), (9, "A b"), (8, "a B"), (8, "other words here"), (8, "other words here"),
                  (None, "alone without an id"), (1, "x " * 50_000), (2, "X\vx " * 50_000), (-4, "é É"), (4, "É É"), (7, "  a")])


def test_empty(spark):
    assert check(spark, []) == []


def ball(centre, n, rng, most=3):
    """Prints within ``most`` bits of the centre."""
    out = set()
    while len(out) < n:
        x = centre
        for _ in range(rng.randint(0, most)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return out


@pytest.mark.parametrize("bucket, chunk", [(4096, 2048), (20, 16), (3, 2)])
def test_links_of_prints(spark, monkeypatch, bucket, chunk):
    """Chains, dense balls and random prints; small buckets, so that every split and chunk pair is reached."""
    monkeypatch.setattr(op, "BUCKET", bucket)
    monkeypatch.setattr(op, "CHUNK", chunk)
    rng = random.Random(bucket)
    prints = {rng.getrandbits(64) for _ in range(150)} | ball(rng.getrandbits(64), 150, rng) | {0, (1 << 64) - 1, 0b11111, 0b1111}
    at = rng.getrandbits(64)
    for i in range(40):  # a chain of steps of 4 bits
        prints.add(at)
        for b in rng.sample(range(64), 4):
            at ^= 1 << b
    df = spark.createDataFrame([(op.signed(p),) for p in prints], "fp long")
    found = op.connected_components(op.links(df), "a", "b", "test").collect()
    got = {}
    for node, root in found:
        got.setdefault(root, set()).add(node)
    want = {}
    for p, r in components(prints).items():
        want.setdefault(r, set()).add(op.signed(p))
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_every_pair_shares_a_group():
    rng = random.Random(4)
    for mask in [0, *op.bit_groups(0), *op.bit_groups(op.bit_groups(0)[2])]:
        groups = op.bit_groups(mask)
        assert all(g & mask == mask for g in groups)
        for _ in range(200):
            free = [j for j in range(64) if not mask >> j & 1]
            differ = sum(1 << j for j in rng.sample(free, 4))
            assert any(g & differ == 0 for g in groups)


def test_counters_and_abandoned_blocks():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2)
    near = prints[:64] ^ np.uint64(0b10011)
    sliced = op.planes(np.concatenate([near, prints]))
    lanes = np.full(len(sliced), ~np.uint64(0), np.uint64)
    of, block = np.repeat(np.arange(64), len(sliced)), np.tile(np.arange(len(sliced)), 64)
    found, words, work = op.within_radius(prints, of, sliced, lanes, block)
    every = np.concatenate([near, prints, np.zeros(24, np.uint64)])
    got = {(of[p], block[p] * 64 + lane) for p, w in zip(found, words) for lane in range(64) if int(w) >> lane & 1}
    want = {(i, j) for i in range(64) for j in range(len(every)) if int(prints[i] ^ every[j]).bit_count() <= 4}
    assert got == want and len(want) >= 128
    assert work < 0.7 * 64 * len(of)  # most blocks are given up before their last plane
