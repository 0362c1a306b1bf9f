"""The manifest against a plain recursive tree: ragged levels, several blocks, ties, nulls, tampering."""

import hashlib
import random
import zlib

import pytest

from contentspark.llm import merkle_manifest as op

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, index int, size int, key int"
H = lambda s: hashlib.sha256(s.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return H("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)))


def climb(nodes, i):
    """Root, and the siblings of node i by level as (left, right)."""
    path = []
    while len(nodes) > 1:
        run = nodes[i - i % 8:i - i % 8 + 8]
        path.append(("".join(run[:i % 8]), "".join(run[i % 8 + 1:])))
        nodes = [H("".join(nodes[j:j + 8])) for j in range(0, len(nodes), 8)]
        i //= 8
    return nodes[0], path


def brute(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    for group in langs.values():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
    subroots = [climb([leaf(*r) for r in langs[x]], 0)[0] for x in order]
    out = []
    for n, x in enumerate(order):
        nodes = [leaf(*r) for r in langs[x]]
        for i, r in enumerate(langs[x]):
            path = climb(nodes, i)[1] + climb(subroots, n)[1]
            root, now = climb(subroots, n)[0], leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                now = leaf(r[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]), *r[2:])
            for a, b in path:
                now = H(a + now + b)
            out.append((r[0], leaf(*r), subroots[n], root, H("".join(a + b for a, b in path)), now, now == root))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1, 2, 3) for r in rows], SCHEMA)
    got = op.manifest(df).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    return got


def table(sizes, seed=1):
    rng, rows, i = random.Random(seed), [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((i, rng.choice(["Clean text É", "all lower", "", "X" * 500]), lang, rng.choice(["a", None]), rng.choice([7, None])))
            i += rng.randint(1, 9)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, "fr": 9, None: 1, "": 65}, {"é": 70, "z": 3, "a": 513}])
def test_against_recursive_trees(spark, sizes):
    got = check(spark, table(sizes))
    assert any(not r["verified"] for r in got) or len(got) < 5


@pytest.mark.parametrize("n", [9, 17, 64, 65, 73, 130, 520, 700])
def test_rounds(spark, monkeypatch, n):
    """Blocks of eight leaves: up to three rounds, last subtrees of every size."""
    monkeypatch.setattr(op, "HEIGHT", 1)
    monkeypatch.setattr(op, "SORT_ROWS", 50)
    check(spark, table({"en": n, "de": 8, "fr": 1}, n))


def test_many_languages(spark, monkeypatch):
    monkeypatch.setattr(op, "HEIGHT", 1)
    check(spark, table({f"l{i}": 1 + i % 3 for i in range(75)}))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, "A", "en", "s", 1), (None, "B", "en", "s", 1), (5, "A", "en", "s", 1), (5, "B", "en", "s", 1), (5, "B", "en", "s", 1),
            (6, None, None, None, None), (7, "Q" * 200_000, "fr", None, -3), (None, None, None, None, None), (8, "1:", "en", "", 0)]
    check(spark, rows)


def test_empty(spark):
    assert check(spark, []) == []
