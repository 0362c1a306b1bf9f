"""Exact dedup: code round trip, edge cases against brute force, one row of each text stays."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contentspark.llm import exact_dedup as op

SCHEMA = "doc_id long, text string, hash string, norm string"
ROWS = [(1, "a b"), (2, "a \t\n b"), (3, None), (4, ""), (5, "x" * 200_000), (6, "x" * 200_000), (7, " a b"),
        (None, "a b"), (8, "solo"), (9, "a b"), (9, "a b"), (10, " é"), (11, " é"), (None, "none"), (None, "none")]


@given(st.sets(st.integers(0, 2**59), max_size=300), st.integers(0, 40))
@settings(max_examples=80, deadline=None)
def test_golomb_round_trip(values, shift):
    v = np.unique(np.array(sorted(values), dtype=np.int64) >> shift)
    assert (op.golomb_decode(op.golomb_encode(v)) == v).all()


def test_golomb_is_smaller_than_raw():
    v = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 50_000))
    assert len(op.golomb_encode(v)) < 0.55 * v.nbytes


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], SCHEMA)


def brute(rows):
    out = []
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    for (i, _), n in zip(rows, norm):
        ids = [j for (j, _), m in zip(rows, norm) if m == n]
        keep = min((j for j in ids if j is not None), default=None)
        out.append((i, keep, len(ids), i == keep))
    return out


def key(r):
    return tuple((x is None, x) for x in r)


@pytest.mark.parametrize("rows", [ROWS, [(i, "same") for i in range(400)] + [(1000 + i, f"t{i}") for i in range(50)], []])
def test_groups_against_brute_force(spark, rows):
    got = [tuple(r)[:4] for r in op.exact_groups(frame(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_several_blocks_and_owners(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_ROWS", 7)
    rows = [(i, f"text {i % 60}") for i in range(300)]
    got = [tuple(r)[:4] for r in op.exact_groups(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_fingerprint_clashes_are_verified_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(op, "SPARE_BITS", -8)  # nearly every document is a suspect
    rows = [(i, f"text {i % 200}") for i in range(300)]
    got = [tuple(r)[:4] for r in op.exact_groups(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_deduplicate_keeps_one_row_of_each_text(spark):
    out = op.deduplicate(frame(spark, ROWS))
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in out.collect()]
    assert out.columns == ["doc_id", "text", "hash", "norm"]
    assert sorted(texts) == sorted({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in ROWS})
