"""Pruned top-k against scoring everything, curated ranks and sessions against plain loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from contentspark.operators import curation as C
from contentspark.operators import ranks as R
from contentspark.operators import search as S
from contentspark.operators import topk as TK
from contentspark.streaming import sync as SY


def corpus(spark, n, seed=1):
    rng = random.Random(seed)
    words = [f"{c}{i}" for i in range(60) for c in ("alpha", "beta", "gam")]
    zipf = [1 / (i + 1) for i in range(len(words))]
    text = lambda k: " ".join(rng.choices(words, zipf, k=k))
    rows = [(i * 3, "title", text(rng.choice([0, 3, 6]))) for i in range(n)] + [(i * 3, "body", text(rng.choice([5, 40]))) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, field string, text string")
    queries = [(q, text(rng.choice([1, 4, 15]))) for q in range(12)] + [(50, "nothing here"), (51, "")]
    return docs, spark.createDataFrame(queries, "query_id long, query string")


WEIGHTS = {"title": 2.0, "body": 1.0}


def rows(df):
    return sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 6)) for r in df.collect())


@pytest.mark.parametrize("k", [1, 5, 400])
def test_top_match_equals_ranking_every_hit(spark, k):
    docs, q = corpus(spark, 300)
    index = S.TextIndex.build(docs).materialize()
    whole = S.top_k(S.match(q, index, WEIGHTS, "or").withColumn("score", S.milli(F.col("score"))), k)
    got = TK.top_match(q, index, WEIGHTS, k, key=S.milli)  # doubles that tie differ in their last bits
    assert rows(got.withColumn("score", S.milli(F.col("score")))) == rows(whole)


def test_rounded_keys_and_ties(spark):
    docs, q = corpus(spark, 200, 4)
    docs = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1))  # every document twice
    index = S.TextIndex.build(docs).materialize()
    whole = S.top_k(S.match(q, index, WEIGHTS, "or").withColumn("score", S.milli(F.col("score"))), 7)
    got = TK.top_match(q, index, WEIGHTS, 7, key=S.milli).withColumn("score", S.milli(F.col("score")))
    assert rows(got) == rows(whole)


def test_top_default_algorithm(spark):
    docs, q = corpus(spark, 150, 9)
    index = S.TextIndex.build(docs).materialize()
    whole = S.top_k(S.search(q, index, WEIGHTS, "default"), 4)
    assert rows(TK.top_default(q, index, WEIGHTS, 4)) == rows(whole)


def test_text_ids(spark):
    docs, q = corpus(spark, 120, 2)
    docs = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    index = S.TextIndex.build(docs).materialize()
    whole = S.top_k(S.match(q, index, WEIGHTS, "or").withColumn("score", S.milli(F.col("score"))), 3)
    assert rows(TK.top_match(q, index, WEIGHTS, 3, key=S.milli).withColumn("score", S.milli(F.col("score")))) == rows(whole)


def test_pruning_reads_a_fraction(spark):
    """Rare words decide: most postings of frequent words are never read."""
    rng = random.Random(2)
    texts = [(i, "body", " ".join(["the", "of"] + rng.choices([f"w{j}" for j in range(3000)], k=12))) for i in range(8000)]
    index = S.TextIndex.build(spark.createDataFrame(texts, "doc_id long, field string, text string")).materialize()
    q = spark.createDataFrame([(i, "the of " + " ".join(texts[i * 50][2].split()[2:6])) for i in range(10)], "query_id long, query string")
    seen = {}
    got = TK.top_match(q, index, {"body": 1.0}, 3, seen=seen)
    assert rows(got) == rows(S.top_k(S.match(q, index, {"body": 1.0}, "or"), 3))
    read = sum(seen[s].count() for s in ("rare", "first-docs", "strong", "weak"))
    every = S._scored(S.query_terms(q).select("query_id", "term").distinct(), index, ["body"]).count()
    assert read < every / 5


def test_ranked_matches_a_window(spark):
    rng = random.Random(3)
    data = [(rng.choice("aab"), rng.randrange(50), i, rng.randrange(9)) for i in range(500)]
    df = spark.createDataFrame(data, "g string, v long, id long, n long")
    got = R.ranked(df, ["g"], [F.col("v").desc(), F.col("id")], "r", {"before": F.col("n")}).collect()
    few = R.ranked(df, ["g"], [F.col("v").desc(), F.col("id")], "r", {"before": F.col("n")}, rows=len(data)).collect()
    assert sorted((r.id, r.r, r.before) for r in got) == sorted((r.id, r.r, r.before) for r in few)
    want = []
    for g in "ab":
        run = 0
        for r, row in enumerate(sorted((x for x in data if x[0] == g), key=lambda x: (-x[1], x[2])), 1):
            want.append((row[2], r, run))
            run += row[3]
    assert sorted((r.id, r.r, r.before) for r in got) == sorted(want)
    assert R.ranked(df.limit(0), ["g"], [F.col("v")], "r").count() == 0


def pinned_plainly(hits, pins):
    """Organic order without the pinned documents, then each pin put at its place, in order of position."""
    order = [d for _, d in sorted((-s, d) for d, s in hits if d not in {d for d, _ in pins})]
    out = list(order)
    for d, p in sorted(pins, key=lambda x: (x[1], x[0])):
        taken = {x for x, y in pins if (y, x) < (p, d)}
        at = p - 1
        while at < len(out) and out[at] in taken:
            at += 1
        out.insert(min(at, len(out)), d)
    return {d: i + 1 for i, d in enumerate(out)}


def test_pins_against_plain_insertion(spark):
    rng = random.Random(5)
    hits, pointers, want = [], [], {}
    for q in range(12):
        of = [(d, rng.randrange(20)) for d in rng.sample(range(100), rng.choice([0, 3, 40]))]
        pins = list(zip(rng.sample(range(100), 5), rng.choice([[1, 2, 3, 4, 5], [1, 4, 9, 30, 77], [2, 2, 2, 6, 6], [50, 51, 60, 60, 99]])))
        hits += [(q, f" Term {q}", d, s) for d, s in of]
        pointers += [(f"tERM {q}", d, p) for d, p in pins]
        if of:  # a query without hits is not in the results
            want |= {(q, d): (p, d in dict(pins)) for d, p in pinned_plainly(of, pins).items()}
    got = C.pin(spark.createDataFrame(hits, "query_id long, query string, doc_id long, score long"),
                spark.createDataFrame(pointers, "search_term string, doc_id long, position int")).collect()
    assert {(r.query_id, r.doc_id): (r.position, r.pinned) for r in got} == want


def test_sessions_from_parts(spark):
    rng = random.Random(8)
    start, data = dt.datetime(2024, 3, 1), []
    for kind in ("hot", "cold"):
        at = start
        for _ in range(1500 if kind == "hot" else 5):
            at += dt.timedelta(seconds=rng.choice([0, 1, 30, 1199, 1200, 1201, 5000]))
            data.append((kind, at))
    df = spark.createDataFrame(data, "kind string, ts timestamp_ntz")
    want, gap = [], dt.timedelta(minutes=20)
    for kind in ("hot", "cold"):
        run = []
        for ts in sorted(t for k, t in data if k == kind) + [dt.datetime(2030, 1, 1)]:
            if run and ts - run[-1] >= gap:
                want.append((run[0], run[-1] + gap, kind, len(run)))
                run = []
            run.append(ts)
    assert sorted(map(tuple, SY.session_counts(df, "ts", "kind", "20 minutes").collect())) == sorted(want)
    assert SY.session_parts(df, "ts", "kind", "20 minutes").count() < len(data)
