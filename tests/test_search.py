"""Full-text operators against brute force on small fixtures."""

import itertools

from pyspark.sql import functions as F

from contentspark.functions.porter import stem
from contentspark.operators import analysis as A
from contentspark.operators import search as S


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


DOCS = [
    (1, "the quick brown fox jumps over the lazy dog"),
    (2, "quick fox"),
    (3, "the brown quick fox"),
    (4, "a fox that is quick and brown and very lazy"),
    (5, "brown brown fox quick quick"),
    (6, "Élan vital: café, cafe, cafés and caffè"),
]
QUERIES = [(10, "quick brown fox"), (11, "brown fox"), (12, "cafe"), (13, "lazy dog"), (14, "fox quick")]


def index(spark, analyzer="plain"):
    d = spark.createDataFrame(DOCS, "doc_id long, text string")
    rows = A.unpivot_fields(d, "doc_id", {"body": F.col("text")})
    return S.TextIndex.build(rows, analyzer)


def queries(spark):
    return spark.createDataFrame(QUERIES, "query_id long, query string")


def toks(s):
    import regex

    return regex.findall(r"[\p{L}\p{N}]+", s.lower())


def test_phrase_matches_brute_force(spark):
    got = {(r.query_id, r.doc_id) for r in S.phrase(queries(spark), index(spark), {"body": 1.0}).collect()}
    want = set()
    for qid, q in QUERIES:
        qt = toks(q)
        for did, text in DOCS:
            t = toks(text)
            if any(t[i:i + len(qt)] == qt for i in range(len(t))):
                want.add((qid, did))
    assert got == want


def slop_brute(qt, t, slop):
    occ = [[p - qi for p, w in enumerate(t) if w == term] for qi, term in enumerate(qt)]
    if any(not o for o in occ):
        return 0
    anchors = set()
    for combo in itertools.product(*occ):
        if max(combo) - min(combo) <= slop:
            anchors.add(min(combo))
    return len(anchors)


def test_sloppy_phrase_matches_brute_force(spark):
    for slop in (0, 2, 5):
        hits = S.sloppy_phrase(queries(spark), index(spark), {"body": 1.0}, slop=slop)
        got = {(r.query_id, r.doc_id) for r in hits.collect()}
        want = set()
        for qid, q in QUERIES:
            qt = toks(q)
            for did, text in DOCS:
                if slop_brute(qt, toks(text), slop):
                    want.add((qid, did))
        assert got == want, slop


def test_match_and_or(spark):
    hits_or = {(r.query_id, r.doc_id) for r in S.match(queries(spark), index(spark), {"body": 1.0}, "or").collect()}
    hits_and = {(r.query_id, r.doc_id) for r in S.match(queries(spark), index(spark), {"body": 1.0}, "and").collect()}
    for qid, q in QUERIES:
        for did, text in DOCS:
            words = set(toks(text))
            assert ((qid, did) in hits_or) == bool(words & set(toks(q)))
            assert ((qid, did) in hits_and) == set(toks(q)).issubset(words)


def test_fuzzy_expansion_is_exact(spark):
    idx = index(spark)
    qt = S.query_terms(queries(spark)).select("query_id", "term").distinct()
    for fz in (1, 2, "auto"):
        got = {(r.term, r.vterm) for r in S.fuzzy_expand(qt, idx.vocabulary(), fz).collect()}
        vocab = {w for _, t in DOCS for w in toks(t)}
        want = set()
        for _, q in QUERIES:
            for term in toks(q):
                k = fz if fz != "auto" else (0 if len(term) <= 2 else 1 if len(term) <= 5 else 2)
                want |= {(term, v) for v in vocab if lev(term, v) <= k}
        assert got == want, fz


def test_fuzzy_expansion_of_long_terms(spark):
    import random

    rng = random.Random(3)
    base = ["".join(rng.choice("abc") for _ in range(n)) for n in (22, 23, 24, 25, 26, 27, 40, 300)]

    def edit(w):
        i = rng.randrange(len(w))
        return rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abc") + w[i:], w[:i] + rng.choice("abc") + w[i + 1:]])

    vocab = set(base) | {edit(w) for w in base for _ in range(6)} | {edit(edit(w)) for w in base for _ in range(6)}
    vocab |= {edit(edit(edit(w))) for w in base for _ in range(6)}
    terms = sorted(set(base) | {edit(w) for w in base})
    qt = spark.createDataFrame([(1, t) for t in terms], "query_id long, term string")
    for fz in (1, 2):
        got = {(r.term, r.vterm) for r in S.fuzzy_expand(qt, spark.createDataFrame([(v,) for v in vocab], "term string"), fz).collect()}
        assert got == {(t, v) for t in terms for v in vocab if lev(t, v) <= fz}
    junk = spark.createDataFrame([("x" * 20_000,)], "term string")
    assert S.vocabulary_keys(junk, 2).count() < 10


def test_whole_text_queries_of_any_length(spark):
    words = [f"w{i}" for i in range(120)]
    docs = spark.createDataFrame([(1, "a " + " ".join(words) + " z"), (2, " ".join(words[:-1])), (3, " ".join(reversed(words)))],
                                 "doc_id long, text string")
    idx = S.TextIndex.build(A.unpivot_fields(docs, "doc_id", {"body": F.col("text")}))
    q = spark.createDataFrame([(7, " ".join(words))], "query_id long, query string")
    assert [r.doc_id for r in S.phrase(q, idx, {"body": 1.0}).collect()] == [1]
    assert sorted(r.doc_id for r in S.match(q, idx, {"body": 1.0}, "and").collect()) == [1, 3]
    assert sorted(r.doc_id for r in S.match(q, idx, {"body": 1.0}, "or").collect()) == [1, 2, 3]


def test_bm25_prefers_shorter_field(spark):
    hits = S.match(queries(spark), index(spark), {"body": 1.0}, "or").filter("query_id = 14").collect()
    score = {r.doc_id: r.score for r in hits}
    assert score[2] > score[1]  # both hold "fox quick"; doc 2 is shorter


def test_porter_stems():
    cases = {"caresses": "caress", "ponies": "poni", "relational": "relat", "hopping": "hop",
             "generalization": "gener", "running": "run"}
    assert {w: stem(w) for w in cases} == cases


def test_english_analyzer_drops_stop_words_keeps_positions(spark):
    d = spark.createDataFrame([(1, "the running of the dogs")], "doc_id long, text string")
    rows = A.unpivot_fields(d, "doc_id", {"body": F.col("text")})
    p = S.TextIndex.build(rows, "english").occurrences().orderBy("pos").collect()
    assert [(r.term, r.pos) for r in p] == [("run", 1), ("dog", 4)]


def test_highlight_and_excerpt(spark):
    df = spark.createDataFrame([("Quick brown fox; quickly!",)], "t string")
    r = df.select(S.highlight(F.col("t"), ["quick", "fox"], "em").alias("h")).first().h
    assert r == '<em class="search-highlight">Quick</em> brown <em class="search-highlight">fox</em>; quickly!'
    long = " ".join(f"w{i}" for i in range(60))
    e = spark.createDataFrame([(long,)], "t string").select(S.excerpt(F.col("t")).alias("e")).first().e
    assert e.startswith("w0 w1") and e.endswith(" […]") and len(e.split(" ")) == 56


def test_shingles_and_edge_ngrams(spark):
    d = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    rows = A.unpivot_fields(d, "doc_id", {"body": F.col("text")})
    sh = sorted((r.n, r.shingle) for r in A.shingles(rows, 2, 3).collect())
    assert sh == [(2, "a b"), (2, "b c"), (2, "c d"), (3, "a b c"), (3, "b c d")]
    e = spark.createDataFrame([(["Widget", "ab"],)], "t array<string>").select(A.edge_ngrams(F.col("t")).alias("g"))
    assert e.first().g == ["wid", "widg", "widge", "widget"]
