"""What may be broadcast, shuffled and written by queries on large tables, seen in their plans and tables."""

import math

from pyspark.sql import functions as F

from contentspark.operators import suggest as SG


def plan_of(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def part_names(spark):
    return spark.createDataFrame([(1, "f", "hot bolt"), (1, "g", "hot"), (2, "f", "hotel boat"), (2, "f", "hotel boat"), (3, "f", "cold bolt")],
                                 "doc_id long, field string, text string")


def test_completion_broadcasts_queries_only(spark, tmp_path):
    part_names(spark).write.parquet(str(tmp_path / "docs"))  # a small file, so its estimate would allow a broadcast
    q = spark.createDataFrame([("a", "hot bo"), ("b", "bol")], "query_id string, query string")
    got = SG.complete(q, SG.prefix_index(spark.read.parquet(str(tmp_path / "docs")), min_len=1))
    assert "BuildRight" in plan_of(got) and "BuildLeft" not in plan_of(got)
    assert {tuple(r) for r in got.collect()} == {("a", 1, 2), ("a", 2, 1), ("b", 1, 1), ("b", 3, 1)}


def test_completion_top_k_shuffles_posts(spark, tmp_path):
    posts = spark.createDataFrame([(1, "post", "publish", 5), (2, "post", "publish", 9), (3, "post", "trash", 9)],
                                  "id long, post_type string, post_status string, post_date long")
    posts.write.parquet(str(tmp_path / "posts"))
    matches = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 3, 2)], "query_id string, doc_id long, matched_fields long")
    got = SG.completion_top_k(matches, spark.read.parquet(str(tmp_path / "posts")), 1)
    assert "BroadcastHashJoin" not in plan_of(got)
    assert [(r.query_id, r.doc_id, r["rank"]) for r in got.collect()] == [("a", 2, 1)]


def test_views_build_what_is_read_only(spark, sf_small):
    from contentspark.functions.meta import live_meta
    from contentspark.operators import facets as G
    from contentspark.operators import predicates as P
    from contentspark.plans import q_facets
    from contentspark.sources import views as V

    posts = V.v_posts(spark, sf_small, lists=True)
    optimized = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    size = posts.select(P.meta_clause({"key": "size", "value": 48, "compare": ">"}).alias("x"))
    assert "p_retailprice" not in optimized(size).split("Relation")[0] and "to_date" not in optimized(size)
    assert "RLIKE" not in optimized(G.distinct_map_keys(posts))
    assert "StructsToJson" not in optimized(q_facets.agg7_taxonomy_facet(spark, sf_small))
    same_keys = F.sort_array("meta_keys") == F.sort_array(F.map_keys(live_meta(F.col("meta"))))
    same_slugs = F.forall(F.map_entries("terms"), lambda e: F.transform(e["value"], lambda t: t["slug"]).eqNullSafe(F.col("term_slugs")[e["key"]]))
    assert posts.filter(~same_keys | ~same_slugs).isEmpty()


def test_matches_shuffle_postings_not_hits(spark):
    from contentspark.operators import search as S

    docs = spark.createDataFrame([(i, "f", "aa bb cc" if i % 2 else "aa dd") for i in range(3000)] + [(1, "f", "aa bb cc")],
                                 "doc_id long, field string, text string")
    q = spark.createDataFrame([(i, "aa bb") for i in range(600)], "query_id long, query string")
    idx = S.TextIndex.build(docs).materialize()
    assert [(r.tf, r.positions) for r in idx.postings.filter("doc_id = 1 and term = 'bb'").collect()] == [(2, [1, 1])]
    hits = S.match(q, idx, {"f": 2.0}, "or")
    plan = plan_of(hits)
    assert "FlatMapCoGroups" in plan and "HashAggregate" not in plan.split("FlatMapCoGroups")[0]
    assert hits.count() == 600 * 3000
    assert S.match(q, idx, {"f": 2.0}, "and").count() == 600 * 1500


def test_rare_terms_are_joined_not_dealt_to_tiles(spark, monkeypatch):
    from contentspark.operators import search as S

    rows = [(i, f, f"{'order ' if f == 'title' else ''}{i}") for i in range(2500) for f in ("title", "id")]
    rows += [(7, "title", "order 7 again"), (None, "title", "order 9"), (8, "id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, field string, text string")
    q = spark.createDataFrame([(i, f"{i} {i + 1}" if i % 5 == 0 else str(i)) for i in range(1200)] + [(None, "3"), (-1, "")],
                              "query_id long, query string")
    idx, weights = S.TextIndex.build(docs), {"title": 2.0, "id": 1.0}
    found = lambda df: sorted((r.query_id, r.doc_id is None, r.doc_id or 0, r["field"] if "field" in df.columns else "", round(r.score, 6)) for r in df.collect())
    ways = [lambda: S.match(q, idx, weights, "or"), lambda: S.match(q, idx, weights, "and"), lambda: S.field_scores(q, idx, list(weights))]
    few_queries = q.filter("query_id < 40")
    fuzzy = [lambda op=op: S.match(few_queries, idx, weights, op, fuzziness=1) for op in ("or", "and")]
    joined = []
    for way in ways:
        got = way()
        assert "FlatMapCoGroups" not in plan_of(got)
        joined.append(found(got))
    assert len(joined[0]) > 1200
    monkeypatch.setattr(S, "_fewer_hits", lambda *a: True)
    joined += [found(way()) for way in fuzzy]
    monkeypatch.setattr(S, "_fewer_hits", lambda *a: False)
    assert [found(way()) for way in ways + fuzzy] == joined


def test_related_adds_up_in_tiles(spark, monkeypatch):
    from contentspark.operators import search as S

    texts = [f"w{i % 7} w{i % 11} w{i % 3} common x{i // 2}" for i in range(60)] + ["alone", "w0 w0 common", None]
    docs = spark.createDataFrame([(i, "f", t) for i, t in enumerate(texts)], "doc_id long, field string, text string")
    idx = S.TextIndex.build(docs).materialize()
    ids = docs.select("doc_id").filter("doc_id <> 13")

    def best():
        df = SG.related(idx, docs.select("doc_id"), ["f"], 4, 0.5, 3, among=ids)
        assert "FlatMapCoGroups" in plan_of(df)  # the pairs meet in tiles, and no row per pair is shuffled
        return sorted(tuple(r) for r in df.collect())

    whole = best()
    monkeypatch.setattr(SG, "TILE_DOCS", 7)
    monkeypatch.setattr(SG, "TILE_SOURCES", 5)
    assert best() == whole

    words = {i: t.split() for i, t in enumerate(texts) if t}
    n, avg = len(words), sum(map(len, words.values())) / len(words)
    df = {w: sum(w in ws for ws in words.values()) for ws in words.values() for w in ws}
    idf = {w: math.log(1 + (n - c + 0.5) / (c + 0.5)) for w, c in df.items()}
    want = []
    for a, ws in words.items():
        top = sorted(set(ws), key=lambda w: (-ws.count(w) * idf[w], w))[:4]
        hits = []
        for b, other in words.items():
            common = [w for w in top if w in other]
            if b not in (a, 13) and len(common) >= math.ceil(len(top) * 0.5):
                norm = 1.2 * (0.25 + 0.75 * len(other) / avg)
                hits.append((-round(sum(idf[w] * other.count(w) * 2.2 / (other.count(w) + norm) for w in common), 6), b))
        want += [(a, b, -s, r) for r, (s, b) in enumerate(sorted(hits)[:3], 1)]
    assert [(a, b, r) for a, b, _, r in whole] == [(a, b, r) for a, b, _, r in sorted(want)]
    assert all(abs(x[2] - y[2]) < 1e-5 for x, y in zip(whole, sorted(want)))


def test_related_looks_frequent_terms_up(spark):
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    n_docs, n_terms, k = 400, 30, 3
    has = rng.random((n_docs, n_terms)) < np.linspace(0.01, 0.9, n_terms) ** 2 + 0.01
    tfs = rng.integers(1, 6, (n_docs, n_terms))
    norm, idf = rng.uniform(0.5, 2, n_docs), np.linspace(6, 0.2, n_terms)
    has[17], tfs[17], norm[17] = has[16], tfs[16], norm[16]  # equal documents tie
    left = pa.table({"doc_id": pa.array(np.arange(n_docs)), "tids": [np.flatnonzero(h) for h in has], "norm": norm,
                     "tfs": pa.array([t[h].tolist() for t, h in zip(tfs, has)], pa.list_(pa.int32()))})
    asked = [rng.choice(n_terms, 12, replace=False) for _ in range(60)] + [np.arange(18, 30), np.array([0, 29])]
    needs = [4] * 61 + [2]
    ids = [*range(10, 70), 1000, 1001]
    right = pa.table({"source_id": pa.array(ids), "need": needs, "tids": asked, "idfs": [idf[a] for a in asked]})
    want = []  # of a source: (source_id, doc_id, score), best first
    for source, need, terms in zip(ids, needs, asked):
        both = has[:, terms]
        s = (both * idf[terms] * tfs[:, terms] * 2.2 / (tfs[:, terms] + norm[:, None])).sum(axis=1)
        found = [(-round(s[d], 6), d) for d in np.flatnonzero(both.sum(axis=1) >= need) if d != source]
        want += [(source, int(d), -x) for x, d in sorted(found)[:k]]
    results = []
    for long_list in (10**9, 1):
        SG.LONG_LIST, was = long_list, SG.LONG_LIST
        try:
            got = sorted(SG._most_related(k)(left, right).to_pylist(), key=lambda r: (r["source_id"], -r["score"], r["doc_id"]))
        finally:
            SG.LONG_LIST = was
        results.append([(r["source_id"], r["doc_id"]) for r in got])
        assert [(r["source_id"], r["doc_id"]) for r in got] == [w[:2] for w in want]
        assert all(abs(r["score"] - w[2]) < 2e-6 for r, w in zip(got, want))
    assert results[0] == results[1]


def test_lattice_edges_come_from_fitting_bigrams(spark, monkeypatch):
    from contentspark.operators import search as S

    docs = spark.createDataFrame([(1, "f", "the cat sat on the mat"), (2, "f", "the car sat near the map"), (3, "f", "that cat ran on"), (4, "f", None)],
                                 "doc_id long, field string, text string")
    q = spark.createDataFrame([(1, "the cta sat on"), (2, "teh cat sat"), (3, "cat"), (None, "the cat"), (4, None)], "query_id long, query string")
    idx = S.TextIndex.build(docs).materialize()
    from contentspark.operators.analysis import shingles

    uni, bi, totals = SG.language_model(shingles(docs, 2, 2), idx.postings)
    names, write = [], SG.written
    monkeypatch.setattr(SG, "written", lambda df, name: (names.append(name), write(df, name))[1])
    monkeypatch.setattr(SG, "LIST_JOINTS", 2)  # the lists of joints are taken apart
    nodes, edges = SG.spelling_lattice(q, idx.vocabulary(), uni, bi, totals)
    assert "joints" in names  # words have lists of joints, and no row is made of a place and a bigram that does not fit it
    pairs = {(r.w1, r.w2): r.c for r in bi.collect()}
    at = [(r.query_id, r.pos, r.vterm, r.norm) for r in nodes.collect()]
    want = sorted((a[0], b[1], a[2], b[2], round(math.log(pairs[a[2], b[2]] + 1) - a[3], 9)) for a in at for b in at
                  if a[0] is not None and a[0] == b[0] and a[1] + 1 == b[1] and (a[2], b[2]) in pairs)
    assert want and sorted((r.query_id, r.pos, r.prev, r.vterm, round(r.logp, 9)) for r in edges.collect()) == want


def test_lookups_broadcast_counted_query_sides(spark):
    from contentspark.operators import search as S

    docs = spark.createDataFrame([(i, "f", f"aa w{i % 5} bb") for i in range(50)], "doc_id long, field string, text string")
    idx = S.TextIndex.build(docs).materialize()
    q = spark.createDataFrame([(1, "aa w1"), (2, "w2 bb")], "query_id long, query string")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_of(idx.postings_for(S.query_terms(q)))  # the postings are not shuffled for a few terms
        assert S.phrase(q, idx, {"f": 1.0}).count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_shingles_are_counted_where_they_are_read(spark, monkeypatch):
    from contentspark.operators import analysis as A

    rows = [(i, "f", f"Tom ran {'to ' * (i % 4)}w{i % 5} tom ran") for i in range(40)]
    rows += [(None, "f", "tom ran, tom ran"), (None, "f", "only here"), (50, "f", ""), (51, "f", "one"), (52, "f", "é x\n\té x")]
    twice = [(3, "f", "tom ran home"), (3, "g", "tom ran home"), (52, "g", "é x y")]

    def want(rows):
        freq, docs = {}, {}
        for d, _, text in rows:
            toks = "".join(c if c.isalnum() else " " for c in text.lower()).split()
            for n in (2, 3):
                for i in range(len(toks) - n + 1):
                    k = (n, " ".join(toks[i:i + n]))
                    freq[k] = freq.get(k, 0) + 1
                    docs.setdefault(k, set()).update([] if d is None else [d])
        return sorted((*k, f, len(docs[k])) for k, f in freq.items())

    def counted(rows):
        return A.shingles(spark.createDataFrame(rows, "doc_id long, field string, text string").repartition(3), 2, 3, counted=True)

    plan = plan_of(counted(rows))
    assert "MapInArrow" in plan and "Generate" not in plan  # no row per occurrence
    for tokens, chars in ((A.PIECE_TOKENS, A.BUCKET_CHARS), (7, 50)):
        monkeypatch.setattr(A, "PIECE_TOKENS", tokens)
        monkeypatch.setattr(A, "BUCKET_CHARS", chars)
        for given in (rows, rows + twice, [(1, "f", "")], [(1, "f", "a b")]):
            assert sorted(map(tuple, counted(given).collect())) == want(given)


def test_pin_reads_a_query_text_once(spark, monkeypatch):
    from contentspark.operators import curation as C

    q = spark.createDataFrame([(1, "Red bolt"), (2, "nut"), (2, "NUT "), (3, "no hits"), (None, "nut")], "query_id long, query string")
    hits = spark.createDataFrame([(1, 10, 9), (1, 11, 8), (2, 10, 5), (2, 12, 4)], "query_id long, doc_id long, score long")
    pointers = spark.createDataFrame([(" red BOLT", 30, 1), ("nut", 12, 2), ("no hits", 10, 1)], "search_term string, doc_id long, position int")
    organic = hits.join(q, "query_id")
    plans, write = [], C.written
    monkeypatch.setattr(C, "written", lambda df, name: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(df, name))[1])
    got, want = C.pin(organic, pointers, queries=q), C.pin(organic, pointers)
    assert "LeftSemi" in plans[0] and "LeftSemi" not in plans[1]  # ids of hits meet the texts, not texts the hits
    assert got.count() == 6 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_all_terms_are_found_by_few_keys_and_candidates(spark):
    from contentspark.operators import search as S

    vocabulary = spark.createDataFrame([(f"abcdefgh{i:02d}",) for i in range(40)], "term string")
    assert S.vocabulary_keys(vocabulary, 2).count() <= 40 * 6  # 56 deletion keys each
    docs = spark.createDataFrame([(i, "f", f"common rare{i % 7} odd{i % 5} even{i % 3}") for i in range(210)], "doc_id long, field string, text string")
    q = spark.createDataFrame([(1, "common rare1 odd1 even1"), (2, "rare2 nothing"), (3, "rare3")], "query_id long, query string")
    idx = S.TextIndex.build(docs).materialize()
    got = S.candidates(S.query_terms(q, "plain"), idx, ["f"], per_field=True).collect()
    whole = {(1, i) for i in range(210) if i % 7 == 1 and i % 5 == 1 and i % 3 == 1}
    assert {(r.query_id, r.doc_id) for r in got} == whole | {(3, i) for i in range(210) if i % 7 == 3} and len(got) == len(whole) + 30
    assert {r.doc_id for r in S.match(q, idx, {"f": 1.0}, "and").collect() if r.query_id == 1} == {i for _, i in whole}
    near = {r.doc_id for r in S.match(q, idx, {"f": 1.0}, "and", "auto").collect() if r.query_id == 1}
    assert {i for _, i in whole} < near
