"""Queries for suggestion, completion, spelling and related documents (SUG-1..8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from contentspark.operators import analysis as A
from contentspark.operators import documents as DOC
from contentspark.operators import fields as FL
from contentspark.operators import search as S
from contentspark.operators import suggest as SG
from contentspark.plans.registry import query
from contentspark.plans.sqlviews import V_POSTS, tokens, with_views
from contentspark.session import written
from contentspark.sources import views as V
from contentspark.sources.tables import Tables


def product_rows(spark, sf):
    p = Tables(spark, sf).part
    return A.unpivot_fields(p, "p_partkey", {"post_title": F.col("p_name"),
                                             "term_suggest": F.concat_ws(" ", "p_brand", "p_type")})


def name_prefix_queries(spark, sf):
    p = Tables(spark, sf).part
    q = F.substring("p_name", 1, 6)
    return p.select(q.alias("query_id"), q.alias("query")).distinct()


SUG_SQL = f"""
WITH qs AS (SELECT DISTINCT substr(p_name, 1, 6) AS query_id FROM part),
qtok AS (SELECT DISTINCT query_id, unnest({tokens('query_id')}) AS ptok FROM qs),
qn AS (SELECT query_id, count(*) AS n FROM qtok GROUP BY query_id),
fr AS (SELECT p_partkey AS doc_id, 'post_title' AS field, p_name AS txt FROM part
       UNION ALL SELECT p_partkey, 'term_suggest', p_brand || ' ' || p_type FROM part),
toks AS (SELECT DISTINCT doc_id, field, unnest({tokens('txt')}) AS tok FROM fr),
h AS (SELECT q.query_id, p.doc_id, count(DISTINCT q.ptok) AS m, count(DISTINCT p.field) AS f
      FROM qtok q JOIN toks p ON starts_with(p.tok, q.ptok) GROUP BY ALL),
matches AS (SELECT h.query_id, h.doc_id, h.f AS matched_fields FROM h JOIN qn ON qn.query_id = h.query_id WHERE h.m = qn.n)
"""


@query("sug1_prefix_completion", SUG_SQL + "SELECT query_id, doc_id, matched_fields FROM matches")
def sug1_prefix_completion(spark, sf):
    """Every distinct 6-character product-name prefix completed against titles and term names."""
    return SG.complete(name_prefix_queries(spark, sf), SG.prefix_index(product_rows(spark, sf), min_len=1))


@query("sug3_completion_top5", SUG_SQL + """
SELECT query_id, doc_id, rank FROM (
  SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY matched_fields DESC,
         TIMESTAMP '2023-01-01 00:00:00' + to_hours(doc_id::BIGINT) DESC, doc_id) AS rank FROM matches
) WHERE rank <= 5""")
def sug3_completion_top5(spark, sf):
    m = SG.complete(name_prefix_queries(spark, sf), SG.prefix_index(product_rows(spark, sf), min_len=1))
    posts = V.v_posts(spark, sf, types=["product"])
    return SG.completion_top_k(m, posts, k=5).select("query_id", "doc_id", "rank")


def misspelled_queries(spark, sf):
    """Benchmark queries with their longest token's 2nd and 3rd letters swapped (a typo)."""
    q = V.v_queries(spark, sf)
    t = S.analyze(F.col("query"))
    longest = F.aggregate(t, F.lit(""), lambda acc, x: F.when(F.length(x) > F.length(acc), x).otherwise(acc))
    typo = F.concat(F.substring(longest, 1, 1), F.substring(longest, 3, 1), F.substring(longest, 2, 1),
                    F.substring(longest, 4, 1 << 20))
    return q.select("query_id", F.array_join(F.transform(t, lambda x: F.when(x == longest, typo).otherwise(x)), " ")
                    .alias("query"))


def phrases(spark, sf, k: int):
    """The k likeliest phrases of every misspelled query."""
    rows = A.unpivot_fields(Tables(spark, sf).documents, "doc_id", {"post_content": F.col("text")})
    idx = S.cached_index("documents:post_content=text", rows)
    uni, bi, totals = SG.language_model(A.shingles(rows, 2, 2), idx.postings)
    uni, bi = written(uni, "unigrams"), written(bi, "bigrams")
    totals = uni.agg(F.sum("c").alias("n_tokens"), F.count(F.lit(1)).cast("double").alias("vocab"))
    return SG.best_phrases(SG.spelling_lattice(misspelled_queries(spark, sf), idx.vocabulary(), uni, bi, totals), k)


SPELLING_SQL = f'''
WITH RECURSIVE dt AS (SELECT doc_id, {tokens('text')} AS toks FROM documents),
uni AS (SELECT term, count(*) AS c FROM (SELECT unnest(toks) AS term FROM dt) GROUP BY term),
bi AS (SELECT w1, w2, count(*) AS c FROM (SELECT unnest(toks[:-2]) AS w1, unnest(toks[2:]) AS w2 FROM dt WHERE len(toks) > 1)
       GROUP BY ALL),
tot AS (SELECT sum(c) AS n, count(*) AS v FROM uni),
q0 AS (SELECT item_id AS query_id, {tokens('text')} AS t FROM benchmark),
q1 AS (SELECT query_id, t, list_filter(t, lambda x: length(x) = list_max(list_transform(t, lambda y: length(y))))[1] AS l FROM q0),
q AS (SELECT query_id, list_transform(t, lambda x: CASE WHEN x = l
        THEN substr(l, 1, 1) || substr(l, 3, 1) || substr(l, 2, 1) || substr(l, 4) ELSE x END) AS t FROM q1),
ctx AS (SELECT query_id, i AS pos, t[i + 1] AS term FROM (SELECT query_id, t, unnest(range(len(t))) AS i FROM q)),
qw AS (SELECT DISTINCT term FROM ctx),
chars AS (SELECT ch, row_number() OVER (ORDER BY ch) AS r FROM (
  SELECT DISTINCT unnest(string_split(term, '')) AS ch FROM (SELECT term FROM uni UNION SELECT term FROM qw))),
cm AS (SELECT map_from_entries(list(struct_pack(k := ch, v := chr((32 + r)::INTEGER)))) AS m FROM chars),
qe AS (SELECT term, array_to_string(list_transform(string_split(term, ''), lambda c: map_extract_value(cm.m, c)), '') AS e FROM qw, cm),
ve AS (SELECT term, array_to_string(list_transform(string_split(term, ''), lambda c: map_extract_value(cm.m, c)), '') AS e FROM uni, cm),
pairs AS (SELECT qe.term, ve.term AS vterm, levenshtein(qe.e, ve.e) AS d FROM qe JOIN ve
          ON abs(length(qe.e) - length(ve.e)) <= 2 AND levenshtein(qe.e, ve.e)
             <= CASE WHEN length(qe.e) <= 2 THEN 0 WHEN length(qe.e) <= 5 THEN 1 ELSE 2 END
          UNION SELECT term, term, 0 FROM qw),
words AS (
  SELECT p.term, p.vterm, ln((coalesce(u.c, 0) + 1) / (tot.n + tot.v)) + p.d * ln(0.05) + CASE WHEN u.c IS NULL THEN 3 * ln(0.05) ELSE 0 END AS own,
         coalesce(u.c, 0) + tot.v AS norm
  FROM pairs p CROSS JOIN tot LEFT JOIN uni u ON u.term = p.vterm),
nodes AS (SELECT query_id, pos, term, vterm, own, norm FROM ctx JOIN words USING (term)),
steps AS (
  SELECT a.query_id, b.pos, a.vterm AS prev, a.term AS prev_term, b.vterm, b.term, b.own + ln((coalesce(bi.c, 0) + 1) / a.norm) AS logp
  FROM nodes a JOIN nodes b ON b.query_id = a.query_id AND b.pos = a.pos + 1 LEFT JOIN bi ON bi.w1 = a.vterm AND bi.w2 = b.vterm),
vit AS (
  SELECT query_id, pos, vterm, own AS score, vterm AS path, 1::BIGINT AS r FROM nodes WHERE pos = 0
  UNION ALL
  SELECT * FROM (
    SELECT s.query_id, s.pos, s.vterm, v.score + s.logp AS score, v.path || ' ' || s.vterm AS path,
           row_number() OVER (PARTITION BY s.query_id, s.vterm ORDER BY round(v.score + s.logp, 9) DESC, v.path) AS r
    FROM vit v JOIN steps s ON s.query_id = v.query_id AND s.pos = v.pos + 1 AND s.prev = v.vterm)
  WHERE r <= 6),
base AS (
  SELECT query_id, sum(own) AS said FROM (
    SELECT query_id, own FROM nodes WHERE pos = 0 AND vterm = term
    UNION ALL SELECT query_id, logp FROM steps WHERE prev = prev_term AND vterm = term) GROUP BY query_id),
best AS (
  SELECT v.query_id, v.path AS suggestion, array_to_string(q.t, ' ') AS query, round(v.score - b.said, 9) AS gain,
         row_number() OVER (PARTITION BY v.query_id ORDER BY round(v.score, 9) DESC, v.path) AS rank
  FROM vit v JOIN q ON q.query_id = v.query_id AND v.pos = len(q.t) - 1 JOIN base b ON b.query_id = v.query_id),
said AS (SELECT query_id, query, suggestion, 1 - exp(-gain) AS score FROM best WHERE rank = 1)
'''


@query("sug4_spelling_suggestions", SPELLING_SQL + "SELECT * FROM said WHERE suggestion <> query AND score > 0.0001")
def sug4_spelling_suggestions(spark, sf):
    """Noisy-channel phrase corrections (score > 0.0001) for typo'd queries: the best path of each lattice."""
    return SG.spelling(misspelled_queries(spark, sf), phrases(spark, sf, 1))


@query("sug5_min_score_strict", SPELLING_SQL + "SELECT * FROM said WHERE suggestion <> query AND score > 0.99")
def sug5_min_score_strict(spark, sf):
    """The same with a 0.99 minimum score: weaker suggestions are dropped."""
    return SG.spelling(misspelled_queries(spark, sf), phrases(spark, sf, 1), min_score=0.99)


@query("sug6_suggest_only_when_empty", SPELLING_SQL + """
SELECT * FROM said WHERE suggestion <> query AND score > 0.0001 AND query_id NOT IN (
  SELECT q.query_id FROM q JOIN dt ON list_has_all(dt.toks, q.t))""")
def sug6_suggest_only_when_empty(spark, sf):
    """Suggestions only for typo'd queries whose AND match finds nothing."""
    q = misspelled_queries(spark, sf)
    hits = S.match(q, V.documents_index(spark, sf), {"post_content": 1.0}, "and")
    return SG.only_when_empty(SG.spelling(q, phrases(spark, sf, 1)), hits)


@query("sug6_alternatives", SPELLING_SQL + """,
alt AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS place FROM best
        WHERE rank <= 6 AND suggestion <> query AND gain > 0)
SELECT query_id, place AS rank, suggestion, 1 - exp(-gain) AS score FROM alt WHERE place <= 5""")
def sug6_alternatives(spark, sf):
    """Up to five whole phrases per query that are likelier than it, best first."""
    return SG.alternatives(misspelled_queries(spark, sf), phrases(spark, sf, 6), 5)


RELATED_FIELDS = ["post_title", "post_content", "terms.source.name"]


@query("sug7_related_documents", with_views(V_POSTS) + f''',
fr AS (SELECT id, post_title AS txt FROM v_posts WHERE post_type IN ('post', 'page')
       UNION ALL SELECT id, post_content FROM v_posts WHERE post_type IN ('post', 'page')
       UNION ALL SELECT id, source FROM v_posts WHERE post_type = 'post'),
occ AS (SELECT id, unnest({tokens('txt')}) AS term FROM fr),
tf AS (SELECT id, term, count(*) AS tf FROM occ GROUP BY ALL),
lens AS (SELECT id, sum(tf) AS len FROM tf GROUP BY id),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(*) AS n, avg(len) AS avg_len FROM lens),
top AS (SELECT id AS source_id, term, df, count(*) OVER (PARTITION BY id) AS nq FROM (
          SELECT tf.id, tf.term, df.df, row_number() OVER (PARTITION BY tf.id
                   ORDER BY tf.tf * ln(1.0 + (n.n - df.df + 0.5) / (df.df + 0.5)) DESC, tf.term) AS r
          FROM tf JOIN df USING (term) CROSS JOIN n JOIN v_posts p ON p.id = tf.id AND p.post_type = 'post') WHERE r <= 12),
per AS (SELECT t.source_id, tf.id AS doc_id, any_value(t.nq) AS nq, count(*) AS m,
               round(sum(ln(1.0 + (n.n - t.df + 0.5) / (t.df + 0.5)) * tf.tf * 2.2
                         / (tf.tf + 1.2 * (0.25 + 0.75 * l.len / n.avg_len))), 6) AS score
        FROM top t JOIN tf ON tf.term = t.term AND tf.id <> t.source_id JOIN lens l ON l.id = tf.id CROSS JOIN n
        JOIN v_posts p ON p.id = tf.id AND p.post_type = 'post' GROUP BY t.source_id, tf.id)
SELECT source_id, doc_id, round(score * 1000)::BIGINT AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY score DESC, doc_id) AS rank FROM per
  WHERE m >= ceil(nq * 0.3)) WHERE rank <= 5''')
def sug7_related_documents(spark, sf):
    """More-like-this for every post over titles, contents and source tags of posts and pages: top-12 tf-idf
    terms, >= 30 % matched, top 5 among the posts."""
    posts = V.v_posts(spark, sf, types=["post", "page"])
    rows = FL.field_rows(posts, RELATED_FIELDS)
    idx = S.cached_index("v_posts(post,page):" + ",".join(RELATED_FIELDS), rows)
    ids = V.v_posts(spark, sf, types=["post"]).select(F.col("id").alias("doc_id"))
    out = SG.related(idx, ids, RELATED_FIELDS, 12, 0.3, 5, among=ids)
    return out.select("source_id", "doc_id", S.milli(F.col("score")).alias("score"), "rank")


@query("sug8_order_completion", f"""
WITH o AS (
  SELECT o.o_orderkey, o.o_orderkey::VARCHAR AS order_number,
         list_filter(['customer' || c.c_custkey::VARCHAR || '@example.com', c.c_mktsegment, c.c_name],
                     lambda x: x IS NOT NULL AND x <> '') AS terms
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
),
qs AS (SELECT DISTINCT lower(substr(c_mktsegment, 1, 4)) AS query_id FROM customer),
pre AS (SELECT DISTINCT o_orderkey AS doc_id, substr(tok, 1, i) AS prefix
        FROM (SELECT o_orderkey, unnest({tokens("array_to_string(list_append(terms, order_number), ' ')")}) AS tok FROM o),
             range(3, 11) r(i) WHERE i <= length(tok))
SELECT qs.query_id, pre.doc_id FROM qs JOIN pre ON pre.prefix = qs.query_id""")
def sug8_order_completion(spark, sf):
    """Order number, billing e-mail and names completed by segment prefixes."""
    t = Tables(spark, sf)
    docs = DOC.order_suggest_terms(t.orders, t.customer)
    rows = docs.select(F.col("o_orderkey").alias("doc_id"), F.lit("term_suggest").alias("field"),
                       F.array_join(F.concat(F.col("term_suggest"), F.array(F.col("order_number"))), " ").alias("text"))
    q = t.customer.select(F.lower(F.substring("c_mktsegment", 1, 4)).alias("query_id")).distinct() \
        .withColumn("query", F.col("query_id"))
    return SG.complete(q, SG.prefix_index(rows)).select("query_id", "doc_id")
