"""Queries for analysis (DOC-22..24), full text (TXT) and scoring (SCR, SRT-10).

Test setup: ``documents`` searched on two fields, ``post_title`` (first line,
weight 2) and ``post_content`` (the whole text, weight 1); queries are the
benchmark items (whole texts; passages of them occur in documents).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from contentspark.functions.text import first_line
from contentspark.operators import analysis as A
from contentspark.operators import fields as FL
from contentspark.operators import search as S
from contentspark.operators import topk as TK
from contentspark.operators.predicates import post_filter
from contentspark.plans.registry import query
from contentspark.plans.sqlviews import tokens
from contentspark.sources import views as V
from contentspark.sources.tables import Tables

WEIGHTS = {"post_title": 2.0, "post_content": 1.0}


def doc_fields(spark, sf):
    d = Tables(spark, sf).documents
    return A.unpivot_fields(d, "doc_id", {"post_title": first_line(F.col("text")), "post_content": F.col("text")})


def doc_index(spark, sf, analyzer="plain"):
    return V.documents_index(spark, sf, analyzer)


def bench_queries(spark, sf):
    return V.v_queries(spark, sf)


def scored(df):
    return df.select("query_id", "doc_id", S.milli(F.col("score")).alias("score"))


# ---------------------------------------------------------------- SQL building blocks

TOK = tokens("{x}")
BASE_SQL = f"""
WITH q AS (SELECT item_id AS query_id, {tokens('text')} AS toks FROM benchmark),
qp AS (SELECT query_id, unnest(toks) AS term, unnest(range(len(toks))) AS qpos FROM q),
qt AS (SELECT DISTINCT query_id, term FROM qp),
qn AS (SELECT query_id, count(*) AS n_terms FROM qt GROUP BY query_id),
fr AS (SELECT doc_id, 'post_title' AS field, trim(split_part(text, chr(10), 1)) AS txt FROM documents
       UNION ALL SELECT doc_id, 'post_content', text FROM documents),
ft AS (SELECT doc_id, field, {tokens('txt')} AS toks FROM fr),
lens AS (SELECT doc_id, field, len(toks) AS len FROM ft),
st AS (SELECT field, count(*) AS n_docs, avg(len) AS avg_len FROM lens WHERE len > 0 GROUP BY field),
post AS (SELECT doc_id, field, unnest(toks) AS term, unnest(range(len(toks))) AS pos FROM ft),
qpost AS (SELECT * FROM post WHERE term IN (SELECT term FROM qt)),
tf AS (SELECT doc_id, field, term, count(*) AS tf FROM qpost GROUP BY ALL),
df AS (SELECT field, term, count(*) AS df FROM tf GROUP BY ALL),
ts AS (
  SELECT qt.query_id, tf.doc_id, tf.field, tf.term, tf.tf, l.len, st.avg_len, st.n_docs, df.df,
         ln(1.0 + (st.n_docs - df.df + 0.5) / (df.df + 0.5)) * tf.tf * 2.2
           / (tf.tf + 1.2 * (0.25 + 0.75 * l.len / st.avg_len)) AS s
  FROM qt JOIN tf ON tf.term = qt.term JOIN df ON df.field = tf.field AND df.term = tf.term
  JOIN lens l ON l.doc_id = tf.doc_id AND l.field = tf.field JOIN st ON st.field = tf.field
),
fs AS (SELECT query_id, doc_id, field, sum(s) AS s, count(*) AS m FROM ts GROUP BY ALL),
occ AS (SELECT qp.query_id, p.doc_id, p.field, qp.qpos, p.pos - qp.qpos AS off FROM qp JOIN qpost p ON p.term = qp.term),
npos AS (SELECT query_id, count(*) AS n_pos FROM qp GROUP BY query_id),
starts AS (SELECT o.query_id, o.doc_id, o.field, o.off FROM occ o JOIN npos n ON n.query_id = o.query_id
           GROUP BY ALL HAVING count(DISTINCT o.qpos) = max(n.n_pos)),
pf AS (SELECT query_id, doc_id, field, count(*) AS pf FROM starts GROUP BY ALL),
sidf AS (SELECT qt.query_id, df.field, sum(ln(1.0 + (st.n_docs - df.df + 0.5) / (df.df + 0.5))) AS sum_idf
         FROM qt JOIN df ON df.term = qt.term JOIN st ON st.field = df.field GROUP BY ALL),
ps AS (SELECT pf.query_id, pf.doc_id, pf.field,
              sidf.sum_idf * pf.pf * 2.2 / (pf.pf + 1.2 * (0.25 + 0.75 * l.len / st.avg_len))
              * CASE pf.field WHEN 'post_title' THEN 2.0 ELSE 1.0 END AS s
       FROM pf JOIN sidf ON sidf.query_id = pf.query_id AND sidf.field = pf.field
       JOIN lens l ON l.doc_id = pf.doc_id AND l.field = pf.field JOIN st ON st.field = pf.field),
bdf AS (SELECT term, max(df) AS bdf FROM df GROUP BY term),
xf AS (
  SELECT ts.query_id, ts.doc_id, ts.term,
         ln(1.0 + (ts.n_docs - b.bdf + 0.5) / (b.bdf + 0.5)) * ts.tf * 2.2
           / (ts.tf + 1.2 * (0.25 + 0.75 * ts.len / ts.avg_len)) AS s
  FROM ts JOIN bdf b ON b.term = ts.term
),
xt AS (SELECT query_id, doc_id, term, max(s) + 0.5 * (sum(s) - max(s)) AS s FROM xf GROUP BY ALL),
xs AS (SELECT xt.query_id, xt.doc_id, sum(s) AS s, count(*) AS m FROM xt GROUP BY ALL),
w AS (SELECT * FROM (VALUES ('post_title', 2.0), ('post_content', 1.0)) t(field, weight))
"""


# Phrases with slop: an anchor d is an offset such that every query position occurs at an offset in [d, d + 5].
SLOP_SQL = """,
full_docs AS (SELECT query_id, doc_id, field FROM occ JOIN npos USING (query_id)
              GROUP BY ALL HAVING count(DISTINCT qpos) = max(n_pos)),
off AS (SELECT DISTINCT query_id, doc_id, field, qpos, off FROM occ JOIN full_docs USING (query_id, doc_id, field)),
anchors AS (
  SELECT a.query_id, a.doc_id, a.field, a.off
  FROM (SELECT DISTINCT query_id, doc_id, field, off FROM off) a
  JOIN off b ON b.query_id = a.query_id AND b.doc_id = a.doc_id AND b.field = a.field AND b.off BETWEEN a.off AND a.off + 5
  JOIN npos n ON n.query_id = a.query_id
  GROUP BY ALL HAVING count(DISTINCT b.qpos) = max(n.n_pos)),
sf AS (SELECT query_id, doc_id, field, count(*) AS pf FROM anchors GROUP BY ALL),
ss AS (SELECT sf.query_id, sf.doc_id, max(
              sidf.sum_idf * sf.pf * 2.2 / (sf.pf + 1.2 * (0.25 + 0.75 * l.len / st.avg_len))
              * CASE sf.field WHEN 'post_title' THEN 2.0 ELSE 1.0 END) AS s
       FROM sf JOIN sidf ON sidf.query_id = sf.query_id AND sidf.field = sf.field
       JOIN lens l ON l.doc_id = sf.doc_id AND l.field = sf.field JOIN st ON st.field = sf.field GROUP BY ALL)
"""

# Clause scores per (query, document) that algorithms add up.
PHRASE_SQL = "SELECT query_id, doc_id, max(s) AS s FROM ps GROUP BY ALL"
AND_SQL = """SELECT fs.query_id, fs.doc_id, max(fs.s * w.weight) AS s FROM fs JOIN w ON w.field = fs.field
  JOIN qn ON qn.query_id = fs.query_id WHERE fs.m = qn.n_terms GROUP BY ALL"""
CROSS_SQL = "SELECT xs.query_id, xs.doc_id, xs.s FROM xs JOIN qn ON qn.query_id = xs.query_id WHERE xs.m = qn.n_terms"


def fuzzy_scores(k: str, only_all: bool) -> str:
    """SQL of fuzzy best-fields scores over ``qx`` (query_id, term, vterm); ``only_all``: AND."""
    return f"""
SELECT f.query_id, f.doc_id, max(f.s * w.weight) AS s FROM (
  SELECT query_id, doc_id, field, sum(s) AS s, count(*) AS m FROM (
    SELECT {k}.query_id, tf.doc_id, tf.field, {k}.term,
           max(ln(1.0 + (st.n_docs - df.df + 0.5) / (df.df + 0.5)) * tf.tf * 2.2
               / (tf.tf + 1.2 * (0.25 + 0.75 * l.len / st.avg_len))) AS s
    FROM {k} JOIN tf ON tf.term = {k}.vterm JOIN df ON df.field = tf.field AND df.term = tf.term
    JOIN lens l ON l.doc_id = tf.doc_id AND l.field = tf.field JOIN st ON st.field = tf.field GROUP BY ALL)
  GROUP BY ALL) f JOIN w ON w.field = f.field
  {"JOIN qn ON qn.query_id = f.query_id WHERE f.m = qn.n_terms" if only_all else ""} GROUP BY ALL"""


def added(*clauses: tuple[str, float]) -> str:
    """SQL of bool should: boosted clause scores summed per (query, document)."""
    union = " UNION ALL ".join(f"SELECT query_id, doc_id, s * {boost} AS s FROM ({sql})" for sql, boost in clauses)
    return f"SELECT query_id, doc_id, round(sum(s) * 1000)::BIGINT AS score FROM ({union}) GROUP BY ALL"


@query("doc22_postings", f"""
WITH fr AS (SELECT doc_id, 'post_title' AS field, trim(split_part(text, chr(10), 1)) AS txt FROM documents
            UNION ALL SELECT doc_id, 'post_content', text FROM documents),
ft AS (SELECT doc_id, field, {tokens('txt')} AS toks FROM fr)
SELECT doc_id, field, unnest(toks) AS term, unnest(range(len(toks))) AS pos FROM ft""")
def doc22_postings(spark, sf):
    return S.TextIndex.build(doc_fields(spark, sf)).occurrences().select("doc_id", "field", "term", "pos")


@query("doc22_term_stats", f"""
WITH fr AS (SELECT doc_id, 'post_title' AS field, trim(split_part(text, chr(10), 1)) AS txt FROM documents
            UNION ALL SELECT doc_id, 'post_content', text FROM documents),
post AS (SELECT doc_id, field, unnest({tokens('txt')}) AS term FROM fr)
SELECT field, term, count(DISTINCT doc_id)::BIGINT AS df, count(*)::BIGINT AS cf FROM post GROUP BY ALL""")
def doc22_term_stats(spark, sf):
    p = S.TextIndex.build(doc_fields(spark, sf)).postings
    return p.groupBy("field", "term").agg(F.count(F.lit(1)).cast("bigint").alias("df"),
                                          F.sum("tf").cast("bigint").alias("cf"))


@query("doc22_english_postings")
def doc22_english_postings(spark, sf):
    """english analyzer (stop words + Porter stems, pandas_udf): term statistics."""
    p = S.TextIndex.build(doc_fields(spark, sf), "english").postings
    return p.groupBy("field", "term").agg(F.sum("tf").cast("bigint").alias("cf"))


@query("doc23_shingles", f"""
WITH t AS (SELECT doc_id, {tokens('text')} AS toks FROM documents),
g AS (
  SELECT doc_id, 2 AS n, array_to_string(toks[i:i + 1], ' ') AS shingle
  FROM t, range(1, len(toks)) r(i)
  UNION ALL
  SELECT doc_id, 3, array_to_string(toks[i:i + 2], ' ') FROM t, range(1, len(toks) - 1) r(i)
)
SELECT n, shingle, count(*)::BIGINT AS freq, count(DISTINCT doc_id)::BIGINT AS docs FROM g
GROUP BY n, shingle""")
def doc23_shingles(spark, sf):
    """Word 2-3-grams of whole document texts with their occurrences and documents."""
    rows = A.unpivot_fields(Tables(spark, sf).documents, "doc_id", {"post_content": F.col("text")})
    return A.shingles(rows, 2, 3, counted=True)


@query("doc24_edge_ngrams", f"""
WITH t AS (SELECT p_partkey, unnest({tokens('p_name')}) AS tok FROM part)
SELECT DISTINCT p_partkey, substr(tok, 1, i) AS prefix FROM t, range(3, 11) r(i) WHERE i <= length(tok)""")
def doc24_edge_ngrams(spark, sf):
    from contentspark.functions.text import tokens as toks

    p = Tables(spark, sf).part
    return p.select("p_partkey", F.explode(A.edge_ngrams(toks(F.col("p_name")))).alias("prefix")).distinct()


@query("txt1_match_any", BASE_SQL + """
SELECT fs.query_id, fs.doc_id, round(max(fs.s * w.weight) * 1000)::BIGINT AS score
FROM fs JOIN w ON w.field = fs.field GROUP BY ALL""")
def txt1_match_any(spark, sf):
    return scored(S.match(bench_queries(spark, sf), doc_index(spark, sf), WEIGHTS, "or"))


@query("txt2_match_all", BASE_SQL + """
SELECT fs.query_id, fs.doc_id, round(max(fs.s * w.weight) * 1000)::BIGINT AS score
FROM fs JOIN w ON w.field = fs.field JOIN qn ON qn.query_id = fs.query_id WHERE fs.m = qn.n_terms GROUP BY ALL""")
def txt2_match_all(spark, sf):
    return scored(S.match(bench_queries(spark, sf), doc_index(spark, sf), WEIGHTS, "and"))


@query("txt3_phrase", BASE_SQL + """
SELECT query_id, doc_id, round(max(s) * 1000)::BIGINT AS score FROM ps GROUP BY ALL""")
def txt3_phrase(spark, sf):
    return scored(S.phrase(bench_queries(spark, sf), doc_index(spark, sf), WEIGHTS))


@query("txt4_sloppy_phrase", BASE_SQL + SLOP_SQL + "SELECT query_id, doc_id, round(s * 1000)::BIGINT AS score FROM ss")
def txt4_sloppy_phrase(spark, sf):
    """Phrase with slop 5."""
    return scored(S.sloppy_phrase(bench_queries(spark, sf), doc_index(spark, sf), WEIGHTS, 5))


@query("txt5_cross_fields", BASE_SQL + """
SELECT xs.query_id, xs.doc_id, round(xs.s * 1000)::BIGINT AS score FROM xs JOIN qn ON qn.query_id = xs.query_id
WHERE xs.m = qn.n_terms""")
def txt5_cross_fields(spark, sf):
    return scored(S.cross_fields(bench_queries(spark, sf), doc_index(spark, sf), list(WEIGHTS), "and", 0.5))


FUZZY_SQL = BASE_SQL.replace("qpost AS (SELECT * FROM post WHERE term IN (SELECT term FROM qt)),", """
voc AS (SELECT DISTINCT term FROM post),
chars AS (SELECT ch, row_number() OVER (ORDER BY ch) AS r FROM (
  SELECT DISTINCT unnest(string_split(term, '')) AS ch FROM (SELECT term FROM voc UNION SELECT term FROM qt))),
cm AS (SELECT map_from_entries(list(struct_pack(k := ch, v := chr((32 + r)::INTEGER)))) AS m FROM chars),
qe AS (SELECT query_id, term, array_to_string(list_transform(string_split(term, ''),
         lambda c: map_extract_value(cm.m, c)), '') AS e FROM qt, cm),
ve AS (SELECT term, array_to_string(list_transform(string_split(term, ''),
         lambda c: map_extract_value(cm.m, c)), '') AS e FROM voc, cm),
qx AS (SELECT qe.query_id, qe.term, v.term AS vterm FROM qe JOIN ve v ON abs(length(qe.e) - length(v.e)) <= 1 AND levenshtein(qe.e, v.e) <= 1),
qpost AS (SELECT * FROM post WHERE term IN (SELECT vterm FROM qx)),""")


@query("txt6_fuzzy", FUZZY_SQL + """,
fz AS (
  SELECT qx.query_id, tf.doc_id, tf.field, qx.term,
         max(ln(1.0 + (st.n_docs - df.df + 0.5) / (df.df + 0.5)) * tf.tf * 2.2
             / (tf.tf + 1.2 * (0.25 + 0.75 * l.len / st.avg_len))) AS s
  FROM qx JOIN tf ON tf.term = qx.vterm JOIN df ON df.field = tf.field AND df.term = tf.term
  JOIN lens l ON l.doc_id = tf.doc_id AND l.field = tf.field JOIN st ON st.field = tf.field
  GROUP BY ALL
),
fzf AS (SELECT query_id, doc_id, field, sum(s) AS s FROM fz GROUP BY ALL)
SELECT fzf.query_id, fzf.doc_id, round(max(fzf.s * w.weight) * 1000)::BIGINT AS score
FROM fzf JOIN w ON w.field = fzf.field GROUP BY ALL""")
def txt6_fuzzy(spark, sf):
    """OR match with fuzziness 1: vocabulary expansion through deletion keys, no cross join."""
    return scored(S.match(bench_queries(spark, sf), doc_index(spark, sf), WEIGHTS, "or", fuzziness=1))


@query("txt6_fuzzy_expansions", f"""
WITH q AS (SELECT item_id AS query_id, {tokens('text')} AS toks FROM benchmark),
qt AS (SELECT DISTINCT query_id, unnest(toks) AS term FROM q),
voc AS (SELECT DISTINCT unnest({tokens('text')}) AS term FROM documents),
chars AS (SELECT ch, row_number() OVER (ORDER BY ch) AS r FROM (
  SELECT DISTINCT unnest(string_split(term, '')) AS ch FROM (SELECT term FROM voc UNION SELECT term FROM qt))),
cm AS (SELECT map_from_entries(list(struct_pack(k := ch, v := chr((32 + r)::INTEGER)))) AS m FROM chars),
qe AS (SELECT query_id, term, array_to_string(list_transform(string_split(term, ''),
         lambda c: map_extract_value(cm.m, c)), '') AS e FROM qt, cm),
ve AS (SELECT term, array_to_string(list_transform(string_split(term, ''),
         lambda c: map_extract_value(cm.m, c)), '') AS e FROM voc, cm)
SELECT qe.query_id, qe.term, v.term AS vterm FROM qe JOIN ve v
  ON abs(length(qe.e) - length(v.e)) <= 2 AND levenshtein(qe.e, v.e) <= CASE WHEN length(qe.term) <= 2 THEN 0 WHEN length(qe.term) <= 5 THEN 1 ELSE 2 END""")
def txt6_fuzzy_expansions(spark, sf):
    """(The oracle re-encodes characters as single bytes: DuckDB's levenshtein counts bytes.)

    'auto' fuzziness expansions of every query token over the whole document vocabulary."""
    rows = A.unpivot_fields(Tables(spark, sf).documents, "doc_id", {"post_content": F.col("text")})
    idx = S.TextIndex.build(rows)
    qt = S.query_terms(bench_queries(spark, sf)).select("query_id", "term").distinct()
    return S.fuzzy_expand(qt, idx.vocabulary(), "auto").select("query_id", "term", "vterm")


@query("txt7_match_everything", "SELECT count(*)::BIGINT AS n, sum(1.0) AS total_score FROM documents")
def txt7_match_everything(spark, sf):
    hits = S.match_everything(Tables(spark, sf).documents)
    return hits.agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.sum("score").alias("total_score"))


@query("txt9_algorithm_default", FUZZY_SQL + added((PHRASE_SQL, 4.0), (AND_SQL, 2.0), (fuzzy_scores("qx", False), 1.0)))
def txt9_algorithm_default(spark, sf):
    return scored(S.search(bench_queries(spark, sf), doc_index(spark, sf), WEIGHTS, "default"))


@query("txt10_algorithm_350", BASE_SQL + SLOP_SQL + added((PHRASE_SQL, 3.0), ("SELECT query_id, doc_id, s FROM ss", 1.0)))
def txt10_algorithm_350(spark, sf):
    return scored(S.search(bench_queries(spark, sf), doc_index(spark, sf), WEIGHTS, "3.5"))


# Budgets of 'auto' fuzziness: 0, 1, 2 edits for up to 2, up to 5, more characters.
AUTO_SQL = FUZZY_SQL.replace(
    "abs(length(qe.e) - length(v.e)) <= 1 AND levenshtein(qe.e, v.e) <= 1",
    "abs(length(qe.e) - length(v.e)) <= 2 AND levenshtein(qe.e, v.e) <= "
    "CASE WHEN length(qe.e) <= 2 THEN 0 WHEN length(qe.e) <= 5 THEN 1 ELSE 2 END")


@query("txt11_algorithm_400", AUTO_SQL + added((PHRASE_SQL, 3.0), (fuzzy_scores("qx", True), 1.0), (CROSS_SQL, 1.0)))
def txt11_algorithm_400(spark, sf):
    return scored(S.search(bench_queries(spark, sf), doc_index(spark, sf), WEIGHTS, "4.0"))


@query("srt10_top_k_per_query", BASE_SQL + """,
m AS (SELECT fs.query_id, fs.doc_id, round(max(fs.s * w.weight) * 1000)::BIGINT AS score
      FROM fs JOIN w ON w.field = fs.field GROUP BY ALL)
SELECT query_id, doc_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM m) WHERE rank <= 5""")
def srt10_top_k_per_query(spark, sf):
    hits = scored(S.match(bench_queries(spark, sf), doc_index(spark, sf), WEIGHTS, "or"))
    return S.top_k(hits, 5).select("query_id", "doc_id", "score", "rank")


def page(best):
    return best.select("query_id", "doc_id", S.milli(F.col("score")).alias("score"), "rank")


def top_sql(scores: str, k: int) -> str:
    """SQL of the k best rows of scores (query_id, doc_id, score)."""
    return f"""
SELECT query_id, doc_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM ({scores})) WHERE rank <= {k}"""


@query("txt1_match_any_page", BASE_SQL + top_sql("""SELECT fs.query_id, fs.doc_id, round(max(fs.s * w.weight) * 1000)::BIGINT AS score
FROM fs JOIN w ON w.field = fs.field GROUP BY ALL""", 10))
def txt1_match_any_page(spark, sf):
    """The first page of ten of every OR match, most postings of frequent terms unread."""
    return page(TK.top_match(bench_queries(spark, sf), doc_index(spark, sf), WEIGHTS, 10, key=S.milli))


def flagship(spark, sf):
    """Benchmark phrases searched in documents: phrase x3 + AND x1, no passworded or excluded
    documents, top 5 per query."""
    t = Tables(spark, sf)
    docs = t.documents.join(t.labels, "doc_id", "left").filter(
        (F.coalesce(F.col("toxic"), F.lit(0)) != 1) & (F.coalesce(F.col("quality"), F.lit(1)) != 0))
    rows = A.unpivot_fields(docs, "doc_id", {"post_title": first_line(F.col("text")), "post_content": F.col("text")})
    idx = S.cached_index("documents-public:post_title=first_line(text),post_content=text;no toxic,no quality=0",
                         rows)
    q = bench_queries(spark, sf)
    hits = S.bool_should([(S.phrase(q, idx, WEIGHTS), 3.0), (S.match(q, idx, WEIGHTS, "and"), 1.0)])
    return S.top_k(scored(hits), 5).select("query_id", "doc_id", "score", "rank")


FLAGSHIP_SQL = BASE_SQL.replace("WITH q AS", """WITH okd AS (
  SELECT d.* FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
  WHERE coalesce(l.toxic, 0) <> 1 AND coalesce(l.quality, 1) <> 0
),
q AS""", 1).replace("FROM documents\n", "FROM okd\n").replace("text FROM documents)", "text FROM okd)")


@query("flagship_phrase_and_top5", FLAGSHIP_SQL + """,
comb AS (
  SELECT query_id, doc_id, sum(s) AS s FROM (
    SELECT query_id, doc_id, max(s) * 3.0 AS s FROM ps GROUP BY ALL
    UNION ALL
    SELECT fs.query_id, fs.doc_id, max(fs.s * w.weight) * 1.0 FROM fs JOIN w ON w.field = fs.field
    JOIN qn ON qn.query_id = fs.query_id WHERE fs.m = qn.n_terms GROUP BY ALL
  ) GROUP BY ALL
)
SELECT query_id, doc_id, score, rank FROM (
  SELECT query_id, doc_id, round(s * 1000)::BIGINT AS score,
         row_number() OVER (PARTITION BY query_id ORDER BY round(s * 1000) DESC, doc_id) AS rank FROM comb
) WHERE rank <= 5""")
def flagship_phrase_and_top5(spark, sf):
    return flagship(spark, sf)


# ---------------------------------------------------------------- SCR


@query("scr7_recency_decay", BASE_SQL + """,
m AS (SELECT fs.query_id, fs.doc_id, max(fs.s * w.weight) AS s FROM fs JOIN w ON w.field = fs.field GROUP BY ALL)
SELECT query_id, doc_id,
       round(s * (exp(ln(0.25) / 14.0 * greatest(0.0, abs(epoch(TIMESTAMP '2024-02-15 00:00:00')
              - epoch(TIMESTAMP '2024-01-01 00:00:00' + to_hours(doc_id::BIGINT))) / 86400.0 - 7.0)) + 0.001)
             * 1000)::BIGINT AS score
FROM m""")
def scr7_recency_decay(spark, sf):
    """OR-match score x (exp decay on post date, scale 14d, decay .25, offset 7d, + .001), as of 2024-02-15."""
    hits = S.match(bench_queries(spark, sf), doc_index(spark, sf), WEIGHTS, "or")
    date = F.timestamp_add("HOUR", F.col("doc_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    out = hits.withColumn("score", F.col("score") * S.decay_factor(date, dt.datetime(2024, 2, 15)))
    return scored(out)


@query("scr9_sticky_first", """
SELECT doc_id, row_number() OVER (ORDER BY doc_id IN (500, 7, 900) DESC, n_chars DESC, doc_id) AS pos
FROM documents ORDER BY pos LIMIT 10""")
def scr9_sticky_first(spark, sf):
    from pyspark.sql import Window

    from contentspark.operators.sorting import sticky_first

    d = Tables(spark, sf).documents
    order = [sticky_first([500, 7, 900], "doc_id"), F.col("n_chars").desc(), F.col("doc_id").asc()]
    top = d.orderBy(*order).limit(10)
    return top.select("doc_id", F.row_number().over(Window.orderBy(*order)).alias("pos"))


@query("scr10_random_order", "SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id::VARCHAR), doc_id LIMIT 10")
def scr10_random_order(spark, sf):
    """Deterministic random order (hash of id and seed), first page of 10."""
    from contentspark.operators.sorting import random_key

    d = Tables(spark, sf).documents
    return d.orderBy(random_key(42, "doc_id"), "doc_id").limit(10).select("doc_id")


TYPE_FIELDS = ["post_title", "post_content", "post_excerpt", "terms.brand.name", "terms.source.name"]


def type_weighted_search(spark, sf):
    """Best fields of the weighting table: every field that any type has there is searched, each type
    with its own weights."""
    posts = V.v_posts(spark, sf, types=["post", "product", "page"]).filter(
        post_filter({"post_type": ["post", "product", "page"]}))
    rows = FL.field_rows(posts, TYPE_FIELDS, extra=["post_type"])
    idx = S.cached_index("v_posts(post,product,page):" + ",".join(TYPE_FIELDS), rows.select("doc_id", "field", "text"))
    per = S.field_scores(bench_queries(spark, sf), idx, TYPE_FIELDS)
    weighted = S.apply_weights(per.withColumn("post_type", V.post_type_of(F.col("doc_id"))), V.v_weights(spark))
    return scored(weighted.groupBy("query_id", "doc_id").agg(F.max("score").alias("score")))
