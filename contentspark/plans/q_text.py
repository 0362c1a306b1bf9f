"""Queries for search fields, synonyms, highlight/excerpt, attachments (TXT-8, 13-18) and SCR-6/11."""

from __future__ import annotations

from pyspark.sql import functions as F

from contentspark.functions.text import html_title, strip_html
from contentspark.operators import analysis as A
from contentspark.operators import fields as FL
from contentspark.operators import search as S
from contentspark.operators import synonyms as SY
from contentspark.operators.predicates import post_filter
from contentspark.plans.registry import query
from contentspark.plans.sqlsearch import best_fields, bm25_sql
from contentspark.plans.sqlviews import V_POSTS, html_title as sql_title, strip_html as sql_strip, tokens, with_views
from contentspark.sources import views as V
from contentspark.sources.tables import Tables


def products(spark, sf):
    return V.v_posts(spark, sf, types=["product"]).filter(post_filter({"post_type": "product"}))


def type_queries(spark, sf):
    p = Tables(spark, sf).part
    return p.select(F.col("p_type").alias("query_id"), F.col("p_type").alias("query")).distinct()


TXT8_WEIGHTS = {"post_title": 1.0, "terms.brand.name": 3.0, "terms.ptype.name": 1.0}
PART_FIELDS_SQL = """
SELECT p_partkey AS doc_id, 'post_title' AS field, p_name AS txt FROM part
UNION ALL SELECT p_partkey, 'terms.brand.name', p_brand FROM part
UNION ALL SELECT p_partkey, 'terms.ptype.name', p_type FROM part"""


@query("txt8_search_fields", bm25_sql(PART_FIELDS_SQL, "SELECT DISTINCT p_type AS query_id, p_type AS query FROM part",
                                      TXT8_WEIGHTS) + """,
b AS (""" + best_fields("or") + """)
SELECT query_id, doc_id, round(s * 1000)::BIGINT AS score FROM b""")
def txt8_search_fields(spark, sf):
    """Title plus taxonomy-name fields (brand weight 3) for the product types as queries."""
    fields = FL.resolve_fields(["post_title"], taxonomies=["brand", "ptype"])
    idx = S.TextIndex.build(FL.field_rows(products(spark, sf), fields))
    hits = S.match(type_queries(spark, sf), idx, TXT8_WEIGHTS, "or")
    return hits.select("query_id", "doc_id", S.milli(F.col("score")).alias("score"))


# Fixed values for the test: the synonym pairs of the inline list (single words).
SYN_PAIRS_SQL = """
SELECT * FROM (VALUES ('ring', 'band', false), ('band', 'ring', false), ('bolt', 'screw', false),
  ('screw', 'bolt', false), ('gizmo', 'gadget', false), ('gizmo', 'widget', false), ('gadget', 'gizmo', false),
  ('gadget', 'widget', false), ('widget', 'gizmo', false), ('widget', 'gadget', false),
  ('gear', 'cog', true), ('gear', 'wheel', true)) t(phrase, alternative, repl)"""


@query("txt13_synonym_search", f"""
WITH names AS (SELECT DISTINCT p_name AS query_id, {tokens('p_name')} AS toks FROM part),
pairs AS ({SYN_PAIRS_SQL}),
pos AS (SELECT query_id, toks, unnest(range(1, len(toks) + 1)) AS i FROM names),
alts AS (SELECT p.query_id, list_concat(p.toks[1:p.i - 1], [s.alternative], p.toks[p.i + 1:]) AS toks, s.repl
         FROM pos p JOIN pairs s ON s.phrase = p.toks[p.i]),
allq AS (SELECT query_id, toks FROM names WHERE query_id NOT IN (SELECT query_id FROM alts WHERE repl)
         UNION SELECT query_id, toks FROM alts),
pt AS (SELECT p_partkey, {tokens('p_name')} AS toks FROM part)
SELECT DISTINCT a.query_id, pt.p_partkey AS doc_id FROM allq a JOIN pt ON list_has_all(pt.toks, a.toks)""")
def txt13_synonym_search(spark, sf):
    """Every distinct product name as a query, expanded with the synonym list (equivalent sets
    and a replacement rule), AND-matched against product titles."""
    rules = SY.parse_lines(V.v_synonym_lines(spark))
    qs = Tables(spark, sf).part.select(F.col("p_name").alias("query_id"), F.col("p_name").alias("query")).distinct()
    alts = SY.expand_queries(qs, SY.rewrite_pairs(rules))
    idx = S.TextIndex.build(A.unpivot_fields(Tables(spark, sf).part, "p_partkey", {"post_title": F.col("p_name")}))
    hits = S.match(alts.select(F.col("alt").alias("query_id"), "query"), idx, {"post_title": 1.0}, "and")
    back = alts.select(F.col("alt").alias("aq"), F.col("query_id").alias("orig"))
    return (hits.join(back, hits.query_id == back.aq).select(F.col("orig").alias("query_id"), "doc_id").distinct())


@query("txt14_synonym_replacement", f"""
WITH names AS (SELECT DISTINCT p_name AS query_id, {tokens('p_name')} AS toks FROM part
               WHERE list_contains({tokens('p_name')}, 'gear'))
SELECT query_id, array_to_string(list_transform(toks, lambda t: CASE WHEN t = 'gear' THEN a ELSE t END), ' ') AS query
FROM names, (VALUES ('cog'), ('wheel')) v(a)""")
def txt14_synonym_replacement(spark, sf):
    """Names holding 'gear' are replaced by 'cog' / 'wheel' (the original query is dropped)."""
    rules = SY.parse_lines(V.v_synonym_lines(spark))
    qs = Tables(spark, sf).part.select(F.col("p_name").alias("query_id"), F.col("p_name").alias("query")).distinct()
    alts = SY.expand_queries(qs, SY.rewrite_pairs(rules).filter("replace"))
    gear = qs.filter(F.array_contains(S.analyze(F.col("query")), "gear")).select("query_id")
    return alts.join(gear, "query_id", "left_semi").select("query_id", "query")


# Texts are cut into token and other runs; runs that are query terms are wrapped.
HIGHLIGHT_SQL = """,
runs AS (SELECT doc_id, regexp_extract_all(text, '[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+') AS parts FROM documents)
SELECT fs.query_id, fs.doc_id, array_to_string(list_transform(any_value(r.parts), lambda x: CASE
         WHEN list_contains(any_value(q.toks), lower(x)) THEN '<mark class="search-highlight">' || x || '</mark>' ELSE x END), '')
         AS highlighted
FROM fs JOIN qn ON qn.query_id = fs.query_id JOIN q ON q.query_id = fs.query_id JOIN runs r ON r.doc_id = fs.doc_id
WHERE fs.m = qn.n_terms GROUP BY fs.query_id, fs.doc_id"""


def _base_sql() -> str:
    from contentspark.plans.q_search import BASE_SQL

    return BASE_SQL


@query("txt16_highlight", _base_sql() + HIGHLIGHT_SQL)
def txt16_highlight(spark, sf):
    """AND-match hits with their whole texts highlighted (query terms wrapped in <mark>)."""
    from contentspark.plans.q_search import WEIGHTS, bench_queries, doc_index

    q = bench_queries(spark, sf)
    hits = S.match(q, doc_index(spark, sf), WEIGHTS, "and")
    docs = Tables(spark, sf).documents.select("doc_id", "text")
    qterms = q.select("query_id", S.analyze(F.col("query")).alias("terms"))
    return (hits.join(qterms, "query_id").join(docs, "doc_id")
            .select("query_id", "doc_id", S.highlight_terms(F.col("text"), F.col("terms")).alias("highlighted")))


@query("txt17_excerpt", r"""
WITH t AS (SELECT doc_id, string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ') AS parts FROM documents)
SELECT doc_id, CASE WHEN len(parts) > 55 THEN array_to_string(parts[1:55], ' ') || ' […]'
                    ELSE array_to_string(parts, ' ') END AS excerpt FROM t""")
def txt17_excerpt(spark, sf):
    d = Tables(spark, sf).documents
    return d.select("doc_id", S.excerpt(F.col("text")).alias("excerpt"))


ATT_WEIGHTS = {"post_title": 1.0, "attachments.attachment.content": 1.0}


@query("txt18_attachment_search", bm25_sql(
    f"SELECT page_id AS doc_id, 'post_title' AS field, {sql_title('html')} AS txt FROM pages "
    f"UNION ALL SELECT page_id, 'attachments.attachment.content', {sql_strip('html')} FROM pages",
    f"SELECT item_id AS query_id, array_to_string({tokens('text')}, ' ') AS query FROM benchmark",
    ATT_WEIGHTS) + """,
b AS (""" + best_fields("or") + """)
SELECT query_id, doc_id, round(s * 1000)::BIGINT AS score FROM b""")
def txt18_attachment_search(spark, sf):
    """Pages as attachments (inherit status, text/html allowed): title + extracted content field."""
    pg = Tables(spark, sf).pages.select(
        F.col("page_id").alias("id"), html_title(F.col("html")).alias("post_title"),
        F.lit("inherit").alias("post_status"), F.lit("text/html").alias("post_mime_type"))
    att = Tables(spark, sf).pages.select(F.col("page_id").alias("doc_id"), strip_html(F.col("html")).alias("content"))
    allowed = pg.filter(F.col("post_mime_type").isin("text/html") & F.col("post_status").isin("publish", "inherit"))
    rows = FL.field_rows(allowed, ["post_title"], attachments=att.join(allowed.select(F.col("id").alias("doc_id")),
                                                                          "doc_id", "left_semi"))
    hits = S.match(V.v_queries(spark, sf), S.TextIndex.build(rows), ATT_WEIGHTS, "or")
    return hits.select("query_id", "doc_id", S.milli(F.col("score")).alias("score"))


@query("scr6_searchable_types", with_views(V_POSTS) + """
SELECT id FROM v_posts WHERE post_type IN ('post', 'product', 'page')""")
def scr6_searchable_types(spark, sf):
    """Types without enabled weighted fields (shop_order here) are excluded from search."""
    types = FL.searchable_types(V.v_weights(spark))
    return V.v_posts(spark, sf).join(types, "post_type", "left_semi").select("id")


@query("scr11_range_boost", bm25_sql("SELECT p_partkey AS doc_id, 'post_title' AS field, p_name AS txt FROM part",
                                     "SELECT DISTINCT p_type AS query_id, p_type AS query FROM part",
                                     {"post_title": 1.0}) + """,
b AS (""" + best_fields("or") + """)
SELECT b.query_id, b.doc_id,
       round((b.s + CASE WHEN p.p_retailprice BETWEEN 950 AND 999 THEN 2.0 ELSE 0.0 END) * 1000)::BIGINT AS score
FROM b JOIN part p ON p.p_partkey = b.doc_id""")
def scr11_range_boost(spark, sf):
    """Title match plus a boost-2 price-range clause for products priced 950..999."""
    posts = products(spark, sf)
    idx = S.TextIndex.build(FL.field_rows(posts, ["post_title"]))
    hits = S.match(type_queries(spark, sf), idx, {"post_title": 1.0}, "or")
    from contentspark.operators.predicates import meta_clause

    boost = posts.select(F.col("id").alias("doc_id"), F.when(
        meta_clause({"key": "_price", "value": [950, 999], "compare": "BETWEEN"}), F.lit(2.0)).otherwise(0.0)
        .alias("boost"))
    return (hits.join(boost, "doc_id")
            .select("query_id", "doc_id", S.milli(F.col("score") + F.col("boost")).alias("score")))


@query("txt15_lines", """
SELECT 'equivalent' AS kind, '' AS lhs, lower(replace(p_brand, '#', ' ')) || ',' || lower(p_type) AS rhs
FROM (SELECT DISTINCT p_brand, p_type FROM part)
UNION ALL SELECT DISTINCT 'replace', lower(p_type), 'type ' || lower(p_type) FROM part""")
def txt15_lines(spark, sf):
    """Synonym lists read as lines of a text file (made of the product table) and parsed into rules."""
    import os
    import uuid

    from contentspark.session import checkpoint_dir

    p = Tables(spark, sf).part
    sets = p.select(F.concat("p_brand", F.lit(", "), "p_type").alias("value")).distinct()
    rules = p.select(F.concat("p_type", F.lit(" => type "), "p_type").alias("value")).distinct()
    notes = sets.select(F.concat(F.lit("# "), "value").alias("value"))
    path = os.path.join(checkpoint_dir(spark), f"synonyms-{uuid.uuid4().hex}")
    sets.unionByName(rules).unionByName(notes).write.text(path)
    parsed = SY.parse_lines(spark.read.text(path).withColumnRenamed("value", "line"))
    phrases = lambda c: F.array_join(F.transform(c, lambda a: F.array_join(a, " ")), ",")
    return parsed.select("kind", phrases("lhs").alias("lhs"), phrases("rhs").alias("rhs"))
