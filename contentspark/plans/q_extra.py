"""Queries for the remaining inventory items: FLT-13, TRM-10, CMT-5, SCR-1..5/8, SUG-2."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from contentspark.operators import analysis as A
from contentspark.operators import comments as C
from contentspark.operators import fields as FL
from contentspark.operators import predicates as P
from contentspark.operators import search as S
from contentspark.operators import suggest as SG
from contentspark.operators import terms as TR
from contentspark.plans.registry import query
from contentspark.plans.sqlsearch import best_fields, bm25_sql
from contentspark.plans.sqlviews import V_COMMENTS, V_POSTS, V_TERMS, tokens, with_views
from contentspark.sources import views as V
from contentspark.sources.tables import Tables


def milli(df):
    return df.select("query_id", "doc_id", S.milli(F.col("score")).alias("score"))


ORDER_FIELDS_SQL = """
SELECT o_orderkey AS doc_id, 'post_title' AS field, 'Order #' || o_orderkey::VARCHAR AS txt FROM orders
UNION ALL SELECT o_orderkey, 'ID', o_orderkey::VARCHAR FROM orders"""


@query("flt13_id_search_is_exact", bm25_sql(
    ORDER_FIELDS_SQL,
    "SELECT o_orderkey AS query_id, o_orderkey::VARCHAR AS query FROM orders WHERE o_orderpriority = '1-URGENT'",
    {"post_title": 1.0, "ID": 1.0}) + ", b AS (" + best_fields("or") + """)
SELECT query_id, doc_id, round(s * 1000)::BIGINT AS score FROM b""")
def flt13_id_search_is_exact(spark, sf):
    """Order numbers searched in title and ID with fuzziness 1 requested: the ID field turns it off."""
    o = Tables(spark, sf).orders
    rows = A.unpivot_fields(o, "o_orderkey", {"post_title": F.concat(F.lit("Order #"), F.col("o_orderkey").cast("string")),
                                              "ID": F.col("o_orderkey").cast("string")})
    q = o.filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("query_id"), F.col("o_orderkey").cast("string").alias("query"))
    weights = {"post_title": 1.0, "ID": 1.0}
    fz = FL.effective_fuzziness(list(weights), 1)
    return milli(S.match(q, S.TextIndex.build(rows), weights, "or", fuzziness=fz))


@query("trm10_term_meta_query", with_views(V_TERMS) + """
SELECT taxonomy, slug FROM v_terms WHERE count > 60 AND taxonomy IN ('geo', 'brand')""")
def trm10_term_meta_query(spark, sf):
    """Term meta query: objects (numeric) > 60 and kind IN (nation, region, brand)."""
    terms = V.v_terms(spark, sf)
    mq = {"relation": "AND", "a": {"key": "objects", "value": 60, "compare": ">", "type": "NUMERIC"},
          "b": {"key": "kind", "value": ["nation", "region", "brand"], "compare": "IN"}}
    return terms.filter(TR.term_filter({"extra": P.meta_query(mq)})).select("taxonomy", "slug")


@query("cmt5_comment_meta", with_views(V_COMMENTS) + """
SELECT comment_ID FROM v_comments WHERE length(comment_content) > 500 AND comment_author <> 'system'""")
def cmt5_comment_meta(spark, sf):
    mq = [{"key": "length", "value": 500, "compare": ">", "type": "NUMERIC"},
          {"key": "role", "value": "system", "compare": "!="}]
    return V.v_comments(spark, sf).filter(C.comment_filter({"meta_query": mq})).select("comment_ID")


POSTS_TC_SQL = """
SELECT id AS doc_id, 'post_title' AS field, post_title AS txt FROM v_posts WHERE post_type IN ('post', 'product', 'page')
UNION ALL SELECT id, 'post_content', post_content FROM v_posts WHERE post_type IN ('post', 'product', 'page')
UNION ALL SELECT id, 'terms.brand.name', brand FROM v_posts WHERE post_type = 'product'
UNION ALL SELECT id, 'terms.source.name', source FROM v_posts WHERE post_type = 'post'"""
QUERIES_SQL = f"SELECT item_id AS query_id, array_to_string({tokens('text')}, ' ') AS query FROM benchmark"


def _posts_sql(body: str) -> str:
    return body.replace("WITH qsrc AS", with_views(V_POSTS) + ",\nqsrc AS", 1)


@query("scr1_scr2_type_weights", _posts_sql(bm25_sql(POSTS_TC_SQL.replace(" AS txt FROM v_posts", " AS txt FROM v_posts"), QUERIES_SQL, {})
       .replace("SELECT * FROM (VALUES ) t(field, weight)", """SELECT * FROM (VALUES ('post', 'post_title', 2), ('post', 'post_content', 1),
         ('product', 'post_title', 5), ('product', 'terms.brand.name', 3), ('page', 'post_title', 1), ('page', 'post_content', 4))
         t(post_type, field, weight)""")
       + """SELECT query_id, fs.doc_id, round(max(s * weight) * 1000)::BIGINT AS score
FROM fs JOIN v_posts p ON p.id = fs.doc_id JOIN w ON w.field = fs.field AND w.post_type = p.post_type GROUP BY ALL"""))
def scr1_scr2_type_weights(spark, sf):
    """Weights of the weighting table per (type, field) over posts, products and pages: fields of the table
    that a type doesn't enable don't count for it."""
    from contentspark.plans.q_search import type_weighted_search

    return type_weighted_search(spark, sf)


PRODUCT_DEFAULT_SQL = f"""
SELECT p_partkey AS doc_id, 'post_title' AS field, p_name AS txt FROM part
UNION ALL SELECT p_partkey, 'post_content', p_name FROM part
UNION ALL SELECT p_partkey, 'terms.post_tag.name', array_to_string(list_distinct({tokens('p_name')}), ' ') FROM part"""


@query("scr3_default_weights", bm25_sql(PRODUCT_DEFAULT_SQL,
                                        "SELECT DISTINCT p_type AS query_id, p_type AS query FROM part",
                                        {"post_title": 1.0, "post_content": 1.0, "terms.post_tag.name": 1.0})
       + ", b AS (" + best_fields("or") + ") SELECT query_id, doc_id, round(s * 1000)::BIGINT AS score FROM b")
def scr3_default_weights(spark, sf):
    """Default weights (title, content, excerpt, author, tag and category names = 1) over products."""
    posts = V.v_posts(spark, sf, types=["product"]).filter(P.post_filter({"post_type": "product"}))
    fields = list(FL.DEFAULT_WEIGHTS)
    rows = FL.field_rows(posts, fields)
    q = Tables(spark, sf).part.select(F.col("p_type").alias("query_id"), F.col("p_type").alias("query")).distinct()
    return milli(S.match(q, S.TextIndex.build(rows), FL.DEFAULT_WEIGHTS, "or"))


PRODUCT_WEIGHTED_SQL = """
SELECT p_partkey AS doc_id, 'post_title' AS field, p_name AS txt FROM part
UNION ALL SELECT p_partkey, 'terms.brand.name', p_brand FROM part"""


@query("scr4_cross_fields_flat_weights", bm25_sql(
    PRODUCT_WEIGHTED_SQL, "SELECT DISTINCT p_type AS query_id, p_type || ' brand' AS query FROM part", {"post_title": 1.0})
    + "SELECT xs.query_id, xs.doc_id, round(xs.s * 1000)::BIGINT AS score FROM xs JOIN qn USING (query_id) WHERE xs.m = qn.n_terms")
def scr4_cross_fields_flat_weights(spark, sf):
    """Cross-fields clause over weighted product fields: the weights are flattened to 1."""
    posts = V.v_posts(spark, sf, types=["product"]).filter(P.post_filter({"post_type": "product"}))
    weights = FL.type_weights(V.WEIGHT_ROWS, "product")
    rows = FL.field_rows(posts, list(weights))
    q = Tables(spark, sf).part.select(F.col("p_type").alias("query_id"),
                                      F.concat_ws(" ", "p_type", F.lit("brand")).alias("query")).distinct()
    return milli(S.cross_fields(q, S.TextIndex.build(rows), list(weights), "and"))


@query("scr5_fuzzy_fields_per_type", bm25_sql(
    "SELECT p_partkey AS doc_id, 'post_title' AS field, p_name AS txt FROM part",
    "SELECT DISTINCT p_type AS query_id, p_type AS query FROM part", {"post_title": 5.0}, fuzzy=1)
    + ", b AS (" + best_fields("or") + ") SELECT query_id, doc_id, round(s * 1000)::BIGINT AS score FROM b")
def scr5_fuzzy_fields_per_type(spark, sf):
    """Fuzzy clause over the product fields flagged fuzzy (brand names are not)."""
    posts = V.v_posts(spark, sf, types=["product"]).filter(P.post_filter({"post_type": "product"}))
    fz = FL.fuzzy_clause_weights(V.WEIGHT_ROWS, "product")
    rows = FL.field_rows(posts, list(fz))
    q = Tables(spark, sf).part.select(F.col("p_type").alias("query_id"), F.col("p_type").alias("query")).distinct()
    return milli(S.match(q, S.TextIndex.build(rows), fz, "or", fuzziness=1))


@query("scr8_decay_switch", bm25_sql("SELECT p_partkey AS doc_id, 'post_title' AS field, p_name AS txt FROM part",
                                     "SELECT DISTINCT p_type AS query_id, p_type AS query FROM part",
                                     {"post_title": 1.0})
       + ", b AS (" + best_fields("or") + ") SELECT query_id, doc_id, round(s * 1000)::BIGINT AS score FROM b")
def scr8_decay_switch(spark, sf):
    """Decay mode 'off_products' with only products searched: scores are left undecayed."""
    posts = V.v_posts(spark, sf, types=["product"]).filter(P.post_filter({"post_type": "product"}))
    hits = S.match(Tables(spark, sf).part.select(F.col("p_type").alias("query_id"), F.col("p_type").alias("query"))
                   .distinct(), S.TextIndex.build(FL.field_rows(posts, ["post_title"])), {"post_title": 1.0}, "or")
    if FL.decay_enabled("off_products", ["product"]):
        hits = hits.join(posts.select(F.col("id").alias("doc_id"), "post_date"), "doc_id").withColumn(
            "score", F.col("score") * S.decay_factor(F.col("post_date"), dt.datetime(2024, 1, 1)))
    return milli(hits)


@query("sug2_suggest_fields_in_fuzzy", bm25_sql(f"""
SELECT p_partkey AS doc_id, 'post_title' AS field, p_name AS txt FROM part
UNION ALL SELECT p_partkey, 'post_title.suggest', array_to_string(list_distinct(list(substr(tok, 1, n))), ' ')
FROM (SELECT p_partkey, unnest({tokens('p_name')}) AS tok FROM part), range(3, 11) r(n) WHERE n <= length(tok) GROUP BY p_partkey""",
    "SELECT DISTINCT substr(p_name, 1, 5) AS query_id, substr(p_name, 1, 5) AS query FROM part",
    {"post_title": 3.0, "post_title.suggest": 2.0}, fuzzy=1)
    + ", b AS (" + best_fields("or") + ") SELECT query_id, doc_id, round(s * 1000)::BIGINT AS score FROM b")
def sug2_suggest_fields_in_fuzzy(spark, sf):
    """Fuzzy clause with the suggest (edge n-gram) field added at weight - 1 (min 1)."""
    p = Tables(spark, sf).part
    rows = A.unpivot_fields(p, "p_partkey", {"post_title": F.col("p_name")})
    grams = F.array_distinct(A.edge_ngrams(A.analyze(F.col("p_name"))))
    pre = A.unpivot_fields(p, "p_partkey", {"post_title.suggest": F.array_join(grams, " ")})
    weights = SG.suggest_field_weights({"post_title": 3.0}, ["post_title.suggest"])
    idx = S.TextIndex.build(rows.unionByName(pre))
    q = p.select(F.substring("p_name", 1, 5).alias("query_id"), F.substring("p_name", 1, 5).alias("query")).distinct()
    return milli(S.match(q, idx, weights, "or", fuzziness=1))
