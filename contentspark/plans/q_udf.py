"""Queries exercising the extension surface (UDF-1..8): every hook is a plain argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from contentspark.functions.text import first_line
from contentspark.operators import analysis as A
from contentspark.operators import documents as DOC
from contentspark.operators import facets as G
from contentspark.operators import predicates as P
from contentspark.operators import search as S
from contentspark.plans.registry import query
from contentspark.plans.sqlsearch import best_fields, bm25_sql
from contentspark.plans.sqlviews import V_POSTS, tokens, with_views
from contentspark.sources import views as V
from contentspark.sources.tables import Tables
from contentspark.streaming import sync as SY

DOC_FIELDS_SQL = """
SELECT doc_id, 'post_title' AS field, trim(split_part(text, chr(10), 1)) AS txt FROM documents
UNION ALL SELECT doc_id, 'post_content', text FROM documents"""
QUERIES_SQL = f"SELECT item_id AS query_id, array_to_string({tokens('text')}, ' ') AS query FROM benchmark"


@query("udf1_document_transform", """
SELECT o_orderkey AS id, floor(o_totalprice / 100000)::BIGINT AS total_band FROM orders""")
def udf1_document_transform(spark, sf):
    """A caller transform adds a column to the order documents."""
    t = Tables(spark, sf)
    band = lambda df: df.withColumn(
        "total_band", F.floor(F.col("meta")["_total"][0]["double"] / 100000).cast("bigint"))
    d = DOC.order_document(t.orders, t.customer, t.nation, t.region, t.lineitem, t.part, transform=band)
    return d.select("id", "total_band")


@query("udf2_skip_predicate", "SELECT count_if(lang = 'fr')::BIGINT AS skipped FROM documents")
def udf2_skip_predicate(spark, sf):
    """A caller skip predicate (French documents) counted as skipped in a rebuild."""
    d = Tables(spark, sf).documents
    plan = SY.rebuild_plan(d, skip=F.col("lang") == "fr", valid=F.lit(True), error=F.lit(""))
    return plan.agg(F.count_if(F.col("sync_status") == "skipped").cast("bigint").alias("skipped"))


@query("udf3_extra_filter", with_views(V_POSTS) + """
SELECT id FROM v_posts WHERE post_type = 'product' AND length(post_title) > 10""")
def udf3_extra_filter(spark, sf):
    """A caller Column AND-ed into the compiled filters."""
    return V.v_posts(spark, sf, types=["product"]).filter(
        P.post_filter({"post_type": "product", "extra": F.length("post_title") > 10})).select("id")


@query("udf4_search_field_boosts", bm25_sql(DOC_FIELDS_SQL, QUERIES_SQL, {"post_title": 5.0, "post_content": 1.0})
       + ", b AS (" + best_fields("and") + ") SELECT query_id, doc_id, round(s * 1000)::BIGINT AS score FROM b")
def udf4_search_field_boosts(spark, sf):
    """Caller-chosen fields and boosts (title 5) for an AND match."""
    from contentspark.plans.q_search import bench_queries, doc_index

    hits = S.match(bench_queries(spark, sf), doc_index(spark, sf), {"post_title": 5.0, "post_content": 1.0}, "and")
    return hits.select("query_id", "doc_id", S.milli(F.col("score")).alias("score"))


def _phrase_and_sql() -> str:
    from contentspark.plans.q_search import AND_SQL, BASE_SQL, PHRASE_SQL, added

    return BASE_SQL + added((PHRASE_SQL, 2.0), (AND_SQL, 1.0))


@query("udf5_registered_algorithm", _phrase_and_sql())
def udf5_registered_algorithm(spark, sf):
    """A registered algorithm ('phrase_and': phrase x2 + AND x1) used by name."""
    from contentspark.plans.q_search import WEIGHTS, bench_queries, doc_index

    def phrase_and(queries, index, weights, analyzer=None):
        return S.bool_should([(S.phrase(queries, index, weights, analyzer), 2.0),
                              (S.match(queries, index, weights, "and", 0, analyzer), 1.0)])

    S.register_algorithm("phrase_and", phrase_and)
    hits = S.search(bench_queries(spark, sf), doc_index(spark, sf), WEIGHTS, "phrase_and")
    return hits.select("query_id", "doc_id", S.milli(F.col("score")).alias("score"))


@query("udf6_facet_type", """
SELECT 'price_band' AS facet, (floor(p_retailprice / 25) * 25)::BIGINT::VARCHAR AS value, count(*)::BIGINT AS doc_count
FROM part GROUP BY 2""")
def udf6_facet_type(spark, sf):
    """A caller facet type: (name, values Column) counted like the built-in ones."""
    posts = V.v_posts(spark, sf, types=["product"]).filter(P.post_filter({"post_type": "product"}))
    band = F.transform(F.col("meta")["_price"], lambda x: (F.floor(x["double"] / 25) * 25).cast("bigint").cast("string"))
    return G.facet_counts(posts, {"price_band": band})


@query("udf7_decay_parameters", bm25_sql(DOC_FIELDS_SQL, QUERIES_SQL, {"post_title": 2.0, "post_content": 1.0})
       + ", b AS (" + best_fields("or") + """)
SELECT query_id, doc_id,
       round(s * (exp(ln(0.5) / 7.0 * greatest(0.0, abs(epoch(TIMESTAMP '2024-02-15 00:00:00')
              - epoch(TIMESTAMP '2024-01-01 00:00:00' + to_hours(doc_id::BIGINT))) / 86400.0 - 1.0)) + 0.001)
             * 1000)::BIGINT AS score FROM b""")
def udf7_decay_parameters(spark, sf):
    """Decay with caller parameters: scale 7 days, decay 0.5, offset 1 day."""
    from contentspark.plans.q_search import WEIGHTS, bench_queries, doc_index

    hits = S.match(bench_queries(spark, sf), doc_index(spark, sf), WEIGHTS, "or")
    date = F.timestamp_add("HOUR", F.col("doc_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    out = hits.withColumn("score", F.col("score") * S.decay_factor(date, dt.datetime(2024, 2, 15), scale_days=7.0,
                                                                    decay=0.5, offset_days=1.0))
    return out.select("query_id", "doc_id", S.milli(F.col("score")).alias("score"))


@query("udf8_english_analyzer")
def udf8_english_analyzer(spark, sf):
    """The english analyzer (stop words, Porter stems) chosen by argument for an AND match."""
    d = Tables(spark, sf).documents
    rows = A.unpivot_fields(d, "doc_id", {"post_title": first_line(F.col("text")), "post_content": F.col("text")})
    idx = S.cached_index("documents:post_title=first_line(text),post_content=text", rows, "english")
    q = V.v_queries(spark, sf)
    hits = S.match(q, idx, {"post_title": 2.0, "post_content": 1.0}, "and", analyzer="english")
    return hits.select("query_id", "doc_id", S.milli(F.col("score")).alias("score"))
