"""Queries for sources and scans (SRC-1..7)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from contentspark.operators import predicates as P
from contentspark.operators import sorting as S
from contentspark.operators import sources as SRC
from contentspark.plans.registry import query
from contentspark.plans.sqlviews import V_COMMENTS, V_POSTS, V_TERMS, with_views
from contentspark.sources import views as V
from contentspark.sources.tables import Tables


@query("src1_post_scan", with_views(V_POSTS) + """
SELECT id, post_type FROM v_posts
WHERE post_type IN ('product', 'post', 'page') AND post_status = 'publish' AND post_password = ''""")
def src1_post_scan(spark, sf):
    posts = V.v_posts(spark, sf)
    return SRC.eligible_posts(posts, ["product", "post", "page"], ["publish"]).select("id", "post_type")


@query("src2_id_range_page", """
SELECT doc_id, row_number() OVER (ORDER BY doc_id DESC) AS pos FROM documents
WHERE doc_id BETWEEN 100 AND 900 ORDER BY doc_id DESC LIMIT 50""")
def src2_id_range_page(spark, sf):
    docs = Tables(spark, sf).documents
    page = SRC.id_range_page(docs, "doc_id", lower=100, upper=900, size=50)
    return page.select("doc_id", F.row_number().over(Window.orderBy(F.col("doc_id").desc())).alias("pos"))


@query("src3_offset_page", """
SELECT n_nationkey, n_name, (SELECT CASE WHEN count(*) <= 5 THEN 0 ELSE count(*) END FROM nation)::BIGINT AS total
FROM nation ORDER BY n_nationkey LIMIT 10 OFFSET 5""")
def src3_offset_page(spark, sf):
    nation = Tables(spark, sf).nation
    page, total = SRC.offset_page(nation, [F.col("n_nationkey").asc()], offset=5, number=10)
    return page.select("n_nationkey", "n_name", total.alias("total"))


@query("src4_term_scan", with_views(V_TERMS) + """
SELECT taxonomy, slug, count FROM v_terms WHERE taxonomy IN ('geo', 'brand', 'ptype')""")
def src4_term_scan(spark, sf):
    terms = V.v_terms(spark, sf)
    return SRC.term_scan(terms, ["geo", "brand", "ptype"]).select("taxonomy", "slug", "count")


@query("src5_comment_scan", with_views(V_POSTS, V_COMMENTS) + """
SELECT c.comment_ID FROM v_comments c JOIN v_posts p ON p.id = c.comment_post_ID
WHERE c.comment_approved = '1' AND c.comment_type IN ('user', 'assistant')
  AND p.post_type IN ('post', 'page') AND p.post_status = 'publish'""")
def src5_comment_scan(spark, sf):
    comments = V.v_comments(spark, sf)
    posts = V.v_posts(spark, sf, types=["post", "page"])
    return SRC.comment_scan(comments, posts, comment_types=["user", "assistant"],
                            post_types=["post", "page"]).select("comment_ID")


@query("src6_eligible_counts", with_views(V_POSTS) + """
SELECT post_type, post_status, count(*)::BIGINT AS n FROM v_posts
WHERE post_password = '' GROUP BY post_type, post_status""")
def src6_eligible_counts(spark, sf):
    return SRC.eligible_counts(V.v_posts(spark, sf))


@query("src7_change_eligibility", """
SELECT event_id, user_id AS object_id,
       CASE WHEN event_type IN ('view', 'click', 'purchase', 'signup') THEN 'upsert' ELSE 'delete' END AS op
FROM events""")
def src7_change_eligibility(spark, sf):
    ch = V.v_changes(spark, sf)
    return SRC.change_action(ch, F.col("event_type").isin("view", "click", "purchase", "signup")).select(
        "event_id", "object_id", "op")


@query("srt8_paging", with_views(V_POSTS) + """
SELECT id, row_number() OVER (ORDER BY post_date DESC, id) AS pos FROM v_posts
WHERE post_type = 'post' ORDER BY post_date DESC, id LIMIT 10 OFFSET 20""")
def srt8_paging(spark, sf):
    posts = V.v_posts(spark, sf, types=["post"]).filter(P.post_filter({"post_type": "post"}))
    cols = S.sort_columns(None, "desc", has_search=False)
    page = S.paginate(posts, cols, page=3, per_page=10)
    return page.select("id", (F.row_number().over(Window.orderBy(*cols)) + 20).alias("pos"))
