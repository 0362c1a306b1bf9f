"""Queries for sorting, paging and projections (SRT-1..13)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from contentspark.operators import predicates as P
from contentspark.operators import sorting as S
from contentspark.operators.terms import text_match_all
from contentspark.plans.registry import query
from contentspark.plans.sqlviews import V_COMMENTS, V_POSTS, with_views

POSTS = with_views(V_POSTS)
FOLD = "translate(lower(post_title), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy')"


def page_rows(df, cols, page=None, per_page=None, offset=None):
    """A page plus its absolute position (window over the page rows only)."""
    off, _ = S.page_window(page, per_page, offset)
    p = S.paginate(df, cols, page=page, per_page=per_page, offset=offset)
    return p.select("id", (F.row_number().over(Window.orderBy(*cols)) + off).alias("pos"))


def posts(spark, sf, types):
    from contentspark.sources import views as V

    return V.v_posts(spark, sf, types=types).filter(P.post_filter({"post_type": types}))


@query("srt1_sort_title", POSTS + f"""
SELECT id, row_number() OVER (ORDER BY {FOLD} ASC NULLS LAST, id) AS pos
FROM v_posts WHERE post_type = 'post' ORDER BY pos LIMIT 10""")
def srt1_sort_title(spark, sf):
    """'title' alias: lower-cased, accent-folded title, ascending, first page of 10."""
    return page_rows(posts(spark, sf, ["post"]), S.sort_columns("title", "asc"), page=1, per_page=10)


@query("srt2_multi_key", POSTS + f"""
SELECT id, row_number() OVER (ORDER BY menu_order DESC, {FOLD} ASC, id) AS pos
FROM v_posts WHERE post_type = 'product' ORDER BY pos LIMIT 20""")
def srt2_multi_key(spark, sf):
    cols = S.sort_columns({"menu_order": "desc", "title": "asc"})
    return page_rows(posts(spark, sf, ["product"]), cols, per_page=20)


@query("srt3_meta_value_num", POSTS + """
SELECT id, row_number() OVER (ORDER BY price ASC NULLS LAST, id) AS pos
FROM v_posts WHERE post_type = 'product' ORDER BY pos LIMIT 10""")
def srt3_meta_value_num(spark, sf):
    cols = S.sort_columns("meta_value_num", "asc", meta_key="_price")
    return page_rows(posts(spark, sf, ["product"]), cols, per_page=10)


@query("srt4_named_meta_clause", POSTS + """
SELECT id, row_number() OVER (ORDER BY trunc(price) DESC, id) AS pos
FROM v_posts WHERE post_type = 'product' AND trunc(price) > 950 ORDER BY pos LIMIT 10""")
def srt4_named_meta_clause(spark, sf):
    """orderby names a meta_query clause: its key and type give the sort path."""
    mq = {"price_clause": {"key": "_price", "value": 950, "compare": ">", "type": "NUMERIC"}}
    df = posts(spark, sf, ["product"]).filter(P.meta_query(mq))
    cols = S.sort_columns(S.resolve_meta_orderby("price_clause", mq), "desc")
    return page_rows(df, cols, per_page=10)


@query("srt5_default_sort", POSTS + """
SELECT id, row_number() OVER (ORDER BY post_date DESC, id) AS pos
FROM v_posts WHERE post_type = 'shop_order' ORDER BY pos LIMIT 10""")
def srt5_default_sort(spark, sf):
    """No search and no orderby: newest first."""
    return page_rows(posts(spark, sf, ["shop_order"]), S.sort_columns(None, "desc", has_search=False), per_page=10)


@query("srt7_orderby_none", POSTS + """
SELECT id, row_number() OVER (ORDER BY id) AS pos FROM v_posts WHERE post_type = 'product' ORDER BY pos LIMIT 10""")
def srt7_orderby_none(spark, sf):
    return page_rows(posts(spark, sf, ["product"]), S.sort_columns("none"), per_page=10)


@query("srt9_total_and_pages", POSTS + """
SELECT id, (SELECT count(*) FROM v_posts WHERE post_type = 'shop_order' AND post_status = 'O')::BIGINT AS found,
       ceil((SELECT count(*) FROM v_posts WHERE post_type = 'shop_order' AND post_status = 'O') / 25.0)::BIGINT
         AS max_pages
FROM (SELECT id FROM v_posts WHERE post_type = 'shop_order' AND post_status = 'O'
      ORDER BY post_date DESC, id LIMIT 25 OFFSET 25)""")
def srt9_total_and_pages(spark, sf):
    df = posts(spark, sf, ["shop_order"]).filter(P.post_status_filter("O"))
    page = S.paginate(df, S.sort_columns(None, "desc"), page=2, per_page=25).select("id")
    return S.with_total(df, page, size=25)


@query("srt11_projection", with_views(V_COMMENTS) + """
SELECT comment_ID AS id, comment_parent AS post_parent FROM v_comments WHERE comment_parent <> 0""")
def srt11_projection(spark, sf):
    """fields 'id=>parent'."""
    from contentspark.plans.q_filters import comments_as_posts

    df = comments_as_posts(spark, sf).filter(F.col("post_parent") != 0)
    return S.project(df, "id=>parent")


@query("srt12_instant_results", POSTS + """
SELECT id, row_number() OVER (ORDER BY price DESC, id) AS pos FROM v_posts
WHERE post_type = 'product' AND (ptype = 'SMALL' AND brand IN ('Brand#1', 'Brand#2', 'Brand#3'))
  AND price >= 920 AND price <= 980
ORDER BY price DESC, id LIMIT 6 OFFSET 6""")
def srt12_instant_results(spark, sf):
    """Instant-results arguments: offset 6, per_page 6, orderby price desc, tax-* filters with
    relation 'and', min/max price."""
    from contentspark.operators.commerce import instant_results_args

    args = instant_results_args(offset=6, per_page=6, orderby="price", order="desc", post_types=["product"],
                                tax={"ptype": ["small"], "brand": ["brand-1", "brand-2", "brand-3"]},
                                relation="and", min_price=920, max_price=980)
    df = posts(spark, sf, ["product"]).filter(P.post_filter(args["filters"]))
    return page_rows(df, args["sort"], offset=6, per_page=6)


@query("srt13_order_search", POSTS + """
SELECT id, row_number() OVER (ORDER BY post_date DESC, id) AS pos FROM v_posts
WHERE post_type = 'shop_order' AND post_author IN (10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20)
  AND year(post_date) * 100 + month(post_date) BETWEEN 199701 AND 199712
ORDER BY pos LIMIT 6""")
def srt13_order_search(spark, sf):
    """Order search arguments: customers, m (yyyymm range), per_page 6, search text 'order'."""
    df = posts(spark, sf, ["shop_order"]).filter(P.post_filter({
        "post_type": "shop_order", "author__in": list(range(10, 21)),
        "date_query": [{"m": [199701, 199712], "compare": "BETWEEN"}]}))
    df = df.filter(text_match_all(["post_title"], "order"))
    return page_rows(df, S.sort_columns(None, "desc"), per_page=6)


@query("srt1_nested_paths", POSTS + """
SELECT id, row_number() OVER (ORDER BY lower(brand) DESC, author_login ASC, id) AS pos
FROM (SELECT *, '' AS author_login FROM v_posts WHERE post_type = 'product') ORDER BY pos LIMIT 25""")
def srt1_nested_paths(spark, sf):
    """Sort paths into the document: terms.brand.name.sortable (descending), then post_author.login.sortable."""
    cols = S.sort_columns({"terms.brand.name.sortable": "desc", "post_author.login.sortable": "asc"})
    return page_rows(posts(spark, sf, ["product"]), cols, per_page=25)


@query("srt8_all_rows", POSTS + "SELECT id FROM v_posts WHERE post_type = 'shop_order'")
def srt8_all_rows(spark, sf):
    """Page size -1: every row."""
    return S.paginate(posts(spark, sf, ["shop_order"]), S.sort_columns(None, "desc"), per_page=-1).select("id")
