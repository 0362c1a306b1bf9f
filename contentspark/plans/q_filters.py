"""Queries for post filters (FLT), taxonomy (TAX), meta (META) and date (DATE) predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from contentspark.functions.text import slug_py
from contentspark.operators import predicates as P
from contentspark.plans.registry import query
from contentspark.plans.sqlviews import V_COMMENTS, V_POSTS, tokens, with_views
from contentspark.sources import views as V
from contentspark.sources.tables import Tables

POSTS = with_views(V_POSTS)


def posts_where(spark, sf, args: dict, types=None, searchable=None):
    """Ids of v_posts rows matching a dictionary of query variables."""
    posts = V.v_posts(spark, sf, types=types)
    return posts.filter(P.post_filter(args, searchable_types=searchable, taxonomies=["brand", "ptype", "lang"]))


def comments_as_posts(spark, sf):
    c = V.v_comments(spark, sf)
    return c.select(F.col("comment_ID").alias("id"), F.col("comment_parent").alias("post_parent"),
                    F.col("comment_type").alias("post_type"))


# ---------------------------------------------------------------- FLT

@query("flt1_post_type", POSTS + "SELECT id FROM v_posts WHERE post_type IN ('product', 'page')")
def flt1_post_type(spark, sf):
    return posts_where(spark, sf, {"post_type": ["product", "page"]}).select("id")


@query("flt1_default_type", POSTS + "SELECT id FROM v_posts WHERE post_type = 'post'")
def flt1_default_type(spark, sf):
    """No post_type argument -> type 'post'."""
    return posts_where(spark, sf, {}).select("id")


@query("flt2_post_status", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'shop_order' AND post_status IN ('O', 'F')""")
def flt2_post_status(spark, sf):
    return posts_where(spark, sf, {"post_type": "shop_order", "post_status": "O, F"}, types=["shop_order"]).select("id")


@query("flt2_status_any", POSTS + """
SELECT id FROM v_posts WHERE post_type IN ('shop_order', 'product') AND post_status = 'publish'""")
def flt2_status_any(spark, sf):
    """'any' status for an anonymous reader = public statuses only."""
    return posts_where(spark, sf, {"post_type": ["shop_order", "product"], "post_status": "any"},
                       types=["shop_order", "product"]).select("id")


@query("flt3_post_parent", with_views(V_COMMENTS) + "SELECT comment_ID AS id FROM v_comments WHERE comment_parent = 0")
def flt3_post_parent(spark, sf):
    return comments_as_posts(spark, sf).filter(P.post_filter({"post_parent": 0, "default_type": False})).select("id")


@query("flt4_parent_in_not_in", with_views(V_COMMENTS) + """
SELECT comment_ID AS id FROM v_comments
WHERE comment_parent IN (1000, 1001, 2000, 2001, 3002) AND comment_parent NOT IN (1001, 3002)""")
def flt4_parent_in_not_in(spark, sf):
    args = {"post_parent__in": [1000, 1001, 2000, 2001, 3002, 0], "post_parent__not_in": [1001, 3002],
            "default_type": False}
    return comments_as_posts(spark, sf).filter(P.post_filter(args)).select("id")


@query("flt5_id_in_not_in", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'post' AND id IN (72057594037927937, 72057594037927938, 72057594037927939, 72057594037927946, 72057594037928436)
  AND id NOT IN (72057594037927938, 72057594037928436)""")
def flt5_id_in_not_in(spark, sf):
    args = {"post__in": [V.DOC_ID_OFFSET + i for i in (1, 2, 3, 10, 500)],
            "post__not_in": [V.DOC_ID_OFFSET + i for i in (2, 500)]}
    return posts_where(spark, sf, args, types=["post"]).select("id")


@query("flt5_id_table_semi", """
SELECT d.doc_id FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
  AND d.doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def flt5_id_table_semi(spark, sf):
    """Id lists given as tables: semi join (IN) and anti join (NOT IN)."""
    from contentspark.operators.filters_tables import ids_in, ids_not_in

    t = Tables(spark, sf)
    keep = t.labels.filter(F.col("quality") == 1).select("doc_id")
    drop = t.labels.filter(F.col("toxic") == 1).select("doc_id")
    return ids_not_in(ids_in(t.documents, keep, "doc_id"), drop, "doc_id").select("doc_id")


@query("flt6_name_in", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'product' AND post_name IN ('small-ring-0', 'blue-bolt-2', 'nope-1')""")
def flt6_name_in(spark, sf):
    return posts_where(spark, sf, {"post_type": "product", "post_name__in": ["small-ring-0", "blue-bolt-2", "nope-1"]},
                       types=["product"]).select("id")


@query("flt7_tag_not_in", POSTS + f"""
SELECT id FROM v_posts WHERE post_type = 'product'
  AND NOT list_has_any({tokens('post_title')}, ['bolt', 'gear'])""")
def flt7_tag_not_in(spark, sf):
    ids = [V.flat_term_id_py("post_tag", s) for s in ("bolt", "gear")]
    return posts_where(spark, sf, {"post_type": "product", "tag__not_in": ids}, types=["product"]).select("id")


@query("flt8_author_precedence", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'shop_order' AND post_author IN (10, 20, 30)""")
def flt8_author_precedence(spark, sf):
    """author__in wins over author__not_in when author and author_name are absent."""
    args = {"post_type": "shop_order", "author__in": [10, 20, 30], "author__not_in": [10]}
    return posts_where(spark, sf, args, types=["shop_order"]).select("id")


@query("flt8_author_not_in", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'shop_order' AND post_author NOT IN (1, 2, 3, 4, 5)""")
def flt8_author_not_in(spark, sf):
    return posts_where(spark, sf, {"post_type": "shop_order", "author__not_in": [1, 2, 3, 4, 5]},
                       types=["shop_order"]).select("id")


@query("flt9_mime_type", POSTS + """
SELECT id FROM v_posts WHERE post_type IN ('post', 'page')
  AND (post_mime_type LIKE 'text/src1%' OR post_mime_type = 'text/html')""")
def flt9_mime_type(spark, sf):
    """A string is a prefix family; a list entry 'x/*' a whole family."""
    c = P.mime_type_filter("text/src1") | P.mime_type_filter(["text/html"])
    return V.v_posts(spark, sf, types=["post", "page"]).filter(
        P.post_filter({"post_type": ["post", "page"], "extra": c})).select("id")


@query("flt9_prefix", POSTS + """
SELECT id FROM v_posts WHERE post_type IN ('post', 'page') AND starts_with(post_mime_type, 'text/h')
UNION ALL SELECT id FROM v_posts WHERE post_type = 'page'""")
def flt9_prefix(spark, sf):
    """A string is a plain prefix; the empty string filters nothing."""
    posts = V.v_posts(spark, sf, types=["post", "page"])
    a = posts.filter(P.post_filter({"post_type": ["post", "page"], "post_mime_type": "text/h"})).select("id")
    b = posts.filter(P.post_filter({"post_type": ["page"], "post_mime_type": ""})).select("id")
    return a.unionByName(b)


@query("flt10_no_password", POSTS + "SELECT id FROM v_posts WHERE post_type = 'post' AND post_password = ''")
def flt10_no_password(spark, sf):
    return posts_where(spark, sf, {"post_type": "post", "has_password": False}, types=["post"]).select("id")


@query("flt11_exclude_flag", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'post' AND (quality IS NULL OR quality <> 0)""")
def flt11_exclude_flag(spark, sf):
    """quality=0 stands for the exclude-from-search flag."""
    return posts_where(spark, sf, {"post_type": "post", "exclude_flag": ("quality", "0")}, types=["post"]).select("id")


@query("flt12_searchable_any", POSTS + "SELECT id FROM v_posts WHERE post_type IN ('post', 'page')")
def flt12_searchable_any(spark, sf):
    return posts_where(spark, sf, {"post_type": "any"}, searchable=["post", "page"]).select("id")


# ---------------------------------------------------------------- TAX

@query("tax1_in_slug", POSTS + "SELECT id FROM v_posts WHERE post_type = 'product' AND brand IN ('Brand#2', 'Brand#17')")
def tax1_in_slug(spark, sf):
    tq = {"taxonomy": "brand", "field": "slug", "terms": ["brand-2", "brand-17"]}
    return posts_where(spark, sf, {"post_type": "product", "tax_query": [tq]}, types=["product"]).select("id")


@query("tax1_in_name", POSTS + "SELECT id FROM v_posts WHERE post_type = 'product' AND ptype IN ('SMALL', 'LARGE')")
def tax1_in_name(spark, sf):
    tq = {"taxonomy": "ptype", "field": "name", "terms": ["SMALL", "LARGE"]}
    return posts_where(spark, sf, {"post_type": "product", "tax_query": [tq]}, types=["product"]).select("id")


@query("tax1_in_term_id", POSTS + "SELECT id FROM v_posts WHERE post_type = 'product' AND brand = 'Brand#5'")
def tax1_in_term_id(spark, sf):
    tq = {"taxonomy": "brand", "field": "term_id", "terms": [V.flat_term_id_py("brand", "brand-5")]}
    return posts_where(spark, sf, {"post_type": "product", "tax_query": [tq]}, types=["product"]).select("id")


@query("tax2_not_in", POSTS + """
SELECT id FROM v_posts WHERE post_type IN ('product', 'post') AND ptype IS DISTINCT FROM 'PROMO'
  AND ptype IS DISTINCT FROM 'ECONOMY'""")
def tax2_not_in(spark, sf):
    """NOT IN matches objects without the taxonomy (posts have no ptype)."""
    tq = {"taxonomy": "ptype", "field": "name", "terms": ["PROMO", "ECONOMY"], "operator": "NOT IN"}
    return posts_where(spark, sf, {"post_type": ["product", "post"], "tax_query": [tq]},
                       types=["product", "post"]).select("id")


@query("tax3_and", POSTS + f"""
SELECT id FROM v_posts WHERE post_type = 'product' AND list_has_all({tokens('post_title')}, ['small', 'bolt'])""")
def tax3_and(spark, sf):
    tq = {"taxonomy": "post_tag", "field": "slug", "terms": ["small", "bolt"], "operator": "AND"}
    return posts_where(spark, sf, {"post_type": "product", "tax_query": [tq]}, types=["product"]).select("id")


@query("tax4_exists", POSTS + """
SELECT id FROM v_posts WHERE post_type IN ('product', 'post', 'page') AND lang IS NULL""")
def tax4_exists(spark, sf):
    """NOT EXISTS lang over three types (products and pages lack the taxonomy)."""
    tq = {"relation": "AND", "a": {"taxonomy": "lang", "operator": "NOT EXISTS"}}
    return posts_where(spark, sf, {"post_type": ["product", "post", "page"], "tax_query": tq}).select("id")


@query("tax4_exists_brand", POSTS + "SELECT id FROM v_posts WHERE post_type IN ('product', 'post') AND brand IS NOT NULL")
def tax4_exists_brand(spark, sf):
    tq = {"taxonomy": "brand", "operator": "EXISTS"}
    return posts_where(spark, sf, {"post_type": ["product", "post"], "tax_query": [tq]},
                       types=["product", "post"]).select("id")


@query("tax5_nested", POSTS + f"""
SELECT id FROM v_posts WHERE post_type = 'product'
  AND (brand IN ('Brand#1', 'Brand#2') OR ptype = 'SMALL')
  AND NOT list_has_any({tokens('post_title')}, ['ring'])""")
def tax5_nested(spark, sf):
    tq = {"relation": "AND",
          "g": {"relation": "OR",
                "a": {"taxonomy": "brand", "field": "name", "terms": ["Brand#1", "Brand#2"]},
                "b": {"taxonomy": "ptype", "field": "name", "terms": ["SMALL"]}},
          "c": {"taxonomy": "post_tag", "field": "slug", "terms": ["ring"], "operator": "NOT IN"}}
    return posts_where(spark, sf, {"post_type": "product", "tax_query": tq}, types=["product"]).select("id")


@query("tax6_slug_normalization", POSTS + "SELECT id FROM v_posts WHERE post_type = 'product' AND brand = 'Brand#3'")
def tax6_slug_normalization(spark, sf):
    tq = {"taxonomy": "brand", "field": "slug", "terms": ["  BRAND#3 "]}
    assert slug_py("  BRAND#3 ") == "brand-3"
    return posts_where(spark, sf, {"post_type": "product", "tax_query": [tq]}, types=["product"]).select("id")


@query("tax7_implicit_args", POSTS + f"""
SELECT id FROM v_posts WHERE post_type = 'product' AND list_contains({tokens('post_title')}, 'bolt')
  AND brand IN ('Brand#3', 'Brand#4')""")
def tax7_implicit_args(spark, sf):
    args = {"post_type": "product", "tag": "bolt", "brand": "brand-3,brand-4"}
    return posts_where(spark, sf, args, types=["product"]).select("id")


# ---------------------------------------------------------------- META

@query("meta1_eq_in", POSTS + "SELECT id FROM v_posts WHERE post_type = 'product' AND size IN (5, 10, 15)")
def meta1_eq_in(spark, sf):
    mq = [{"key": "size", "value": [5, 10, 15], "compare": "IN"}]
    return posts_where(spark, sf, {"post_type": "product", "meta_query": mq}, types=["product"]).select("id")


@query("meta2_not_equal", POSTS + "SELECT id FROM v_posts WHERE post_type = 'post' AND quality IS DISTINCT FROM 1")
def meta2_not_equal(spark, sf):
    """!= matches posts that lack the key."""
    mq = [{"key": "quality", "value": "1", "compare": "!="}]
    return posts_where(spark, sf, {"post_type": "post", "meta_query": mq}, types=["post"]).select("id")


@query("meta2_not_in", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'product' AND size NOT IN (1, 2, 3, 4, 5)""")
def meta2_not_in(spark, sf):
    mq = [{"key": "size", "value": ["1", "2", "3", "4", "5"], "compare": "NOT IN"}]
    return posts_where(spark, sf, {"post_type": "product", "meta_query": mq}, types=["product"]).select("id")


@query("meta3_exists", POSTS + "SELECT id FROM v_posts WHERE post_type = 'post' AND toxic IS NOT NULL")
def meta3_exists(spark, sf):
    """No compare and no value -> EXISTS."""
    mq = [{"key": "toxic"}]
    return posts_where(spark, sf, {"post_type": "post", "meta_query": mq}, types=["post"]).select("id")


@query("meta3_not_exists", POSTS + "SELECT id FROM v_posts WHERE post_type IN ('post', 'page') AND toxic IS NULL")
def meta3_not_exists(spark, sf):
    mq = [{"key": "toxic", "compare": "NOT EXISTS"}]
    return posts_where(spark, sf, {"post_type": ["post", "page"], "meta_query": mq}, types=["post", "page"]).select("id")


@query("meta4_range", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'product' AND price > 950 AND price <= 990.5 AND size >= 10 AND size < 40""")
def meta4_range(spark, sf):
    mq = [{"key": "_price", "value": 950, "compare": ">"}, {"key": "_price", "value": 990.5, "compare": "<="},
          {"key": "size", "value": 10, "compare": ">="}, {"key": "size", "value": 40, "compare": "<"}]
    return posts_where(spark, sf, {"post_type": "product", "meta_query": mq}, types=["product"]).select("id")


@query("meta5_between", POSTS + "SELECT id FROM v_posts WHERE post_type = 'product' AND price BETWEEN 920 AND 930")
def meta5_between(spark, sf):
    mq = [{"key": "_price", "value": [920, 930], "compare": "BETWEEN"}]
    return posts_where(spark, sf, {"post_type": "product", "meta_query": mq}, types=["product"]).select("id")


@query("meta5_not_between", POSTS + """
SELECT id FROM v_posts WHERE post_type IN ('product', 'post') AND (price <= 920 OR price >= 990)""")
def meta5_not_between(spark, sf):
    """NOT BETWEEN keeps the end points and excludes objects without the key."""
    mq = [{"key": "_price", "value": [920, 990], "compare": "NOT BETWEEN"}]
    return posts_where(spark, sf, {"post_type": ["product", "post"], "meta_query": mq},
                       types=["product", "post"]).select("id")


@query("meta6_like", POSTS + f"""
SELECT id FROM v_posts WHERE post_type = 'product'
  AND position(' red widget ' IN ' ' || array_to_string({tokens('post_title')}, ' ') || ' ') > 0""")
def meta6_like(spark, sf):
    """LIKE is a case-insensitive token phrase match."""
    mq = [{"key": "label", "value": "RED  Widget", "compare": "LIKE"}]
    return posts_where(spark, sf, {"post_type": "product", "meta_query": mq}, types=["product"]).select("id")


@query("meta6_not_like", POSTS + f"""
SELECT id FROM v_posts WHERE post_type = 'page'
   OR (post_type = 'product' AND NOT list_contains({tokens('post_title')}, 'small'))""")
def meta6_not_like(spark, sf):
    mq = [{"key": "label", "value": "small", "compare": "NOT LIKE"}]
    return posts_where(spark, sf, {"post_type": ["product", "page"], "meta_query": mq},
                       types=["product", "page"]).select("id")


@query("meta7_typed_numeric", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'shop_order' AND trunc(total) >= 300000 AND trunc(total) < 300500""")
def meta7_typed_numeric(spark, sf):
    """type NUMERIC reads the long reading (truncated)."""
    mq = [{"key": "_total", "value": 300000, "compare": ">=", "type": "NUMERIC"},
          {"key": "_total", "value": 300500, "compare": "<", "type": "NUMERIC"}]
    return posts_where(spark, sf, {"post_type": "shop_order", "meta_query": mq}, types=["shop_order"]).select("id")


@query("meta7_typed_char", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'shop_order' AND id IN (
  SELECT 216172782113783808 + o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def meta7_typed_char(spark, sf):
    mq = [{"key": "_priority", "value": "1-URGENT", "compare": "=", "type": "CHAR"}]
    return posts_where(spark, sf, {"post_type": "shop_order", "meta_query": mq}, types=["shop_order"]).select("id")


@query("meta8_nested", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'product' AND (price > 995 OR (size < 3 AND price < 905))""")
def meta8_nested(spark, sf):
    mq = {"relation": "OR",
          "a": {"key": "_price", "value": 995, "compare": ">"},
          "b": {"relation": "AND", "x": {"key": "size", "value": 3, "compare": "<"},
                "y": {"key": "_price", "value": 905, "compare": "<"}}}
    return posts_where(spark, sf, {"post_type": "product", "meta_query": mq}, types=["product"]).select("id")


@query("meta9_short_form", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'product' AND size > 45 AND price < 950""")
def meta9_short_form(spark, sf):
    """meta_key/meta_value_num/meta_compare AND-ed with meta_query."""
    args = {"post_type": "product", "meta_key": "size", "meta_value_num": 45, "meta_compare": ">",
            "meta_query": [{"key": "_price", "value": 950, "compare": "<"}]}
    return posts_where(spark, sf, args, types=["product"]).select("id")


# ---------------------------------------------------------------- DATE

@query("date1_simple_parts", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'shop_order' AND year(post_date) = 1997 AND month(post_date) = 3""")
def date1_simple_parts(spark, sf):
    return posts_where(spark, sf, {"post_type": "shop_order", "year": 1997, "monthnum": 3},
                       types=["shop_order"]).select("id")


@query("date1_m_week", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'shop_order' AND year(post_date) * 100 + month(post_date) = 199801
   OR (post_type = 'shop_order' AND weekofyear(post_date) = 10 AND year(post_date) = 1999)""")
def date1_m_week(spark, sf):
    dq = {"relation": "OR", "a": {"m": 199801}, "b": {"w": 10, "year": 1999}}
    return posts_where(spark, sf, {"post_type": "shop_order", "date_query": dq}, types=["shop_order"]).select("id")


@query("date2_before_after", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'shop_order'
  AND post_date > TIMESTAMP '1996-12-31 23:59:59' AND post_date < TIMESTAMP '1997-03-01 00:00:00'""")
def date2_before_after(spark, sf):
    """Exclusive bounds: after year 1996 (end of it), before March 1997 (start of it)."""
    dq = [{"after": {"year": 1996}, "before": {"year": 1997, "month": 3}}]
    return posts_where(spark, sf, {"post_type": "shop_order", "date_query": dq}, types=["shop_order"]).select("id")


@query("date2_inclusive", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'shop_order'
  AND post_date >= TIMESTAMP '1998-01-01 00:00:00' AND post_date <= TIMESTAMP '1998-01-02 23:59:59'""")
def date2_inclusive(spark, sf):
    dq = [{"after": "1998-01-01", "before": "1998-01-02", "inclusive": True}]
    return posts_where(spark, sf, {"post_type": "shop_order", "date_query": dq}, types=["shop_order"]).select("id")


@query("date3_column_choice", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-06-01 00:00:00' AND l_shipdate <= TIMESTAMP '1997-06-30 23:59:59'
  AND dayofweek(l_shipdate) = 1""")
def date3_column_choice(spark, sf):
    dq = [{"column": "l_shipdate", "after": "1997-06-01", "before": "1997-06-30", "inclusive": True,
           "dayofweek": 1}]
    return Tables(spark, sf).lineitem.filter(P.date_query(dq)).select("l_orderkey", "l_linenumber")


@query("date4_part_compare", """
SELECT event_id FROM events WHERE hour(ts) BETWEEN 9 AND 17 AND dayofweek(ts) NOT IN (0, 6)""")
def date4_part_compare(spark, sf):
    dq = [{"column": "ts", "hour": [9, 17], "compare": "BETWEEN"},
          {"column": "ts", "dayofweek": [0, 6], "compare": "NOT IN"}]
    return Tables(spark, sf).events.filter(P.date_query(dq)).select("event_id")


@query("date4_not_between", """
SELECT event_id FROM events WHERE NOT (dayofmonth(ts) > 5 AND dayofmonth(ts) < 25)""")
def date4_not_between(spark, sf):
    """Date NOT BETWEEN keeps the end points (NOT (a < x < b))."""
    dq = [{"column": "ts", "day": [5, 25], "compare": "NOT BETWEEN"}]
    return Tables(spark, sf).events.filter(P.date_query(dq)).select("event_id")


@query("date5_tree", """
SELECT event_id FROM events WHERE (dayofmonth(ts) = 3 AND hour(ts) < 6)
   OR (isodow(ts) = 7 AND minute(ts) >= 30 AND dayofyear(ts) - 1 > 20)""")
def date5_tree(spark, sf):
    dq = {"relation": "OR", "column": "ts",
          "a": {"day": 3, "relation": "AND", "x": {"hour": 6, "compare": "<"}},
          "b": {"dayofweek_iso": 7, "z": {"minute": 30, "compare": ">="}, "y": {"dayofyear": 20, "compare": ">"}}}
    return Tables(spark, sf).events.filter(P.date_query(dq)).select("event_id")


@query("date6_invalid_parts", """
SELECT o_orderkey FROM orders
WHERE try_cast(printf('%04d-%02d-%02d', year(o_orderdate), month(o_orderdate), dayofmonth(o_orderdate) + 2)
               AS DATE) IS NULL""")
def date6_invalid_parts(spark, sf):
    """Report rows whose (year, month, day + 2) is not a real calendar date."""
    o = Tables(spark, sf).orders
    d = F.col("o_orderdate")
    bad = P.invalid_date_parts(F.year(d), F.month(d), F.dayofmonth(d) + 2)
    return o.filter(bad).select("o_orderkey")


@query("date7_relative_range", POSTS + """
SELECT id FROM v_posts WHERE post_type = 'shop_order'
  AND post_date BETWEEN TIMESTAMP '2000-08-01 00:00:00' AND TIMESTAMP '2001-08-01 23:59:59'""")
def date7_relative_range(spark, sf):
    import datetime as dt

    from contentspark.functions.dates import relative_range

    s, e = relative_range("last-12-months", as_of=dt.datetime(2001, 8, 1, 12, 0, 0))
    dq = [{"after": s.strftime("%Y-%m-%d %H:%M:%S"), "before": e.strftime("%Y-%m-%d %H:%M:%S"), "inclusive": True}]
    return posts_where(spark, sf, {"post_type": "shop_order", "date_query": dq}, types=["shop_order"]).select("id")
