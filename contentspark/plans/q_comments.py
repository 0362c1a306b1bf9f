"""Queries for comment filters and listings (CMT-1..13)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from contentspark.operators import comments as C
from contentspark.operators import sorting as S
from contentspark.plans.registry import query
from contentspark.plans.sqlviews import V_COMMENTS, V_POSTS, tokens, with_views
from contentspark.sources import views as V

CM = with_views(V_COMMENTS)


def comments_where(spark, sf, args):
    return V.v_comments(spark, sf).filter(C.comment_filter(args))


@query("cmt1_author_fields", CM + """
SELECT comment_ID FROM v_comments WHERE comment_author_email = 'user@example.com' AND user_id IN (1, 2, 3, 4, 5, 6)
UNION ALL SELECT comment_ID FROM v_comments WHERE comment_author_url = 'https://system.example.com'
UNION ALL SELECT comment_ID FROM v_comments WHERE user_id NOT IN (0, 1, 2)""")
def cmt1_author_fields(spark, sf):
    a = comments_where(spark, sf, {"author_email": "user@example.com", "author__in": [1, 2, 3, 4, 5, 6]})
    b = comments_where(spark, sf, {"author_url": "https://system.example.com"})
    c = comments_where(spark, sf, {"author__not_in": [0, 1, 2], "extra": F.col("user_id") != 0})
    return a.select("comment_ID").unionByName(b.select("comment_ID")).unionByName(c.select("comment_ID"))


@query("cmt2_comment_ids", CM + """
SELECT comment_ID FROM v_comments WHERE comment_ID IN (1, 2, 3, 16777217, 83886083) AND comment_ID NOT IN (2)""")
def cmt2_comment_ids(spark, sf):
    return comments_where(spark, sf, {"comment__in": [1, 2, 3, V.TURNS + 1, 5 * V.TURNS + 3],
                                      "comment__not_in": [2]}).select("comment_ID")


@query("cmt3_date_query", CM + """
SELECT comment_ID FROM v_comments WHERE comment_date_gmt >= TIMESTAMP '2024-01-02 00:00:00'
  AND comment_date_gmt <= TIMESTAMP '2024-01-03 23:59:59' AND minute(comment_date_gmt) >= 2""")
def cmt3_date_query(spark, sf):
    dq = [{"after": "2024-01-02", "before": "2024-01-03", "inclusive": True}, {"minute": 2, "compare": ">="}]
    return comments_where(spark, sf, {"date_query": dq}).select("comment_ID")


@query("cmt4_karma", CM + "SELECT comment_ID FROM v_comments WHERE comment_karma = 0")
def cmt4_karma(spark, sf):
    """karma 0 is a value, not 'no filter'."""
    return comments_where(spark, sf, {"karma": 0}).select("comment_ID")


@query("cmt6_parent", CM + """
SELECT comment_ID FROM v_comments WHERE comment_parent = 0
UNION ALL SELECT comment_ID FROM v_comments WHERE comment_parent IN (1, 1001) AND comment_parent NOT IN (1001)""")
def cmt6_parent(spark, sf):
    """hierarchical -> top level only; parent__in / parent__not_in."""
    a = comments_where(spark, sf, {"hierarchical": "threaded"}).select("comment_ID")
    b = comments_where(spark, sf, {"parent__in": [1, 1001], "parent__not_in": [1001]}).select("comment_ID")
    return a.unionByName(b)


@query("cmt7_parent_post_filters", with_views(V_POSTS, V_COMMENTS) + """
SELECT c.comment_ID FROM v_comments c JOIN v_posts p ON p.id = c.comment_post_ID
WHERE p.post_type = 'post' AND p.post_status = 'publish' AND p.id NOT IN (72057594037927936, 72057594037927937)
  AND p.post_password = ''""")
def cmt7_parent_post_filters(spark, sf):
    posts = V.v_posts(spark, sf, types=["post"]).filter(F.col("post_password") == "")
    c = V.v_comments(spark, sf)
    out = C.with_post_filter(c, posts, {"post_type": "post", "post_status": "publish",
                                        "post__not_in": [V.DOC_ID_OFFSET, V.DOC_ID_OFFSET + 1]})
    return out.select("comment_ID")


@query("cmt8_search", CM + f"""
SELECT comment_ID FROM v_comments
WHERE list_has_all(list_concat({tokens('comment_author')}, {tokens('comment_author_email')},
                               {tokens('comment_author_url')}, {tokens('comment_content')}), ['the', 'and', 'user'])""")
def cmt8_search(spark, sf):
    return comments_where(spark, sf, {"search": "The AND user"}).select("comment_ID")


@query("cmt8_meta", CM + """
SELECT comment_ID FROM v_comments WHERE comment_author = 'assistant'""")
def cmt8_meta(spark, sf):
    """Search in chosen fields only, here a meta key: other fields don't count."""
    return comments_where(spark, sf, {"search": "ASSISTANT", "search_fields": ["meta.role.value"]}
                          ).select("comment_ID")


@query("cmt11_meta", CM + """
SELECT comment_ID, row_number() OVER (ORDER BY length(comment_content) DESC, comment_ID) AS pos FROM v_comments
ORDER BY pos LIMIT 8""")
def cmt11_meta(spark, sf):
    """First page of 8 by the numeric reading of the meta key 'length'."""
    cols = C.comment_sort("meta.length.long", "desc")
    page = S.paginate(V.v_comments(spark, sf), cols, page=1, per_page=8)
    return page.select("comment_ID", F.row_number().over(Window.orderBy(*cols)).alias("pos"))


@query("cmt9_status", CM + """
SELECT comment_ID FROM v_comments WHERE comment_approved = '0'
UNION ALL SELECT comment_ID FROM v_comments WHERE comment_approved = '1' OR user_id IN (3, 4)
  OR comment_author_email = 'system@example.com'""")
def cmt9_status(spark, sf):
    a = comments_where(spark, sf, {"status": "hold"}).select("comment_ID")
    b = comments_where(spark, sf, {"status": "approve",
                                   "include_unapproved": [3, 4, "system@example.com"]}).select("comment_ID")
    return a.unionByName(b)


@query("cmt10_type", CM + """
SELECT comment_ID FROM v_comments WHERE comment_type IN ('user', 'system') AND comment_type NOT IN ('system')""")
def cmt10_type(spark, sf):
    return comments_where(spark, sf, {"type__in": ["user", "system"], "type__not_in": ["system"]}).select("comment_ID")


@query("cmt11_paging_sort", CM + """
SELECT comment_ID, row_number() OVER (ORDER BY comment_date_gmt DESC, comment_ID) AS pos FROM v_comments
ORDER BY comment_date_gmt DESC, comment_ID LIMIT 5 OFFSET 10""")
def cmt11_paging_sort(spark, sf):
    """number 5, paged 3 (offset 10), default order date desc."""
    cols = C.comment_sort()
    page = S.paginate(V.v_comments(spark, sf), cols, page=3, per_page=5)
    return page.select("comment_ID", (F.row_number().over(Window.orderBy(*cols)) + 10).alias("pos"))


@query("cmt12_count", CM + "SELECT count(*)::BIGINT AS count FROM v_comments WHERE comment_type = 'assistant'")
def cmt12_count(spark, sf):
    df = comments_where(spark, sf, {"type": "assistant"})
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("count"))


@query("cmt13_top_comments_for_phrase", with_views(V_POSTS, V_COMMENTS) + f""",
hits AS (
  SELECT c.comment_ID, c.comment_date_gmt FROM v_comments c JOIN v_posts p ON p.id = c.comment_post_ID
  WHERE c.comment_approved = '1' AND p.post_type IN ('post') AND p.post_status = 'publish'
    AND list_has_all(list_concat({tokens('c.comment_author')}, {tokens('c.comment_author_email')},
                     {tokens('c.comment_author_url')}, {tokens('c.comment_content')}), ['the'])
)
SELECT comment_ID, row_number() OVER (ORDER BY comment_date_gmt DESC, comment_ID) AS pos FROM hits
ORDER BY comment_date_gmt DESC, comment_ID LIMIT 5""")
def cmt13_top_comments_for_phrase(spark, sf):
    """Five newest approved comments matching 'the' on published posts of the chosen types."""
    c = comments_where(spark, sf, {"status": "approve", "search": "the"})
    c = C.with_post_filter(c, V.v_posts(spark, sf, types=["post"]), {"post_type": ["post"], "post_status": "publish"})
    cols = C.comment_sort()
    top = c.orderBy(*cols).limit(5)
    return top.select("comment_ID", F.row_number().over(Window.orderBy(*cols)).alias("pos"))
