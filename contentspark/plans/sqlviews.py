"""DuckDB SQL twins of the views in :mod:`contentspark.sources.views`.

Only used by oracle SQL: each oracle query prefixes the CTEs it needs. They
express the same definitions on the base tables, written independently of
the Spark code (flat columns instead of maps).
"""

SLUG = ("regexp_replace(regexp_replace(lower(translate(lower({x}), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', "
        "'aaaaaaceeeeiiiinooooouuuuyy')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')")


def slug(x: str) -> str:
    return SLUG.format(x=x)


def tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}]+')"


STRIP_HTML = (
    "trim(regexp_replace(replace(replace(replace(replace(replace(replace("
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, "
    "'(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), "
    "'(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), "
    "'&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), "
    "'[ \\t\\n\\r]+', ' ', 'g'))"
)

HTML_TITLE = (
    "trim(replace(replace(replace(replace(replace(replace("
    "regexp_extract({x}, '(?is)<title[^>]*>(.*?)</title>', 1), "
    "'&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'))"
)


def strip_html(x: str) -> str:
    return STRIP_HTML.format(x=x)


def html_title(x: str) -> str:
    return HTML_TITLE.format(x=x)


V_POSTS = f"""
v_posts AS (
  SELECT p_partkey::BIGINT AS id, 'product' AS post_type, 'publish' AS post_status, p_name AS post_title,
         p_name AS post_content, {slug('p_name')} || '-' || p_partkey::VARCHAR AS post_name,
         0::BIGINT AS post_parent, 0::BIGINT AS post_author,
         TIMESTAMP '2023-01-01 00:00:00' + to_hours(p_partkey::BIGINT) AS post_date,
         '' AS post_mime_type, '' AS post_password, p_size AS menu_order,
         p_retailprice AS price, p_size AS size, p_brand AS brand, p_type AS ptype,
         NULL::INTEGER AS quality, NULL::INTEGER AS toxic, NULL::VARCHAR AS lang, NULL::VARCHAR AS source,
         NULL::DOUBLE AS total
  FROM part
  UNION ALL
  SELECT 72057594037927936 + d.doc_id, 'post', 'publish', trim(split_part(d.text, chr(10), 1)), d.text,
         'doc-' || d.doc_id::VARCHAR, 0, 0, TIMESTAMP '2024-01-01 00:00:00' + to_hours(d.doc_id::BIGINT),
         'text/' || d.source, CASE WHEN l.toxic = 1 THEN 'protected' ELSE '' END, 0,
         NULL, NULL, NULL, NULL, l.quality, l.toxic, d.lang, d.source, NULL
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
  UNION ALL
  SELECT 144115188075855872 + page_id, 'page', 'publish', {html_title('html')}, {strip_html('html')},
         'page-' || page_id::VARCHAR, 0, 0, TIMESTAMP '2024-06-01 00:00:00' + to_hours(page_id::BIGINT),
         'text/html', '', 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM pages
  UNION ALL
  SELECT 216172782113783808 + o_orderkey, 'shop_order', o_orderstatus, 'Order #' || o_orderkey::VARCHAR, '',
         'order-' || o_orderkey::VARCHAR, 0, o_custkey, o_orderdate, '', '', 0,
         NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, o_totalprice
  FROM orders
)"""

V_TERMS = f"""
v_terms AS (
  SELECT (r_regionkey + 1)::BIGINT AS term_id, 'geo' AS taxonomy, r_name AS name, {slug('r_name')} AS slug,
         'Region ' || r_name AS description, 0::BIGINT AS parent, 0::BIGINT AS count
  FROM region
  UNION ALL
  SELECT (n_nationkey + 100)::BIGINT, 'geo', n_name, {slug('n_name')}, 'Nation ' || n_name,
         (n_regionkey + 1)::BIGINT, (SELECT count(*) FROM customer c WHERE c.c_nationkey = n.n_nationkey)::BIGINT
  FROM nation n
  UNION ALL
  SELECT NULL::BIGINT, 'brand', p_brand, {slug('p_brand')}, 'brand ' || p_brand, 0, count(*)::BIGINT
  FROM part GROUP BY p_brand
  UNION ALL
  SELECT NULL::BIGINT, 'ptype', p_type, {slug('p_type')}, 'ptype ' || p_type, 0, count(*)::BIGINT
  FROM part GROUP BY p_type
)"""

V_COMMENTS = """
v_comments AS (
  SELECT (conv_id * 16777216 + turn + 1)::BIGINT AS comment_ID, (conv_id + 72057594037927936)::BIGINT AS comment_post_ID,
         CASE WHEN turn = 0 THEN 0 ELSE conv_id * 16777216 + turn END::BIGINT AS comment_parent,
         role AS comment_author, role || '@example.com' AS comment_author_email,
         'https://' || role || '.example.com' AS comment_author_url, role AS comment_type,
         text AS comment_content,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(conv_id::BIGINT) + to_minutes(turn::BIGINT) AS comment_date_gmt,
         CASE WHEN role = 'system' THEN '0' ELSE '1' END AS comment_approved,
         turn::BIGINT AS comment_karma,
         CASE WHEN role = 'user' THEN conv_id ELSE 0 END::BIGINT AS user_id
  FROM conversations
)"""

V_QUERIES = f"""
v_queries AS (
  SELECT item_id AS query_id, array_to_string({tokens('text')}, ' ') AS query FROM benchmark
)"""


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(v.strip() for v in views)
