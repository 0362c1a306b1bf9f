"""Queries for document building (DOC-1..21) and sinks (SNK-2..5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from contentspark.functions import dates as D
from contentspark.operators import documents as DOC
from contentspark.operators import hierarchy as H
from contentspark.plans.registry import query
from contentspark.plans.sqlviews import V_COMMENTS, V_POSTS, V_TERMS, slug, strip_html, tokens, with_views
from contentspark.sources import views as V
from contentspark.sources.tables import Tables

ITEMS_SQL = """
items AS (
  SELECT l.l_orderkey AS o_orderkey,
         string_agg(coalesce(p.p_name, ''), '|' ORDER BY l.l_linenumber, coalesce(p.p_name, '')) AS items,
         count(*)::BIGINT AS n_items
  FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey GROUP BY l.l_orderkey
)"""


@query("doc1_order_document", f"""
WITH {ITEMS_SQL},
geo AS (SELECT n.n_nationkey, {slug('n.n_name')} || ',' || {slug('r.r_name')} AS geo
        FROM nation n LEFT JOIN region r ON r.r_regionkey = n.n_regionkey)
SELECT o.o_orderkey AS id, coalesce(c.c_name, '') AS author_display, coalesce(i.n_items, 0) AS n_items,
       coalesce(i.items, '') AS items, g.geo AS geo, year(o.o_orderdate) AS year
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN items i ON i.o_orderkey = o.o_orderkey
LEFT JOIN geo g ON g.n_nationkey = c.c_nationkey""")
def doc1_order_document(spark, sf):
    """Nested order documents, checked on a flattened projection."""
    t = Tables(spark, sf)
    d = DOC.order_document(t.orders, t.customer, t.nation, t.region, t.lineitem, t.part)
    return d.select("id", F.col("post_author.display_name").alias("author_display"), "n_items",
                    F.col("meta")["_items"][0]["raw"].alias("items"),
                    F.array_join(F.transform(F.col("terms")["geo"], lambda x: x["slug"]), ",").alias("geo"),
                    F.col("date_terms.year").alias("year"))


@query("doc1_post_document", with_views(V_POSTS) + f''',
img AS (SELECT page_id, nullif(regexp_extract(regexp_extract(html, '(?is)<img\\b[^>]*>'), '(?is)\\bsrc\\s*=\\s*"([^"]*)"', 1), '') AS src
        FROM pages),
tags AS (SELECT id, unnest(list_distinct({tokens('post_title')})) AS t FROM v_posts WHERE post_type = 'product'),
terms AS (
  SELECT id, 'brand:' || {slug('brand')} AS term FROM v_posts WHERE brand IS NOT NULL
  UNION ALL SELECT id, 'ptype:' || {slug('ptype')} FROM v_posts WHERE ptype IS NOT NULL
  UNION ALL SELECT id, 'post_tag:' || {slug('t')} FROM tags
  UNION ALL SELECT id, 'lang:' || {slug('lang')} FROM v_posts WHERE lang IS NOT NULL
  UNION ALL SELECT id, 'source:' || {slug('source')} FROM v_posts WHERE source IS NOT NULL)
SELECT p.id, p.post_type, '' AS author_display, year(p.post_date) AS year,
       coalesce((SELECT string_agg(term, ',' ORDER BY term) FROM terms t WHERE t.id = p.id), '') AS terms,
       CASE WHEN post_type = 'product' THEN '_price,_sku,label,size'
            WHEN post_type = 'post' THEN concat_ws(',', 'n_chars', CASE WHEN quality IS NOT NULL THEN 'quality,toxic' END)
            ELSE '' END AS meta_keys, img.src AS thumbnail
FROM v_posts p LEFT JOIN img ON p.post_type = 'page' AND img.page_id = p.id - {V.PAGE_ID_OFFSET}
WHERE post_type IN ('product', 'post', 'page')''')
def doc1_post_document(spark, sf):
    """Documents of products, posts and pages: author, date parts, typed meta, terms, thumbnail."""
    posts = V.v_posts(spark, sf, types=["product", "post", "page"])
    images = Tables(spark, sf).pages.select((F.col("page_id") + V.PAGE_ID_OFFSET).alias("id"),
                                            DOC.thumbnail(F.col("html")).alias("thumbnail"))
    d = DOC.post_document(posts, images)
    terms = F.flatten(F.transform(F.map_entries("terms"), lambda e: F.transform(
        e["value"], lambda t: F.concat_ws(":", e["key"], t["slug"]))))
    return d.select("id", "post_type", F.col("post_author.display_name").alias("author_display"),
                    F.col("date_terms.year").alias("year"), F.array_join(F.array_sort(terms), ",").alias("terms"),
                    F.array_join(F.array_sort(F.map_keys("meta")), ",").alias("meta_keys"),
                    F.col("thumbnail.src").alias("thumbnail"))


@query("doc2_invalid_dates", """
SELECT o_orderkey, try_strptime(printf('%04d-%02d-%02d', year(o_orderdate), month(o_orderdate),
                                       dayofmonth(o_orderdate) + 2), '%Y-%m-%d') AS cleaned
FROM orders""")
def doc2_invalid_dates(spark, sf):
    """Dates written as text (day + 2, so some are not real dates) cleaned to timestamps or NULL."""
    o = Tables(spark, sf).orders
    d = F.col("o_orderdate")
    txt = F.format_string("%04d-%02d-%02d", F.year(d), F.month(d), F.dayofmonth(d) + 2)
    return o.select("o_orderkey", D.clean_date(txt).alias("cleaned"))


@query("doc3_date_parts", """
SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, weekofyear(o_orderdate) AS week,
       dayofyear(o_orderdate) - 1 AS dayofyear, dayofmonth(o_orderdate) AS day, dayofweek(o_orderdate) AS dayofweek,
       isodow(o_orderdate) AS dayofweek_iso, hour(o_orderdate) AS hour, minute(o_orderdate) AS minute,
       second(o_orderdate) AS second, year(o_orderdate) * 100 + month(o_orderdate) AS m
FROM orders""")
def doc3_date_parts(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", D.date_terms(F.col("o_orderdate")).alias("d")).select("o_orderkey", "d.*")


@query("doc4_term_ancestors", with_views(V_TERMS) + """
SELECT c.c_custkey AS object_id, string_agg(t.slug, ',' ORDER BY t.slug) AS terms
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN v_terms t ON t.taxonomy = 'geo' AND t.term_id IN (c.c_nationkey + 100, n.n_regionkey + 1)
GROUP BY c.c_custkey""")
def doc4_term_ancestors(spark, sf):
    """Each customer's nation term plus every ancestor term once."""
    terms = V.v_terms(spark, sf).filter(F.col("taxonomy") == "geo")
    rel = V.v_term_relationships(spark, sf).filter(F.col("object_type") == "customer")
    assigned = rel.select("object_id", F.col("term_taxonomy_id").alias("term_id"))
    allt = DOC.with_ancestor_terms(assigned, H.closure(terms), terms.select("term_id", "slug"))
    return allt.groupBy("object_id").agg(F.array_join(F.array_sort(F.collect_list("slug")), ",").alias("terms"))


@query("doc5_term_facet_json", f"""
SELECT n_nationkey, to_json({{'term_id': n_nationkey + 100, 'slug': {slug('n_name')}, 'name': n_name,
  'parent': n_regionkey + 1, 'term_taxonomy_id': n_nationkey + 100, 'term_order': 0}})::VARCHAR AS facet FROM nation""")
def doc5_term_facet_json(spark, sf):
    from contentspark.functions.text import slug as sl

    n = Tables(spark, sf).nation
    t = V.term_struct(F.col("n_nationkey") + 100, sl(F.col("n_name")), F.col("n_name"), F.col("n_regionkey") + 1)
    return n.select("n_nationkey", t["facet"].alias("facet"))


@query("doc6_term_order", """
SELECT c_custkey AS object_id, (c_nationkey + 100)::BIGINT AS term_taxonomy_id,
       CASE WHEN c_acctbal >= 0 THEN c_custkey % 4 ELSE 0 END AS term_order FROM customer""")
def doc6_term_order(spark, sf):
    """Every customer's term with its place; relationships of customers in debt are missing, so their place is 0."""
    rel = V.v_term_relationships(spark, sf)
    assigned = rel.filter(F.col("object_type") == "customer").select("object_id", "term_taxonomy_id")
    known = Tables(spark, sf).customer.filter(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("object_id"))
    ordered = rel.filter(F.col("object_type") == "customer").join(known, "object_id", "left_semi")
    return DOC.term_order(assigned, ordered).select(
        "object_id", "term_taxonomy_id", "term_order")


@query("doc7_meta_typing", """
WITH e AS (SELECT event_id, json_extract_string(props, '$.k') AS v FROM events)
SELECT event_id, v AS raw, trunc(v::DOUBLE)::BIGINT AS long, v::DOUBLE AS double,
       lower(trim(v)) IN ('1', 'true', 'on', 'yes') AS boolean FROM e""")
def doc7_meta_typing(spark, sf):
    """props JSON {'k': n} -> typed meta readings of k."""
    e = Tables(spark, sf).events
    m = DOC.meta_from_json(F.col("props"))
    k = m["k"][0]
    return e.select("event_id", k["raw"].alias("raw"), k["long"].alias("long"), k["double"].alias("double"),
                    k["boolean"].alias("boolean"))


@query("doc8_meta_allow_auto", """
SELECT p_partkey AS id, '_price,size' AS keys FROM part""")
def doc8_meta_allow_auto(spark, sf):
    """Auto mode: public keys (size, label) minus excluded (label); '_price' allow-listed; '_sku' dropped."""
    p = V.v_posts(spark, sf, types=["product"])
    m = DOC.meta_allow_auto(F.col("meta"), exclude=["label"], allow_protected=["_price"])
    return p.select("id", F.array_join(F.array_sort(F.map_keys(m)), ",").alias("keys"))


@query("doc9_meta_allow_manual", with_views(V_POSTS) + """
SELECT id, CASE WHEN post_type = 'product' THEN '_sku,label' ELSE '' END AS keys FROM v_posts
WHERE post_type IN ('product', 'post')""")
def doc9_meta_allow_manual(spark, sf):
    """Manual mode: keys weighted in the search fields (meta.label.value) plus allowed '_sku'."""
    p = V.v_posts(spark, sf, types=["product", "post"])
    m = DOC.meta_allow_manual(F.col("meta"), ["label"], allow_protected=["_sku"])
    return p.select("id", F.array_join(F.array_sort(F.map_keys(m)), ",").alias("keys"))


@query("doc10_drop_empty_keys", """
SELECT event_id, 'k' AS keys FROM events""")
def doc10_drop_empty_keys(spark, sf):
    """props JSON with an extra empty key: the empty key is dropped."""
    e = Tables(spark, sf).events
    js = F.regexp_replace(F.col("props"), r"^\{", '{"": "x", ')
    return e.select("event_id", F.array_join(F.array_sort(F.map_keys(DOC.meta_from_json(js))), ",").alias("keys"))


THUMBNAIL_SQL = """
WITH i AS (SELECT page_id, regexp_extract(html, '(?is)<img\\b[^>]*>') AS img FROM pages)
SELECT page_id, nullif(regexp_extract(img, '(?is)\\bsrc\\s*=\\s*"([^"]*)"', 1), '') AS src,
       TRY_CAST(regexp_extract(img, '(?is)\\bwidth\\s*=\\s*"([^"]*)"', 1) AS INTEGER) AS width,
       TRY_CAST(regexp_extract(img, '(?is)\\bheight\\s*=\\s*"([^"]*)"', 1) AS INTEGER) AS height,
       CASE WHEN img <> '' THEN trim(regexp_extract(img, '(?is)\\balt\\s*=\\s*"([^"]*)"', 1)) END AS alt
FROM i"""


@query("doc11_thumbnail", THUMBNAIL_SQL)
def doc11_thumbnail(spark, sf):
    """First image of each page: source, size, alternative text (NULL when the page has none)."""
    pg = Tables(spark, sf).pages
    return pg.select("page_id", DOC.thumbnail(F.col("html")).alias("t")).select("page_id", "t.*")


@query("doc12_plain_text", f"SELECT page_id, {strip_html('html')} AS plain FROM pages")
def doc12_plain_text(spark, sf):
    pg = Tables(spark, sf).pages
    return pg.select("page_id", DOC.plain_text(F.col("html")).alias("plain"))


@query("doc13_suggest_terms", f"""
SELECT p_partkey AS id, array_to_string(list_sort(list_concat([p_brand, p_type], list_distinct({tokens('p_name')}))),
       '|') AS term_suggest FROM part""")
def doc13_suggest_terms(spark, sf):
    p = V.v_posts(spark, sf, types=["product"])
    return p.select("id", F.array_join(F.array_sort(DOC.suggest_terms(F.col("terms"))), "|").alias("term_suggest"))


@query("doc14_redact_protected", with_views(V_POSTS) + """
SELECT id, CASE WHEN post_password <> '' THEN 0 ELSE length(post_content) END AS content_len,
       CASE WHEN post_password <> '' THEN 0 ELSE 1 + (quality IS NOT NULL)::INT + (toxic IS NOT NULL)::INT END
         AS n_meta
FROM v_posts WHERE post_type = 'post'""")
def doc14_redact_protected(spark, sf):
    """toxic=1 documents (passworded) lose content and meta."""
    p = DOC.redact_protected(V.v_posts(spark, sf, types=["post"]))
    from contentspark.functions.meta import live_meta

    return p.select("id", F.length("post_content").alias("content_len"), F.size(live_meta(F.col("meta"))).alias("n_meta"))


@query("doc15_term_document", with_views(V_TERMS) + """
SELECT term_id, (parent <> 0)::INT AS n_ancestors,
       CASE WHEN parent = 0 THEN (SELECT count(*) FROM nation n WHERE n.n_regionkey + 1 = t.term_id) ELSE 0 END
         AS n_descendants,
       CASE WHEN parent = 0 THEN 0 ELSE count END AS n_objects
FROM v_terms t WHERE taxonomy = 'geo'""")
def doc15_term_document(spark, sf):
    terms = V.v_terms(spark, sf).filter(F.col("taxonomy") == "geo")
    rel = V.v_term_relationships(spark, sf).filter(F.col("object_type") == "customer")
    d = DOC.term_document(terms, H.with_hierarchy(terms), rel)
    return d.select("term_id", F.size("ancestors").alias("n_ancestors"), "n_descendants", "n_objects")


@query("doc16_term_objects", "SELECT (c_nationkey + 100)::BIGINT AS term_taxonomy_id, c_custkey AS object_id FROM customer")
def doc16_term_objects(spark, sf):
    rel = V.v_term_relationships(spark, sf).filter(F.col("object_type") == "customer")
    return DOC.term_objects(rel)


@query("doc17_comment_document", with_views(V_POSTS, V_COMMENTS) + """
SELECT c.comment_ID, p.post_author AS comment_post_author_ID, p.post_status AS comment_post_status,
       p.post_type AS comment_post_type, coalesce(nullif(c.comment_type, ''), 'comment') AS comment_type
FROM v_comments c LEFT JOIN v_posts p ON p.id = c.comment_post_ID""")
def doc17_comment_document(spark, sf):
    d = DOC.comment_document(V.v_comments(spark, sf), V.v_posts(spark, sf, types=["post"]))
    return d.select("comment_ID", "comment_post_author_ID", "comment_post_status", "comment_post_type",
                    "comment_type")


@query("doc19_order_items", f"WITH {ITEMS_SQL} SELECT o_orderkey, items, n_items FROM items")
def doc19_order_items(spark, sf):
    t = Tables(spark, sf)
    return DOC.order_items(t.lineitem, t.part)


@query("doc20_variation_skus", """
WITH p AS (SELECT p_partkey, p_brand, min(p_partkey) OVER (PARTITION BY p_brand) AS parent FROM part)
SELECT parent AS parent_id, 'SKU-' || p_partkey::VARCHAR AS variation_sku FROM p WHERE p_partkey <> parent""")
def doc20_variation_skus(spark, sf):
    """Products of a brand are variations of the brand's first product."""
    p = Tables(spark, sf).part
    parent = p.groupBy("p_brand").agg(F.min("p_partkey").alias("parent"))
    prods = p.join(parent, "p_brand").select("p_partkey", "parent",
                                             F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"))
    return DOC.variation_skus(prods, "parent", "sku", "p_partkey")


@query("doc21_order_suggest_terms", """
SELECT o.o_orderkey, o.o_orderkey::VARCHAR AS order_number,
       array_to_string(list_filter(['customer' || c.c_custkey::VARCHAR || '@example.com', c.c_mktsegment, c.c_name],
                                   lambda x: x IS NOT NULL AND x <> ''), '|') AS terms
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey""")
def doc21_order_suggest_terms(spark, sf):
    t = Tables(spark, sf)
    d = DOC.order_suggest_terms(t.orders, t.customer)
    return d.select("o_orderkey", "order_number", F.array_join("term_suggest", "|").alias("terms"))


@query("snk2_get_by_ids", """
SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def snk2_get_by_ids(spark, sf):
    t = Tables(spark, sf)
    return DOC.get_by_ids(t.documents, t.labels.filter("toxic = 1"), "doc_id").select("doc_id", "n_chars")


@query("snk3_delete_by_ids", """
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)""")
def snk3_delete_by_ids(spark, sf):
    t = Tables(spark, sf)
    return DOC.delete_by_ids(t.documents, t.labels.filter("quality = 0"), "doc_id").select("doc_id")


@query("snk4_json_documents", """
SELECT doc_id AS id, to_json(struct_pack(doc_id := doc_id, lang := lang, source := source, n_chars := n_chars)) AS document
FROM documents""")
def snk4_json_documents(spark, sf):
    """One JSON text per document, as the JSON-lines sink writes it."""
    d = Tables(spark, sf).documents
    return DOC.json_documents(d.select("doc_id", "lang", "source", "n_chars"), "doc_id")


@query("snk5_oversize_routing", "SELECT doc_id, n_chars, n_chars > 20000 AS oversize FROM documents")
def snk5_oversize_routing(spark, sf):
    """Documents above a size limit are marked for a sink of their own; no batch is simulated."""
    d = Tables(spark, sf).documents.select("doc_id", "n_chars")
    return DOC.route_oversize(d, F.col("n_chars"), 20000)
