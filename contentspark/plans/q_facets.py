"""Queries for aggregations and facets (AGG-1..20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from contentspark.operators import facet_index as FI
from contentspark.operators import facets as G
from contentspark.operators import predicates as P
from contentspark.plans.registry import query
from contentspark.plans.sqlviews import V_POSTS, V_TERMS, slug, tokens, with_views
from contentspark.sources import views as V
from contentspark.sources.tables import Tables


def products(spark, sf):
    return V.v_posts(spark, sf, types=["product"], lists=True).filter(P.post_filter({"post_type": "product"}))


def term_slugs(tax: str):
    """The slugs of a taxonomy's terms, from the view's list of them: no term struct is built."""
    return F.col("term_slugs")[tax]


def meta_raw(key: str):
    return F.transform(F.col("meta")[key], lambda x: x["raw"])


def price_between(lo, hi):
    return P.meta_clause({"key": "_price", "value": [lo, hi], "compare": "BETWEEN"})


FACETS_SQL = f"""
WITH pf AS (
  SELECT p_partkey AS id, {slug('p_brand')} AS brand, {slug('p_type')} AS ptype, p_size::VARCHAR AS size,
         p_retailprice AS price, list_distinct({tokens('p_name')}) AS tags
  FROM part
)"""


@query("agg1_named_terms", FACETS_SQL + """
SELECT facet, value, count(*)::BIGINT AS doc_count FROM (
  SELECT 'brand' AS facet, brand AS value FROM pf UNION ALL SELECT 'ptype', ptype FROM pf
) GROUP BY facet, value""")
def agg1_named_terms(spark, sf):
    """Two named terms aggregations computed in one scan."""
    return G.facet_counts(products(spark, sf), {"brand": term_slugs("brand"), "ptype": term_slugs("ptype")})


@query("agg1_min_max", "SELECT min(p_retailprice) AS min_value, max(p_retailprice) AS max_value FROM part")
def agg1_min_max(spark, sf):
    return G.min_max(products(spark, sf), F.array_min(F.transform(F.col("meta")["_price"], lambda x: x["double"])))


@query("agg2_filtered_aggregation", FACETS_SQL + """
SELECT 'brand' AS facet, brand AS value, count(*)::BIGINT AS doc_count FROM pf WHERE price > 950 GROUP BY brand""")
def agg2_filtered_aggregation(spark, sf):
    """use-filter: the aggregation sees the filter (count_if in the same scan)."""
    flag = P.meta_clause({"key": "_price", "value": 950, "compare": ">"})
    return G.facet_counts(products(spark, sf), {"brand": term_slugs("brand")}, flags={"brand": flag})


@query("agg3_distinct_values", """
SELECT event_type AS key, count(*)::BIGINT AS doc_count FROM events GROUP BY event_type""")
def agg3_distinct_values(spark, sf):
    ev = Tables(spark, sf).events
    return G.distinct_values(ev, F.array(F.col("event_type")))


@query("agg4_meta_map_keys", """
SELECT unnest(['_price', 'size', '_sku', 'label', 'quality', 'toxic', 'n_chars', '_total', '_priority']) AS key""")
def agg4_meta_map_keys(spark, sf):
    """Distinct keys of the meta map over all object families."""
    return G.distinct_map_keys(V.v_posts(spark, sf, lists=True))


@query("agg5_meta_keys_sorted", """
SELECT key FROM (SELECT unnest(['_price', 'size', 'label', 'quality', 'toxic', 'n_chars']) AS key)
ORDER BY key""")
def agg5_meta_keys_sorted(spark, sf):
    return G.distinct_meta_keys(V.v_posts(spark, sf, lists=True), allow=["_price"])


@query("agg6_meta_keys_per_type", with_views(V_POSTS) + """
SELECT post_type AS type, key, count(*)::BIGINT AS n_objects FROM (
  SELECT post_type, 'size' AS key FROM v_posts WHERE post_type = 'product'
  UNION ALL SELECT post_type, 'label' FROM v_posts WHERE post_type = 'product'
  UNION ALL SELECT post_type, 'quality' FROM v_posts WHERE quality IS NOT NULL
  UNION ALL SELECT post_type, 'toxic' FROM v_posts WHERE toxic IS NOT NULL
  UNION ALL SELECT post_type, 'n_chars' FROM v_posts WHERE post_type = 'post'
) GROUP BY post_type, key""")
def agg6_meta_keys_per_type(spark, sf):
    return G.meta_keys_per_type(V.v_posts(spark, sf, lists=True))


@query("agg7_taxonomy_facet", FACETS_SQL + """
SELECT facet, value, doc_count FROM (
  SELECT facet, value, count(*)::BIGINT AS doc_count
  FROM (SELECT 'brand' AS facet, brand AS value FROM pf UNION ALL SELECT 'ptype', ptype FROM pf
        UNION ALL SELECT 'post_tag', unnest(tags) FROM pf)
  GROUP BY facet, value)""")
def agg7_taxonomy_facet(spark, sf):
    return G.facet_counts(products(spark, sf), {t: term_slugs(t) for t in ("brand", "ptype", "post_tag")})


@query("agg8_meta_facet", FACETS_SQL + """
SELECT facet, value, doc_count, substr(value, 1, 100) AS label FROM (
  SELECT 'size' AS facet, size AS value, count(*)::BIGINT AS doc_count
  FROM pf GROUP BY size)""")
def agg8_meta_facet(spark, sf):
    counts = G.facet_counts(products(spark, sf), {"size": meta_raw("size")})
    return G.meta_facet_display(counts)


@query("agg9_meta_range", FACETS_SQL + """
SELECT min(price) AS min_value, max(price) AS max_value FROM pf WHERE ptype = 'small'""")
def agg9_meta_range(spark, sf):
    """min/max of price under the other filters (ptype) but not the range's own selection."""
    df = products(spark, sf)
    other = P.tax_clause({"taxonomy": "ptype", "field": "slug", "terms": ["small"]})
    price = F.array_min(F.transform(F.col("meta")["_price"], lambda x: x["double"]))
    return G.min_max(df, price, flag=other)


@query("agg10_post_type_facet", with_views(V_POSTS) + """
SELECT 'post_type' AS facet, post_type AS value, count(*)::BIGINT AS doc_count FROM v_posts
WHERE post_status = 'publish' GROUP BY post_type""")
def agg10_post_type_facet(spark, sf):
    posts = V.v_posts(spark, sf).filter(F.col("post_status") == "publish")
    return G.facet_counts(posts, {"post_type": F.array(F.col("post_type"))})


@query("agg11_date_facet_filter", with_views(V_POSTS) + """
SELECT id FROM v_posts WHERE post_type = 'shop_order'
  AND post_date BETWEEN TIMESTAMP '1999-01-01 00:00:00' AND TIMESTAMP '1999-03-31 23:59:59'""")
def agg11_date_facet_filter(spark, sf):
    import datetime as dt

    from contentspark.functions.dates import relative_range

    s, e = relative_range("custom", dt.datetime(2001, 1, 1), start="1999-01-01", end="1999-03-31")
    dq = [{"after": s.isoformat(sep=" "), "before": e.isoformat(sep=" "), "inclusive": True}]
    return V.v_posts(spark, sf, types=["shop_order"]).filter(
        P.post_filter({"post_type": "shop_order", "date_query": dq})).select("id")


SEL = {"brand": ["brand-2", "brand-3"], "post_tag": ["bolt"]}


def facet_index(spark, sf):
    """Bitmaps of the products' facets, with their prices beside the document numbers."""
    fv = {"brand": term_slugs("brand"), "post_tag": term_slugs("post_tag"), "ptype": term_slugs("ptype")}
    prices = F.transform(F.col("meta")["_price"], lambda x: x["double"])
    return FI.cached_facets("products:brand,post_tag,ptype;prices", products(spark, sf), "id", fv, {"prices": prices})


@query("agg12_match_all_bitmaps", FACETS_SQL + "SELECT id FROM pf WHERE brand = 'brand-2' AND list_contains(tags, 'bolt')")
def agg12_match_all_bitmaps(spark, sf):
    """'all' from the bitmaps: an AND of the selected values' words."""
    index = facet_index(spark, sf)
    return index.documents(index.mask_of_selection({"brand": ["brand-2"], "post_tag": ["bolt"]}, "all"))


@query("agg12_match_all", FACETS_SQL + """
SELECT id FROM pf WHERE brand = 'brand-2' AND brand = 'brand-3' AND list_contains(tags, 'bolt')
UNION ALL
SELECT id FROM pf WHERE brand = 'brand-2' AND list_contains(tags, 'bolt')""")
def agg12_match_all(spark, sf):
    """'all': every selected value must be present (two selections run as one union)."""
    df = products(spark, sf)
    fv = {"brand": term_slugs("brand"), "post_tag": term_slugs("post_tag")}
    a = df.filter(G.selection(fv, SEL, "all")).select("id")
    b = df.filter(G.selection(fv, {"brand": ["brand-2"], "post_tag": ["bolt"]}, "all")).select("id")
    return a.unionByName(b)


@query("agg13_match_any", FACETS_SQL + """
SELECT id FROM pf WHERE brand IN ('brand-2', 'brand-3') OR list_contains(tags, 'bolt')""")
def agg13_match_any(spark, sf):
    """'any' from the bitmaps: an OR of the selected values' words."""
    index = facet_index(spark, sf)
    return index.documents(index.mask_of_selection(SEL, "any"))


AGG14_SQL = FACETS_SQL + """
, flags AS (
  SELECT *, (list_contains(tags, 'bolt')) AS sel_tag, (brand IN ('brand-2', 'brand-3')) AS sel_brand,
         price > 920 AS base FROM pf
)
SELECT facet, value, doc_count FROM (
  SELECT 'brand' AS facet, brand AS value, count(*)::BIGINT AS doc_count FROM flags
  WHERE base AND sel_tag GROUP BY brand
  UNION ALL
  SELECT 'post_tag', t, count(*)::BIGINT FROM (SELECT unnest(tags) AS t, base, sel_brand FROM flags)
  WHERE base AND sel_brand GROUP BY t
  UNION ALL
  SELECT 'ptype', ptype, count(*)::BIGINT FROM flags WHERE base AND (sel_tag OR sel_brand) GROUP BY ptype
)"""


@query("agg14_counts_ignoring_selection", AGG14_SQL)
def agg14_counts_ignoring_selection(spark, sf):
    """'any': each facet counts under the other facets' selections and the base filter, from the bitmaps."""
    base = F.exists("prices", lambda x: x > 920)
    return facet_index(spark, sf).counts_ignoring_own(["brand", "post_tag", "ptype"], SEL, "any", base)


@query("agg14_counts_in_one_scan", AGG14_SQL)
def agg14_counts_in_one_scan(spark, sf):
    """The same counts without an index: flags on one scan of the documents."""
    names = ["brand", "post_tag", "ptype"]
    base = P.meta_clause({"key": "_price", "value": 920, "compare": ">"})
    df = products(spark, sf).select(base.alias("base"), *[term_slugs(t).alias(t) for t in names])  # computed once a row
    fv = {t: F.col(t) for t in names}
    return G.facet_counts(df, fv, flags=G.counting_flags(fv, SEL, "any", F.col("base")))


@query("agg15_drop_empty", FACETS_SQL + """
SELECT 'brand' AS facet, brand AS value, count(*)::BIGINT AS doc_count FROM pf WHERE size::INTEGER > 48 GROUP BY brand""")
def agg15_drop_empty(spark, sf):
    """Buckets whose filtered count is 0 are dropped."""
    flag = P.meta_clause({"key": "size", "value": 48, "compare": ">"})
    return G.facet_counts(products(spark, sf), {"brand": term_slugs("brand")}, flags={"brand": flag})


@query("agg16_bucket_order", FACETS_SQL + """
SELECT facet, value, doc_count,
       row_number() OVER (PARTITION BY facet ORDER BY value IN ('brand-9', 'brand-10') DESC, value DESC) AS pos
FROM (SELECT 'brand' AS facet, brand AS value, count(*)::BIGINT AS doc_count FROM pf GROUP BY brand)""")
def agg16_bucket_order(spark, sf):
    counts = G.facet_counts(products(spark, sf), {"brand": term_slugs("brand")})
    return G.order_buckets(counts, {"brand": ["brand-9", "brand-10"]}, by="name", order="desc")


@query("agg17_price_range", FACETS_SQL + """
SELECT count(*)::BIGINT AS n, min(price) AS min_value, max(price) AS max_value FROM pf
WHERE price BETWEEN 930 AND 960""")
def agg17_price_range(spark, sf):
    """Filter by a selected price range and report the range of what is left."""
    df = products(spark, sf).filter(price_between(930, 960))
    price = F.array_min(F.transform(F.col("meta")["_price"], lambda x: x["double"]))
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.min(price).alias("min_value"),
                  F.max(price).alias("max_value"))


@query("agg18_grouping_sets", """
SELECT CASE WHEN grouping(p_brand) = 0 THEN 'p_brand' WHEN grouping(p_type) = 0 THEN 'p_type' ELSE 'p_size' END
         AS facet,
       CASE WHEN grouping(p_brand) = 0 THEN p_brand WHEN grouping(p_type) = 0 THEN p_type
            ELSE p_size::VARCHAR END AS value,
       count(*)::BIGINT AS doc_count
FROM part GROUP BY GROUPING SETS ((p_brand), (p_type), (p_size))""")
def agg18_grouping_sets(spark, sf):
    return G.grouping_sets_counts(Tables(spark, sf).part, ["p_brand", "p_type", "p_size"])


@query("agg18_multi_facet", AGG14_SQL.replace("price > 920", "price > 0"))
def agg18_multi_facet(spark, sf):
    """Each facet as its own filtered aggregation in one request, from the bitmaps."""
    base = F.exists("prices", lambda x: x > 0)
    return facet_index(spark, sf).counts_ignoring_own(["brand", "post_tag", "ptype"], SEL, "any", base)


@query("agg19_term_sample", with_views(V_TERMS) + """
SELECT taxonomy, slug, row_number() OVER (PARTITION BY taxonomy ORDER BY name, slug) AS pos
FROM v_terms QUALIFY pos <= 20""")
def agg19_term_sample(spark, sf):
    terms = V.v_terms(spark, sf)
    return G.sample_per_group(terms, "taxonomy", [F.col("name"), F.col("slug")], 20).select("taxonomy", "slug", "pos")


@query("agg20_term_count_limit", with_views(V_TERMS) + """
SELECT taxonomy, max(count) AS max_value, max(count) > 350 AS over_limit FROM v_terms GROUP BY taxonomy""")
def agg20_term_count_limit(spark, sf):
    return G.over_limit(V.v_terms(spark, sf), "taxonomy", "count", 350)
