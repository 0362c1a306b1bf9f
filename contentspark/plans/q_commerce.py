"""Queries for commerce operators (COM-1..8)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from contentspark.functions.meta import typed_value
from contentspark.operators import commerce as CO
from contentspark.operators import documents as DOC
from contentspark.operators import predicates as P
from contentspark.operators.terms import text_match_all
from contentspark.plans.registry import query
from contentspark.plans.sqlviews import V_POSTS, tokens, with_views
from contentspark.sources import views as V
from contentspark.sources.tables import Tables


def shop_products(spark, sf):
    """Products with sales aggregates, stock status meta and visibility terms (derived from size)."""
    t = Tables(spark, sf)
    posts = V.v_posts(spark, sf, types=["product"]).filter(P.post_filter({"post_type": "product"}))
    lines = t.lineitem.select(F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("quantity"),
                              (F.col("l_quantity") / 10).alias("rating"))
    out = CO.with_sales(posts, lines)
    size = F.col("menu_order")
    stock = F.when(size <= 2, F.lit("outofstock")).otherwise(F.lit("instock"))
    vis = F.when(size >= 49, F.array(V.flat_term("product_visibility", F.lit("exclude-from-search")))) \
        .when(size <= 2, F.array(V.flat_term("product_visibility", F.lit("outofstock"))))
    terms = F.when(vis.isNotNull(), F.map_concat("terms", F.create_map(F.lit("product_visibility"), vis))) \
        .otherwise(F.col("terms"))
    meta = F.map_concat("meta", F.create_map(F.lit("_stock_status"), F.array(typed_value(stock))))
    return out.withColumn("terms", terms).withColumn("meta", meta)


def ranked(df, cols, k):
    top = df.orderBy(*cols).limit(k)
    return top.select("id", F.row_number().over(Window.orderBy(*cols)).alias("pos"))


SALES_SQL = """
WITH s AS (SELECT l_partkey, sum(l_quantity) AS total_sales, avg(l_quantity / 10) AS rating FROM lineitem GROUP BY 1),
pp AS (SELECT p.*, coalesce(s.total_sales, 0) AS total_sales, s.rating,
              TIMESTAMP '2023-01-01 00:00:00' + to_hours(p.p_partkey::BIGINT) AS post_date
       FROM part p LEFT JOIN s ON s.l_partkey = p.p_partkey)
"""


@query("com1_price_filter", "SELECT p_partkey AS id FROM part WHERE p_retailprice BETWEEN 930 AND 960")
def com1_price_filter(spark, sf):
    return shop_products(spark, sf).filter(CO.price_filter(930, 960)).select("id")


@query("com2_popularity_sort", SALES_SQL + """
SELECT p_partkey AS id, row_number() OVER (ORDER BY total_sales::BIGINT DESC, post_date DESC, p_partkey) AS pos
FROM pp ORDER BY pos LIMIT 10""")
def com2_popularity_sort(spark, sf):
    return ranked(shop_products(spark, sf), CO.product_sort("popularity"), 10)


@query("com2_price_desc_sort", SALES_SQL + """
SELECT p_partkey AS id, row_number() OVER (ORDER BY p_retailprice DESC, post_date DESC, p_partkey) AS pos
FROM pp ORDER BY pos LIMIT 10""")
def com2_price_desc_sort(spark, sf):
    return ranked(shop_products(spark, sf), CO.product_sort("price-desc"), 10)


@query("com3_top_rated", SALES_SQL + """
SELECT p_partkey AS id, row_number() OVER (ORDER BY rating DESC NULLS LAST, post_date DESC, p_partkey) AS pos
FROM pp ORDER BY pos LIMIT 10""")
def com3_top_rated(spark, sf):
    return ranked(shop_products(spark, sf), CO.product_sort("rating"), 10)


@query("com4_product_taxonomy_args", "SELECT p_partkey AS id FROM part WHERE p_brand = 'Brand#3' AND p_type = 'SMALL'")
def com4_product_taxonomy_args(spark, sf):
    f = CO.product_tax_filter({"product_cat": "brand-3", "product_type": "SMALL"})
    return shop_products(spark, sf).filter(f).select("id")


@query("com5_visibility_exclusion", """
SELECT p_partkey AS id FROM part WHERE p_size < 49
UNION ALL SELECT p_partkey FROM part WHERE p_size < 49 AND p_size > 2""")
def com5_visibility_exclusion(spark, sf):
    """Hide exclude-from-search products; the second set also hides out-of-stock ones."""
    df = shop_products(spark, sf)
    a = df.filter(CO.visibility_exclusion(False)).select("id")
    b = df.filter(CO.visibility_exclusion(True)).select("id")
    return a.unionByName(b)


@query("com6_product_list_filters", f"""
SELECT p_partkey AS id FROM part
WHERE p_size > 2 AND list_has_all(list_concat({tokens('p_name')}, {tokens("'SKU-' || p_partkey::VARCHAR")}),
                                  ['small'])""")
def com6_product_list_filters(spark, sf):
    """In-stock products matching 'small' in title, content or SKU."""
    df = shop_products(spark, sf).withColumn("sku", F.col("meta")["_sku"][0]["raw"])
    f = CO.product_list_filter(stock_status=["instock"])
    return df.filter(f & text_match_all(["post_title", "post_content", "post_excerpt", "sku"], "small")).select("id")


@query("com6_variation_skus", f"""
WITH p AS (SELECT *, 'SKU-' || p_partkey::VARCHAR AS sku, min(p_partkey) OVER (PARTITION BY p_brand) AS parent FROM part),
bag AS (SELECT parent AS id, unnest({tokens('sku')}) AS t FROM p WHERE p_partkey <> parent
        UNION ALL SELECT p_partkey, unnest({tokens("p_name || ' ' || sku")}) FROM p WHERE p_partkey = parent)
SELECT id FROM bag WHERE t IN ('sku', '77') GROUP BY id HAVING count(DISTINCT t) = 2""")
def com6_variation_skus(spark, sf):
    """Parent products (a brand's first) matching 'SKU 77' in title, own SKU or a variation's SKU."""
    p = Tables(spark, sf).part.withColumn("sku", F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")))
    parents = p.groupBy("p_brand").agg(F.min("p_partkey").alias("parent"))
    p = p.join(parents, "p_brand")
    variations = DOC.variation_skus(p, "parent", "sku", "p_partkey").select(
        F.col("parent_id").alias("id"), F.col("variation_sku").alias("text"))
    own = p.filter(F.col("p_partkey") == F.col("parent")).select(F.col("p_partkey").alias("id"), "p_name", "sku")
    return CO.search_with_children(own, "id", ["p_name", "sku"], variations, "SKU 77").select("id")


@query("com7_order_items", f"""
WITH bag AS (
  SELECT o.o_orderkey AS id, unnest({tokens("coalesce(c.c_name, '') || ' ' || coalesce(c.c_mktsegment, '')")}) AS t
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  UNION ALL SELECT l.l_orderkey, unnest({tokens('p.p_name')}) FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey)
SELECT id FROM bag WHERE id IN (SELECT o_orderkey FROM orders) AND t IN ('machinery', 'widget')
GROUP BY id HAVING count(DISTINCT t) = 2""")
def com7_order_items(spark, sf):
    """Orders matching 'machinery widget' over customer fields and item names."""
    t = Tables(spark, sf)
    o = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"), "o_custkey", "left")
    items = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey").select(
        F.col("l_orderkey").alias("id"), F.col("p_name").alias("text"))
    return CO.search_with_children(o.withColumnRenamed("o_orderkey", "id"), "id", ["c_name", "c_mktsegment"], items,
                                   "machinery widget").select("id")


@query("com7_order_search", f"""
WITH o AS (SELECT o.o_orderkey, c.c_name, c.c_mktsegment, o.o_orderpriority FROM orders o
           LEFT JOIN customer c ON c.c_custkey = o.o_custkey)
SELECT 'machinery' AS q, o_orderkey FROM o
WHERE list_contains(list_concat({tokens('c_name')}, {tokens('c_mktsegment')}, {tokens('o_orderpriority')}), 'machinery')
UNION ALL
SELECT '42', o_orderkey FROM o WHERE o_orderkey = 42
   OR list_contains(list_concat({tokens('c_name')}, {tokens('c_mktsegment')}, {tokens('o_orderpriority')}), '42')""")
def com7_order_search(spark, sf):
    """Order search over customer and order fields; numeric text also matches the order id."""
    t = Tables(spark, sf)
    o = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"),
                      "o_custkey", "left")
    fields = ["c_name", "c_mktsegment", "o_orderpriority"]
    a = o.filter(CO.order_search_filter("machinery", fields, "o_orderkey")).select(F.lit("machinery").alias("q"),
                                                                                    "o_orderkey")
    b = o.filter(CO.order_search_filter("42", fields, "o_orderkey")).select(F.lit("42").alias("q"), "o_orderkey")
    return a.unionByName(b)


@query("com8_password_exception", with_views(V_POSTS) + """
SELECT id FROM v_posts WHERE post_password = '' OR post_type = 'shop_order'""")
def com8_password_exception(spark, sf):
    return V.v_posts(spark, sf).filter(CO.password_exception()).select("id")
