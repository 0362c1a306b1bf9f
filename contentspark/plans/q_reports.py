"""Queries for reports (OBS-1..8) and multi-site operations (SET-1..4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from contentspark.operators import facets as G
from contentspark.operators import reports as R
from contentspark.operators.terms import text_match_all
from contentspark.plans.registry import query
from contentspark.plans.sqlviews import V_POSTS, tokens, with_views
from contentspark.sources import views as V
from contentspark.sources.tables import Tables


def log_table(spark, sf):
    """The error-event log with a request type (by duration) and an engine message (by status)."""
    lg = V.v_log(spark, sf)
    k = F.get_json_object("body", "$.k")
    rtype = F.when(F.col("query_time") < 10, "delete").when(F.col("query_time") < 30, "bulk").otherwise("query")
    st = F.col("status_code")
    msg = (F.when(st == 404, F.concat(F.lit("no such index [site-"), F.col("user_id").cast("string"), F.lit("]")))
           .when(st < 450, F.concat(F.lit("No mapping found for [field_"), k, F.lit("] in order to sort on")))
           .when(st < 500, F.concat(F.lit("Limit of total fields [1000] in index [site-"),
                                    F.col("user_id").cast("string"), F.lit("] has been exceeded")))
           .when(st < 550, F.concat(F.lit("field [f"), k, F.lit("] is of type [text], but only numeric types are "
                                                                 "supported.")))
           .otherwise(F.lit("Not set")))
    return lg.withColumn("request_type", rtype).withColumn("message", msg)


LOG_SQL = """
WITH lg AS (
  SELECT event_id AS request_id, ts, value AS query_time, (400 + json_extract_string(props, '$.k')::BIGINT % 200)::INT
         AS status_code, props AS body, user_id, json_extract_string(props, '$.k') AS k
  FROM events WHERE event_type = 'error'
),
lt AS (
  SELECT *, CASE WHEN query_time < 10 THEN 'delete' WHEN query_time < 30 THEN 'bulk' ELSE 'query' END AS request_type,
         CASE WHEN status_code = 404 THEN 'no such index [site-' || user_id::VARCHAR || ']'
              WHEN status_code < 450 THEN 'No mapping found for [field_' || k || '] in order to sort on'
              WHEN status_code < 500 THEN 'Limit of total fields [1000] in index [site-' || user_id::VARCHAR
                                          || '] has been exceeded'
              WHEN status_code < 550 THEN 'field [f' || k || '] is of type [text], but only numeric types are supported.'
              ELSE 'Not set' END AS message
  FROM lg
)
"""


@query("obs1_failed_requests", LOG_SQL + """
SELECT request_id, request_type FROM lt WHERE request_type IN ('query', 'bulk') OR status_code <> 404""")
def obs1_failed_requests(spark, sf):
    return R.failed_requests(log_table(spark, sf)).select("request_id", "request_type")


@query("obs2_log_shaping", LOG_SQL + """
SELECT request_id, round(query_time * 1000)::BIGINT AS duration_ms,
       CASE WHEN length(body) > 204800 THEN substr(body, 1, 1000) ELSE body END AS body FROM lt""")
def obs2_log_shaping(spark, sf):
    return R.shape_log(log_table(spark, sf), R.MAX_BODY_BYTES).select("request_id", "duration_ms", "body")


@query("obs3_retention", LOG_SQL + """
SELECT request_id FROM lt WHERE ts > (SELECT max(ts) FROM lt) - INTERVAL 24 HOURS AND ts <= (SELECT max(ts) FROM lt)
ORDER BY ts DESC, request_id DESC LIMIT 5""")
def obs3_retention(spark, sf):
    """Last 24 h before the newest entry, newest 5, size cap 1 MB."""
    lg = log_table(spark, sf)
    as_of = lg.select(F.max("ts")).scalar()
    return R.retention(lg, as_of, 24, R.KEEP_LAST, R.MAX_LOG_BYTES).select("request_id")


@query("obs4_error_classes", LOG_SQL + """
SELECT CASE
  WHEN regexp_matches(message, '^no such index$') THEN 'no such index'
  WHEN regexp_matches(message, 'no such index \\[(.*?)\\]') THEN 'no such index [???]'
  WHEN regexp_matches(message, 'No mapping found for \\[(.*?)\\] in order to sort on')
    THEN 'No mapping found for [???] in order to sort on'
  WHEN regexp_matches(message, 'field \\[(.*?)\\] is of type \\[(.*?)\\], but only numeric types are supported.')
    THEN 'field [???] is of type [???], but only numeric types are supported.'
  WHEN regexp_matches(message, 'Limit of total fields \\[(.*?)\\]( in index \\[(.*?)\\])? has been exceeded')
    THEN 'Limit of total fields [???] in index [???] has been exceeded'
  ELSE message END AS error, count(*)::BIGINT AS n
FROM lt GROUP BY 1""")
def obs4_error_classes(spark, sf):
    lg = log_table(spark, sf)
    return lg.groupBy(R.classify_error(F.col("message")).alias("error")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("obs5_content_counts", """
SELECT c.c_nationkey AS site_id, 'shop_order' AS post_type, count_if(o.o_orderstatus IN ('O', 'F'))::BIGINT AS eligible,
       count(*)::BIGINT AS total
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY c.c_nationkey""")
def obs5_content_counts(spark, sf):
    """Orders per site (the customer's nation) and type: eligible statuses vs all."""
    t = Tables(spark, sf)
    posts = V.order_posts(t).join(t.customer.select(F.col("c_custkey").alias("post_author"),
                                                    F.col("c_nationkey").alias("site_id")), "post_author")
    return R.content_counts(posts, ["O", "F"])


@query("obs6_meta_key_counts", with_views(V_POSTS) + """,
pairs AS (
  SELECT post_type AS type, 'size' AS key FROM v_posts WHERE post_type = 'product'
  UNION ALL SELECT post_type, 'label' FROM v_posts WHERE post_type = 'product'
  UNION ALL SELECT post_type, 'quality' FROM v_posts WHERE quality IS NOT NULL
  UNION ALL SELECT post_type, 'toxic' FROM v_posts WHERE toxic IS NOT NULL
  UNION ALL SELECT post_type, 'n_chars' FROM v_posts WHERE post_type = 'post'
)
SELECT type, key, count(*)::BIGINT AS n_objects FROM pairs GROUP BY ALL
UNION ALL SELECT 'total', key, count(*)::BIGINT FROM pairs GROUP BY key""")
def obs6_meta_key_counts(spark, sf):
    return R.meta_key_counts(G.meta_keys_per_type(V.v_posts(spark, sf, lists=True)))


@query("obs7_missing_present", """
SELECT doc_id, 'missing' AS status FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'present' FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""")
def obs7_missing_present(spark, sf):
    t = Tables(spark, sf)
    return R.missing_present(t.documents, t.labels, "doc_id")


@query("obs8_index_totals", """
WITH g AS (SELECT source, count(*)::BIGINT AS docs, sum(n_chars)::BIGINT AS bytes FROM documents GROUP BY source)
SELECT source, docs, bytes,
       CASE WHEN bytes < 1024 THEN bytes::VARCHAR || ' B'
            WHEN bytes < 1048576 THEN format('{:,.2f}', bytes / 1024.0) || ' KB'
            WHEN bytes < 1073741824 THEN format('{:,.2f}', bytes / 1048576.0) || ' MB'
            ELSE format('{:,.2f}', bytes / 1073741824.0) || ' GB' END AS size
FROM g""")
def obs8_index_totals(spark, sf):
    return R.index_totals(Tables(spark, sf).documents, "source", "n_chars")


# ---------------------------------------------------------------- sites


def sites(spark, sf):
    """Sites = nations; sites of the MIDDLE EAST region are archived."""
    t = Tables(spark, sf)
    n = t.nation.join(t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey")
    return n.select(F.col("n_nationkey").alias("site_id"), F.lit(True).alias("indexable"),
                    F.lit(False).alias("deleted"), (F.col("r_name") == "MIDDLE EAST").alias("archived"),
                    F.lit(False).alias("spam"))


def customers_by_site(spark, sf):
    return Tables(spark, sf).customer.withColumnRenamed("c_nationkey", "site_id")


SITES_SQL = """
WITH s AS (SELECT n.n_nationkey AS site_id, r.r_name = 'MIDDLE EAST' AS archived FROM nation n
           JOIN region r ON r.r_regionkey = n.n_regionkey)
"""


@query("set1_site_union", SITES_SQL + """
SELECT 'all' AS scope, c_custkey FROM customer WHERE c_nationkey IN (SELECT site_id FROM s WHERE NOT archived)
UNION ALL SELECT 'in', c_custkey FROM customer WHERE c_nationkey IN (1, 2, 3)
UNION ALL SELECT 'current', c_custkey FROM customer WHERE c_nationkey = 5""")
def set1_site_union(spark, sf):
    c, s = customers_by_site(spark, sf), sites(spark, sf)
    a = R.site_scope(c, s, all_sites=True).select(F.lit("all").alias("scope"), "c_custkey")
    b = R.site_scope(c, s, site__in=[1, 2, 3]).select(F.lit("in").alias("scope"), "c_custkey")
    d = R.site_scope(c, s, current=5).select(F.lit("current").alias("scope"), "c_custkey")
    return a.unionByName(b).unionByName(d)


@query("set2_sites_except", SITES_SQL + """
SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT site_id FROM s WHERE NOT archived)
  AND c_nationkey NOT IN (1, 2)""")
def set2_sites_except(spark, sf):
    return R.site_scope(customers_by_site(spark, sf), sites(spark, sf), site__not_in=[1, 2]).select("c_custkey")


@query("set3_site_on_hits", SITES_SQL + f"""
SELECT c_custkey, c_nationkey AS site_id FROM customer
WHERE list_contains({tokens('c_mktsegment')}, 'building') AND c_nationkey IN (SELECT site_id FROM s WHERE NOT archived)""")
def set3_site_on_hits(spark, sf):
    c = R.site_scope(customers_by_site(spark, sf), sites(spark, sf), all_sites=True)
    return c.filter(text_match_all(["c_mktsegment"], "building")).select("c_custkey", "site_id")


@query("set4_eligible_sites", SITES_SQL + "SELECT site_id FROM s WHERE NOT archived")
def set4_eligible_sites(spark, sf):
    return R.eligible_sites(sites(spark, sf)).select("site_id")
