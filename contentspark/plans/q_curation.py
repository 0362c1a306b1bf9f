"""Queries for curated results (CUR-1..4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from contentspark.operators import curation as C
from contentspark.operators import search as S
from contentspark.plans.q_search import BASE_SQL, WEIGHTS, bench_queries, doc_index
from contentspark.plans.registry import query
from contentspark.session import written
from contentspark.sources import views as V
from contentspark.sources.tables import Tables

# SQL: organic best-fields OR scores (rounded), pointers from phrase matches, then insertion.
CUR_SQL = BASE_SQL + """,
organic AS (
  SELECT fs.query_id, fs.doc_id, round(max(fs.s * w.weight) * 1000)::BIGINT AS score
  FROM fs JOIN w ON w.field = fs.field GROUP BY ALL
),
qtext AS (SELECT query_id, array_to_string(toks, ' ') AS query FROM q),
cstarts AS (SELECT o.query_id, o.doc_id FROM occ o JOIN npos n ON n.query_id = o.query_id
            WHERE o.field = 'post_content' GROUP BY o.query_id, o.doc_id, o.off
            HAVING count(DISTINCT o.qpos) = max(n.n_pos)),
cand AS (
  SELECT query_id, doc_id, min(prio) AS prio FROM (
    SELECT DISTINCT query_id, doc_id, 0 AS prio FROM cstarts
    UNION ALL
    SELECT q.query_id, d.doc_id, 1 FROM q, (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 2) d
  ) GROUP BY ALL
),
pointers AS (
  SELECT qt2.query AS search_term, c.doc_id, CASE WHEN c.r = 1 THEN 1 ELSE 3 END AS position FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY prio, doc_id) AS r FROM cand) c
  JOIN qtext qt2 ON qt2.query_id = c.query_id WHERE c.r <= 2
),
pinned AS (
  SELECT qx.query_id, p.doc_id, p.position FROM qtext qx JOIN pointers p ON lower(trim(p.search_term)) = lower(trim(qx.query))
  WHERE qx.query_id IN (SELECT query_id FROM organic)
),
rest AS (
  SELECT o.*, row_number() OVER (PARTITION BY o.query_id ORDER BY o.score DESC, o.doc_id) AS r FROM organic o
  WHERE NOT EXISTS (SELECT 1 FROM pinned p WHERE p.query_id = o.query_id AND p.doc_id = o.doc_id)
),
thr AS (SELECT query_id, position - row_number() OVER (PARTITION BY query_id ORDER BY position, doc_id) + 1 AS t
        FROM pinned),
slots AS (
  SELECT query_id, doc_id, (r + (SELECT count(*) FROM thr WHERE thr.query_id = rest.query_id AND thr.t <= rest.r))::DOUBLE
         AS slot, false AS pinned FROM rest
  UNION ALL SELECT query_id, doc_id, position::DOUBLE, true FROM pinned
),
final AS (
  SELECT query_id, doc_id, pinned,
         row_number() OVER (PARTITION BY query_id ORDER BY slot, pinned DESC, doc_id) AS position FROM slots
)
"""


def organic_hits(spark, sf):
    """The ranking that pins go into, matched once and written: every use reads the table."""
    q = bench_queries(spark, sf)
    hits = S.match(q, doc_index(spark, sf), WEIGHTS, "or")
    return written(hits.select("query_id", "doc_id", S.milli(F.col("score")).alias("score")), "organic").join(q, "query_id")


@query("cur1_pinned_positions", CUR_SQL + "SELECT query_id, doc_id, position, pinned FROM final")
def cur1_pinned_positions(spark, sf):
    """Organic OR-match ranking with curated documents inserted at their positions."""
    pointers = written(V.v_pointers(spark, sf), "pointers")
    return C.pin(organic_hits(spark, sf), pointers, queries=bench_queries(spark, sf)).select("query_id", "doc_id", "position", "pinned")


@query("cur2_forced_match", CUR_SQL + """
SELECT f.query_id, f.doc_id, f.position FROM final f
WHERE f.pinned AND NOT EXISTS (SELECT 1 FROM organic o WHERE o.query_id = f.query_id AND o.doc_id = f.doc_id)""")
def cur2_forced_match(spark, sf):
    """Pinned documents that the text clause alone would not have returned."""
    org = organic_hits(spark, sf)
    res = C.pin(org, written(V.v_pointers(spark, sf), "pointers"), queries=bench_queries(spark, sf))
    return (res.filter("pinned").join(org.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")
            .select("query_id", "doc_id", "position"))


@query("cur3_preview_without_pointers", CUR_SQL + """
SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS position
FROM organic""")
def cur3_preview_without_pointers(spark, sf):
    return C.organic_only(organic_hits(spark, sf)).select("query_id", "doc_id", "position")


@query("cur4_pointer_maintenance", CUR_SQL + """,
live AS (SELECT d.doc_id FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE coalesce(l.toxic, 0) <> 1),
newp AS (SELECT * FROM pointers WHERE position BETWEEN 1 AND 2 AND doc_id IN (SELECT doc_id FROM live))
SELECT coalesce(n.search_term, o.search_term) AS search_term, coalesce(n.doc_id, o.doc_id) AS doc_id,
       CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete' ELSE 'update' END AS op,
       coalesce(n.position, o.position) AS position
FROM pointers o FULL OUTER JOIN newp n ON n.search_term = o.search_term AND n.doc_id = o.doc_id
WHERE o.doc_id IS NULL OR n.doc_id IS NULL OR o.position <> n.position""")
def cur4_pointer_maintenance(spark, sf):
    """Page size 2 drops position-3 pointers; trashed (toxic) documents lose their pointers."""
    old = written(V.v_pointers(spark, sf), "pointers")
    t = Tables(spark, sf)
    posts = t.documents.join(t.labels, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        F.when(F.coalesce(F.col("toxic"), F.lit(0)) == 1, "trash").otherwise("publish").alias("post_status"))
    new = C.clean_pointers(old, posts, page_size=2)
    return C.pointer_changes(old, new)


@query("cur4_rekey", CUR_SQL + """
SELECT CASE WHEN query_id % 2 = 0 THEN 'new ' || p.search_term ELSE p.search_term END AS search_term, p.doc_id, p.position
FROM pointers p JOIN qtext ON qtext.query = p.search_term""")
def cur4_rekey(spark, sf):
    """Every second search term is renamed; its pointers follow."""
    renames = bench_queries(spark, sf).filter(F.col("query_id") % 2 == 0).select(
        F.upper("query").alias("old_term"), F.concat(F.lit("new "), F.col("query")).alias("new_term"))
    return C.rekey(written(V.v_pointers(spark, sf), "pointers"), renames)


@query("cur4_untrash", CUR_SQL + "SELECT search_term, doc_id, position FROM pointers")
def cur4_untrash(spark, sf):
    """Toxic documents go to the trash with their pointers, and come back: the pointers return to their places."""
    old = written(V.v_pointers(spark, sf), "pointers")
    t = Tables(spark, sf)
    docs = t.documents.join(t.labels, "doc_id", "left").select(F.col("doc_id").alias("id"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    status = F.when(F.col("toxic") == 1, "trash").otherwise("publish")
    kept = C.clean_pointers(old, docs.withColumn("post_status", status))
    removed = old.join(kept.select("search_term", "doc_id"), ["search_term", "doc_id"], "left_anti")
    return C.restore(kept, removed, docs.withColumn("post_status", F.lit("publish")))
