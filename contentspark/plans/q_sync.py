"""Queries for sync and streaming (STR-1..13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from contentspark.operators.intervals import tour
from contentspark.plans.q_hierarchy import GEO_CLOSURE_SQL
from contentspark.plans.registry import query
from contentspark.session import checkpoint_dir, written
from contentspark.sources import views as V
from contentspark.sources.tables import Tables
from contentspark.streaming import sync as SY

LAST_SQL = """
WITH last AS (
  SELECT user_id AS object_id, arg_max(event_id, (ts, event_id)) AS event_id,
         arg_max(event_type, (ts, event_id)) AS event_type
  FROM events GROUP BY user_id
)
"""


def doc_plan(spark, sf):
    t = Tables(spark, sf)
    d = t.documents.join(t.labels, "doc_id", "left")
    return SY.rebuild_plan(d, skip=F.coalesce(F.col("quality"), F.lit(1)) == 0,
                           valid=(F.length("text") > 0) & (F.col("n_chars") <= 20000),
                           error=F.lit("document too large"))


@query("str1_full_rebuild_summary", """
WITH t AS (
  SELECT 'post' AS entity,
         count_if(coalesce(l.quality, 1) <> 0 AND d.n_chars <= 20000 AND length(d.text) > 0)::BIGINT AS synced,
         count_if(coalesce(l.quality, 1) = 0)::BIGINT AS skipped,
         count_if(coalesce(l.quality, 1) <> 0 AND NOT (d.n_chars <= 20000 AND length(d.text) > 0))::BIGINT AS failed
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
)
SELECT *, CASE WHEN failed = 0 THEN 'success' WHEN synced = 0 THEN 'failed' ELSE 'with_errors' END AS status FROM t""")
def str1_full_rebuild_summary(spark, sf):
    """Every document classified (synced / skipped by the exclude flag / failed validation), the synced
    ones written, and the totals of what was written."""
    run = SY.full_rebuild(spark, doc_plan(spark, sf), "post")
    return run.select("entity", "synced", "skipped", "failed", "status")


@query("str2_change_dedup", LAST_SQL + "SELECT object_id, event_id, event_type FROM last")
def str2_change_dedup(spark, sf):
    ch = V.v_changes(spark, sf)
    return SY.last_change_per_key(ch).select("object_id", "event_id", "event_type")


def change_transform(batch):
    ch = batch.select("event_id", "ts", F.col("user_id").alias("object_id"), "event_type", "value", "props")
    return SY.eligibility(ch, F.col("event_type") != "error")


def event_files(spark, sf, files: int = 8) -> str:
    """The events as files of a feed in the shared folder (a stand-in for files that arrive over time)."""
    import os
    import uuid

    path = os.path.join(checkpoint_dir(spark), f"feed-{uuid.uuid4().hex}")
    Tables(spark, sf).events.repartition(files, "event_id").write.parquet(path)
    return path


@query("str3_incremental_upsert_final", LAST_SQL + "SELECT object_id, event_id FROM last WHERE event_type <> 'error'")
def str3_incremental_upsert_final(spark, sf):
    """The events table, as eight files of a change feed, streamed (readStream -> foreachBatch, one file a
    micro-batch) into a versioned target; live rows."""
    feed = event_files(spark, sf)
    out = SY.run_change_stream(spark, feed, Tables(spark, sf).events.schema, change_transform, "str3")
    return SY.current_state(out).select("object_id", "event_id")


@query("str3_batch_apply_in_two_steps", LAST_SQL + "SELECT object_id, event_id FROM last WHERE event_type <> 'error'")
def str3_batch_apply_in_two_steps(spark, sf):
    """The same changes applied as two batches (newer half first): order-free, same final state."""
    ev = Tables(spark, sf).events
    mid = ev.select(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.5)).scalar()
    late = change_transform(ev.filter(F.unix_micros(F.col("ts").cast("timestamp")) > mid))
    early = change_transform(ev.filter(F.unix_micros(F.col("ts").cast("timestamp")) <= mid))
    state = SY.apply_changes(SY.apply_changes(None, late), early)
    return SY.current_state(state).select("object_id", "event_id")


@query("str4_term_cascade", GEO_CLOSURE_SQL + """,
obj AS (SELECT c_custkey AS object_id, c_nationkey + 100 AS term_id FROM customer WHERE c_acctbal >= 0),
own AS (SELECT g.term_id, o.object_id FROM geo g JOIN obj o ON o.term_id = g.term_id),
noown AS (SELECT term_id FROM geo WHERE term_id NOT IN (SELECT term_id FROM own)),
dsc AS (SELECT n.term_id, o.object_id FROM noown n JOIN clo c ON c.ancestor = n.term_id JOIN obj o ON o.term_id = c.id),
allr AS (SELECT * FROM own UNION SELECT * FROM dsc)
SELECT term_id, object_id FROM allr""")
def str4_term_cascade(spark, sf):
    """Every geo term edited: its customers (non-negative balance) or, without own objects, its
    descendants' customers."""
    terms = V.v_terms(spark, sf).filter(F.col("taxonomy") == "geo")
    rel = V.v_term_relationships(spark, sf).filter(F.col("object_type") == "customer")
    objs = Tables(spark, sf).customer.filter(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("object_id"))
    return SY.term_cascade(terms.select("term_id"), written(tour(terms), "tour"), rel, objs).select("term_id", "object_id")


@query("str5_hierarchy_cascade", GEO_CLOSURE_SQL + """
SELECT DISTINCT t AS term_id FROM (
  SELECT term_id AS t FROM geo WHERE slug IN ('nation-1', 'asia')
  UNION ALL SELECT c.ancestor FROM clo c JOIN geo g ON g.term_id = c.id WHERE g.slug IN ('nation-1', 'asia')
  UNION ALL SELECT c.id FROM clo c JOIN geo g ON g.term_id = c.ancestor WHERE g.slug IN ('nation-1', 'asia'))""")
def str5_hierarchy_cascade(spark, sf):
    terms = V.v_terms(spark, sf).filter(F.col("taxonomy") == "geo")
    changed = terms.filter(F.col("slug").isin("nation-1", "asia")).select("term_id")
    return SY.hierarchy_cascade(changed, terms)


@query("str6_meta_change", LAST_SQL + """,
cur AS (SELECT e.user_id AS object_id, json_extract_string(e.props, '$.k') AS value FROM events e
        JOIN last l ON l.event_id = e.event_id),
mc AS (SELECT CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS object_id,
              CASE WHEN event_type = 'view' THEN '_edit_lock' ELSE 'k' END AS key,
              json_extract_string(props, '$.k') AS value,
              CASE WHEN event_type = 'error' THEN 'delete_all' ELSE 'update' END AS op FROM events)
SELECT DISTINCT object_id FROM (
  SELECT object_id FROM mc WHERE key = 'k' AND op <> 'delete_all'
  UNION ALL SELECT c.object_id FROM cur c JOIN mc ON mc.key = 'k' AND mc.op = 'delete_all' AND mc.value = c.value)""")
def str6_meta_change(spark, sf):
    """Meta changes of allowed keys (not the '_edit_lock' of views) and delete-all by key/value."""
    ev = Tables(spark, sf).events
    k = F.get_json_object("props", "$.k")
    mc = ev.select(F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("user_id")).alias("object_id"),
                   F.when(F.col("event_type") == "view", "_edit_lock").otherwise("k").alias("key"),
                   k.alias("value"),
                   F.when(F.col("event_type") == "error", "delete_all").otherwise("update").alias("op"))
    last = SY.last_change_per_key(V.v_changes(spark, sf))
    cur = last.select("object_id", F.lit("k").alias("key"), F.get_json_object("props", "$.k").alias("value"))
    return SY.meta_change_targets(mc, ["k"], cur)


@query("str7_media_change", """
SELECT DISTINCT user_id AS object_id FROM events WHERE event_type IN ('purchase', 'click')""")
def str7_media_change(spark, sf):
    """Attachment attach (purchase) / detach (click) changes trigger a sync of their object."""
    ch = V.v_changes(spark, sf).withColumn(
        "media_op", F.when(F.col("event_type") == "purchase", "attach").when(F.col("event_type") == "click", "detach"))
    return ch.filter(F.col("media_op").isin("attach", "detach")).select("object_id").distinct()


@query("str8_failed_rows", """
SELECT d.doc_id, 'document too large' AS error FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
WHERE coalesce(l.quality, 1) <> 0 AND NOT (d.n_chars <= 20000 AND length(d.text) > 0)""")
def str8_failed_rows(spark, sf):
    """Every row that failed validation, with its message."""
    return SY.failed_rows(doc_plan(spark, sf)).select("doc_id", "error")


@query("str8_retries", """
SELECT 'post' AS entity, count_if(coalesce(l.quality, 1) <> 0 AND d.n_chars <= 80000 AND length(d.text) > 0)::BIGINT AS synced,
       count_if(coalesce(l.quality, 1) = 0)::BIGINT AS skipped,
       count_if(coalesce(l.quality, 1) <> 0 AND NOT (d.n_chars <= 80000 AND length(d.text) > 0))::BIGINT AS failed
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def str8_retries(spark, sf):
    """Rows that fail are tried again, here with twice and four times the size limit; what is left has failed."""
    def again(failed, attempt):
        return SY.rebuild_plan(failed.drop("sync_status", "error"), F.lit(False),
                               (F.length("text") > 0) & (F.col("n_chars") <= 20000 * 2 ** (attempt - 1)), F.lit("document too large"))

    run = SY.full_rebuild(spark, doc_plan(spark, sf), "post", retry=again, attempts=3)
    return run.select("entity", "synced", "skipped", "failed")


@query("str9_skip_rules", """
SELECT count_if(coalesce(l.quality, 1) = 0)::BIGINT AS skipped FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def str9_skip_rules(spark, sf):
    return doc_plan(spark, sf).agg(F.count_if(F.col("sync_status") == "skipped").cast("bigint").alias("skipped"))


@query("str10_range_limited_sync", """
SELECT doc_id FROM documents WHERE doc_id BETWEEN 200 AND 700 AND lang IN ('en', 'de')
UNION ALL SELECT doc_id FROM documents WHERE doc_id IN (3, 5, 8)""")
def str10_range_limited_sync(spark, sf):
    """Sync limited by an id range and a type list, or by explicit ids."""
    d = Tables(spark, sf).documents
    a = d.filter(F.col("doc_id").between(200, 700) & F.col("lang").isin("en", "de")).select("doc_id")
    b = d.filter(F.col("doc_id").isin(3, 5, 8)).select("doc_id")
    return a.unionByName(b)


@query("str11_sync_history", """
WITH runs AS (
  SELECT date_trunc('day', ts) AS run, count_if(event_type <> 'error')::BIGINT AS synced,
         count_if(event_type = 'error')::BIGINT AS failed FROM events GROUP BY 1
),
last5 AS (SELECT * FROM runs ORDER BY run DESC LIMIT 5)
SELECT run, synced, failed,
       CASE WHEN failed = 0 THEN 'success' WHEN synced = 0 THEN 'failed' ELSE 'with_errors' END AS status,
       CASE WHEN run = (SELECT max(run) FROM last5) THEN failed ELSE 0 END AS errors_kept
FROM last5""")
def str11_sync_history(spark, sf):
    """One sync run per day of changes: totals and status; the last 5 runs; errors kept for the newest."""
    ev = Tables(spark, sf).events
    plan = ev.withColumn("sync_status", F.when(F.col("event_type") == "error", "failed").otherwise("synced"))
    runs = plan.groupBy(F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("run")).agg(
        F.count_if(F.col("sync_status") == "synced").cast("bigint").alias("synced"),
        F.count_if(F.col("sync_status") == "failed").cast("bigint").alias("failed"))
    last5 = runs.orderBy(F.col("run").desc()).limit(5)
    newest = last5.select(F.max("run")).scalar()
    status = F.when(F.col("failed") == 0, "success").when(F.col("synced") == 0, "failed").otherwise("with_errors")
    return last5.select("run", "synced", "failed", status.alias("status"),
                        F.when(F.col("run") == newest, F.col("failed")).otherwise(F.lit(0).cast("bigint"))
                        .alias("errors_kept"))


@query("str13_tumbling_counts", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL""")
def str13_tumbling_counts(spark, sf):
    return SY.windowed_counts(Tables(spark, sf).events, "ts", "event_type", "1 hour")


@query("str13_sliding_counts", """
WITH b AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS s, event_type FROM events),
w AS (SELECT s AS window_start, event_type FROM b UNION ALL SELECT s - INTERVAL 1 HOUR, event_type FROM b)
SELECT window_start, window_start + INTERVAL 2 HOUR AS window_end, event_type, count(*)::BIGINT AS n FROM w GROUP BY ALL""")
def str13_sliding_counts(spark, sf):
    return SY.windowed_counts(Tables(spark, sf).events, "ts", "event_type", "2 hours", "1 hour")


@query("str13_session_counts", """
WITH o AS (SELECT event_type, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev FROM events),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts - prev >= INTERVAL 20 MINUTE THEN 1 ELSE 0 END)
                OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM o)
SELECT min(ts) AS window_start, max(ts) + INTERVAL 20 MINUTE AS window_end, event_type, count(*)::BIGINT AS n
FROM s GROUP BY event_type, sid""")
def str13_session_counts(spark, sf):
    return SY.session_counts(Tables(spark, sf).events, "ts", "event_type", "20 minutes")


@query("str13_stream_window_table", """
WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
                  event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL)
SELECT * FROM w WHERE window_end <= (SELECT max(ts) FROM events)""")
def str13_stream_window_table(spark, sf):
    """The same counts from a stream: windows that the watermark (no delay) has closed, written by a file sink."""
    feed = event_files(spark, sf, 1)
    return SY.stream_window_table(spark, feed, Tables(spark, sf).events.schema, "ts", "event_type", "1 hour", "0 seconds")


@query("str13_stream_session_table", """
WITH o AS (SELECT event_type, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev FROM events),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts - prev >= INTERVAL 20 MINUTE THEN 1 ELSE 0 END)
                OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM o),
done AS (SELECT time_bucket(INTERVAL 20 MINUTE, max(ts)) AS upto FROM events),
all_ AS (SELECT min(ts) AS window_start, max(ts) + INTERVAL 20 MINUTE AS window_end, event_type, count(*)::BIGINT AS n,
                min(ts) FILTER (ts >= upto) AS late FROM s, done GROUP BY event_type, sid)
SELECT window_start, window_end, event_type, n FROM all_ WHERE late IS NULL AND (
  window_end <= (SELECT max(ts) FROM events) OR EXISTS (
    SELECT 1 FROM all_ o, done WHERE o.event_type = all_.event_type AND o.window_start > all_.window_start AND o.window_start < upto))""")
def str13_stream_session_table(spark, sf):
    """Sessions from a stream: pre-aggregated parts joined by a group's state, those that the watermark has closed."""
    feed = event_files(spark, sf, 1)
    return SY.stream_session_table(spark, feed, Tables(spark, sf).events.schema, "ts", "event_type", "20 minutes", "0 seconds")
