"""Feature fixtures: curated positions, synonyms, error classes, hierarchies, sync, attachments."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from contentspark.operators import curation as CU
from contentspark.operators import documents as DOC
from contentspark.operators import hierarchy as H
from contentspark.operators import reports as R
from contentspark.operators import synonyms as SY
from contentspark.operators import terms as TR
from contentspark.streaming import sync as SYN


def test_curated_position_first(spark):
    organic = spark.createDataFrame([(1, "findme", 1, 3.0), (1, "findme", 2, 2.0), (1, "findme", 3, 1.0)],
                                    "query_id long, query string, doc_id long, score double")
    pointers = spark.createDataFrame([("FindMe", 2, 1)], "search_term string, doc_id long, position int")
    out = CU.pin(organic, pointers).orderBy("position").collect()
    assert [r.doc_id for r in out] == [2, 1, 3]


def test_curated_free_slots_and_gaps(spark):
    organic = spark.createDataFrame([(1, "q", d, float(10 - d)) for d in range(1, 6)],
                                    "query_id long, query string, doc_id long, score double")
    pointers = spark.createDataFrame([("q", 9, 2), ("q", 8, 3), ("q", 7, 20)],
                                     "search_term string, doc_id long, position int")
    out = [r.doc_id for r in CU.pin(organic, pointers).orderBy("position").collect()]
    # pinned 9 at 2, 8 at 3; organic fill the free slots; 7 (position 20) goes last
    assert out == [1, 9, 8, 2, 3, 4, 5, 7]


def test_synonyms_multiword_and_case(spark):
    lines = spark.createDataFrame([("internet of things, IoT",), ("hoodie, sweatshirt",), ("# c",), ("",),
                                   ("gear => cog, wheel",)], "line string")
    pairs = SY.rewrite_pairs(SY.parse_lines(lines))
    q = spark.createDataFrame([(1, "internet of things"), (2, "HoOdiE"), (3, "gear box")], "query_id long, query string")
    alts = {(r.query_id, r.query) for r in SY.expand_queries(q, pairs).collect()}
    assert (1, "iot") in alts and (1, "internet of things") in alts
    assert (2, "sweatshirt") in alts and (2, "hoodie") in alts
    assert (3, "cog box") in alts and (3, "wheel box") in alts and (3, "gear box") not in alts


def test_error_classes(spark):
    msgs = ["no such index [x]", "No mapping found for [f] in order to sort on",
            "Limit of total fields [1000] in index [x] has been exceeded", "Not set"]
    df = spark.createDataFrame([(m,) for m in msgs], "m string").select(R.classify_error(F.col("m")).alias("e"))
    assert [r.e for r in df.collect()] == ["no such index [???]", "No mapping found for [???] in order to sort on",
                                           "Limit of total fields [???] in index [???] has been exceeded", "Not set"]


def test_hierarchical_hide_empty(spark):
    # childless assigned (1); parent (2) with assigned child (3); parent (4) with unassigned child (5)
    terms = spark.createDataFrame([(1, 0, 1, "a"), (2, 0, 0, "b"), (3, 2, 1, "c"), (4, 0, 0, "d"), (5, 4, 0, "e")],
                                  "term_id long, parent long, count long, name string")
    h = H.with_hierarchy(terms)
    kept = sorted(r.term_id for r in h.filter(TR.term_filter({"hide_empty": True})).collect())
    assert kept == [1, 2, 3]


def test_comment_thread(spark):
    c = spark.createDataFrame([(1, 0, dt.datetime(2020, 1, 1)), (2, 1, dt.datetime(2020, 1, 2))],
                              "comment_ID long, comment_parent long, comment_date_gmt timestamp_ntz")
    t = H.thread(c).collect()
    assert sorted((r.comment_ID, r.root, r.level) for r in t) == [(1, 1, 0), (2, 1, 1)]


def test_change_application_is_order_free(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 0, 0), 7, "upsert"), (2, dt.datetime(2024, 1, 1, 1, 0), 7, "delete"),
            (3, dt.datetime(2024, 1, 1, 2, 0), 8, "upsert"), (4, dt.datetime(2024, 1, 1, 3, 0), 7, "upsert")]
    ch = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, object_id long, op string")
    once = SYN.current_state(SYN.apply_changes(None, ch))
    late_first = SYN.apply_changes(SYN.apply_changes(None, ch.filter("event_id >= 3")), ch.filter("event_id < 3"))
    assert sorted((r.object_id, r.event_id) for r in once.collect()) == [(7, 4), (8, 3)]
    assert sorted((r.object_id, r.event_id) for r in SYN.current_state(late_first).collect()) == [(7, 4), (8, 3)]


def test_stream_windows_equal_batch(spark, sf_small):
    from contentspark.sources.tables import Tables

    ev = Tables(spark, sf_small).events
    batch = {tuple(r) for r in SYN.windowed_counts(ev, "ts", "event_type", "1 hour").collect()}
    q = SYN.stream_windowed_counts(spark, sf_small, ev.schema, "ts", "event_type", "1 hour", "0 seconds",
                                   "win_test", glob="events.parquet")
    q.awaitTermination()
    streamed = {tuple(r) for r in spark.sql("SELECT * FROM win_test").collect()}
    # append mode emits windows closed by the watermark: every emitted window equals the batch one
    assert streamed and streamed <= batch


def test_attachment_rows_from_binary_files(spark):
    d = tempfile.mkdtemp(prefix="att-")
    for name in ("a.pdf", "b.docx", "c.txt"):
        with open(os.path.join(d, name), "wb") as f:
            f.write(b"x" * 10)
    files = spark.read.format("binaryFile").load(d)
    out = sorted(r.mime for r in DOC.attachment_rows(files).collect())
    assert out == ["application/pdf", "application/vnd.openxmlformats-officedocument.wordprocessingml.document"]


def test_oversize_rows_are_marked(spark):
    df = spark.createDataFrame([(1, 5), (2, 30), (3, 10), (4, None)], "id long, n long")
    got = {r.id: r.oversize for r in DOC.route_oversize(df, F.col("n"), 10).collect()}
    assert got == {1: False, 2: True, 3: False, 4: None}


def test_deep_chains_and_cycles(spark):
    from contentspark.operators import hierarchy as H

    chain = spark.createDataFrame([(i, i - 1, f"n{i}", 1) for i in range(1, 131)], "term_id long, parent long, name string, count long")
    c = H.closure(chain)
    assert c.count() == 130 * 129 // 2 and c.agg(F.max("depth")).first()[0] == 129
    deepest = [r for r in H.tree(chain).collect() if r.term_id == 130][0]
    assert deepest.level == 129 and len(deepest.path) == 130
    cycle = spark.createDataFrame([(1, 2), (2, 1), (3, 2), (4, 4), (5, 0)], "term_id long, parent long")
    got = sorted((r.id, r.ancestor, r.depth) for r in H.closure(cycle).collect())
    assert got == [(1, 2, 1), (2, 1, 1), (3, 1, 2), (3, 2, 1)]


def test_tree_descending_names(spark):
    from contentspark.operators import hierarchy as H

    terms = spark.createDataFrame([(1, 0, "a"), (2, 0, "b"), (3, 1, "x"), (4, 1, "y")], "term_id long, parent long, name string")
    order = lambda d: [r.term_id for r in sorted(H.tree(terms, descending=d).collect(), key=lambda r: r.path)]
    assert order(False) == [1, 3, 4, 2] and order(True) == [2, 1, 4, 3]


def test_long_synonym_phrases(spark):
    from contentspark.operators import synonyms as SY

    rules = SY.parse_lines(spark.createDataFrame([("a b c d e, zed",)], "line string"))
    q = spark.createDataFrame([(1, "x a b c d e y")], "query_id long, query string")
    assert {r.query for r in SY.expand_queries(q, SY.rewrite_pairs(rules)).collect()} == {"x a b c d e y", "x zed y"}


def test_completion_compares_whole_tokens(spark):
    from contentspark.operators import suggest as SG

    docs = spark.createDataFrame([(1, "f", "internatioxyz"), (2, "f", "international days"), (3, "f", "in")], "doc_id long, field string, text string")
    q = spark.createDataFrame([("a", "international"), ("b", "in"), ("c", "i d")], "query_id string, query string")
    got = {(r.query_id, r.doc_id) for r in SG.complete(q, SG.prefix_index(docs, min_len=1)).collect()}
    assert got == {("a", 2), ("b", 1), ("b", 2), ("b", 3), ("c", 2)}


def test_mime_rules(spark):
    from contentspark.operators.predicates import mime_type_filter

    df = spark.createDataFrame([("image/png",), ("image",), ("imagx/y",), ("",)], "post_mime_type string")
    got = lambda m: sorted(r[0] for r in df.filter(mime_type_filter(m)).collect())
    assert got("imag") == ["image", "image/png", "imagx/y"] and got(["image"]) == ["image", "image/png"] and got(["image/png"]) == ["image/png"]
    assert mime_type_filter("") is None


def test_change_stream_over_generations(spark, tmp_path):
    feed, target = str(tmp_path / "feed"), str(tmp_path / "target")
    schema = "event_id long, ts timestamp, object_id long, op string"
    base = dt.datetime(2024, 1, 1)
    batches = [[(n * 100 + i, base + dt.timedelta(minutes=(7 * n + i) % 50), i % (5 + n), "upsert" if i % 3 else "delete")
                for i in range(20)] for n in range(5)]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(feed)
    SYN.stream_changes(spark, feed, spark.read.parquet(feed).schema, target, str(tmp_path / "ck"), lambda b: b).awaitTermination()
    got = {r.object_id: r.event_id for r in SYN.read_target(spark, target).collect()}
    want = {}
    for e, ts, o, _ in sorted((r for rows in batches for r in rows), key=lambda r: (r[1], r[0])):
        want[o] = e
    assert got == want
    # merged on read: a micro-batch writes a row per key that it changes, and nothing else
    assert [(r["first"], r["rows"]) for r in SYN.manifest(spark, target)] == [(n, len({r[2] for r in rows})) for n, rows in enumerate(batches)]


def test_rebuild_retries_and_history(spark, tmp_path):
    docs = spark.createDataFrame([(1, 10), (2, 30), (3, 99), (4, 5)], "id long, size long")
    plan = SYN.rebuild_plan(docs, F.col("id") == 4, F.col("size") <= 20, F.lit("too large"))
    again = lambda failed, n: SYN.rebuild_plan(failed.drop("sync_status", "error"), F.lit(False), F.col("size") <= 20 * n, F.lit("too large"))
    run = SYN.full_rebuild(spark, plan, "post", str(tmp_path / "out"), again, 3)
    r = run.first()
    assert (r.synced, r.skipped, r.failed, r.status, r.attempts) == (2, 1, 1, "with_errors", 3) and r.seconds > 0
    for _ in range(2):
        history = SYN.append_history(spark, run, str(tmp_path / "history"))
    assert history.count() == 2 and {x.failed for x in history.collect()} == {1}
