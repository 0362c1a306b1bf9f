"""Queries for hierarchies (HIER-1..5) and term queries (TRM-1..12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from contentspark.operators import hierarchy as H
from contentspark.operators import terms as TR
from contentspark.operators.intervals import covered, tour
from contentspark.plans.registry import query
from contentspark.plans.sqlviews import V_COMMENTS, V_TERMS, with_views
from contentspark.session import written
from contentspark.sources import views as V

GEO_CLOSURE_SQL = with_views(V_TERMS) + """,
geo AS (SELECT term_id, parent, count, name, slug, description, taxonomy FROM v_terms WHERE taxonomy = 'geo'),
clo AS (
  WITH RECURSIVE c(id, ancestor, depth) AS (
    SELECT term_id, parent, 1 FROM geo WHERE parent IS NOT NULL AND parent <> 0
    UNION ALL
    SELECT c.id, g.parent, c.depth + 1 FROM c JOIN geo g ON g.term_id = c.ancestor
    WHERE g.parent IS NOT NULL AND g.parent <> 0
  ) SELECT * FROM c
),
hier AS (
  SELECT g.*, coalesce(d.n_descendants, 0)::BIGINT AS n_descendants,
         coalesce(d.children_count, 0)::BIGINT AS children_count,
         (g.count + coalesce(d.children_count, 0))::BIGINT AS padded_count,
         coalesce(a.ancestors, []::BIGINT[]) AS ancestors
  FROM geo g
  LEFT JOIN (SELECT c.ancestor AS term_id, count(*) AS n_descendants, sum(g2.count) AS children_count
             FROM clo c JOIN geo g2 ON g2.term_id = c.id GROUP BY c.ancestor) d ON d.term_id = g.term_id
  LEFT JOIN (SELECT id AS term_id, list_sort(list(ancestor)) AS ancestors FROM clo GROUP BY id) a
         ON a.term_id = g.term_id
)
"""


def geo_terms(spark, sf):
    return V.v_terms(spark, sf).filter(F.col("taxonomy") == "geo")


def geo_hier(spark, sf, ancestors=False):
    return H.with_hierarchy(geo_terms(spark, sf), ancestors=ancestors)


@query("hier1_closure", GEO_CLOSURE_SQL + "SELECT id, ancestor, depth FROM clo")
def hier1_closure(spark, sf):
    return H.closure(geo_terms(spark, sf))


@query("hier1_descendants", GEO_CLOSURE_SQL + "SELECT id FROM clo WHERE ancestor = 3")
def hier1_descendants(spark, sf):
    """Descendants of region term 3: a range of places, no closure."""
    walk = written(tour(geo_terms(spark, sf)), "tour")
    return covered(walk, spark.createDataFrame([(3,)], "id long"))


@query("hier2_children_count", GEO_CLOSURE_SQL + "SELECT term_id, n_descendants, children_count FROM hier")
def hier2_children_count(spark, sf):
    return geo_hier(spark, sf).select("term_id", "n_descendants", "children_count")


@query("hier3_padded_counts", GEO_CLOSURE_SQL + "SELECT term_id, count, padded_count FROM hier")
def hier3_padded_counts(spark, sf):
    return geo_hier(spark, sf).select("term_id", "count", "padded_count")


TREE_SQL = with_views(V_TERMS) + """,
geo AS (SELECT term_id, parent, name FROM v_terms WHERE taxonomy = 'geo'),
t AS (
  WITH RECURSIVE t(id, level, path) AS (
    SELECT term_id, 0, [lower(name) || chr(1) || lpad(term_id::VARCHAR, 20, '0')] FROM geo WHERE parent = 0
    UNION ALL
    SELECT g.term_id, t.level + 1, list_append(t.path, lower(g.name) || chr(1) || lpad(g.term_id::VARCHAR, 20, '0'))
    FROM t JOIN geo g ON g.parent = t.id
  ) SELECT * FROM t
)
SELECT id AS term_id, level, array_to_string(path, '>') AS path_key FROM t"""


@query("hier4_term_tree", TREE_SQL)
def hier4_term_tree(spark, sf):
    """Pre-order tree: ordering by path_key lists every node right after its parent."""
    t = H.tree(geo_terms(spark, sf), sort_key="name")
    return t.select("term_id", "level", F.array_join("path", ">").alias("path_key"))


@query("hier4_term_tree_positions", TREE_SQL.replace(
    "SELECT id AS term_id, level, array_to_string(path, '>') AS path_key FROM t",
    "SELECT id AS term_id, level, row_number() OVER (ORDER BY path) - 1 AS position FROM t"))
def hier4_term_tree_positions(spark, sf):
    """The same tree as places in pre-order: a number per node, however deep it is."""
    return H.tree(geo_terms(spark, sf), sort_key="name", path=False)


@query("hier4_term_tree_descending", with_views(V_TERMS) + """,
geo AS (SELECT term_id, parent, name, lpad((row_number() OVER (PARTITION BY parent ORDER BY lower(name) DESC, term_id))::VARCHAR,
               12, '0') AS tok FROM v_terms WHERE taxonomy = 'geo'),
t AS (
  WITH RECURSIVE t(id, level, path) AS (
    SELECT term_id, 0, [tok] FROM geo WHERE parent = 0
    UNION ALL SELECT g.term_id, t.level + 1, list_append(t.path, g.tok) FROM t JOIN geo g ON g.parent = t.id
  ) SELECT * FROM t
)
SELECT id AS term_id, level, array_to_string(path, '>') AS path_key FROM t""")
def hier4_term_tree_descending(spark, sf):
    """The tree with siblings in descending name order."""
    t = H.tree(geo_terms(spark, sf), sort_key="name", descending=True)
    return t.select("term_id", "level", F.array_join("path", ">").alias("path_key"))


@query("hier5_threaded_order", with_views(V_COMMENTS) + """,
t AS (
  WITH RECURSIVE t(id, path) AS (
    SELECT comment_ID, [strftime(comment_date_gmt, '%Y%m%d%H%M%S') || lpad(comment_ID::VARCHAR, 20, '0')]
    FROM v_comments WHERE comment_parent = 0
    UNION ALL
    SELECT c.comment_ID, list_append(t.path, strftime(c.comment_date_gmt, '%Y%m%d%H%M%S') || lpad(c.comment_ID::VARCHAR, 20, '0'))
    FROM t JOIN v_comments c ON c.comment_parent = t.id
  ) SELECT * FROM t
)
SELECT id AS comment_ID, row_number() OVER (ORDER BY path) - 1 AS position FROM t""")
def hier5_threaded_order(spark, sf):
    """Every comment's place when threads are listed with each reply below its parent, by date."""
    return H.thread(V.v_comments(spark, sf)).select("comment_ID", "position")


@query("hier5_comment_thread", with_views(V_COMMENTS) + """,
t AS (
  WITH RECURSIVE t(id, root, level) AS (
    SELECT comment_ID, comment_ID, 0 FROM v_comments WHERE comment_parent = 0
    UNION ALL
    SELECT c.comment_ID, t.root, t.level + 1 FROM t JOIN v_comments c ON c.comment_parent = t.id
  ) SELECT * FROM t
)
SELECT id AS comment_ID, root, level FROM t""")
def hier5_comment_thread(spark, sf):
    """Every comment with its thread's root and its level in it."""
    return H.thread(V.v_comments(spark, sf)).select("comment_ID", "root", "level")


# ---------------------------------------------------------------- TRM

def term_queries(spark, sf, *queries):
    """The terms that each of some term queries finds, over one term table."""
    h = written(geo_hier(spark, sf, ancestors=any("child_of" in args for args in queries)), "geo-terms")
    return [h.filter(TR.term_filter(args)) for args in queries]


def term_query(spark, sf, args):
    return geo_hier(spark, sf).filter(TR.term_filter(args))


@query("trm1_taxonomy", with_views(V_TERMS) + "SELECT slug FROM v_terms WHERE taxonomy IN ('brand', 'ptype')")
def trm1_taxonomy(spark, sf):
    return V.v_terms(spark, sf).filter(TR.term_filter({"taxonomy": ["brand", "ptype"]})).select("slug")


@query("trm2_object_terms", with_views(V_TERMS) + """
SELECT term_id FROM v_terms WHERE taxonomy = 'geo' AND term_id IN (
  SELECT c_nationkey + 100 FROM customer WHERE c_custkey IN (1, 2, 3, 40))""")
def trm2_object_terms(spark, sf):
    rel = V.v_term_relationships(spark, sf).filter(F.col("object_type") == "customer")
    return TR.terms_of_objects(geo_terms(spark, sf), rel, [1, 2, 3, 40]).select("term_id")


@query("trm3_include_exclude", GEO_CLOSURE_SQL + """
SELECT term_id FROM hier WHERE term_id IN (101, 102)
UNION ALL SELECT term_id FROM hier WHERE term_id NOT IN (1, 2, 101)""")
def trm3_include_exclude(spark, sf):
    """exclude is ignored when include is given (first part); exclude alone (second)."""
    a, b = term_queries(spark, sf, {"include": [101, 102], "exclude": [102]}, {"exclude": [1, 2, 101]})
    return a.select("term_id").unionByName(b.select("term_id"))


@query("trm4_exclude_tree", GEO_CLOSURE_SQL + "SELECT term_id FROM hier WHERE term_id <> 2 AND parent <> 2")
def trm4_exclude_tree(spark, sf):
    return term_query(spark, sf, {"exclude_tree": [2]}).select("term_id")


@query("trm5_name_slug", GEO_CLOSURE_SQL + """
SELECT term_id FROM hier WHERE name IN ('NATION_3', 'AFRICA') OR slug = 'nation-4'""")
def trm5_name_slug(spark, sf):
    a, b = term_queries(spark, sf, {"name": ["NATION_3", "AFRICA"]}, {"slug": "NATION 4"})
    return a.select("term_id").unionByName(b.select("term_id"))


@query("trm6_term_taxonomy_id", GEO_CLOSURE_SQL + "SELECT term_id FROM hier WHERE term_id IN (104, 105, 3)")
def trm6_term_taxonomy_id(spark, sf):
    return term_query(spark, sf, {"term_taxonomy_id": [104, 105, 3, 0]}).select("term_id")


@query("trm7_hide_empty", GEO_CLOSURE_SQL + """
SELECT term_id FROM hier WHERE count >= 1 OR children_count >= 1
UNION ALL SELECT term_id FROM hier WHERE count >= 1""")
def trm7_hide_empty(spark, sf):
    """Hierarchical hide_empty keeps parents with non-empty descendants; flat does not."""
    a, b = term_queries(spark, sf, {"hide_empty": True}, {"hide_empty": True, "hierarchical": False})
    return a.select("term_id").unionByName(b.select("term_id"))


@query("trm8_child_of_parent_childless", GEO_CLOSURE_SQL + """
SELECT 'child_of' AS q, term_id FROM hier WHERE list_contains(ancestors, 4)
UNION ALL SELECT 'parent', term_id FROM hier WHERE parent = 5
UNION ALL SELECT 'childless', term_id FROM hier WHERE n_descendants = 0""")
def trm8_child_of_parent_childless(spark, sf):
    found = term_queries(spark, sf, {"child_of": 4}, {"parent": 5}, {"childless": True})
    a, b, c = (df.select(F.lit(q).alias("q"), "term_id") for q, df in zip(("child_of", "parent", "childless"), found))
    return a.unionByName(b).unionByName(c)


@query("trm9_search", with_views(V_TERMS) + """
SELECT taxonomy, slug FROM v_terms
WHERE list_has_all(list_concat(regexp_extract_all(lower(name), '[\\p{L}\\p{N}]+'),
                               regexp_extract_all(lower(slug), '[\\p{L}\\p{N}]+'),
                               regexp_extract_all(lower(taxonomy), '[\\p{L}\\p{N}]+'),
                               regexp_extract_all(lower(description), '[\\p{L}\\p{N}]+')), ['nation', '1'])
   OR list_has_all(regexp_extract_all(lower(name), '[\\p{L}\\p{N}]+'), ['brand', '7'])""")
def trm9_search(spark, sf):
    """search over name/slug/taxonomy/description; name__like restricted to the name."""
    terms = V.v_terms(spark, sf)
    a = terms.filter(TR.term_filter({"search": "Nation 1"}))
    b = terms.filter(TR.term_filter({"name__like": "brand 7"}))
    return a.unionByName(b).select("taxonomy", "slug").distinct()


@query("trm11_sort", GEO_CLOSURE_SQL + """
SELECT term_id, row_number() OVER (ORDER BY lower(name) DESC, term_id) AS pos FROM hier ORDER BY pos LIMIT 20""")
def trm11_sort(spark, sf):
    """First page of 20 terms by descending name (a partial top-k, the rank over the page only)."""
    from pyspark.sql import Window

    order = TR.term_sort("name", "desc")
    page = geo_hier(spark, sf).orderBy(*order).limit(20)
    return page.select("term_id", F.row_number().over(Window.orderBy(*order)).alias("pos"))


@query("trm11_meta_sort", GEO_CLOSURE_SQL + """
SELECT term_id, row_number() OVER (ORDER BY count DESC, term_id) AS pos FROM hier ORDER BY pos LIMIT 20""")
def trm11_meta_sort(spark, sf):
    """First page of 20 terms by the numeric reading of the meta key 'objects'."""
    from pyspark.sql import Window

    order = TR.term_sort("meta.objects.long", "desc")
    page = geo_hier(spark, sf).orderBy(*order).limit(20)
    return page.select("term_id", F.row_number().over(Window.orderBy(*order)).alias("pos"))


@query("trm12_fields", GEO_CLOSURE_SQL + """
SELECT term_id, parent FROM hier WHERE parent <> 0""")
def trm12_fields(spark, sf):
    return TR.term_fields(term_query(spark, sf, {"extra": F.col("parent") != 0}), "id=>parent")


@query("trm12_count", GEO_CLOSURE_SQL + "SELECT count(*)::BIGINT AS count FROM hier WHERE count >= 1")
def trm12_count(spark, sf):
    return TR.term_fields(term_query(spark, sf, {"hide_empty": True, "hierarchical": False}), "count")
