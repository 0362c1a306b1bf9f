"""Virtual views that give the driver tables the shapes of content objects.

``v_posts``  products (part), posts (documents + labels), pages, orders
``v_terms``  taxonomy ``geo`` (regions > nations), flat ``brand`` / ``ptype``
``v_term_relationships``  customers/suppliers -> nations, parts -> brand/ptype
``v_comments``  conversation turns as a threaded comment table
``v_changes``   events as a change feed; ``v_log`` error events as a query log
``v_queries``   benchmark items as search queries (whole texts)

Hot filter columns (type, status, dates, ids) stay top-level so Catalyst pushes
them into the Parquet scans; a ``post_type`` filter prunes whole union branches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contentspark.functions import text as T
from contentspark.functions.meta import META_VALUE_TYPE, build_meta, meta_keys
from contentspark.sources.tables import Tables

# Id offsets of the object families inside v_posts.
DOC_ID_OFFSET = 1 << 56
PAGE_ID_OFFSET = 2 << 56
ORDER_ID_OFFSET = 3 << 56
# Fixed value: turns that a conversation has room for in comment ids.
TURNS = 1 << 24
# Id offsets of geo terms.
REGION_TERM_OFFSET = 1
NATION_TERM_OFFSET = 100

TERM_TYPE = ("struct<term_id:bigint,slug:string,name:string,parent:bigint,"
             "term_taxonomy_id:bigint,term_order:int,facet:string>")
TERMS_TYPE = f"map<string,array<{TERM_TYPE}>>"
META_TYPE = f"map<string,array<{META_VALUE_TYPE}>>"

POST_COLUMNS = ["id", "post_type", "post_status", "post_title", "post_content", "post_excerpt",
                "post_name", "post_parent", "post_author", "author_name", "post_date", "post_date_gmt",
                "post_modified", "post_mime_type", "post_password", "menu_order", "comment_count",
                "terms", "meta"]
LISTS = ["meta_keys", "term_slugs"]  # what the maps hold, without building their structs


def flat_term_id(taxonomy: str, slug_col: Column) -> Column:
    """Stable positive id of a term in a flat taxonomy (hash of taxonomy and slug)."""
    return F.xxhash64(F.lit(taxonomy), slug_col).bitwiseAND(F.lit(0x7FFFFFFFFFFF)) + F.lit(10_000)


def flat_term_id_py(taxonomy: str, slug_value: str) -> int:
    """Driver-side twin of :func:`flat_term_id` (Spark's xxhash64: XXH64 chained, seed 42)."""
    import xxhash

    h = 42
    for v in (taxonomy, slug_value):
        h = xxhash.xxh64_intdigest(v.encode("utf-8"), seed=h & 0xFFFFFFFFFFFFFFFF)
    return (h & 0x7FFFFFFFFFFF) + 10_000


def term_struct(term_id: Column, slug: Column, name: Column, parent: Column | None = None,
                term_order: Column | None = None) -> Column:
    """DOC-5: term struct; ``facet`` is the JSON of the term with term_order 0."""
    parent = parent if parent is not None else F.lit(0).cast("bigint")
    order = term_order if term_order is not None else F.lit(0)
    base = [term_id.cast("bigint").alias("term_id"), slug.alias("slug"), name.alias("name"),
            parent.cast("bigint").alias("parent"), term_id.cast("bigint").alias("term_taxonomy_id")]
    facet = F.to_json(F.struct(*base, F.lit(0).alias("term_order")))
    return F.struct(*base, order.cast("int").alias("term_order"), facet.alias("facet"))


def flat_term(taxonomy: str, name: Column) -> Column:
    s = T.slug(name)
    return term_struct(flat_term_id(taxonomy, s), s, name)


def _posts_frame(df: DataFrame, meta_pairs: list[tuple[str, Column]], **cols: Column) -> DataFrame:
    """The columns of a post and :data:`LISTS`: the keys that its meta map really has, its terms' slugs per taxonomy.

    ``terms`` and ``meta`` are of the view's types as they are built. They get no cast: behind one, Catalyst
    would no longer see the map and its structs, and a query of one key or field would compute all of them.
    """
    defaults = {
        "post_title": F.lit(""), "post_content": F.lit(""), "post_excerpt": F.lit(""),
        "post_name": F.lit(""), "post_parent": F.lit(0).cast("bigint"), "post_author": F.lit(0).cast("bigint"),
        "author_name": F.lit(""), "post_status": F.lit("publish"),
        "post_mime_type": F.lit(""), "post_password": F.lit(""), "menu_order": F.lit(0),
        "comment_count": F.lit(0), "terms": F.create_map().cast(TERMS_TYPE),
        "meta": build_meta(meta_pairs), "meta_keys": meta_keys(meta_pairs),
        "term_slugs": F.create_map().cast("map<string,array<string>>"),
    }
    defaults.update(cols)
    if "post_date_gmt" not in cols:
        defaults["post_date_gmt"] = defaults["post_date"]
    if "post_modified" not in cols:
        defaults["post_modified"] = defaults["post_date"]
    types = {"id": "bigint", "post_parent": "bigint", "post_author": "bigint", "menu_order": "int",
             "comment_count": "int", "post_date": "timestamp_ntz", "post_date_gmt": "timestamp_ntz",
             "post_modified": "timestamp_ntz"}
    built = ("terms", "meta", *LISTS)
    return df.select(*[(defaults[c] if c in built else defaults[c].cast(types.get(c, "string"))).alias(c)
                       for c in (*POST_COLUMNS, *LISTS)])


def products(t: Tables) -> DataFrame:
    """part -> product posts (price and size meta; brand, ptype and word tags)."""
    p = t.part
    name = F.col("p_name")
    words = F.array_distinct(T.tokens(name))
    tags = F.transform(words, lambda w: flat_term("post_tag", w))
    return _posts_frame(
        p,
        id=F.col("p_partkey"), post_type=F.lit("product"), post_title=name, post_content=name,
        post_name=F.concat_ws("-", T.slug(name), F.col("p_partkey").cast("string")),
        post_date=F.timestamp_add("HOUR", F.col("p_partkey"), F.lit("2023-01-01 00:00:00").cast("timestamp_ntz")),
        menu_order=F.col("p_size"),
        terms=F.create_map(F.lit("brand"), F.array(flat_term("brand", F.col("p_brand"))),
                           F.lit("ptype"), F.array(flat_term("ptype", F.col("p_type"))),
                           F.lit("post_tag"), tags),
        term_slugs=F.create_map(F.lit("brand"), F.array(T.slug(F.col("p_brand"))), F.lit("ptype"), F.array(T.slug(F.col("p_type"))),
                                F.lit("post_tag"), F.transform(words, T.slug)),
        meta_pairs=[("_price", F.col("p_retailprice")), ("size", F.col("p_size")),
                    ("_sku", F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string"))),
                    ("label", name)],
    )


def doc_posts(t: Tables) -> DataFrame:
    """documents (+ labels as meta) -> posts. toxic=1 stands for a password."""
    d = t.documents.join(t.labels, "doc_id", "left")
    return _posts_frame(
        d,
        id=F.col("doc_id") + F.lit(DOC_ID_OFFSET), post_type=F.lit("post"),
        post_title=T.first_line(F.col("text")), post_content=F.col("text"),
        post_name=F.concat(F.lit("doc-"), F.col("doc_id").cast("string")),
        post_date=F.timestamp_add("HOUR", F.col("doc_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")),
        post_mime_type=F.concat(F.lit("text/"), F.col("source")),
        post_password=F.when(F.col("toxic") == 1, F.lit("protected")).otherwise(F.lit("")),
        terms=F.create_map(F.lit("lang"), F.array(flat_term("lang", F.col("lang"))),
                           F.lit("source"), F.array(flat_term("source", F.col("source")))),
        term_slugs=F.create_map(F.lit("lang"), F.array(T.slug(F.col("lang"))), F.lit("source"), F.array(T.slug(F.col("source")))),
        meta_pairs=[("quality", F.col("quality")), ("toxic", F.col("toxic")), ("n_chars", F.col("n_chars"))],
    )


def page_posts(t: Tables) -> DataFrame:
    """pages -> page posts with the stripped HTML as content."""
    pg = t.pages
    return _posts_frame(
        pg,
        id=F.col("page_id") + F.lit(PAGE_ID_OFFSET), post_type=F.lit("page"),
        post_title=T.html_title(F.col("html")), post_content=T.strip_html(F.col("html")),
        post_name=F.concat(F.lit("page-"), F.col("page_id").cast("string")),
        post_date=F.timestamp_add("HOUR", F.col("page_id"), F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")),
        post_mime_type=F.lit("text/html"), meta_pairs=[],
    )


def order_posts(t: Tables) -> DataFrame:
    """orders -> shop_order posts (status, customer as author, total as meta)."""
    o = t.orders
    return _posts_frame(
        o,
        id=F.col("o_orderkey") + F.lit(ORDER_ID_OFFSET), post_type=F.lit("shop_order"),
        post_status=F.col("o_orderstatus"),
        post_title=F.concat(F.lit("Order #"), F.col("o_orderkey").cast("string")),
        post_name=F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")),
        post_author=F.col("o_custkey"), post_date=F.col("o_orderdate"),
        meta_pairs=[("_total", F.col("o_totalprice")), ("_priority", F.col("o_orderpriority"))],
    )


def v_posts(spark: SparkSession, sf_dir: str, types: list[str] | None = None, lists: bool = False) -> DataFrame:
    """All post-like objects. ``types`` restricts which families are read; ``lists`` adds :data:`LISTS`."""
    t = Tables(spark, sf_dir)
    parts = {"product": products, "post": doc_posts, "page": page_posts, "shop_order": order_posts}
    frames = [fn(t) for k, fn in parts.items() if types is None or k in types]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out if lists else out.drop(*LISTS)


def post_type_of(post_id: Column) -> Column:
    """The post type that an id of :func:`v_posts` belongs to."""
    return (F.when(post_id >= ORDER_ID_OFFSET, "shop_order").when(post_id >= PAGE_ID_OFFSET, "page")
            .when(post_id >= DOC_ID_OFFSET, "post").otherwise("product"))


def v_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms: geo (regions, nations with region parents), brand and ptype (flat).

    ``count`` = number of objects directly carrying the term (customers for geo,
    parts for brand/ptype), as the source system stores it.
    """
    t = Tables(spark, sf_dir)
    cols = ["term_id", "term_taxonomy_id", "taxonomy", "name", "slug", "description", "parent", "count",
            "term_group"]

    def frame(df, term_id, taxonomy, name, parent, count, description):
        return df.select(term_id.cast("bigint").alias("term_id"), term_id.cast("bigint").alias("term_taxonomy_id"),
                         F.lit(taxonomy).alias("taxonomy"), name.alias("name"), T.slug(name).alias("slug"),
                         description.alias("description"), parent.cast("bigint").alias("parent"),
                         count.cast("bigint").alias("count"), F.lit(0).cast("bigint").alias("term_group"))

    regions = frame(t.region, F.col("r_regionkey") + REGION_TERM_OFFSET, "geo", F.col("r_name"), F.lit(0),
                    F.lit(0), F.concat(F.lit("Region "), F.col("r_name")))
    per_nation = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    nations = frame(t.nation.join(per_nation, F.col("n_nationkey") == F.col("c_nationkey"), "left"),
                    F.col("n_nationkey") + NATION_TERM_OFFSET, "geo", F.col("n_name"),
                    F.col("n_regionkey") + REGION_TERM_OFFSET, F.coalesce(F.col("n"), F.lit(0)),
                    F.concat(F.lit("Nation "), F.col("n_name")))
    out = regions.unionByName(nations)
    for place, (tax, col) in enumerate((("brand", "p_brand"), ("ptype", "p_type"))):
        g = t.part.groupBy(col).agg(F.count("*").alias("n"))
        out = out.unionByName(frame(g, flat_term_id(tax, T.slug(F.col(col))), tax, F.col(col), F.lit(0),
                                    F.col("n"), F.concat(F.lit(f"{tax} "), F.col(col))))
    kind = F.when(F.col("taxonomy") != "geo", F.col("taxonomy")).when(F.col("parent") == 0, "region") \
        .otherwise("nation")
    meta = build_meta([("kind", kind), ("objects", F.col("count"))])
    return out.select(*cols, meta.alias("meta"))


def v_term_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(object_id, object_type, term_taxonomy_id, taxonomy, term_order); places 0 to 3 for geo terms, 0 and 1 for brand and type."""
    t = Tables(spark, sf_dir)
    cust = t.customer.select(F.col("c_custkey").alias("object_id"), F.lit("customer").alias("object_type"),
                             (F.col("c_nationkey") + NATION_TERM_OFFSET).cast("bigint").alias("term_taxonomy_id"),
                             F.lit("geo").alias("taxonomy"), (F.col("c_custkey") % 4).cast("int").alias("term_order"))
    supp = t.supplier.select(F.col("s_suppkey").alias("object_id"), F.lit("supplier").alias("object_type"),
                             (F.col("s_nationkey") + NATION_TERM_OFFSET).cast("bigint").alias("term_taxonomy_id"),
                             F.lit("geo").alias("taxonomy"), (F.col("s_suppkey") % 4).cast("int").alias("term_order"))
    out = cust.unionByName(supp)
    for place, (tax, col) in enumerate((("brand", "p_brand"), ("ptype", "p_type"))):
        out = out.unionByName(t.part.select(
            F.col("p_partkey").alias("object_id"), F.lit("product").alias("object_type"),
            flat_term_id(tax, T.slug(F.col(col))).alias("term_taxonomy_id"), F.lit(tax).alias("taxonomy"),
            F.lit(place).alias("term_order")))
    return out


def v_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as comments; each turn replies to the previous one."""
    c = Tables(spark, sf_dir).conversations
    cid = F.col("conv_id") * F.lit(TURNS) + F.col("turn") + 1  # ids start at 1: 0 means "no parent"
    return c.select(
        cid.cast("bigint").alias("comment_ID"),
        (F.col("conv_id") + DOC_ID_OFFSET).cast("bigint").alias("comment_post_ID"),
        F.when(F.col("turn") == 0, F.lit(0)).otherwise(cid - 1).cast("bigint").alias("comment_parent"),
        F.col("role").alias("comment_author"),
        F.concat(F.col("role"), F.lit("@example.com")).alias("comment_author_email"),
        F.concat(F.lit("https://"), F.col("role"), F.lit(".example.com")).alias("comment_author_url"),
        F.col("role").alias("comment_type"),
        F.col("text").alias("comment_content"),
        F.timestamp_add("MINUTE", F.col("turn"),
                        F.timestamp_add("HOUR", F.col("conv_id"),
                                        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))).alias("comment_date_gmt"),
        F.when(F.col("role") == "system", F.lit("0")).otherwise(F.lit("1")).alias("comment_approved"),
        F.col("turn").cast("bigint").alias("comment_karma"),
        F.when(F.col("role") == "user", F.col("conv_id")).otherwise(F.lit(0)).cast("bigint").alias("user_id"),
        build_meta([("length", F.length("text")), ("role", F.col("role"))]).alias("meta"),
    )


def v_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """benchmark items as search queries: (query_id, query) = all tokens of the text."""
    b = Tables(spark, sf_dir).benchmark
    return b.select(F.col("item_id").alias("query_id"),
                    F.array_join(T.tokens(F.col("text")), " ").alias("query"))


def documents_index(spark: SparkSession, sf_dir: str, analyzer: str = "plain"):
    """The postings of documents (title = first line, content = text), analyzed once per session and
    input version and written to the shared checkpoint folder."""
    from contentspark.operators.analysis import unpivot_fields
    from contentspark.operators.search import cached_index

    rows = unpivot_fields(Tables(spark, sf_dir).documents, "doc_id",
                          {"post_title": T.first_line(F.col("text")), "post_content": F.col("text")})
    return cached_index("documents:post_title=first_line(text),post_content=text", rows, analyzer)


def v_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a change feed keyed by user_id: error = delete, else upsert."""
    e = Tables(spark, sf_dir).events
    return e.select(
        F.col("event_id"), F.col("ts"), F.col("user_id").alias("object_id"), F.col("event_type"),
        F.when(F.col("event_type") == "error", F.lit("delete")).otherwise(F.lit("upsert")).alias("op"),
        F.col("value"), F.col("props"),
    )


def v_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events as a failed-request log: duration = value, status = 400 + k % 200."""
    e = Tables(spark, sf_dir).events.filter(F.col("event_type") == "error")
    k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
    return e.select(F.col("event_id").alias("request_id"), F.col("ts"),
                    F.col("value").alias("query_time"),
                    (F.lit(400) + k % 200).cast("int").alias("status_code"),
                    F.col("props").alias("body"), F.col("user_id"))


# The synonym list used by the synonym operators (with one comment
# and one blank line, which parsing must skip).
SYNONYM_LINES = [
    "ring, band",
    "bolt, screw",
    "# hardware words",
    "",
    "gizmo, gadget, widget",
    "gear => cog, wheel",
]

# The field weighting table (post_type, field, enabled, weight, fuzzy).
WEIGHT_ROWS = [
    ("post", "post_title", True, 2, True),
    ("post", "post_content", True, 1, True),
    ("post", "post_excerpt", True, 1, True),
    ("post", "terms.brand.name", True, 3, False),
    ("post", "terms.source.name", False, 0, False),
    ("product", "post_title", True, 5, True),
    ("product", "post_content", False, 1, True),
    ("product", "terms.brand.name", True, 3, False),
    ("page", "post_title", True, 1, True),
    ("page", "post_content", True, 4, True),
]


def v_synonym_lines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(x,) for x in SYNONYM_LINES], "line string")


def v_weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(WEIGHT_ROWS, "post_type string, field string, enabled boolean, weight int, "
                                              "fuzzy boolean")


def v_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated pointers: per benchmark query its 2 smallest phrase-matching documents (else the 2
    smallest document ids) at positions 1 and 3; search term = the query text."""
    from pyspark.sql import Window

    from contentspark.operators.search import phrase

    q = v_queries(spark, sf_dir)
    docs = Tables(spark, sf_dir).documents
    idx = documents_index(spark, sf_dir)
    hits = phrase(q, idx, {"post_content": 1.0}).select("query_id", "doc_id", F.lit(0).alias("prio"))
    smallest = docs.select("doc_id").orderBy("doc_id").limit(2).agg(F.collect_list("doc_id")).scalar()
    fallback = q.select("query_id", F.explode(smallest).alias("doc_id"), F.lit(1).alias("prio"))
    cand = hits.unionByName(fallback).groupBy("query_id", "doc_id").agg(F.min("prio").alias("prio"))
    w = Window.partitionBy("query_id").orderBy("prio", "doc_id")
    top = cand.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= 2)
    return (top.join(q, "query_id")
            .select(F.col("query").alias("search_term"), "doc_id",
                    F.when(F.col("r") == 1, F.lit(1)).otherwise(F.lit(3)).alias("position")))
