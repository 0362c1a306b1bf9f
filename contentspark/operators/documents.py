"""Document building (DOC-1..21) and sinks (SNK-2..5).

Set-based replacements for per-object document assembly: every related table
is pre-aggregated per object key and then joined once (left joins, so a
missing author or meta leaves empty fields). Multi-valued parts that grow
with the data (objects of a term, variations of a product) are kept in long
form, never gathered into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentspark.functions import dates as D
from contentspark.functions.meta import live_meta, typed_value
from contentspark.functions.text import strip_html

# Attachment MIME types whose text can be extracted.
ATTACHMENT_MIME_TYPES = {
    "pdf": "application/pdf",
    "ppt": "application/vnd.ms-powerpoint",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "xls": "application/vnd.ms-excel",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
}


def sorted_join(order: Column, value: Column, sep: str) -> Column:
    """Aggregate: values joined in ``order`` (use inside ``agg``)."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))),
                                    lambda x: x["v"]), sep)


def post_document(posts: DataFrame, images: DataFrame | None = None, transform=None) -> DataFrame:
    """DOC-1: one nested row per post-like object: author struct, cleaned date and its parts, the live
    typed meta, terms by taxonomy, and the thumbnail of ``images`` (id, thumbnail) where there is one.

    UDF-1: ``transform`` (DataFrame -> DataFrame) changes or adds document columns."""
    name = F.coalesce(F.col("author_name"), F.lit(""))
    author = F.struct(name.alias("raw"), name.alias("login"), name.alias("display_name"), F.col("post_author").alias("id"))
    out = posts.select("id", "post_type", "post_status", "post_title", "post_content", "post_excerpt", "post_name",
                       "post_parent", "menu_order", author.alias("post_author"),
                       D.clean_date(F.col("post_date")).alias("post_date"), D.date_terms(F.col("post_date")).alias("date_terms"),
                       live_meta(F.col("meta")).alias("meta"), "terms")
    if images is not None:
        out = out.join(images, "id", "left")
    return out.transform(transform) if transform is not None else out


def order_items(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """DOC-19: (o_orderkey, items) item names of an order joined with '|' in line order."""
    j = lines.select("l_orderkey", "l_linenumber", "l_partkey").join(
        parts.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey", "left")
    return j.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        sorted_join(F.col("l_linenumber"), F.coalesce(F.col("p_name"), F.lit("")), "|").alias("items"),
        F.count(F.lit(1)).cast("bigint").alias("n_items"))


def order_document(orders: DataFrame, customers: DataFrame, nations: DataFrame, regions: DataFrame,
                   lines: DataFrame, parts: DataFrame, transform=None) -> DataFrame:
    """DOC-1: one nested row per order: author struct, date parts, meta map (total, priority,
    items), geo terms with ancestors. Missing customer -> empty author fields.

    UDF-1: ``transform`` (DataFrame -> DataFrame) changes or adds document columns."""
    items = order_items(lines, parts)
    cust = customers.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    geo = geo_terms(nations, regions)
    d = (orders.join(cust, "o_custkey", "left").join(items, "o_orderkey", "left")
         .join(geo, F.col("c_nationkey") == F.col("nation_key"), "left"))
    author = F.struct(F.coalesce(F.col("c_name"), F.lit("")).alias("raw"),
                      F.coalesce(F.col("c_name"), F.lit("")).alias("login"),
                      F.coalesce(F.col("c_name"), F.lit("")).alias("display_name"),
                      F.col("o_custkey").alias("id"))
    meta = F.create_map(
        F.lit("_total"), F.array(typed_value(F.col("o_totalprice"))),
        F.lit("_priority"), F.array(typed_value(F.col("o_orderpriority"))),
        F.lit("_items"), F.array(typed_value(F.coalesce(F.col("items"), F.lit("")))))
    out = d.select(F.col("o_orderkey").alias("id"), author.alias("post_author"),
                   D.clean_date(F.col("o_orderdate")).alias("post_date"),
                   D.date_terms(F.col("o_orderdate")).alias("date_terms"),
                   F.col("o_orderstatus").alias("post_status"), meta.alias("meta"),
                   F.create_map(F.lit("geo"), F.coalesce(F.col("geo_terms"), F.array())).alias("terms"),
                   F.coalesce(F.col("n_items"), F.lit(0)).alias("n_items"))
    return out.transform(transform) if transform is not None else out


def geo_terms(nations: DataFrame, regions: DataFrame) -> DataFrame:
    """DOC-4/5: per nation the term itself plus its ancestor region, as term structs."""
    from contentspark.functions.text import slug
    from contentspark.sources.views import NATION_TERM_OFFSET, REGION_TERM_OFFSET, term_struct

    r = regions.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    n = nations.join(r, "n_regionkey", "left")
    nation_t = term_struct(F.col("n_nationkey") + NATION_TERM_OFFSET, slug(F.col("n_name")), F.col("n_name"),
                           F.col("n_regionkey") + REGION_TERM_OFFSET)
    region_t = term_struct(F.col("n_regionkey") + REGION_TERM_OFFSET, slug(F.col("r_name")), F.col("r_name"))
    return n.select(F.col("n_nationkey").alias("nation_key"),
                    F.filter(F.array(nation_t, region_t), lambda t: t["name"].isNotNull()).alias("geo_terms"))


def with_ancestor_terms(assignments: DataFrame, closure: DataFrame, terms: DataFrame) -> DataFrame:
    """DOC-4: (object_id, term_id) assignments -> every assigned term plus each ancestor once."""
    anc = closure.select(F.col("id").alias("term_id"), F.col("ancestor").alias("anc_id"))
    up = assignments.join(anc, "term_id").select("object_id", F.col("anc_id").alias("term_id"))
    allt = assignments.select("object_id", "term_id").unionByName(up).distinct()
    return allt.join(terms, "term_id")


def term_order(assignments: DataFrame, relationships: DataFrame) -> DataFrame:
    """DOC-6: term_order per (object, term_taxonomy_id) from the relationships (0 when absent)."""
    r = relationships.select("object_id", "term_taxonomy_id", "term_order")
    return (assignments.join(r, ["object_id", "term_taxonomy_id"], "left")
            .withColumn("term_order", F.coalesce(F.col("term_order"), F.lit(0))))


def meta_allow_auto(meta: Column, exclude: list[str] | None = None, allow_protected: list[str] | None = None) -> Column:
    """DOC-8: public keys minus excluded; '_' keys only when allow-listed."""
    exclude, allow = exclude or [], allow_protected or []
    return F.map_filter(meta, lambda k, v: v.isNotNull() & (~k.startswith("_") | k.isin(allow if allow else [""]))
                        & ~k.isin(exclude if exclude else [""]))


def meta_allow_manual(meta: Column, weighted_keys: list[str], allow_protected: list[str] | None = None) -> Column:
    """DOC-9: only keys that appear in the weighting table, plus allowed protected keys."""
    keep = list(weighted_keys) + list(allow_protected or [])
    return F.map_filter(meta, lambda k, v: v.isNotNull() & k.isin(keep if keep else [""]))


def meta_from_json(js: Column) -> Column:
    """DOC-7/10: a JSON object of raw values -> typed meta map; empty keys dropped."""
    raw = F.from_json(js, "map<string,string>")
    typed = F.transform_values(raw, lambda k, v: F.array(typed_value(v)))
    return F.map_filter(typed, lambda k, v: k != "")


def thumbnail(html: Column) -> Column:
    """DOC-11: first <img> of a page: src, width, height, alt (trimmed, tags stripped)."""
    img = F.regexp_extract(html, r"(?is)<img\b[^>]*>", 0)

    def attr(name):
        return F.nullif(F.regexp_extract(img, rf'(?is)\b{name}\s*=\s*"([^"]*)"', 1), F.lit(""))

    return F.when(img != "", F.struct(attr("src").alias("src"), attr("width").try_cast("int").alias("width"),
                                      attr("height").try_cast("int").alias("height"),
                                      F.trim(strip_html(F.coalesce(attr("alt"), F.lit("")))).alias("alt")))


def plain_text(html: Column) -> Column:
    """DOC-12."""
    return strip_html(html)


def suggest_terms(terms: Column) -> Column:
    """DOC-13: flat list of all term names of a document."""
    return F.flatten(F.transform(F.map_values(terms), lambda arr: F.transform(arr, lambda t: t["name"])))


def redact_protected(df: DataFrame, password_col: str = "post_password",
                     columns=("post_content", "post_content_filtered", "post_content_plain", "price_html")) -> DataFrame:
    """DOC-14: protected documents get blank content columns, an empty meta map and no thumbnail."""
    prot = F.coalesce(F.col(password_col), F.lit("")) != ""
    out = df
    for c in columns:
        if c in df.columns:
            out = out.withColumn(c, F.when(prot, F.lit("")).otherwise(F.col(c)))
    if "meta" in df.columns:
        out = out.withColumn("meta", F.when(prot, F.map_filter("meta", lambda k, v: F.lit(False)))
                             .otherwise(F.col("meta")))
    if "thumbnail" in df.columns:
        out = out.withColumn("thumbnail", F.when(prot, F.lit(None)).otherwise(F.col("thumbnail")))
    return out


def term_objects(relationships: DataFrame) -> DataFrame:
    """DOC-16: (term_taxonomy_id, object_id) long form: all objects carrying a term."""
    return relationships.select("term_taxonomy_id", "object_id").distinct()


def term_document(terms: DataFrame, hierarchy: DataFrame, relationships: DataFrame) -> DataFrame:
    """DOC-15: term + hierarchy summary + number of objects (object ids stay in DOC-16 long form)."""
    n_obj = term_objects(relationships).groupBy(F.col("term_taxonomy_id").alias("term_id")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_objects"))
    h = hierarchy.select("term_id", "ancestors", "n_descendants", "children_count")
    return (terms.join(h, "term_id", "left").join(n_obj, "term_id", "left")
            .withColumn("n_objects", F.coalesce("n_objects", F.lit(0).cast("bigint"))))


def comment_document(comments: DataFrame, posts: DataFrame) -> DataFrame:
    """DOC-17: comment + parent post columns; empty comment_type -> 'comment'."""
    p = posts.select(F.col("id").alias("comment_post_ID"), F.col("post_author").alias("comment_post_author_ID"),
                     F.col("post_status").alias("comment_post_status"), F.col("post_type").alias("comment_post_type"),
                     F.col("post_name").alias("comment_post_name"), F.col("post_parent").alias("comment_post_parent"))
    return (comments.join(p, "comment_post_ID", "left")
            .withColumn("comment_type", F.coalesce(F.nullif(F.col("comment_type"), F.lit("")), F.lit("comment"))))


def attachment_rows(files: DataFrame, parent_of: DataFrame | None = None) -> DataFrame:
    """DOC-18: allowed office/PDF files from ``spark.read.format('binaryFile')`` rows.

    Keeps (path, mime, length) and drops the bytes (text extraction is done by
    an external extractor; see README). ``parent_of`` (path, parent_id) attaches
    files to documents.
    """
    ext = F.lower(F.regexp_extract(F.col("path"), r"\.([A-Za-z0-9]+)$", 1))
    mime = F.element_at(F.create_map(*[x for k, v in ATTACHMENT_MIME_TYPES.items() for x in (F.lit(k), F.lit(v))]),
                        ext)
    out = files.select("path", mime.alias("mime"), "length").filter(F.col("mime").isNotNull())
    return out.join(parent_of, "path", "left") if parent_of is not None else out


def variation_skus(products: DataFrame, parent_col: str, sku_col: str, id_col: str) -> DataFrame:
    """DOC-20: (parent_id, variation_sku) long form (children of a parent product)."""
    return (products.filter(F.col(parent_col).isNotNull() & (F.col(parent_col) != F.col(id_col)))
            .select(F.col(parent_col).alias("parent_id"), F.col(sku_col).alias("variation_sku")))


def order_suggest_terms(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """DOC-21: order number meta plus non-empty billing e-mail, first and last name."""
    c = customers.select(F.col("c_custkey").alias("o_custkey"),
                         F.concat(F.lit("customer"), F.col("c_custkey").cast("string"), F.lit("@example.com"))
                         .alias("billing_email"), F.col("c_mktsegment").alias("billing_first_name"),
                         F.col("c_name").alias("billing_last_name"))
    o = orders.join(c, "o_custkey", "left")
    terms = F.filter(F.array("billing_email", "billing_first_name", "billing_last_name"),
                     lambda x: x.isNotNull() & (x != ""))
    return o.select("o_orderkey", F.col("o_orderkey").cast("string").alias("order_number"),
                    terms.alias("term_suggest"))


# ---------------------------------------------------------------- sinks


def get_by_ids(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """SNK-2: documents whose id is in ``ids`` (semi join; missing ids are simply absent)."""
    return docs.join(ids.select(key).distinct(), key, "left_semi")


def delete_by_ids(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """SNK-3: the table without the deleted ids (anti join); write it back per partition."""
    return docs.join(ids.select(key).distinct(), key, "left_anti")


def json_documents(docs: DataFrame, id_col: str) -> DataFrame:
    """SNK-4: (id, document) with each row as one JSON text."""
    return docs.select(F.col(id_col).alias("id"), F.to_json(F.struct(*[F.col(c) for c in docs.columns])).alias("document"))


def write_documents(docs: DataFrame, path: str, format: str = "parquet") -> None:
    """SNK-4: write documents with Spark's own writers (parquet or json lines)."""
    docs.write.mode("overwrite").format(format).save(path)


def route_oversize(docs: DataFrame, size_col: Column, limit: int) -> DataFrame:
    """SNK-5: rows with ``oversize``, for those that a size-limited consumer gets by another way."""
    return docs.withColumn("oversize", size_col > limit)
