"""Commerce queries (COM-1..8) and the argument sets of instant results / order search (SRT-12/13).

Everything compiles to the same predicate and sort builders as posts; product
popularity and rating are per-product aggregates joined in (a shuffle on the
product key with map-side partial aggregation of the sales lines).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentspark.functions.multivalue import and_all
from contentspark.functions.text import py_tokens, slug_py, tokens
from contentspark.operators import predicates as P
from contentspark.operators.sorting import sort_columns

# Product sort keys -> (path, order); the date is the tie-break.
PRODUCT_SORTS = {
    "price": ("meta._price.double", "asc"),
    "price-desc": ("meta._price.double", "desc"),
    "popularity": ("meta.total_sales.long", "desc"),
    "rating": ("meta.average_rating.double", "desc"),
    "date": ("post_date", "desc"),
    "title": ("title", "asc"),
    "id": ("id", "asc"),
    "sku": ("meta._sku.raw", "asc"),
    "menu_order": ("menu_order", "asc"),
}
# Product query arguments -> taxonomy (our product taxonomies).
PRODUCT_TAX_ARGS = {"product_cat": "brand", "product_type": "ptype", "product_tag": "post_tag",
                    "product_visibility": "product_visibility"}


def price_filter(min_price=None, max_price=None) -> Column | None:
    """COM-1: closed price range on the ``_price`` double reading."""
    conds = []
    if min_price is not None:
        conds.append(P.meta_clause({"key": "_price", "value": min_price, "compare": ">=", "type": "DECIMAL"}))
    if max_price is not None:
        conds.append(P.meta_clause({"key": "_price", "value": max_price, "compare": "<=", "type": "DECIMAL"}))
    return and_all(conds) if conds else None


def product_sort(orderby: str) -> list[Column]:
    """COM-2/3: product sort with date (desc) as tie-break, then id."""
    path, order = PRODUCT_SORTS.get(orderby, PRODUCT_SORTS["date"])
    cols = sort_columns({path: order})[:-1]
    if path != "post_date":
        cols.append(F.col("post_date").desc_nulls_last())
    return cols + [F.col("id").asc()]


def product_tax_filter(args: dict, relation: str = "and") -> Column | None:
    """COM-4: product taxonomy / attribute args as slug IN clauses."""
    clauses = []
    for arg, tax in PRODUCT_TAX_ARGS.items():
        if args.get(arg):
            vals = args[arg] if isinstance(args[arg], (list, tuple)) else str(args[arg]).split(",")
            clauses.append({"taxonomy": tax, "field": "slug", "terms": [slug_py(v) for v in vals]})
    for k, v in args.items():
        if k.startswith("pa_") and v:
            vals = v if isinstance(v, (list, tuple)) else str(v).split(",")
            clauses.append({"taxonomy": k, "field": "slug", "terms": [slug_py(x) for x in vals]})
    if not clauses:
        return None
    return P.tax_query({"relation": relation.upper(), **{str(i): c for i, c in enumerate(clauses)}})


def visibility_exclusion(hide_out_of_stock: bool = False) -> Column:
    """COM-5: hide products flagged exclude-from-search (and out-of-stock ones when asked)."""
    terms = ["exclude-from-search"] + (["outofstock"] if hide_out_of_stock else [])
    return P.tax_clause({"taxonomy": "product_visibility", "field": "slug", "terms": terms, "operator": "NOT IN"})


def product_list_filter(virtual=None, downloadable=None, stock_status=None) -> Column | None:
    """COM-6: virtual / downloadable / stock status meta filters."""
    conds = []
    if virtual is not None:
        conds.append(P.meta_clause({"key": "_virtual", "value": "yes" if virtual else "no"}))
    if downloadable is not None:
        conds.append(P.meta_clause({"key": "_downloadable", "value": "yes" if downloadable else "no"}))
    if stock_status:
        conds.append(P.meta_clause({"key": "_stock_status", "value": stock_status, "compare": "IN"}))
    return and_all(conds) if conds else None


def search_with_children(parents: DataFrame, key: str, fields: list[str], children: DataFrame, text: str) -> DataFrame:
    """COM-6/7: parents for which every token of ``text`` occurs in one of their fields or in a child's text.

    ``children``: (key, text), e.g. variation SKUs of a product or item names of an order. Only query
    tokens leave the children's scan, so a parent's gathered tokens are at most as many as the query's.
    """
    q = py_tokens(text)
    if not q:
        return parents
    wanted = F.array(*[F.lit(t) for t in q])
    found = children.select(F.col(key).alias("__key"), F.explode(F.array_intersect(tokens(F.col("text")), wanted)).alias("t"))
    found = found.groupBy("__key").agg(F.collect_set("t").alias("__child"))
    none = F.array().cast("array<string>")
    own = F.flatten(F.array(*[F.coalesce(tokens(F.col(f)), none) for f in fields]))
    return (parents.join(found, F.col(key) == F.col("__key"), "left")
            .filter(F.size(F.array_except(wanted, F.concat(own, F.coalesce("__child", none)))) == 0).drop("__key", "__child"))


def order_search_filter(text: str, fields: list[str], id_col: str = "id", id_offset: int = 0) -> Column:
    """COM-7: token match over order fields; a numeric text also matches the order id."""
    from contentspark.operators.terms import text_match_all

    cond = text_match_all(fields, text)
    t = text.strip().lstrip("#")
    if t.isdigit():
        cond = cond | (F.col(id_col) == int(t) + id_offset)
    return cond


def password_exception() -> Column:
    """COM-8: passworded objects are kept only when they are orders."""
    return (F.coalesce(F.col("post_password"), F.lit("")) == "") | (F.col("post_type") == "shop_order")


def with_sales(products: DataFrame, lines: DataFrame, id_col: str = "id") -> DataFrame:
    """Attach total_sales (sum of quantities) and average_rating as meta readings.

    ``lines``: (product_id, quantity, rating) sales lines; aggregated before the join.
    """
    agg = lines.groupBy("product_id").agg(F.sum("quantity").alias("total_sales"),
                                          F.avg("rating").alias("average_rating"))
    from contentspark.functions.meta import typed_value

    out = products.join(agg, products[id_col] == agg.product_id, "left").drop("product_id")
    extra = F.create_map(
        F.lit("total_sales"), F.array(typed_value(F.coalesce(F.col("total_sales"), F.lit(0)).cast("bigint"))),
        F.lit("average_rating"), F.array(typed_value(F.col("average_rating"))))
    extra = F.map_filter(extra, lambda k, v: v[0]["raw"].isNotNull())
    return out.withColumn("meta", F.map_concat("meta", extra)).drop("total_sales", "average_rating")


def instant_results_args(offset=0, per_page=6, orderby="relevance", order="desc", post_types=None, tax=None,
                         relation="and", min_price=None, max_price=None, search=None) -> dict:
    """SRT-12: instant-results arguments -> {'filters': post query vars, 'sort': Columns, 'offset', 'size'}."""
    filters: dict = {"post_type": post_types or ["product"]}
    clauses = [{"taxonomy": t, "field": "slug", "terms": vals} for t, vals in (tax or {}).items() if vals]
    if clauses:
        filters["tax_query"] = {"relation": relation.upper(), **{str(i): c for i, c in enumerate(clauses)}}
    pf = price_filter(min_price, max_price)
    if pf is not None:
        filters["extra"] = pf
    if orderby == "price":
        sort = sort_columns({"meta._price.double": order})
    elif orderby == "date":
        sort = sort_columns({"post_date": order})
    else:
        sort = sort_columns(None, order, has_search=bool(search))
    return {"filters": filters, "sort": sort, "offset": offset, "size": per_page}


def order_search_args(customer=None, m=None, offset=0, per_page=6) -> dict:
    """SRT-13: order search arguments -> post query vars."""
    f: dict = {"post_type": "shop_order"}
    if customer is not None:
        f["author__in"] = customer if isinstance(customer, (list, tuple)) else [customer]
    if m is not None:
        f["m"] = int(m)
    return {"filters": f, "offset": offset, "size": per_page}


