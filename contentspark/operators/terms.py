"""Term queries (TRM-1..12) over a term table enriched by :func:`hierarchy.with_hierarchy`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentspark.functions.multivalue import and_all, clean_list
from contentspark.operators.fields import field_column
from contentspark.functions.text import py_tokens, slug_py, sortable, tokens

# Fields a term search looks at by default.
TERM_SEARCH_FIELDS = ["name", "slug", "taxonomy", "description"]


def text_match_all(fields: list[str], text: str) -> Column:
    """Every query token occurs in some field (cross-fields AND, plain analyzer).

    Fields are columns or document paths such as ``meta.<key>.value``."""
    q = py_tokens(text)
    if not q:
        return F.lit(True)
    bag = F.array_distinct(F.flatten(F.array(*[F.coalesce(tokens(field_column(f)), F.array().cast("array<string>"))
                                               for f in fields])))
    return F.coalesce(F.size(F.array_except(F.array(*[F.lit(t) for t in q]), bag)) == 0, F.lit(False))


def term_filter(args: dict, objects: DataFrame | None = None) -> Column:
    """Compile term query variables into one predicate.

    taxonomy, include / exclude (exclude ignored when include given),
    exclude_tree, name, slug, term_taxonomy_id, hide_empty (+ hierarchical),
    child_of, parent, childless, search / name__like / description__like.
    """
    conds = []
    tax = args.get("taxonomy")
    if tax:
        conds.append(F.col("taxonomy").isin(tax if isinstance(tax, (list, tuple)) else [tax]))
    inc = clean_list(args.get("include"))
    if inc:
        conds.append(F.col("term_id").isin(inc))
    else:
        exc = clean_list(args.get("exclude"))
        if exc:
            conds.append(~F.col("term_id").isin(exc))
        tree = clean_list(args.get("exclude_tree"))
        if tree:
            conds.append(~F.col("term_id").isin(tree) & ~F.coalesce(F.col("parent").isin(tree), F.lit(False)))
    if args.get("name"):
        names = args["name"] if isinstance(args["name"], (list, tuple)) else [args["name"]]
        conds.append(F.col("name").isin(list(names)))
    if args.get("slug"):
        slugs = args["slug"] if isinstance(args["slug"], (list, tuple)) else [args["slug"]]
        conds.append(F.col("slug").isin([slug_py(s) for s in slugs]))
    if clean_list(args.get("term_taxonomy_id")):
        conds.append(F.col("term_taxonomy_id").isin(clean_list(args["term_taxonomy_id"])))
    if args.get("hide_empty"):
        nonempty = F.col("count") >= 1
        if args.get("hierarchical", True):
            nonempty = nonempty | (F.col("children_count") >= 1)
        conds.append(nonempty)
    if args.get("child_of") not in (None, 0, ""):
        conds.append(F.array_contains(F.col("ancestors"), int(args["child_of"])))
    if args.get("parent") is not None and args.get("parent") != "":
        conds.append(F.col("parent") == int(args["parent"]))
    if args.get("childless"):
        conds.append(F.col("n_descendants") == 0)
    search, fields = args.get("search"), list(TERM_SEARCH_FIELDS)
    if args.get("name__like"):
        search, fields = args["name__like"], ["name"]
    if args.get("description__like"):
        search = args["description__like"]
        fields = (fields if args.get("name__like") else []) + ["description"]
        if fields == TERM_SEARCH_FIELDS + ["description"]:
            fields = ["description"]
    if search:
        conds.append(text_match_all(fields, search))
    if args.get("extra") is not None:
        conds.append(args["extra"])
    return and_all(conds)


def terms_of_objects(terms: DataFrame, relationships: DataFrame, object_ids: list[int] | DataFrame) -> DataFrame:
    """TRM-2: terms carried by the given objects (semi join through relationships)."""
    rel = relationships
    if isinstance(object_ids, DataFrame):
        rel = rel.join(object_ids.select("object_id"), "object_id", "left_semi")
    else:
        rel = rel.filter(F.col("object_id").isin(list(object_ids)))
    return terms.join(rel.select(F.col("term_taxonomy_id")).distinct(), "term_taxonomy_id", "left_semi")


# Term sort keys.
TERM_SORTS = {"name": "name", "slug": "slug", "id": "term_id", "term_id": "term_id",
              "description": "description", "count": "count", "term_group": "term_group", "parent": "parent"}


def term_sort(orderby: str = "name", order: str = "asc") -> list[Column]:
    """TRM-11: sort keys (name and description normalized), id as tie-break.

    ``meta.<key>.<type>`` sorts by that reading of a meta key (the smallest value ascending, the
    largest descending; terms without it last).
    """
    if orderby.startswith("meta."):
        from contentspark.operators.sorting import meta_sort_key

        key, typ = orderby[len("meta."):].rsplit(".", 1)
        c = meta_sort_key(key, typ, order)
    else:
        col = TERM_SORTS.get(orderby, orderby)
        c = sortable(F.col(col)) if col in ("name", "description") else F.col(col)
    c = c.asc_nulls_last() if order.lower() == "asc" else c.desc_nulls_last()
    return [c, F.col("term_id").asc()]


def term_fields(df: DataFrame, fields: str = "all") -> DataFrame:
    """TRM-12: ids, id=>name, id=>parent, id=>slug, names, tt_ids, count, all."""
    sel = {"ids": ["term_id"], "id=>name": ["term_id", "name"], "id=>parent": ["term_id", "parent"],
           "id=>slug": ["term_id", "slug"], "names": ["name"], "tt_ids": ["term_taxonomy_id"]}
    if fields == "count":
        return df.agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    if fields in sel:
        return df.select(*sel[fields])
    return df
