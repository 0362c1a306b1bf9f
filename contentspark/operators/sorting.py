"""Sort, paging and projection (SRT-1..13, SCR-9, SCR-10).

Sorts compile to one ``orderBy``; with a page window Catalyst plans a
``TakeOrderedAndProject`` (per-partition top-k, no full sort). Multi-valued
keys sort by their min (asc) or max (desc); missing values go last both ways;
the id is always the last key so pages are stable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentspark.functions.text import sortable

# Sort aliases of the query API.
SORT_ALIASES = {
    "relevance": "score", "_score": "score", "score": "score",
    "date": "post_date", "post_date": "post_date", "modified": "post_modified",
    "post_modified": "post_modified", "type": "post_type", "post_type": "post_type",
    "name": "post_name", "post_name": "post_name", "title": "post_title", "post_title": "post_title",
    "id": "id", "ID": "id", "parent": "post_parent", "post_parent": "post_parent",
    "menu_order": "menu_order", "comment_count": "comment_count", "author": "post_author",
}
DEFAULT_PAGE_SIZE = 10
# Author paths and the post columns that hold them.
AUTHOR_PATHS = {"post_author.login": "author_name", "post_author.display_name": "author_name",
                "post_author.raw": "author_name", "post_author.id": "post_author"}


def _direction(col: Column, order: str) -> Column:
    return col.asc_nulls_last() if order.lower() == "asc" else col.desc_nulls_last()


def meta_sort_key(key: str, typ: str, order: str, meta_col: str = "meta") -> Column:
    """SRT-3: multi-valued meta sort key (min for asc, max for desc)."""
    vals = F.transform(F.col(meta_col)[key], lambda x: x[typ])
    return F.array_min(vals) if order.lower() == "asc" else F.array_max(vals)


def path_column(key: str, order: str = "asc") -> Column:
    """SRT-1: a sort alias or document path as a Column.

    ``post_author.login[.sortable]`` and ``post_author.display_name[.sortable]`` read the author
    columns, ``terms.<taxonomy>.<name|slug|term_id>[.sortable]`` the taxonomy's terms (several
    values: the smallest ascending, the largest descending), ``<column>.sortable`` any text column.
    """
    path, folded = (key[: -len(".sortable")], True) if key.endswith(".sortable") else (key, False)
    if path.startswith("terms."):
        _, tax, attribute = path.split(".", 2)
        values = F.transform(F.col("terms")[tax], lambda t: sortable(t[attribute]) if folded else t[attribute])
        return F.array_min(values) if order.lower() == "asc" else F.array_max(values)
    col = AUTHOR_PATHS.get(path) or SORT_ALIASES.get(path, path)
    return sortable(F.col(col).cast("string")) if folded or col == "post_title" else F.col(col)


def sort_columns(orderby=None, order: str = "desc", has_search: bool = False, meta_key: str | None = None,
                 id_col: str = "id") -> list[Column]:
    """SRT-1/2/3/5/7: sort specification -> ordered Columns.

    ``orderby`` may be a space separated string, a list, or a {key: order} dict.
    No orderby: score desc with a search, else date desc. 'none' = id asc.
    """
    if orderby is None or orderby == "":
        spec = [("score" if has_search else "post_date", order)]
    elif isinstance(orderby, dict):
        spec = list(orderby.items())
    elif isinstance(orderby, str):
        spec = [(k, order) for k in orderby.split()]
    else:
        spec = [(k, order) for k in orderby]
    cols = []
    for key, direction in spec:
        direction = str(direction or order)
        if key == "none":
            return [F.col(id_col).asc()]
        if key in ("meta_value", "meta_value_num") or key.startswith("meta_value_"):
            typ = {"meta_value": "raw", "meta_value_num": "double"}.get(key, key[len("meta_value_"):])
            if not meta_key:
                raise ValueError("meta_value sorts need meta_key")
            cols.append(_direction(meta_sort_key(meta_key, typ, direction), direction))
            continue
        if key.startswith("meta."):
            _, k, typ = key.split(".", 2)
            cols.append(_direction(meta_sort_key(k, typ, direction), direction))
            continue
        cols.append(_direction(path_column(key, direction), direction))
    cols.append(F.col(id_col).asc())
    return cols


def sticky_first(sticky_ids: list[int], id_col: str = "id") -> Column:
    """SCR-9: sticky ids sort first."""
    return F.coalesce(F.col(id_col).isin(sticky_ids), F.lit(False)).desc() if sticky_ids else F.lit(0)


def random_key(seed: int, id_col: str = "id") -> Column:
    """SCR-10: deterministic random order (hash of seed and id)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def page_window(page: int | None = None, per_page: int | None = None, offset: int | None = None
                ) -> tuple[int, int | None]:
    """SRT-8: (offset, size). page overrides offset; negatives -> 0; size -1 is all rows (None)."""
    size = DEFAULT_PAGE_SIZE if per_page is None else int(per_page)
    if size == -1:
        return (0 if page and int(page) > 0 else max(int(offset or 0), 0)), None
    size = max(size, 0)
    if page is not None and int(page) > 0:
        off = (int(page) - 1) * size
    else:
        off = max(int(offset or 0), 0)
    return off, size


def paginate(df: DataFrame, cols: list[Column], page=None, per_page=None, offset=None) -> DataFrame:
    """Sorted page of ``df``; the page is a prefix-free slice of the full order."""
    off, size = page_window(page, per_page, offset)
    out = df.orderBy(*cols)
    if off:
        out = out.offset(off)
    return out if size is None else out.limit(size)


def total_count(df: DataFrame) -> Column:
    """SRT-9: total as a scalar subquery (a distributed count, no global window)."""
    return df.select(F.count(F.lit(1)).cast("bigint")).scalar()


def with_total(df: DataFrame, page: DataFrame | None = None, size: int | None = None) -> DataFrame:
    """SRT-9: attach ``found`` (and ``max_pages`` = ceil(found/size)) to ``page`` rows."""
    out = (page if page is not None else df).withColumn("found", total_count(df))
    if size:
        out = out.withColumn("max_pages", F.ceil(F.col("found") / F.lit(size)).cast("bigint"))
    return out


def top_k_per_group(df: DataFrame, group: str | list[str], order: list[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """SRT-10: k best rows per group (``row_number``; Catalyst adds a WindowGroupLimit)."""
    w = Window.partitionBy(*([group] if isinstance(group, str) else group)).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def project(df: DataFrame, fields: str = "all", id_col: str = "id", parent_col: str = "post_parent") -> DataFrame:
    """SRT-11: 'ids', 'id=>parent' or all columns."""
    if fields == "ids":
        return df.select(id_col)
    if fields == "id=>parent":
        return df.select(id_col, parent_col)
    return df


def resolve_meta_orderby(orderby: str, meta_query) -> str:
    """SRT-4: an orderby naming a meta_query clause (or its key) -> 'meta.<key>.<typed field>'."""
    from contentspark.operators.predicates import META_TYPE_FIELD

    def clauses(q):
        if isinstance(q, dict):
            if "key" in q:
                yield None, q
            for k, v in q.items():
                if isinstance(v, dict) and "key" in v:
                    yield k, v
                elif isinstance(v, (dict, list)):
                    yield from clauses(v)
        elif isinstance(q, list):
            for v in q:
                yield from clauses(v)

    for name, c in clauses(meta_query):
        if orderby in (name, c.get("key")):
            typ = META_TYPE_FIELD.get(str(c.get("type", "")).lower(), "raw")
            return f"meta.{c['key']}.{typ}"
    return orderby
