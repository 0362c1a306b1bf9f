"""Comment queries (CMT-1..13).

:func:`comment_filter` compiles comment query variables into one predicate;
parent-post conditions (CMT-7) are a semi join with the filtered post ids, so
only keys cross the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentspark.functions.multivalue import and_all, clean_list, or_all
from contentspark.operators import predicates as P
from contentspark.operators.sorting import meta_sort_key
from contentspark.operators.terms import text_match_all

# Comment search fields.
COMMENT_SEARCH_FIELDS = ["comment_author", "comment_author_email", "comment_author_url", "comment_content"]
# Status names.
STATUS_VALUES = {"hold": "0", "approve": "1", "spam": "spam", "trash": "trash"}


def _in(col: str, values, negate: bool = False) -> Column | None:
    vals = clean_list(values)
    if not vals:
        return None
    c = F.col(col).isin(vals)
    return ~F.coalesce(c, F.lit(False)) if negate else c


def comment_filter(args: dict) -> Column:
    """Compile comment query variables.

    author_email, author_url, user_id, author__in / author__not_in (user ids),
    comment__in / comment__not_in, date_query, karma, parent / parent__in /
    parent__not_in, hierarchical (top level only), search (+ search_fields: columns
    or ``meta.<key>.value`` paths in place of the default fields), status (+
    include_unapproved), type / type__in / type__not_in, meta_query.
    """
    conds: list[Column | None] = []
    if args.get("author_email"):
        conds.append(F.col("comment_author_email") == args["author_email"])
    if args.get("author_url"):
        conds.append(F.col("comment_author_url") == args["author_url"])
    if args.get("user_id") is not None:
        conds.append(F.col("user_id") == int(args["user_id"]))
    conds.append(_in("user_id", args.get("author__in")))
    conds.append(_in("user_id", args.get("author__not_in"), negate=True))
    conds.append(_in("comment_ID", args.get("comment__in")))
    conds.append(_in("comment_ID", args.get("comment__not_in"), negate=True))
    if args.get("date_query") is not None:
        conds.append(P.date_query(args["date_query"], default_column="comment_date_gmt"))
    if args.get("karma") is not None and args.get("karma") != "":
        conds.append(F.col("comment_karma") == int(args["karma"]))  # 0 is a value
    if args.get("parent") is not None and args.get("parent") != "":
        conds.append(F.col("comment_parent") == int(args["parent"]))
    parents_in = args.get("parent__in")
    if parents_in:
        conds.append(F.col("comment_parent").isin([int(x) for x in parents_in]))
    conds.append(_in("comment_parent", args.get("parent__not_in"), negate=True))
    if args.get("hierarchical"):
        conds.append(F.col("comment_parent") == 0)
    if args.get("search"):
        conds.append(text_match_all(args.get("search_fields") or COMMENT_SEARCH_FIELDS, args["search"]))
    status = args.get("status")
    if status is not None and status != "all":
        vals = status if isinstance(status, (list, tuple)) else [status]
        st = F.col("comment_approved").isin([STATUS_VALUES.get(str(v), str(v)) for v in vals])
        inc = args.get("include_unapproved")
        if inc:
            ids = [x for x in inc if isinstance(x, int)]
            emails = [x for x in inc if isinstance(x, str)]
            extra = [F.col("user_id").isin(ids)] if ids else []
            extra += [F.col("comment_author_email").isin(emails)] if emails else []
            st = st | or_all(extra)
        conds.append(st)
    ctype = args.get("type")
    if ctype:
        conds.append(F.col("comment_type").isin(ctype if isinstance(ctype, (list, tuple)) else [ctype]))
    conds.append(_in("comment_type", args.get("type__in")))
    conds.append(_in("comment_type", args.get("type__not_in"), negate=True))
    if args.get("meta_query") is not None:
        conds.append(P.meta_query(args["meta_query"]))
    if args.get("extra") is not None:
        conds.append(args["extra"])
    return and_all(c for c in conds if c is not None)


def with_post_filter(comments: DataFrame, posts: DataFrame, post_args: dict) -> DataFrame:
    """CMT-7: keep comments whose parent post satisfies ``post_args``.

    Supported: post_author / post_author__in / post_author__not_in, post_id,
    post__in / post__not_in, post_status, post_type, post_name, post_parent.
    """
    conds = []
    m = {"post_author": "post_author", "post_id": "id", "post_status": "post_status", "post_type": "post_type",
         "post_name": "post_name", "post_parent": "post_parent"}
    for arg, col in m.items():
        v = post_args.get(arg)
        if v is None or v == "":
            continue
        conds.append(F.col(col).isin(list(v)) if isinstance(v, (list, tuple)) else (F.col(col) == v))
    for arg, col, neg in (("post_author__in", "post_author", False), ("post_author__not_in", "post_author", True),
                          ("post__in", "id", False), ("post__not_in", "id", True)):
        c = _in(col, post_args.get(arg), neg)
        if c is not None:
            conds.append(c)
    keep = posts.filter(and_all(conds)).select(F.col("id").alias("comment_post_ID"))
    return comments.join(keep, "comment_post_ID", "left_semi")


def comment_sort(orderby: str | None = None, order: str = "desc") -> list[Column]:
    """CMT-11: default comment_date_gmt desc; raw column names and ``meta.<key>.<type>`` (a reading
    of a meta key; comments without it last) allowed; id tie-break."""
    if orderby and orderby.startswith("meta."):
        key, typ = orderby[len("meta."):].rsplit(".", 1)
        c = meta_sort_key(key, typ, order)
        return [c.asc_nulls_last() if order.lower() == "asc" else c.desc_nulls_last(), F.col("comment_ID").asc()]
    col = {None: "comment_date_gmt", "": "comment_date_gmt", "comment_date": "comment_date_gmt",
           "comment_ID": "comment_ID", "id": "comment_ID"}.get(orderby, orderby)
    c = F.col(col)
    return [c.asc_nulls_last() if order.lower() == "asc" else c.desc_nulls_last(), F.col("comment_ID").asc()]
