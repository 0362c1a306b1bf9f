"""Post filters (FLT), taxonomy (TAX), meta (META) and date (DATE) predicates.

A query is a dictionary of query variables (as callers of the source system
write them); :func:`post_filter` compiles it into one Spark ``Column`` that is
AND-ed into a ``filter``. Nothing is evaluated on the driver: the result is a
Catalyst expression, so top-level conditions (type, status, ids, dates) reach
the Parquet scans as pushed filters, and map/array conditions run inside
whole-stage codegen.

Multi-valued fields follow "any value matches" / "no value matches (missing
included)" semantics through :mod:`contentspark.functions.multivalue`.
"""

from __future__ import annotations

import datetime as _dt
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from contentspark.functions import dates as D
from contentspark.functions.multivalue import and_all, any_match, clean_list, none_match, or_all
from contentspark.functions.text import slug_py, token_phrase_like

# Statuses visible to everyone; extra ones for privileged readers.
PUBLIC_STATUSES = ["publish"]
PROTECTED_STATUSES = ["future", "draft", "pending"]
PRIVATE_STATUSES = ["private"]

# Meta query type -> typed sub-field.
META_TYPE_FIELD = {
    "numeric": "long", "binary": "raw", "char": "raw", "date": "date", "datetime": "datetime",
    "decimal": "double", "signed": "long", "time": "time", "unsigned": "long",
}

TERM_FIELDS = ("term_id", "slug", "name", "term_taxonomy_id")


# ---------------------------------------------------------------- FLT-1..13

def _as_list(v) -> list:
    if v is None:
        return []
    if isinstance(v, str):
        return [x.strip() for x in v.split(",") if x.strip()]
    if isinstance(v, (list, tuple, set)):
        return list(v)
    return [v]


def post_type_filter(post_type: Any = None, searchable_types: list[str] | None = None) -> Column | None:
    """FLT-1/FLT-12: list -> IN; 'any' -> searchable types (or no filter); absent -> 'post'."""
    if post_type is None:
        return F.col("post_type") == "post"
    if post_type == "any":
        if searchable_types is None:
            return None
        return F.col("post_type").isin(searchable_types) if searchable_types else F.lit(False)
    return F.col("post_type").isin(_as_list(post_type))


def post_status_filter(post_status: Any = None, logged_in: bool = False, admin: bool = False) -> Column | None:
    """FLT-2: comma string or list; 'any' -> public (+ protected for admins, + private when logged in)."""
    if post_status is None:
        return None
    if post_status == "any":
        allowed = list(PUBLIC_STATUSES)
        if admin:
            allowed += PROTECTED_STATUSES
        if logged_in:
            allowed += PRIVATE_STATUSES
        return F.col("post_status").isin(allowed)
    return F.col("post_status").isin(_as_list(post_status))


def author_filter(author=None, author_name=None, author__in=None, author__not_in=None) -> Column | None:
    """FLT-8: first present wins: author > author_name > author__in > author__not_in."""
    if author not in (None, "", 0):
        return F.col("post_author") == int(author)
    if author_name:
        return F.col("author_name") == author_name
    if clean_list(author__in):
        return F.col("post_author").isin(clean_list(author__in))
    if clean_list(author__not_in):
        return ~F.coalesce(F.col("post_author").isin(clean_list(author__not_in)), F.lit(False))
    return None


def mime_type_filter(mime) -> Column | None:
    """FLT-9: a string is a plain prefix ('imag' and 'image' match 'image/png'), '' no filter; list
    entries match exactly, or as a family when they hold no slash ('image', 'image/*')."""
    if mime is None or mime == "":
        return None
    col = F.col("post_mime_type")
    if isinstance(mime, str):
        return col.startswith(mime)
    conds = []
    for m in mime:
        if m.endswith("/*"):
            conds.append(col.startswith(m[:-1]))
        elif "/" not in m:
            conds.append((col == m) | col.startswith(m + "/"))
        else:
            conds.append(col == m)
    return or_all(conds)


def in_filter(column: str, values, negate: bool = False) -> Column | None:
    vals = clean_list(values)
    if not vals:
        return None
    c = F.col(column).isin(vals)
    return ~F.coalesce(c, F.lit(False)) if negate else c


# ---------------------------------------------------------------- TAX-1..7

def _term_values(taxonomy: str, field: str) -> Column:
    return F.transform(F.col("terms")[taxonomy], lambda t: t[field])


def tax_clause(clause: dict) -> Column | None:
    """One taxonomy clause: IN / NOT IN / AND / EXISTS / NOT EXISTS on a term field."""
    taxonomy = clause["taxonomy"]
    field = clause.get("field", "term_id")
    if field == "id":
        field = "term_id"
    if field not in TERM_FIELDS:
        raise ValueError(f"unknown term field {field!r}")
    op = str(clause.get("operator", "IN")).upper()
    arr = F.col("terms")[taxonomy]
    if op == "EXISTS":
        return F.coalesce(F.size(arr) > 0, F.lit(False))
    if op == "NOT EXISTS":
        return ~F.coalesce(F.size(arr) > 0, F.lit(False))
    terms = clause.get("terms", [])
    terms = terms if isinstance(terms, (list, tuple)) else [terms]
    if field == "slug":  # TAX-6
        terms = [slug_py(str(x)) for x in terms]
    if field in ("term_id", "term_taxonomy_id"):
        terms = [int(x) for x in terms]
    values = _term_values(taxonomy, field)
    lit_arr = F.array(*[F.lit(v) for v in terms]) if terms else None
    if op == "IN":
        if not terms:
            return F.lit(False)  # terms on an empty list matches nothing
        return F.coalesce(F.arrays_overlap(values, lit_arr), F.lit(False))
    if op == "NOT IN":
        if not terms:
            return None
        return ~F.coalesce(F.arrays_overlap(values, lit_arr), F.lit(False))
    if op == "AND":
        if not terms:
            return None
        return F.coalesce(F.size(F.array_except(lit_arr, values)) == 0, F.lit(False))
    raise ValueError(f"unknown taxonomy operator {op!r}")


def tax_query(q) -> Column | None:
    """TAX-5: nested clause groups with relation AND/OR (recursive fold)."""
    if q is None:
        return None
    if isinstance(q, dict) and "taxonomy" in q:
        return tax_clause(q)
    if isinstance(q, dict):
        relation = str(q.get("relation", "AND")).upper()
        items = [v for k, v in q.items() if k != "relation"]
    else:
        relation, items = "AND", list(q)
    parts = [c for c in (tax_query(i) for i in items) if c is not None]
    if not parts:
        return None
    return or_all(parts) if relation == "OR" else and_all(parts)


def implicit_tax_args(args: dict, taxonomies: list[str]) -> list[dict]:
    """TAX-7: ``cat`` (ids), ``tag`` / ``category_name`` (slugs) and ``<taxonomy>: slug`` args as IN clauses."""
    out = []
    if args.get("cat") not in (None, "", 0):
        out.append({"taxonomy": "category", "field": "term_id", "terms": _as_list(str(args["cat"]))})
    if args.get("category_name"):
        out.append({"taxonomy": "category", "field": "slug", "terms": _as_list(args["category_name"])})
    if args.get("tag"):
        out.append({"taxonomy": "post_tag", "field": "slug", "terms": _as_list(args["tag"])})
    for tax in taxonomies:
        if args.get(tax):
            out.append({"taxonomy": tax, "field": "slug", "terms": _as_list(args[tax])})
    return out


# ---------------------------------------------------------------- META-1..9

def _meta_path(compare: str, typ: str | None) -> str | None:
    """Typed sub-field a comparison reads (None = the key itself)."""
    if compare in ("exists", "not exists"):
        return None
    if compare in ("=", "!=") and not typ:
        return "raw"
    if compare in ("like", "not like"):
        return "value"
    if typ and typ in META_TYPE_FIELD:
        return META_TYPE_FIELD[typ]
    if compare in (">=", "<=", ">", "<", "between", "not between"):
        return "double"
    return "raw"


def _typed_literal(v, field: str):
    if field in ("double",):
        return float(v)
    if field == "long":
        return int(float(v))
    if field == "date":
        return _dt.date.fromisoformat(str(v)[:10])
    if field == "datetime":
        return D.to_datetime_literal(str(v))
    return str(v)


def meta_clause(clause: dict, meta_col: str = "meta") -> Column | None:
    """One meta clause (META-1..7)."""
    key = clause.get("key")
    if not key:
        return None
    has_value = "value" in clause and clause["value"] is not None
    compare = str(clause.get("compare") or ("=" if has_value else "exists")).lower()
    typ = str(clause["type"]).lower() if clause.get("type") else None
    arr = F.col(meta_col)[key]
    if compare == "exists":
        return F.coalesce(F.size(arr) > 0, F.lit(False))
    if compare == "not exists":
        return ~F.coalesce(F.size(arr) > 0, F.lit(False))
    if not has_value:
        return None
    field = _meta_path(compare, typ)
    arr = arr[field]  # one typed reading of each value: a view that builds the map computes no other
    val = clause["value"]
    if compare in ("like", "not like"):
        pred = lambda x: token_phrase_like(x, str(val))
        return any_match(arr, pred) if compare == "like" else none_match(arr, pred)
    if compare in ("=", "in", "!=", "not in"):
        vals = [_typed_literal(v, field) for v in (val if isinstance(val, (list, tuple)) else [val])]
        pred = lambda x: x.isin(vals)
        return none_match(arr, pred) if compare in ("!=", "not in") else any_match(arr, pred)
    if compare in ("between", "not between"):
        if not isinstance(val, (list, tuple)) or len(val) != 2:
            return None
        lo, hi = (_typed_literal(v, field) for v in val)
        if compare == "between":
            # bounds are tested separately, possibly on different values
            return any_match(arr, lambda x: x >= lo) & any_match(arr, lambda x: x <= hi)
        return any_match(arr, lambda x: x <= lo) | any_match(arr, lambda x: x >= hi)
    ops = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b}
    if compare in ops:
        v = _typed_literal(val, field)
        return any_match(arr, lambda x: ops[compare](x, v))
    raise ValueError(f"unknown meta compare {compare!r}")


def meta_query(q, meta_col: str = "meta") -> Column | None:
    """META-8: nested relation trees."""
    if q is None:
        return None
    if isinstance(q, dict) and "key" in q:
        return meta_clause(q, meta_col)
    if isinstance(q, dict):
        relation = str(q.get("relation", "AND")).upper()
        items = [v for k, v in q.items() if k != "relation"]
    else:
        relation, items = "AND", list(q)
    parts = [c for c in (meta_query(i, meta_col) for i in items) if c is not None]
    if not parts:
        return None
    return or_all(parts) if relation == "OR" else and_all(parts)


def meta_short_form(args: dict) -> dict | None:
    """META-9: ``meta_key`` + ``meta_value``/``meta_value_num`` + ``meta_compare`` as a clause."""
    if not args.get("meta_key"):
        return None
    clause = {"key": args["meta_key"]}
    if args.get("meta_value_num") is not None:
        clause.update(value=args["meta_value_num"], type="numeric")
    elif args.get("meta_value") is not None:
        clause["value"] = args["meta_value"]
    if args.get("meta_compare"):
        clause["compare"] = args["meta_compare"]
    if args.get("meta_type"):
        clause["type"] = args["meta_type"]
    return clause


# ---------------------------------------------------------------- DATE-1..7

PART_ALIASES = {"monthnum": "month", "w": "week", "year": "year", "month": "month", "week": "week",
                "day": "day", "hour": "hour", "minute": "minute", "second": "second",
                "dayofweek": "dayofweek", "dayofweek_iso": "dayofweek_iso", "dayofyear": "dayofyear", "m": "m"}


def _bound(value, inclusive: bool, is_after: bool) -> _dt.datetime:
    """Expand a partial before/after argument to the datetime it stands for."""
    # after (exclusive) and before (inclusive) refer to the end of the period
    end = (is_after and not inclusive) or (not is_after and inclusive)
    return D.to_datetime_literal(value, end_of_period=end)


def date_clause(clause: dict, default_column: str = "post_date") -> Column | None:
    """DATE-1..4: parts compared with ``compare``; before/after on the chosen column."""
    col = F.col(clause.get("column", default_column))
    compare = str(clause.get("compare", "=")).upper()
    inclusive = bool(clause.get("inclusive", False))
    conds = []
    for k, v in clause.items():
        if k not in PART_ALIASES or v is None:
            continue
        p = D.part(col, PART_ALIASES[k])
        vals = v if isinstance(v, (list, tuple)) else [v]
        vals = [int(x) for x in vals]
        if compare in ("=",):
            conds.append(p == vals[0])
        elif compare == "!=":
            conds.append(~F.coalesce(p == vals[0], F.lit(False)))
        elif compare == "IN":
            conds.append(p.isin(vals))
        elif compare == "NOT IN":
            conds.append(~F.coalesce(p.isin(vals), F.lit(False)))
        elif compare == "BETWEEN":
            conds.append((p >= vals[0]) & (p <= vals[1]))
        elif compare == "NOT BETWEEN":
            # kept semantics: end points are not excluded, missing dates are kept
            conds.append(~F.coalesce((p > vals[0]) & (p < vals[1]), F.lit(False)))
        elif compare == ">":
            conds.append(p > vals[0])
        elif compare == ">=":
            conds.append(p >= vals[0])
        elif compare == "<":
            conds.append(p < vals[0])
        elif compare == "<=":
            conds.append(p <= vals[0])
        else:
            raise ValueError(f"unknown date compare {compare!r}")
    if clause.get("after") is not None:
        b = _bound(clause["after"], inclusive, True)
        conds.append(col >= F.lit(b).cast("timestamp_ntz") if inclusive else col > F.lit(b).cast("timestamp_ntz"))
    if clause.get("before") is not None:
        b = _bound(clause["before"], inclusive, False)
        conds.append(col <= F.lit(b).cast("timestamp_ntz") if inclusive else col < F.lit(b).cast("timestamp_ntz"))
    return and_all(conds) if conds else None


def date_query(q, default_column: str = "post_date") -> Column | None:
    """DATE-5: AND/OR trees of date clauses (column may be set per group)."""
    if q is None:
        return None
    if isinstance(q, dict):
        own_keys = set(PART_ALIASES) | {"before", "after", "column", "compare", "inclusive", "relation"}
        nested = [v for k, v in q.items() if k not in own_keys and isinstance(v, (dict, list))]
        col = q.get("column", default_column)
        own = {k: v for k, v in q.items() if k in own_keys}
        relation = str(q.get("relation", "AND")).upper()
        parts = []
        if any(k in own for k in list(PART_ALIASES) + ["before", "after"]):
            parts.append(date_clause(own, col))
        parts += [date_query(n, col) for n in nested]
    else:
        relation, col = "AND", default_column
        parts = [date_query(n, col) for n in q]
    parts = [p for p in parts if p is not None]
    if not parts:
        return None
    return or_all(parts) if relation == "OR" else and_all(parts)


def invalid_date_parts(year: Column, month: Column, day: Column, hour: Column | None = None,
                       minute: Column | None = None, second: Column | None = None) -> Column:
    """DATE-6: True when parts break their bounds or do not form a real calendar date."""
    hour = hour if hour is not None else F.lit(0)
    minute = minute if minute is not None else F.lit(0)
    second = second if second is not None else F.lit(0)
    out_of_bounds = ((month < 1) | (month > 12) | (day < 1) | (day > 31) | (hour < 0) | (hour > 23)
                     | (minute < 0) | (minute > 59) | (second < 0) | (second > 59))
    real = F.try_make_timestamp_ntz(year, month, day, hour, minute, second).isNotNull()
    return F.coalesce(out_of_bounds | ~real, F.lit(True))


# ---------------------------------------------------------------- compile

def post_filter(args: dict, searchable_types: list[str] | None = None,
                taxonomies: list[str] | None = None) -> Column:
    """Compile a dictionary of post query variables into one predicate.

    Supported keys: post_type, post_status, post_parent, post_parent__in,
    post_parent__not_in, post__in, post__not_in, post_name__in,
    category__not_in, tag__not_in, author, author_name, author__in,
    author__not_in, post_mime_type, has_password, exclude_flag (key, value),
    tax_query, meta_query, meta_key/meta_value/meta_compare, date_query,
    year/monthnum/w/day/hour/minute/second/m, cat/tag/<taxonomy>, extra.
    """
    conds: list[Column | None] = []
    if "post_type" in args or args.get("default_type", True):
        conds.append(post_type_filter(args.get("post_type"), searchable_types))
    conds.append(post_status_filter(args.get("post_status"), args.get("logged_in", False),
                                    args.get("admin", False)))
    parent = args.get("post_parent")
    if parent is not None and parent != "any" and parent != "":
        conds.append(F.col("post_parent") == int(parent))
    conds.append(in_filter("post_parent", args.get("post_parent__in")))
    conds.append(in_filter("post_parent", args.get("post_parent__not_in"), negate=True))
    conds.append(in_filter("id", args.get("post__in")))
    conds.append(in_filter("id", args.get("post__not_in"), negate=True))
    conds.append(in_filter("post_name", args.get("post_name__in")))
    for arg, tax in (("category__not_in", "category"), ("tag__not_in", "post_tag")):
        ids = clean_list(args.get(arg))
        if ids:
            conds.append(tax_clause({"taxonomy": tax, "terms": ids, "operator": "NOT IN"}))
    conds.append(author_filter(args.get("author"), args.get("author_name"), args.get("author__in"),
                               args.get("author__not_in")))
    conds.append(mime_type_filter(args.get("post_mime_type")))
    if args.get("has_password") is False:  # FLT-10
        conds.append(F.coalesce(F.col("post_password"), F.lit("")) == "")
    elif args.get("has_password") is True:
        conds.append(F.coalesce(F.col("post_password"), F.lit("")) != "")
    if args.get("exclude_flag"):  # FLT-11
        key, val = args["exclude_flag"]
        conds.append(none_match(F.col("meta")[key], lambda x: x["raw"] == str(val)))
    tq = list(implicit_tax_args(args, taxonomies or []))
    if args.get("tax_query") is not None:
        tq.append(args["tax_query"])
    conds.append(tax_query(tq) if tq else None)
    mq = []
    short = meta_short_form(args)
    if short:
        mq.append(short)
    if args.get("meta_query") is not None:
        mq.append(args["meta_query"])
    conds.append(meta_query(mq) if mq else None)
    simple = {k: args[k] for k in ("year", "monthnum", "w", "day", "hour", "minute", "second", "m")
              if args.get(k) is not None}
    if simple:
        conds.append(date_clause(simple))
    conds.append(date_query(args.get("date_query")))
    if args.get("extra") is not None:  # UDF-3: caller-supplied predicate
        conds.append(args["extra"])
    return and_all(c for c in conds if c is not None)
