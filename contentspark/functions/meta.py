"""DOC-7: multi-typing of meta values.

Each raw value is expanded into every type it can be read as, so typed
comparisons need no parsing at query time. Values are strings (as stored).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contentspark.functions.dates import parse_datetime

# Strings read as boolean true (case-insensitive, trimmed).
TRUE_STRINGS = ["1", "true", "on", "yes"]
# Default date parts for strings that are not dates; max year.
DEFAULT_DATETIME = "1970-01-01 00:00:01"
MAX_YEAR = 2099
LONG_MAX = 9223372036854775807

META_VALUE_TYPE = ("struct<value:string,raw:string,long:bigint,double:double,boolean:boolean,"
                   "date:date,datetime:timestamp_ntz,time:string>")

NUMERIC_PATTERN = r"^[ \t\n\r]*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\n\r]*$"


def typed_value(raw: Column, is_string: Column | None = None) -> Column:
    """Struct of all typed readings of one raw value.

    ``is_string`` marks values that were strings at the source (only those get
    date readings); by default every non-empty value counts as a string.
    """
    s = raw.cast("string")
    numeric = s.rlike(NUMERIC_PATTERN)
    dbl = F.when(numeric, F.trim(s).try_cast("double"))
    dbl = F.when(F.isnan(dbl) | (F.abs(dbl) == float("inf")), F.lit(0.0)).otherwise(dbl)
    lng = F.when(dbl >= F.lit(float(LONG_MAX)), F.lit(LONG_MAX)).otherwise(
        F.when(dbl >= 0, F.floor(dbl)).otherwise(F.ceil(dbl)).try_cast("bigint"))
    boolean = F.lower(F.trim(F.coalesce(s, F.lit("")))).isin(TRUE_STRINGS)
    string_like = (s.isNotNull() & (s != "")) if is_string is None else (is_string & (s != ""))
    # every accepted format starts with yyyy[-/]MM: skip the parse attempts for other strings
    looks_like_date = F.trim(s).rlike(r"^[0-9]{4}[-/]?[0-9]{2}")
    parsed = F.when(looks_like_date, parse_datetime(F.trim(s))).cast("timestamp_ntz")
    ok = parsed.isNotNull() & (F.year(parsed) <= MAX_YEAR) & (F.year(parsed) > 0)
    default_ts = F.lit(DEFAULT_DATETIME).cast("timestamp_ntz")
    ts = F.when(string_like, F.when(ok, parsed).otherwise(default_ts))
    return F.struct(
        s.alias("value"),
        s.alias("raw"),
        F.when(numeric, lng).alias("long"),
        dbl.alias("double"),
        boolean.alias("boolean"),
        F.to_date(ts).alias("date"),
        ts.alias("datetime"),
        F.date_format(ts, "HH:mm:ss").alias("time"),
    )


def meta_entry(key: str, raw: Column) -> tuple[Column, Column]:
    """(key, array of one typed value) pair for ``create_map``; NULL raw → no value."""
    return F.lit(key), F.when(raw.isNotNull(), F.array(typed_value(raw)))


def build_meta(pairs: list[tuple[str, Column]]) -> Column:
    """Meta map from (key, raw column) pairs; a NULL raw value gives a NULL entry.

    The map stays a plain ``create_map`` so Catalyst rewrites ``meta['k']`` to
    that one entry's expression: a predicate on one key computes only that
    key's typed readings. A NULL entry behaves as a missing key in every
    predicate; code that lists keys goes through :func:`live_meta`.
    """
    if not pairs:
        return F.create_map().cast(f"map<string,array<{META_VALUE_TYPE}>>")
    return F.create_map(*[x for k, c in pairs if k != "" for x in meta_entry(k, c)])


def meta_keys(pairs: list[tuple[str, Column]]) -> Column:
    """The keys that :func:`live_meta` leaves of ``build_meta(pairs)``, from the raw values alone: no typed reading is made."""
    keys = [F.when(c.isNotNull(), F.lit(k)) for k, c in pairs if k != ""]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


def live_meta(meta: Column) -> Column:
    """The meta map without NULL entries (keys that are really present)."""
    return F.map_filter(meta, lambda k, v: v.isNotNull())
