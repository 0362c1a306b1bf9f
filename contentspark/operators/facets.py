"""Aggregations and facets (AGG-1..20).

Design: every facet is an array column of values per document. All facets of
a request are unpivoted once into ``(facet, value)`` pairs per document and
counted with one ``groupBy(facet, value)``: one scan, one shuffle, with
map-side partial aggregation, so a value held by a third of all rows is
collapsed before the exchange. Filters that must not affect a facet's own
counts become per-facet ``count_if`` flags on the same scan instead of extra
passes.

Terms aggregations count documents, not occurrences (values are de-duplicated
per document). Bucket order: count desc, key asc. All buckets are
returned unless the caller asks for the ``size`` best (a top-k report).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentspark.functions.meta import live_meta
from contentspark.functions.multivalue import and_all, or_all

META_DISPLAY_CHARS = 100


def facet_pairs(facets: Mapping[str, Column]) -> Column:
    """Array of (facet, value) structs over all facets, values de-duplicated per doc."""
    def tag(name: str):
        return lambda v: F.struct(F.lit(name).alias("facet"), v.cast("string").alias("value"))

    parts = [F.transform(F.array_distinct(F.filter(F.coalesce(arr.cast("array<string>"),
                                                              F.array().cast("array<string>")),
                                                   lambda x: x.isNotNull())), tag(name))
             for name, arr in facets.items()]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def facet_counts(df: DataFrame, facets: Mapping[str, Column], flags: Mapping[str, Column] | None = None,
                 size: int | None = None) -> DataFrame:
    """AGG-1/7/8/10/14/18: (facet, value, doc_count) for several facets in one pass.

    ``flags`` optionally maps a facet name to the predicate a document must
    satisfy to be counted for that facet (the request's filter minus the
    facet's own selection); facets without a flag count every row of ``df``.
    Empty buckets are dropped (AGG-15); with ``size`` each facet keeps its best ones.
    """
    flags = dict(flags or {})
    names = list(facets)
    rows = df.select(facet_pairs(facets).alias("p"),
                     *[(flags[n] if n in flags else F.lit(True)).alias(f"__ok_{i}") for i, n in enumerate(names)])
    ok = F.lit(False)
    for i, n in enumerate(names):
        ok = F.when(F.col("f.facet") == n, F.col(f"__ok_{i}")).otherwise(ok)
    exploded = rows.select(F.explode("p").alias("f"), *[f"__ok_{i}" for i in range(len(names))])
    counted = (exploded.groupBy(F.col("f.facet").alias("facet"), F.col("f.value").alias("value"))
               .agg(F.count_if(ok).cast("bigint").alias("doc_count"))
               .filter(F.col("doc_count") > 0))
    if size is None:
        return counted
    w = Window.partitionBy("facet").orderBy(F.col("doc_count").desc(), F.col("value").asc())
    return counted.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= size).drop("__r")


def terms_agg(df: DataFrame, values: Column, size: int | None = None, name: str = "terms") -> DataFrame:
    """AGG-1/AGG-3: documents per distinct value (the top ``size`` by count desc, key asc, if given)."""
    return facet_counts(df, {name: values}, size=size).select(F.col("value").alias("key"), "doc_count")


def min_max(df: DataFrame, value: Column, flag: Column | None = None) -> DataFrame:
    """AGG-9/AGG-17: min and max of a numeric reading (optionally under a filter)."""
    v = value if flag is None else F.when(flag, value)
    return df.agg(F.min(v).alias("min_value"), F.max(v).alias("max_value"))


def selection(facet_values: Mapping[str, Column], selected: Mapping[str, list], match: str = "all") -> Column:
    """AGG-12/13: filter for selected facet values.

    'all': every selected value of every facet is present;
    'any': some selected value of some facet is present.
    """
    conds = []
    for name, vals in selected.items():
        if not vals:
            continue
        arr = facet_values[name]
        lit = F.array(*[F.lit(v) for v in vals])
        if match == "all":
            conds.append(F.coalesce(F.size(F.array_except(lit, arr)) == 0, F.lit(False)))
        else:
            conds.append(F.coalesce(F.arrays_overlap(arr, lit), F.lit(False)))
    if not conds:
        return F.lit(True)
    return and_all(conds) if match == "all" else or_all(conds)


def counting_flags(facet_values: Mapping[str, Column], selected: Mapping[str, list], match: str,
                   base: Column | None = None) -> dict[str, Column]:
    """AGG-14: per facet, the filter its counts use.

    Under 'any' a facet's own selection is removed from its counting filter
    (other filters stay); under 'all' every facet counts under the full filter.
    """
    base = base if base is not None else F.lit(True)
    out = {}
    for name in facet_values:
        sel = selected if match == "all" else {k: v for k, v in selected.items() if k != name}
        out[name] = base & selection(facet_values, sel, match)
    return out


def order_buckets(counts: DataFrame, selected: Mapping[str, list] | None = None, by: str = "count",
                  order: str = "desc") -> DataFrame:
    """AGG-16: order buckets by count or name (asc/desc), selected values first; adds ``pos``."""
    selected = selected or {}
    sel = or_all([(F.col("facet") == f) & F.col("value").isin(v) for f, v in selected.items() if v])
    key = F.col("doc_count") if by == "count" else F.col("value")
    key = key.desc() if order == "desc" else key.asc()
    w = Window.partitionBy("facet").orderBy(sel.desc(), key, F.col("value").asc())
    return counts.withColumn("pos", F.row_number().over(w))


def meta_facet_display(counts: DataFrame) -> DataFrame:
    """AGG-8: values truncated to 100 characters for display."""
    return counts.withColumn("label", F.substring(F.col("value"), 1, META_DISPLAY_CHARS))


def distinct_values(df: DataFrame, values: Column, size: int | None = None) -> DataFrame:
    """AGG-3: the distinct values of a (multi-valued) field (the ``size`` most frequent, if given)."""
    return terms_agg(df, values, size=size)


def live_keys(df: DataFrame, map_col: str = "meta") -> Column:
    """The keys of a row's meta map: the column ``<map_col>_keys`` where the view has one, else those of the map itself."""
    return F.col(f"{map_col}_keys") if f"{map_col}_keys" in df.columns else F.map_keys(live_meta(F.col(map_col)))


def distinct_map_keys(df: DataFrame, map_col: str = "meta") -> DataFrame:
    """AGG-4: distinct keys of a map column."""
    return df.select(F.explode(live_keys(df, map_col)).alias("key")).distinct()


def allowed_key(key: Column, allow: list[str] | None = None) -> Column:
    """Non-protected keys ('_' prefix is protected) or explicitly allowed ones."""
    cond = ~key.startswith("_")
    if allow:
        cond = cond | key.isin(allow)
    return cond


def distinct_meta_keys(df: DataFrame, allow: list[str] | None = None, limit: int | None = None,
                       map_col: str = "meta") -> DataFrame:
    """AGG-5: sorted distinct non-protected (or allowed) meta keys (the first ``limit``, if given)."""
    keys = distinct_map_keys(df, map_col).filter(allowed_key(F.col("key"), allow))
    keys = keys.orderBy("key")
    return keys if limit is None else keys.limit(limit)


def meta_keys_per_type(df: DataFrame, type_col: str = "post_type", map_col: str = "meta",
                       allow: list[str] | None = None) -> DataFrame:
    """AGG-6 / OBS-6: (type, key, n_objects) for every key used by objects of a type.

    Long form instead of one collected set per type, so no group is gathered
    into a single row whatever the number of keys.
    """
    pairs = df.select(F.col(type_col).alias("type"), F.explode(live_keys(df, map_col)).alias("key"))
    return (pairs.filter(allowed_key(F.col("key"), allow)).groupBy("type", "key")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_objects")))


def sample_per_group(df: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """AGG-19: first ``k`` rows per group."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= k)


def over_limit(df: DataFrame, group: str, value: str, limit: int) -> DataFrame:
    """AGG-20: per group, the largest value and whether it exceeds ``limit``."""
    return df.groupBy(group).agg(F.max(value).alias("max_value")).withColumn(
        "over_limit", F.col("max_value") > F.lit(limit))


def grouping_sets_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """AGG-18 for single-valued facets: one GROUPING SETS aggregation -> (facet, value, doc_count)."""
    sets = ", ".join(f"({c})" for c in columns)
    view = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    gid_cases = " ".join(f"WHEN grouping({c}) = 0 THEN '{c}'" for c in columns)
    val_cases = " ".join(f"WHEN grouping({c}) = 0 THEN {c}" for c in columns)
    spark = df.sparkSession
    return spark.sql(
        f"SELECT CASE {gid_cases} END AS facet, CASE {val_cases} END AS value, "
        f"CAST(count(*) AS BIGINT) AS doc_count FROM {{v}} GROUP BY GROUPING SETS ({sets})", v=view)
