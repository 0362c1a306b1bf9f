"""Reports over logs and tables (OBS-1..8) and multi-site set operations (SET-1..4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Known engine error messages (pattern, normalized error), checked in order.
ERROR_PATTERNS = [
    (r"^no such index$", "no such index"),
    (r"no such index \[(.*?)\]", "no such index [???]"),
    (r"No mapping found for \[(.*?)\] in order to sort on", "No mapping found for [???] in order to sort on"),
    (r"Fielddata is disabled on text fields by default. Set fielddata=true on \[(.*?)\]",
     "Fielddata is disabled on text fields by default. Set fielddata=true on [???]"),
    (r"field \[(.*?)\] is of type \[(.*?)\], but only numeric types are supported.",
     "field [???] is of type [???], but only numeric types are supported."),
    (r"Alternatively, set fielddata=true on \[(.*?)\] in order to load field data by uninverting the inverted index.",
     "Alternatively, set fielddata=true on [???] in order to load field data by uninverting the inverted index."),
    (r"Limit of total fields \[(.*?)\]( in index \[(.*?)\])? has been exceeded",
     "Limit of total fields [???] in index [???] has been exceeded"),
]

# Log limits.
MAX_BODY_BYTES = 200 * 1024
TRIMMED_BODY_CHARS = 1000
KEEP_LAST = 5
MAX_LOG_BYTES = 1024 * 1024


def failed_requests(log: DataFrame) -> DataFrame:
    """OBS-1: failed requests per type: any non-2xx; bulk also with item errors; delete except 404."""
    st = F.col("status_code")
    bad = (st < 200) | (st >= 300)
    t = F.col("request_type")
    cond = (((t == "query") & bad)
            | ((t == "bulk") & (bad | F.col("body").contains('"errors":true')))
            | ((t == "delete") & bad & (st != 404))
            | (~t.isin("query", "bulk", "delete") & bad))
    return log.filter(cond)


def shape_log(log: DataFrame, max_body: int | None = None, trimmed: int = TRIMMED_BODY_CHARS) -> DataFrame:
    """OBS-2: duration in ms; with ``max_body``, bodies above it are cut to ``trimmed`` characters."""
    body = F.col("body")
    if max_body is not None:
        body = F.when(F.length("body") > max_body, F.substring("body", 1, trimmed)).otherwise(body)
    return log.select("request_id", "ts", "request_type", "status_code",
                      F.round(F.col("query_time") * 1000).cast("bigint").alias("duration_ms"), body.alias("body"))


def retention(log: DataFrame, as_of: Column, hours: int, keep: int, max_bytes: int) -> DataFrame:
    """OBS-3: entries of the last ``hours`` before ``as_of``, the newest ``keep``, then oldest dropped
    until the total body size fits ``max_bytes``. The kept set is at most ``keep`` rows."""
    recent = log.filter((F.col("ts") > as_of - F.expr(f"INTERVAL {hours} HOURS")) & (F.col("ts") <= as_of))
    newest = recent.orderBy(F.col("ts").desc(), F.col("request_id").desc()).limit(keep)
    w = Window.orderBy(F.col("ts").desc(), F.col("request_id").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return newest.withColumn("size_so_far", F.sum(F.length("body")).over(w)).filter(
        F.col("size_so_far") <= max_bytes).drop("size_so_far")


def classify_error(msg: Column) -> Column:
    """OBS-4: normalized error (captured names replaced by ???); unknown messages stay as they are."""
    out = msg
    for pat, norm in reversed(ERROR_PATTERNS):
        out = F.when(msg.rlike(pat), F.lit(norm)).otherwise(out)
    return out


def content_counts(posts: DataFrame, statuses: list[str], site_col: str = "site_id") -> DataFrame:
    """OBS-5: per site and type, eligible objects (status in ``statuses``) and all objects."""
    return posts.groupBy(site_col, "post_type").agg(
        F.count_if(F.col("post_status").isin(statuses)).cast("bigint").alias("eligible"),
        F.count(F.lit(1)).cast("bigint").alias("total"))


def meta_key_counts(pairs: DataFrame) -> DataFrame:
    """OBS-6: (type, key, n_objects) plus a 'total' type row per key."""
    total = pairs.groupBy("key").agg(F.sum("n_objects").cast("bigint").alias("n_objects")).withColumn(
        "type", F.lit("total"))
    return pairs.unionByName(total.select("type", "key", "n_objects"))


def missing_present(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """OBS-7: (key, status) missing = expected minus actual, present = both (except / intersect)."""
    e, a = expected.select(key).distinct(), actual.select(key).distinct()
    missing = e.exceptAll(a).withColumn("status", F.lit("missing"))
    present = e.intersect(a).withColumn("status", F.lit("present"))
    return missing.unionByName(present)


def human_bytes(b: Column) -> Column:
    """'N B', 'x.xx KB', 'x.xx MB', 'x.xx GB'."""
    def fmt(div, unit):
        return F.concat(F.format_number(b / F.lit(div), 2), F.lit(f" {unit}"))

    return (F.when(b < 1024, F.concat(b.cast("string"), F.lit(" B")))
            .when(b < 1024 ** 2, fmt(1024, "KB")).when(b < 1024 ** 3, fmt(1024 ** 2, "MB"))
            .otherwise(fmt(1024 ** 3, "GB")))


def index_totals(docs: DataFrame, index_col: str, size_col: str) -> DataFrame:
    """OBS-8: documents and bytes per index with a human-readable size."""
    g = docs.groupBy(index_col).agg(F.count(F.lit(1)).cast("bigint").alias("docs"),
                                    F.sum(size_col).cast("bigint").alias("bytes"))
    return g.withColumn("size", human_bytes(F.col("bytes")))


# ---------------------------------------------------------------- sites


def eligible_sites(sites: DataFrame) -> DataFrame:
    """SET-4: indexable sites that are not deleted, archived or spam."""
    return sites.filter(F.col("indexable") & ~F.col("deleted") & ~F.col("archived") & ~F.col("spam"))


def site_scope(df: DataFrame, sites: DataFrame, site__in=None, site__not_in=None, current: int | None = None,
               all_sites: bool = False, site_col: str = "site_id") -> DataFrame:
    """SET-1/2: rows of the chosen sites. 'current' = one site; site__in = a list; all_sites or
    site__not_in = every eligible site (minus the excluded ones). Partition filter on ``site_col``."""
    if current is not None and not all_sites and not site__in and not site__not_in:
        return df.filter(F.col(site_col) == current)
    ok = eligible_sites(sites).select(F.col("site_id").alias(site_col))
    if site__in:
        ok = ok.filter(F.col(site_col).isin(list(site__in)))
    if site__not_in:
        ok = ok.filter(~F.col(site_col).isin(list(site__not_in)))
    return df.join(ok, site_col, "left_semi")


