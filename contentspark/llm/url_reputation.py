"""URL filters by empirical-Bayes host reputation, with DataFrame operations only.

A rule judges a url where one fits; the others are judged by their host's reputation.

Reputation: labelled outcomes of pages (bad or not) are counted by host and added up by
registered domain and suffix. From the root down, each level's rate is a beta-binomial
posterior whose prior has the parent's mean:

    a = strength * parent_mean + bad,  b = strength * (1 - parent_mean) + good.

``strength`` is one number per level, estimated from the data by moments: the spread of
the children's rates around their parents' means, less what binomial chance explains. A
host with few labels so stays near its domain, a domain near its suffix. A page is blocked
when the posterior of its host's rate lies above ``LIMIT`` with confidence: mean - Z * sd > LIMIT.
A host without labels has its domain's mean as prior and the width of the prior alone.

The registered domain is the last label before the suffix; the suffix is the last label, or
the last two for the registries in ``TWO_LABEL_SUFFIXES``. Ports and user names count for
the ``host`` column but not for the reputation.

A hot host is one row after the partial count of its labels; its pages meet it in a join
that is broadcast if the hosts are counted to be few, and split by adaptive execution if not.

Defined results: a url that is null or has no ``://`` has an empty host and path and the
root's reputation. Contradicting labels of a page: bad wins; null labels are ignored; no
labels at all: nothing is blocked but by rules. Repeated pages are rows of their own, null
page_ids stay null, extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentspark.llm.common import by_key, materialize

# Fixed values of the contract: verdicts and rules.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

# Registries whose suffixes have two labels.
TWO_LABEL_SUFFIXES = ["ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "com.br", "co.in", "co.jp", "ne.jp",
                      "or.jp", "co.kr", "com.mx", "co.nz", "com.sg", "com.tr", "com.tw", "co.za"]

LIMIT = 0.5
Z = 1.645
MOST_STRENGTH = 1000.0

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url, both empty without ``://``."""
    rest = F.substring_index(url, "://", 1)
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.length(rest) + F.lit(4), F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + F.lit(1), F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def domains(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    two = F.substring_index(bare, ".", -2)
    number = bare.rlike(r"^[0-9.]+$|^\[|^[^.]*$")  # addresses and single labels are their own domain
    suffix = F.when(number, bare).when(two.isin(TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(bare, ".", -1))
    domain = F.when(number, bare).when(two.isin(TWO_LABEL_SUFFIXES), F.substring_index(bare, ".", -3)).otherwise(two)
    return domain, suffix


def _strength(children: DataFrame) -> float:
    """Prior strength of one level, from rows with n, bad and their parent's mean."""
    p = F.col("bad") / F.col("n")
    one = children.where("n > 0").agg(
        F.sum("n"), F.count("*"), F.sum(F.col("n") * (p - F.col("mean")) ** 2),
        F.sum(F.col("n") * F.col("mean") * (1 - F.col("mean"))), F.sum(F.col("mean") * (1 - F.col("mean")))).first()
    n, rows, spread, binomial, per_child = (float(x or 0) for x in one)
    if rows < 2 or binomial <= 0:
        return 1.0
    between = max((spread - per_child) / n, 0.0)  # chance alone spreads a child's rate by mean * (1 - mean) / n
    return min(MOST_STRENGTH, max(1.0, binomial / n / between - 1)) if between else MOST_STRENGTH


def reputations(hosts: DataFrame) -> DataFrame:
    """Adds strength, mean and bound to hosts (host, domain, suffix, n, bad)."""
    total = hosts.agg(F.sum("n"), F.sum("bad")).first()
    n, bad = (int(x or 0) for x in total)
    level = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    level = level.withColumn("mean", F.lit((bad + 1.0) / (n + 2.0)))
    for name, parent in (("suffix", None), ("domain", "suffix"), ("host", "domain")):
        if parent:
            keys = ["host", "domain", "suffix"] if name == "host" else ["domain", "suffix"]
            level = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).join(
                means.select(*keys[1:], "mean"), keys[1:])
        level = materialize(level, f"reputation-{name}")
        strength = _strength(level)
        a = strength * F.col("mean") + F.col("bad")
        b = strength * (1 - F.col("mean")) + F.col("n") - F.col("bad")
        level = level.withColumns({"a": a, "b": b}).withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))
        means = level
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("a") + F.col("b") + 1))
    return level.withColumn("bound", F.col("mean") - Z * sd)


def _rules_by_host(hosts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """hosts with their fitting rules (rule, verdict, path), longest first."""
    spark = hosts.sparkSession
    table = spark.createDataFrame([(r.partition("/")[0], "/" + r.partition("/")[2], r, v) for v, r in rules],
                                  "rule_host string, path string, rule string, verdict string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = hosts.select("host", F.explode(suffixes).alias("rule_host")).join(by_key(table, len(rules)), "rule_host")
    longest = lambda x, y: F.when(F.length(x["rule"]) > F.length(y["rule"]), -1).when(
        F.length(x["rule"]) < F.length(y["rule"]), 1).otherwise(0)
    return hosts.join(fits.groupBy("host").agg(F.array_sort(
        F.collect_list(F.struct("rule", "verdict", "path")), longest).alias("rules")), "host", "left")


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, host_labels, bad_rate, bad_bound."""
    host, path = host_and_path(F.col("url"))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    outcomes = labels.where("quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("page_id")).agg(
        F.max((F.col("quality") == 0).cast("int")).alias("bad"))
    counts = pages.join(outcomes, "page_id", "left").groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    domain, suffix = domains(F.col("host"))
    hosts = materialize(counts.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    known = reputations(hosts).select("host", F.col("n").alias("host_labels"), F.round("mean", 6).alias("bad_rate"),
                                      F.round("bound", 6).alias("bad_bound"))
    known = materialize(_rules_by_host(known, rules), "host-reputations")
    out = pages.join(by_key(known), "host")
    out = out.withColumn("fit", F.when(F.size("rules") > 0, F.get(F.filter(
        "rules", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))))
    by_method = F.when(F.col("bad_bound") > LIMIT, "block").otherwise("allow")
    return out.select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                      F.coalesce("fit.verdict", by_method).alias("verdict"), "host_labels", "bad_rate", "bad_bound")
