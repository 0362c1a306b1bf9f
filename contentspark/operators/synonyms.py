"""Synonyms (TXT-13..15): list parsing and query-time expansion.

Lines are ``a, b, c`` (equivalent set) or ``a => b, c`` (``a`` is replaced by
``b`` or ``c``); blank lines and lines starting with ``#`` or ``//`` are
skipped. Expansion joins every token n-gram of every query with the synonym
phrases (an equi-join on the phrase, case-insensitive), and emits alternative
queries that replace one matched span each. The original query is kept
unless a replacement rule matched it. Alternatives share the query id, so a
search over them scores a document by its best alternative.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentspark.functions.text import tokens


def parse_lines(lines: DataFrame, col: str = "line") -> DataFrame:
    """TXT-15: (rule_id, kind, lhs array<string>, rhs array<array<string>>) from raw lines.

    ``kind`` = 'equivalent' (lhs empty, rhs = the set) or 'replace'.
    """
    raw = lines.select(F.trim(F.col(col)).alias("line")).filter(
        (F.col("line") != "") & ~F.col("line").startswith("#") & ~F.col("line").startswith("//"))
    raw = raw.withColumn("rule_id", F.xxhash64("line"))
    is_rep = F.col("line").contains("=>")
    lhs_txt = F.when(is_rep, F.split(F.col("line"), "=>").getItem(0))
    rhs_txt = F.when(is_rep, F.split(F.col("line"), "=>").getItem(1)).otherwise(F.col("line"))

    def phrases(txt):
        return F.filter(F.transform(F.split(txt, ","), lambda p: tokens(F.trim(p))), lambda a: F.size(a) > 0)

    return raw.select(
        "rule_id",
        F.when(is_rep, F.lit("replace")).otherwise(F.lit("equivalent")).alias("kind"),
        F.when(is_rep, phrases(lhs_txt)).otherwise(F.array().cast("array<array<string>>")).alias("lhs"),
        phrases(rhs_txt).alias("rhs"),
    )


def rewrite_pairs(rules: DataFrame) -> DataFrame:
    """(phrase, alternative, replace) pairs: every member of a set maps to every other member;
    a replacement maps its left side to each right side (replace=True drops the original)."""
    eq = rules.filter(F.col("kind") == "equivalent").select(F.col("rhs").alias("members"))
    eq_pairs = (eq.select(F.explode("members").alias("p"), "members")
                .select(F.array_join("p", " ").alias("phrase"), F.explode("members").alias("alt"))
                .select("phrase", F.array_join("alt", " ").alias("alternative"), F.lit(False).alias("replace"))
                .filter(F.col("phrase") != F.col("alternative")))
    rep = rules.filter(F.col("kind") == "replace")
    rep_pairs = (rep.select(F.explode("lhs").alias("l"), "rhs")
                 .select(F.array_join("l", " ").alias("phrase"), F.explode("rhs").alias("r"))
                 .select("phrase", F.array_join("r", " ").alias("alternative"), F.lit(True).alias("replace")))
    return eq_pairs.unionByName(rep_pairs).distinct()


def expand_queries(queries: DataFrame, pairs: DataFrame) -> DataFrame:
    """(query_id, alt, query): the original (unless replaced) plus one row per rewrite.

    Query n-grams are made of the phrase lengths that the rules have (a scalar subquery of the
    distinct lengths; the rules are a settings list).
    """
    sizes = pairs.select(F.size(F.split("phrase", " ")).alias("n")).distinct().agg(
        F.array_sort(F.collect_list("n")).alias("sizes")).scalar()
    queries = queries.withColumn("sizes", F.coalesce(sizes, F.array().cast("array<int>")))
    q = queries.select("query_id", tokens(F.col("query")).alias("toks"), "sizes")
    grams = q.select("query_id", "toks", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("toks"), F.lit(1))),
        lambda s: F.transform(F.col("sizes"),
                              lambda n: F.struct(s.alias("start"), n.alias("n"),
                                                 F.array_join(F.slice("toks", s, n), " ").alias("phrase"))))))
        .alias("g")).filter(F.col("g.start") + F.col("g.n") - 1 <= F.size("toks"))
    hits = grams.join(pairs, F.col("g.phrase") == F.col("phrase"))
    alts = hits.select(
        "query_id",
        F.array_join(F.concat(F.slice("toks", 1, F.col("g.start") - 1), F.split(F.col("alternative"), " "),
                              F.slice("toks", F.col("g.start") + F.col("g.n"),
                                      F.greatest(F.size("toks"), F.lit(1)))), " ").alias("query"),
        "replace")
    replaced = alts.filter("replace").select("query_id").distinct()
    originals = (q.join(replaced, "query_id", "left_anti")
                 .select("query_id", F.array_join("toks", " ").alias("query")))
    out = originals.unionByName(alts.select("query_id", "query")).distinct()
    return out.withColumn("alt", F.xxhash64("query_id", "query"))
