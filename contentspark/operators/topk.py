"""Top-k search that leaves most postings unread (SRT-10, TXT-1, TXT-6, TXT-9).

A :class:`~contentspark.operators.search.TextIndex` keeps, besides its postings, the impact (BM25 of one
term in one field) of every posting and each term's largest impact.

1. The postings of a query's rarest terms (up to ``FIRST_POSTINGS`` of them) name ``FIRST_DOCS`` promising
   documents, which are scored whole. The k-th score there is the query's threshold: no document
   below it can be in the result. Documents with scores from other clauses count as well.
2. A query's terms are split: the weakest, whose largest impacts together stay below ``WEAK`` of the
   threshold, cannot bring a document into the result. Those are the frequent terms, which hold most
   of all postings; only postings of the other (strong) terms are read.
3. A document whose strong terms' sum, with all that the weak ones could add, stays below the threshold goes.
   The few documents that are left meet the weak terms' postings.

The result is whole: every document that is left out is bounded by a score that k documents reach. Every
step is an equi-join on the term or a grouped aggregation; windows see one query's terms, or a task's
best rows of a query.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentspark.operators import search as S
from contentspark.session import written

FIRST_POSTINGS = 2000
FIRST_DOCS = 64
WEAK = 0.6
# Doubles are added in another order by each step, and ranking keys may be rounded to thousandths.
SLACK = 0.0011
BROADCAST_ROWS = 500_000


def _few(rows: DataFrame) -> DataFrame:
    """Written rows as the build side of a join: broadcast only if the counted rows are few."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _sums(rows: DataFrame, by: list[str]) -> DataFrame:
    """Scores of (query, token, document, field) rows summed over tokens, a token by its best expansion."""
    keys = ["query_id", "doc_id", "field", *by]
    return rows.groupBy(*keys, "term").agg(F.max("score").alias("score")).groupBy(*keys).agg(F.sum("score").alias("score"))


def _ranked(hits: DataFrame, k: int, key: Callable[[Column], Column]) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(key(F.col("score")).desc(), F.col("doc_id").asc())
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def top_match(queries: DataFrame, index: S.TextIndex, weights: Mapping[str, float], k: int, fuzziness=0, boost: float = 1.0,
              others: DataFrame | None = None, key: Callable[[Column], Column] = lambda c: c, analyzer: str | None = None,
              seen: dict[str, DataFrame] | None = None) -> DataFrame:
    """The k best documents of every query by OR best_fields match: (query_id, doc_id, score, rank).

    ``others`` (query_id, doc_id, score): scores of further should-clauses, added to ``boost`` times the
    match score. ``key`` is the ranking key of a score (such as its rounding to thousandths); ties go to
    the smaller doc_id. ``seen`` receives the row sets that were scored, for reports.
    """
    fields = list(weights)
    seen = {} if seen is None else seen
    qt = S.query_terms(queries, analyzer or index.analyzer).select("query_id", "term").distinct()
    if fuzziness in (0, "0", None):
        qt = qt.withColumn("vterm", F.col("term"))
    else:
        qt = S.fuzzy_expand(qt, index.vocabulary(), fuzziness, index.vocab_keys(2 if fuzziness == "auto" else int(fuzziness)))
        qt = qt.select("query_id", "term", "vterm")
    weight = S._weight(F.col("field"), weights) * F.lit(float(boost))
    impacts, most = (t.filter(F.col("field").isin(fields)).withColumnRenamed("term", "vterm") for t in index.impact_tables())
    looked = written(qt.join(most, "vterm").withColumn("most", F.col("most") * weight), "query-terms")
    terms = looked.groupBy("query_id", "field", "term").agg(F.max("most").alias("most"), F.sum("df").alias("df"))

    def scored(rows: DataFrame, on: list[str]) -> DataFrame:
        return impacts.join(rows, on).withColumn("score", F.col("impact") * weight)

    def whole(pairs: DataFrame, name: str) -> DataFrame:
        """Match scores of (query_id, doc_id) pairs."""
        rows = written(pairs.join(looked.select("query_id", "term", "vterm", "field"), "query_id"), name)
        seen[name] = scored(_few(rows), ["vterm", "field", "doc_id"])
        return _sums(seen[name], []).groupBy("query_id", "doc_id").agg(F.max("score").alias("score"))

    rarest = Window.partitionBy("query_id").orderBy("df", "term", "field")
    rare = (terms.withColumn("upto", F.sum("df").over(rarest.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("place", F.row_number().over(rarest)).filter((F.col("upto") <= FIRST_POSTINGS) | (F.col("place") == 1)))
    rare = written(rare.select("query_id", "field", "term").join(looked.select("query_id", "field", "term", "vterm"), ["query_id", "field", "term"]), "rare-terms")
    seen["rare"] = scored(_few(rare), ["vterm", "field"])
    hopeful = seen["rare"].groupBy("query_id", "doc_id").agg(F.sum("score").alias("hope"))
    by_hope = Window.partitionBy("query_id").orderBy(F.col("hope").desc(), "doc_id")
    first = hopeful.withColumn("place", F.row_number().over(by_hope)).filter(F.col("place") <= FIRST_DOCS).select("query_id", "doc_id")
    if others is not None:
        first = first.unionByName(others.select("query_id", "doc_id")).distinct()
    found = whole(first, "first-docs")
    if others is not None:  # these documents are scored here, whole, and not again below
        found = found.unionByName(others.select("query_id", "doc_id", "score")).groupBy("query_id", "doc_id").agg(F.sum("score").alias("score"))
    found = written(found, "first-found")

    kth = _ranked(found, k, key).groupBy("query_id").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
    least = kth.filter(F.col("n") == k).select("query_id", (F.col("kth") - F.lit(SLACK)).alias("least"))
    weakest = Window.partitionBy("query_id", "field").orderBy("most", "term").rowsBetween(Window.unboundedPreceding, 0)
    split = terms.join(least, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(0.0)))
    split = split.withColumn("upto", F.sum("most").over(weakest)).withColumn("weak", F.col("upto") < F.lit(WEAK) * F.col("least"))
    # upto grows with the terms, so the last weak term's holds the sum of all weak ones.
    every = Window.partitionBy("query_id", "field")
    split = split.withColumn("rest", F.coalesce(F.max(F.when(F.col("weak"), F.col("upto"))).over(every), F.lit(0.0)))
    split = written(split.join(looked.select("query_id", "term", "vterm", "field"), ["query_id", "term", "field"])
                    .select("query_id", "term", "vterm", "field", "weak", "rest", "least"), "term-split")
    strong = written(split.filter(~F.col("weak")).drop("weak"), "strong-terms")
    seen["strong"] = scored(_few(strong), ["vterm", "field"])
    partial = _sums(seen["strong"], ["rest", "least"]).filter(F.col("score") + F.col("rest") >= F.col("least"))
    partial = written(partial.select("query_id", "doc_id", "field", "score"), "hopeful-docs")
    weak = partial.drop("score").join(split.filter("weak").select("query_id", "field", "term", "vterm"), ["query_id", "field"])
    weak = written(weak, "weak-lookups")
    seen["weak"] = scored(_few(weak), ["vterm", "field", "doc_id"])
    rest = partial.unionByName(_sums(seen["weak"], []))
    rest = (rest.groupBy("query_id", "doc_id", "field").agg(F.sum("score").alias("score"))
            .groupBy("query_id", "doc_id").agg(F.max("score").alias("score")))
    rest = rest.join(found.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")
    return _ranked(found.unionByName(rest), k, key).select("query_id", "doc_id", "score", "rank")


def top_default(queries: DataFrame, index: S.TextIndex, weights: Mapping[str, float], k: int,
                key: Callable[[Column], Column] = lambda c: c, analyzer: str | None = None) -> DataFrame:
    """TXT-9 top-k: phrase x4 + AND x2 + OR fuzzy(1) x1, the OR part read as far as it matters."""
    few = written(S.bool_should([(S.phrase(queries, index, weights, analyzer), 4.0),
                                 (S.match(queries, index, weights, "and", 0, analyzer), 2.0)]), "exact-clauses")
    return top_match(queries, index, weights, k, fuzziness=1, others=few, key=key, analyzer=analyzer)
