"""Facets from bitmaps (AGG-12..14, AGG-18): counts under any selection without reading the documents.

Documents are numbered; a chunk is :data:`CHUNK` neighbouring numbers, a word 64 of them. The index holds,
for each (facet, value, chunk), the words in which the value occurs, as (word, bits) pairs: a frequent
value takes a bit per document, a rare one a pair per occurrence. A selection is a mask, 64 words per chunk,
made by AND and OR of values' words and of filters over a few narrow columns kept beside the numbers.
A bucket's count is the number of bits that a value and the mask share: one equi-join on the chunk.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentspark.operators.facets import facet_pairs
from contentspark.operators.ranks import ranked
from contentspark.operators.search import input_signature
from contentspark.session import written

CHUNK = 4096
WORDS = CHUNK // 64

_CATALOG: dict = {}


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))


def _dense(words: Column) -> Column:
    """All words of a chunk from (w, b) pairs: zero where there is none."""
    held = F.map_from_entries(words)
    return F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.coalesce(F.element_at(held, w), F.lit(0).cast("long")))


def _grouped(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, chunk, place) to (keys, chunk, words): a partial OR per word, then at most WORDS pairs together."""
    words = rows.groupBy(*keys, "chunk", F.floor(F.col("place") / 64).cast("int").alias("w")).agg(F.bit_or(_bit(F.col("place"))).alias("b"))
    return words.groupBy(*keys, "chunk").agg(F.sort_array(F.collect_list(F.struct("w", "b"))).alias("words"))


@dataclass
class FacetIndex:
    """``numbers``: (id, nr, chunk, place, filter columns); ``bits``: (facet, value, chunk, words)."""

    numbers: DataFrame
    bits: DataFrame

    @classmethod
    def build(cls, df: DataFrame, id_col: str, facets: Mapping[str, Column], filters: Mapping[str, Column] | None = None) -> "FacetIndex":
        rows = df.select(F.col(id_col).alias("id"), facet_pairs(facets).alias("pairs"), *[c.alias(n) for n, c in (filters or {}).items()])
        rows = ranked(rows, [], [F.col("id")], "nr", rows=df.count()).withColumns(
            {"chunk": F.floor((F.col("nr") - 1) / CHUNK), "place": ((F.col("nr") - 1) % CHUNK).cast("int")})
        numbers = written(rows.drop("pairs"), "facet-numbers")
        pairs = rows.select("chunk", "place", F.explode("pairs").alias("p")).select("chunk", "place", "p.facet", "p.value")
        bits = _grouped(pairs, ["facet", "value"]).repartition("chunk").sortWithinPartitions("facet", "value")
        return cls(numbers, written(bits, "facet-bits"))

    def mask_of(self, predicate: Column) -> DataFrame:
        """(chunk, mask) of the documents that meet a predicate over the filter columns."""
        rows = _grouped(self.numbers.filter(predicate).select("chunk", "place"), [])
        return rows.select("chunk", _dense(F.col("words")).alias("mask"))

    def mask_of_selection(self, selected: Mapping[str, list], match: str = "all") -> DataFrame | None:
        """AGG-12/13: (chunk, mask) of the documents that hold all ('all') or any ('any') of the selected values.

        None for an empty selection, which selects everything.
        """
        chosen = [(f, str(v)) for f, vals in selected.items() for v in dict.fromkeys(vals)]
        if not chosen:
            return None
        wanted = F.lit(False)
        for f, v in chosen:
            wanted = wanted | ((F.col("facet") == f) & (F.col("value") == v))
        rows = self.bits.filter(wanted).select("chunk", F.explode("words").alias("x")).select("chunk", "x.w", "x.b")
        if match == "all":  # a word of the AND has a pair of every selected value
            words = rows.groupBy("chunk", "w").agg(F.bit_and("b").alias("b"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(chosen))
        else:
            words = rows.groupBy("chunk", "w").agg(F.bit_or("b").alias("b"))
        words = words.groupBy("chunk").agg(F.collect_list(F.struct("w", "b")).alias("words"))
        return words.select("chunk", _dense(F.col("words")).alias("mask"))

    def both(self, *masks: DataFrame | None) -> DataFrame | None:
        """AND of masks; None stands for everything."""
        out = None
        for m in masks:
            if m is not None:
                out = m if out is None else out.join(m.withColumnRenamed("mask", "_other"), "chunk").select(
                    "chunk", F.zip_with("mask", "_other", lambda a, b: a.bitwiseAND(b)).alias("mask"))
        return out

    def documents(self, mask: DataFrame) -> DataFrame:
        """(id) of the documents in a mask."""
        places = F.filter(F.sequence(F.lit(0), F.lit(CHUNK - 1)), lambda p: F.element_at("mask", (F.floor(p / 64) + 1).cast("int")).bitwiseAND(
            _bit(p)) != 0)
        hits = mask.select("chunk", F.explode(places).alias("place"))
        return self.numbers.join(hits, ["chunk", "place"]).select("id")

    def counts(self, masks: Mapping[str, DataFrame | None]) -> DataFrame:
        """AGG-14/18: (facet, value, doc_count) of the named facets, each under its own mask; empty buckets are dropped."""
        out = None
        shared: dict[int, list[str]] = {}
        for facet, mask in masks.items():
            shared.setdefault(id(mask), []).append(facet)
        for facets in shared.values():
            mask = masks[facets[0]]
            rows = self.bits.filter(F.col("facet").isin(facets))
            if mask is None:
                ones = F.aggregate("words", F.lit(0).cast("long"), lambda n, x: n + F.bit_count(x["b"]))
            else:
                rows = rows.join(mask, "chunk")
                ones = F.aggregate("words", F.lit(0).cast("long"), lambda n, x: n + F.bit_count(
                    x["b"].bitwiseAND(F.element_at("mask", (x["w"] + 1).cast("int")))))
            part = rows.groupBy("facet", "value").agg(F.sum(ones).cast("bigint").alias("doc_count")).filter("doc_count > 0")
            out = part if out is None else out.unionByName(part)
        return out

    def counts_ignoring_own(self, facets: list[str], selected: Mapping[str, list], match: str = "all", base: Column | None = None) -> DataFrame:
        """AGG-14: under 'any' each facet counts without its own selection; under 'all' all count under everything selected."""
        first = None if base is None else written(self.mask_of(base), "facet-base")
        masks, made = {}, {}
        for facet in facets:
            of = dict(selected) if match == "all" else {k: v for k, v in selected.items() if k != facet}
            key = tuple(sorted((k, tuple(v)) for k, v in of.items() if v))
            if key not in made:
                made[key] = self.both(first, self.mask_of_selection(of, match))
            masks[facet] = made[key]
        return self.counts(masks)


def cached_facets(key: str, df: DataFrame, id_col: str, facets: Mapping[str, Column], filters: Mapping[str, Column] | None = None) -> FacetIndex:
    """An index shared by every query of the session over the same inputs; a changed table rebuilds it."""
    k = (key, input_signature(df), df.sparkSession.sparkContext.applicationId)
    if k not in _CATALOG:
        _CATALOG[k] = FacetIndex.build(df, id_col, facets, filters)
    return _CATALOG[k]
