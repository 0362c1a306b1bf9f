"""Mixing sources to target weights: Sainte-Lague apportionment of equal-word blocks.

All steps are DataFrame operations.

1. Targets: sources in code point order (null last) weigh 3, 1, 2, 3, ... and share
   ``SHARE`` of all words; a target stops at ``MOST`` times its source's words and the
   excess goes to the others by weight. That water level is found in closed form from
   prefix sums over the sources in order of words per weight.
2. Documents of a source are dealt to shards by a seeded hash of id and text (a hot source has many
   shards) and laid end to end in the order of that hash, so rows that tie are equal in both; a shard's words are cut into blocks of
   equal numbers of words (they differ by one at most), about ``block_words``.
3. Sainte-Lague: seats (blocks to take) go to the highest quotients w / (2k + 1), first
   among the sources (w: the target in blocks), then among each source's shards (w: its
   blocks). Quotients that are certain are counted, and only the few around the
   divisor are ranked, so that the ranked rows are a few per source or shard.
4. A shard with quota q of n blocks takes all of them q div n times, and q mod n of them,
   picked by a seeded hash, once more. A document takes the words of its blocks; prefix
   sums over the blocks give their number without a row per document and block.
5. ``mixed`` joins the partly taken documents with their picked blocks, which makes a row per
   document and block at most, and cuts each run of picked words out of the text.

Defined results: null text has no words; a source without words has target 0 and takes
nothing; null source is a source of its own, null and repeated doc_ids are rows like any
other. A document is never taken more than ``MOST`` times. Extra columns are ignored by
``mix`` and kept by ``mixed``. Window functions run over one row per source (the source
table) and over a few rows per shard of a source; everything that grows with the
documents is partitioned by (source, shard).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentspark.llm.common import by_key, materialize

# Fixed values of the contract: weights by rank, share of all words, most copies of a source.
WEIGHTS = [3, 1, 2]
SHARE = 1.5
MOST = 2

SEED = "mix-1"
BLOCK_WORDS = 128    # words of a block, at most
SOURCE_BLOCKS = 256  # blocks that a source of average size has at least, if it has the words
SHARD_ROWS = 8192    # documents of a shard, on average
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\v\f\r"


def seeded(*parts: Column | str) -> Column:
    """Hash of the seed and the parts as 32 hex digits, the same in every run."""
    return F.md5(F.concat_ws(":", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def targets(sources: DataFrame) -> DataFrame:
    """Adds rank, weight and target to (source, source_size, ...): water-filling under caps of MOST times the size."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("rank") - 1) % len(WEIGHTS) + 1)
    s = sources.withColumn("rank", F.row_number().over(order)).withColumn("weight", weight)
    cap = MOST * F.col("source_size")
    every = Window.partitionBy()
    poorer = Window.orderBy(cap / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = SHARE * F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(poorer), F.lit(0))
    weights = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(poorer), F.lit(0))
    # What is left for a source and those above it, if all below are full, is highest where that first holds.
    s = s.withColumn("level", left / weights).withColumn("level", F.max("level").over(every))
    return s.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.col("level"))).drop("level")


def sainte_lague(items: DataFrame, group: list[str], order: Column) -> DataFrame:
    """Adds seats to items (weight w, most seats, seats to share per group as total).

    Any divisor that gives ``total`` seats lies within half a seat per item of the exact
    one; seats below that range are certain, those within it are ranked by quotient.
    """
    of = Window.partitionBy(*group)
    spread = F.count("*").over(of) + 1
    per = F.col("w") / F.sum("w").over(of)
    items = items.withColumns({
        "sure": F.least(F.greatest(F.floor(per * (F.col("total") - spread) - 1), F.lit(0)), F.col("most")).cast("long"),
        "upto": F.least(F.greatest(F.ceil(per * (F.col("total") + spread) + 1), F.lit(0)), F.col("most")).cast("long")})
    items = items.withColumn("open", F.col("total") - F.sum("sure").over(of))
    ranked = items.where("upto > sure").withColumn("k", F.explode(F.expr("sequence(sure, upto - 1)")))
    place = Window.partitionBy(*group).orderBy((F.col("w") / (2 * F.col("k") + 1)).desc(), order, "k")
    won = (ranked.withColumn("place", F.row_number().over(place)).where("place <= open")
           .groupBy("item").agg(F.count("*").alias("more")))
    return items.join(won, "item", "left").withColumn("seats", F.col("sure") + F.coalesce("more", F.lit(0))).drop(
        "sure", "upto", "open", "more")


def _key(source: Column) -> Column:
    """Null-safe text of a source for joins."""
    return F.when(source.isNull(), "-").otherwise(F.concat(F.lit("+"), source))


def _taken(docs: DataFrame, block_words: int) -> tuple[DataFrame, DataFrame]:
    """Documents with their place in a shard, whole times (full) and words of picked blocks (extra); the blocks."""
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("text").alias("text_hash"), F.md5("text").alias("md5"))
    sized = materialize(sized.withColumns({"key": _key(F.col("source")), "h": seeded(F.col("doc_id"), F.col("md5"))}).drop("md5"), "mix-sizes")
    sources = sized.groupBy("source", "key").agg(
        F.sum("size").alias("source_size"), F.ceil(F.count("*") / SHARD_ROWS).alias("shards"))
    sources = targets(sources)
    words = F.floor(F.sum("source_size").over(Window.partitionBy()) / (F.count("*").over(Window.partitionBy()) * SOURCE_BLOCKS))
    sources = materialize(sources.withColumn("block", F.greatest(F.lit(1), F.least(F.lit(block_words), words))), "mix-sources")

    dealt = sized.join(by_key(sources.select("key", "shards", "source_size", "target", "block")), "key")
    shard = F.pmod(F.conv(F.substring("h", 1, 7), 16, 10).cast("long"), F.col("shards"))
    line = Window.partitionBy("key", "shard").orderBy("h", F.col("doc_id").asc_nulls_first(), "size")
    dealt = dealt.withColumn("shard", shard).withColumn("end", F.sum("size").over(
        line.rowsBetween(Window.unboundedPreceding, 0))).drop("h", "shards", "source")
    dealt = materialize(dealt.withColumn("start", F.col("end") - F.col("size")), "mix-lines")

    shards = dealt.groupBy("key", "shard").agg(F.max("end").alias("words"), F.max("block").alias("block"))
    shards = shards.where("words > 0").withColumn(
        "n", F.greatest(F.lit(1), F.round(F.col("words") / F.col("block"))).cast("long"))
    shards = materialize(shards, "mix-shards")
    blocks = shards.groupBy("key").agg(F.sum("n").alias("n"))
    wanted = sources.join(blocks, "key").select(
        F.col("key").alias("item"), "rank", (F.col("target") * F.col("n") / F.col("source_size")).alias("w"),
        (MOST * F.col("n")).alias("most"))
    all_seats = F.round(F.round(F.sum("w").over(Window.partitionBy()), 6)).cast("long")
    seats = sainte_lague(wanted.withColumn("total", all_seats), [], F.col("rank"))
    quotas = shards.join(seats.select(F.col("item").alias("key"), F.col("seats").alias("total")), "key").select(
        F.struct("key", "shard").alias("item"), "key", "shard", F.col("n").cast("double").alias("w"),
        (MOST * F.col("n")).alias("most"), "total", "n", "words")
    quotas = sainte_lague(quotas, ["key"], F.col("shard")).select(
        "key", "shard", "n", "words", F.expr("seats div n").alias("full"), F.expr("seats % n").alias("extra"))
    quotas = materialize(quotas, "mix-quotas")

    cut = quotas.where("extra > 0").withColumn("j", F.explode(F.expr("sequence(0L, n - 1)")))
    lot = Window.partitionBy("key", "shard").orderBy(seeded(F.col("key"), F.col("shard"), F.col("j")), "j")
    cut = cut.withColumn("picked", F.row_number().over(lot) <= F.col("extra")).withColumns(
        {"lo": F.expr("j * words div n"), "hi": F.expr("(j + 1) * words div n")})
    row = Window.partitionBy("key", "shard").orderBy("j")
    before = row.rowsBetween(Window.unboundedPreceding, -1)
    cut = materialize(cut.select("key", "shard", "j", "lo", "hi", "picked", F.lag("picked", 1, False).over(row).alias("after_one"),
                                 F.lead("picked", 1, False).over(row).alias("before_one"), F.coalesce(
        F.sum(F.when(F.col("picked"), F.col("hi") - F.col("lo")).otherwise(0)).over(before), F.lit(0)).alias("so_far")),
        "mix-blocks")

    def picked_words(side: str) -> DataFrame:
        return cut.select("key", "shard", F.col("j").alias(f"j_{side}"), F.col("lo").alias(f"lo_{side}"),
                          F.col("picked").alias(f"picked_{side}"), F.col("so_far").alias(f"so_far_{side}"))

    lines = dealt.join(by_key(quotas), ["key", "shard"], "left").withColumns({
        "full": F.coalesce("full", F.lit(0)), "first": F.col("start"),
        "last": F.col("end") - 1})
    for side in ("first", "last"):
        lines = lines.withColumn(f"j_{side}", F.when(F.col("size") > 0, F.expr(f"((`{side}` + 1) * n - 1) div words")))
        lines = lines.join(picked_words(side), ["key", "shard", f"j_{side}"], "left")
    upto = lambda side, p: F.col(f"so_far_{side}") + F.when(F.col(f"picked_{side}"), p - F.col(f"lo_{side}")).otherwise(0)
    extra = upto("last", F.col("end")) - upto("first", F.col("start"))
    return lines.withColumn("extra", F.coalesce(extra, F.lit(0))), cut


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, text_hash."""
    return _taken(docs, block_words)[0].select(
        "doc_id", "size", "source_size", "target",
        (F.col("full") * F.col("size") + F.col("extra")).cast("long").alias("taken"), "text_hash")


def _ranges(lines: DataFrame, cut: DataFrame) -> DataFrame:
    """key, shard, start, ranges: the runs of picked words (lo, hi; from 0, hi excluded) of partly taken documents."""
    blocks = cut.where("picked").select("key", "shard", "j", "lo", "hi", "after_one", "before_one")
    part = lines.where("extra > 0 AND extra < size").select("key", "shard", "start", "end", "j_first", "j_last", F.explode(
        F.expr("sequence(j_first, j_last)")).alias("j")).join(by_key(blocks), ["key", "shard", "j"])
    begins = F.when(~F.col("after_one") | (F.col("j") == F.col("j_first")), F.greatest("lo", "start") - F.col("start"))
    ends = F.when(~F.col("before_one") | (F.col("j") == F.col("j_last")), F.least("hi", "end") - F.col("start"))
    part = part.groupBy("key", "shard", "start").agg(
        F.sort_array(F.collect_list(begins)).alias("lo"), F.sort_array(F.collect_list(ends)).alias("hi"))
    return part.select("key", "shard", "start", F.arrays_zip("lo", "hi").alias("ranges"))


def cut_words(text: Column, ranges: Column) -> Column:
    """The texts of word ranges, each with the white space between its words."""
    words = F.regexp_extract_all(text, F.lit(WORD + "[\\x20\\x09-\\x0D]*"), F.lit(0))
    one = lambda w: lambda r: F.rtrim(
        F.array_join(F.slice(w, (r["lo"] + 1).cast("int"), (r["hi"] - r["lo"]).cast("int")), ""), F.lit(SPACES))
    return F.transform(F.array(words), lambda w: F.transform(ranges, one(w)))[0]  # the words are split once


def mixed(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself: a row for each whole time a document is taken, and one for each run of words of its other picked blocks.

    Rows keep all columns; ``n_chars``, where there is one, follows a shortened text, which
    keeps the white space between its words. Rows that agree in doc_id, source and text are
    numbered, and each takes what one of them takes.
    """
    lines, cut = _taken(docs, block_words)
    same = Window.partitionBy("doc_id", "key", "text_hash").orderBy("shard", "start")
    lines = materialize(lines.where("size > 0").withColumn("nth", F.row_number().over(same)).select(
        "doc_id", "key", "text_hash", "nth", "shard", "start", "end", "size", "j_first", "j_last", "full", "extra"), "mix-taken")
    plan = lines.where("full > 0 OR extra > 0").join(_ranges(lines, cut), ["key", "shard", "start"], "left")
    plan = materialize(plan.select(
        F.col("doc_id").alias("_mix_id"), F.col("key").alias("_mix_key"), F.col("text_hash").alias("_mix_hash"),
        F.col("nth").alias("_mix_nth"),
        (F.col("full") + F.when(F.col("extra") == F.col("size"), 1).otherwise(0)).cast("int").alias("_mix_times"),
        F.col("ranges").alias("_mix_ranges")), "mix-plan")
    same = (F.col("doc_id").cast("long").eqNullSafe(F.col("_mix_id")) & (F.xxhash64("text") == F.col("_mix_hash"))
            & (_key(F.col("source").cast("string")) == F.col("_mix_key")))
    repeated = lines.where("nth = 2").select(
        F.col("doc_id").alias("_mix_id"), F.col("key").alias("_mix_key"), F.col("text_hash").alias("_mix_hash"))
    n = repeated.count()
    rows = docs.withColumn("_mix_row", F.lit(1))
    if n:
        others = F.to_json(F.struct(*[c for c in docs.columns if c != "text"]))
        number = F.row_number().over(Window.partitionBy("doc_id", "source", F.xxhash64("text")).orderBy(others))
        rows = docs.join(by_key(repeated, n), same, "left_anti").withColumn("_mix_row", F.lit(1)).unionByName(
            docs.join(by_key(repeated, n), same, "left_semi").withColumn("_mix_row", number))
    rows = rows.join(by_key(plan), same & (F.col("_mix_row") == F.col("_mix_nth")))
    whole = rows.where("_mix_times > 0").withColumn("_mix_copy", F.explode(F.expr("sequence(1, _mix_times)")))
    part = rows.where("_mix_ranges IS NOT NULL").withColumn("text", F.explode(cut_words(F.col("text"), F.col("_mix_ranges"))))
    if "n_chars" in docs.columns:
        part = part.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return whole.select(docs.columns).unionByName(part.select(docs.columns))
