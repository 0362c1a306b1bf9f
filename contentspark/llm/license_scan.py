"""License scans by diagonal voting, with DataFrame operations only.

Words are runs of [0-9a-z] (A-Z lower-cased) and of characters beyond ASCII. All rolling
word k-grams of every document are hashed and joined with the positions that the same
k-grams have in the templates (the words themselves are compared too). A hit at word p of a
document and word t of a template votes for the diagonal p - t: a copy of a template is a
diagonal with many votes, and inserted or dropped words shift the rest of it by a little.

1. Each document emits its k-grams (four words for license texts, two for phrases, these
   only at words that begin a phrase's two-gram); the templates' grams, a fixed list of a few
   hundred rows, are broadcast. Only hits leave the scan.
2. Votes are counted per (document, template, diagonal).
3. Diagonals of a template that differ by at most ``SHIFT`` and lie within ``GAP`` words are
   merged, in order of their first word.
4. A merged span is verified: a phrase needs all of its k-grams on one diagonal (its words
   stand consecutively), a license text at least ``COVER`` of its k-grams, none counted twice.

The score is the largest share of a template's k-grams that an accepted span has (0 to 1).

Defined results: null or wordless texts have no words and no labels; repeated rows and null
doc_ids are rows of their own; extra columns are ignored. A document's hits are grouped by
document and template, so a group is bounded by one document's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the contract: phrases and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Characteristic sentences of licenses, as words, and their labels.
LICENSE_TEXTS = [
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", "gpl"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
     "public license as published by the free software foundation", "lgpl"),
    ("you should have received a copy of the gnu affero general public license along with this program", "agpl"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
     "license", "apache"),
    ("licensed under the apache license version 2 0", "apache"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("released under the mit license", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this work is licensed under the creative commons attribution 4 0 international license", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]

TEXT_GRAM, PHRASE_GRAM = 4, 2
COVER = 0.6   # share of a license text's k-grams that a span needs
SHIFT = 3     # words by which merged diagonals may differ
GAP = 12      # words between merged diagonals' spans

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_grams(spark: SparkSession, phrases: list, texts: list) -> DataFrame:
    """(size, words, template, label, at, grams, phrase): the k-grams of all templates with their positions."""
    rows = []
    for n, (text, label) in enumerate([*phrases, *texts]):
        words, phrase = text.split(), n < len(phrases)
        k = PHRASE_GRAM if phrase else TEXT_GRAM
        if len(words) < k:
            raise ValueError(f"a template needs {k} words: {text}")
        rows += [(words[i:i + k], n, label, i, len(words) - k + 1, phrase) for i in range(len(words) - k + 1)]
    return spark.createDataFrame(
        rows, "words array<string>, template int, label string, at int, grams int, phrase boolean")


def _gram_hash(words: list[Column]) -> Column:
    return F.xxhash64(F.lit(len(words)), *words)


def hits(docs: DataFrame, phrases: list, texts: list) -> DataFrame:
    """A row for each k-gram hit (template, label, at, grams, phrase, pos), and one without template per document."""
    grams = template_grams(docs.sparkSession, phrases, texts)

    def keyed(k: int) -> DataFrame:
        own = grams.where(F.size("words") == k)
        words = [F.col("words")[i] for i in range(k)]
        return F.broadcast(own.select(
            _gram_hash(words).alias(f"hash{k}"), *[w.alias(f"t{k}_{i}") for i, w in enumerate(words)],
            F.struct("template", "label", "at", "grams", "phrase").alias(f"hit{k}")))

    begins = sorted({w for text, _ in phrases for w in text.split()[:-1]})
    words = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0)).alias("w"))
    words = words.withColumn("n_words", F.size("w").cast("long"))
    rolling = F.arrays_zip(*[F.slice("w", i + 1, F.greatest(F.size("w"), F.lit(1))).alias(f"w{i}") for i in range(TEXT_GRAM)])
    rows = words.select("row", "doc_id", "n_words", F.posexplode_outer(rolling).alias("pos", "g")).select(
        "row", "doc_id", "n_words", "pos", *[F.col("g")[f"w{i}"].alias(f"w{i}") for i in range(TEXT_GRAM)])
    w = [F.col(f"w{i}") for i in range(TEXT_GRAM)]
    rows = rows.withColumns({
        "hash4": F.when(w[-1].isNotNull(), _gram_hash(w)),
        "hash2": F.when(w[1].isNotNull() & w[0].isin(begins), _gram_hash(w[:PHRASE_GRAM]))})
    for k in (TEXT_GRAM, PHRASE_GRAM):
        side = keyed(k)
        same = rows[f"hash{k}"] == side[f"hash{k}"]
        for i in range(k):
            same = same & (F.col(f"w{i}") == F.col(f"t{k}_{i}"))
        rows = rows.join(side, same, "left").drop(side[f"hash{k}"])
    rows = rows.where("hit4 IS NOT NULL OR hit2 IS NOT NULL OR pos IS NULL OR pos = 0")
    # A place may have hits of both kinds, and of several templates: the joins pair them, so they are made distinct.
    hit = F.explode(F.array(F.col("hit4"), F.col("hit2"), F.lit(None)))
    return rows.select("row", "doc_id", "n_words", "pos", hit.alias("hit")).select(
        "row", "doc_id", "n_words", F.when(F.col("hit").isNotNull(), F.col("pos")).alias("pos"), "hit.*").distinct()


def spans(found: DataFrame) -> DataFrame:
    """Verified spans: row, doc_id, n_words, label, phrase, first, last, score."""
    key = ["row", "doc_id", "n_words", "template", "label", "grams", "phrase"]
    votes = found.where("template IS NOT NULL").withColumn("diagonal", F.col("pos") - F.col("at")).groupBy(
        *key, "diagonal").agg(F.count("*").alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    line = Window.partitionBy("row", "template").orderBy("lo", "diagonal")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    apart = (F.col("phrase") | (F.abs(F.col("diagonal") - F.lag("diagonal").over(line)) > SHIFT)
             | (F.col("lo") > F.max("hi").over(before) + GAP))
    merged = votes.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("span", F.sum("new").over(line))
    merged = merged.groupBy(*key, "span").agg(
        F.least(F.sum("votes"), F.first("grams")).alias("votes"), F.min("lo").alias("first"), F.max("hi").alias("last"))
    share = F.col("votes") / F.col("grams")
    return merged.where(F.when(F.col("phrase"), share == 1).otherwise(share >= COVER)).withColumn("score", share)


def scan(docs: DataFrame, phrases: list = PHRASES, texts: list = LICENSE_TEXTS) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    found = hits(docs, phrases, texts)
    rows = spans(found).select("row", "doc_id", "n_words", "label", "phrase", "first", "score").unionByName(
        found.where("template IS NULL").select("row", "doc_id", "n_words"), allowMissingColumns=True)
    base = F.when(F.col("phrase"), F.col("first").cast("long"))
    join = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    return rows.groupBy("row", "doc_id", "n_words").agg(
        F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"),
        join(F.when(F.col("phrase"), F.col("label"))).alias("base_labels"), join("label").alias("labels"),
        F.round(F.coalesce(F.max("score"), F.lit(0.0)), 6).alias("score")).drop("row")
