"""The corpus pipeline: filter, remove copies, mix and tokenize ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``. All stages but the last return the columns of
``documents``.

1. quality: the Kneser-Ney classifier, trained on documents that ``labels`` trusts; what it
   rejects goes (also texts that are null or empty).
2. exact_dedup: of equal texts (white space runs count as one space) the smallest doc_id stays.
3. near_dedup: of each class of near copies (Jaccard 0.8 on five-word n-grams, linked
   directly or through others) the smallest doc_id stays.
4. mixing: each source is taken up to its target; documents taken more than once repeat with
   the same doc_id, of one taken in part each run of picked words is a row.
5. tokens: the piece ids of every row, and whether they decode to its text.

``ORACLE_SQL`` is None: perplexities, similarity classes and piece searches are beyond SQL.
``tests/llm/test_pipeline.py`` holds every stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contentspark.llm import exact_dedup, kneser_ney, mixing, ngram_join, sentencepiece_unigram
from contentspark.llm.common import load, materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return kneser_ney.keep_good(docs, load(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.deduplicate(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return ngram_join.one_of_each_class(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold the words that the mix takes."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, n_byte_tokens, ids and round_trip of every row."""
    return sentencepiece_unigram.encode(docs)


STAGES = [
    ("quality", quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixture),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
