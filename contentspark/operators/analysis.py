"""Analysis job (DOC-22..24): analyzers, field rows, shingles, edge n-grams.

The postings themselves are :class:`contentspark.operators.search.TextIndex`.
Analyzers: ``plain`` (lower-case letter/digit runs, pure SQL) and
``english`` (plus stop words and the Porter stemmer in an Arrow pandas_udf;
stop words keep their position gap, as phrase matching expects).
"""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contentspark.functions.text import strip_html, tokens
from contentspark.session import written

PIECE_TOKENS = 1_000_000  # tokens whose shingles a task adds up at a time
BUCKET_CHARS = 2_000_000  # characters of text per bucket of shingles that are added up together

# English stop words of the standard stop filter.
ENGLISH_STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is",
                      "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there",
                      "these", "they", "this", "to", "was", "will", "with"]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _english_terms(arrs: pd.Series) -> pd.Series:
    """Stop words -> NULL (keeps positions), other tokens -> Porter stem."""
    from contentspark.functions.porter import stem

    stops = set(ENGLISH_STOP_WORDS)
    return arrs.map(lambda a: None if a is None else [None if t in stops else stem(t) for t in a])


def analyze(text: Column, analyzer: str = "plain", html: bool = False) -> Column:
    """Token array of a text column under an analyzer (NULL entries = removed stop words)."""
    t = strip_html(text) if html else text
    toks = tokens(t)
    if analyzer == "plain":
        return toks
    if analyzer == "english":
        return _english_terms(toks)
    raise ValueError(f"unknown analyzer {analyzer!r}")


def analyze_query_text(text: str, analyzer: str = "plain") -> list[str]:
    """Driver-side analysis of one literal query string (same rules)."""
    from contentspark.functions.porter import stem
    from contentspark.functions.text import py_tokens

    toks = py_tokens(text)
    if analyzer == "english":
        stops = set(ENGLISH_STOP_WORDS)
        toks = [stem(t) for t in toks if t not in stops]
    return toks


def unpivot_fields(docs: DataFrame, id_col: str, fields: Mapping[str, Column], extra: list[str] | None = None
                   ) -> DataFrame:
    """(doc_id, field, text[, extra...]) from named text columns, one scan."""
    arr = F.array(*[F.struct(F.lit(name).alias("field"), col.cast("string").alias("text"))
                    for name, col in fields.items()])
    return (docs.select(F.col(id_col).alias("doc_id"), *(extra or []), F.explode(arr).alias("f"))
            .select("doc_id", *(extra or []), F.col("f.field").alias("field"), F.col("f.text").alias("text"))
            .filter(F.col("text").isNotNull()))


def shingles(field_rows: DataFrame, min_n: int = 2, max_n: int = 3, analyzer: str = "plain", counted: bool = False) -> DataFrame:
    """DOC-23: word n-grams (min_n..max_n) of consecutive tokens: (doc_id, field, pos, n, shingle).

    Computed per row from the token array (``sequence`` + ``slice``): no
    window, no shuffle; a long document is just a long array in its own row.
    ``counted``: (n, shingle, freq, docs) instead, their occurrences and documents (null ids count as none).
    """
    if counted:
        return _counted(field_rows, min_n, max_n, analyzer)
    toks = analyze(F.col("text"), analyzer)
    outs = []
    for n in range(min_n, max_n + 1):
        starts = F.sequence(F.lit(1), F.greatest(F.size("toks") - n + 1, F.lit(0)))
        grams = F.transform(starts, lambda i: F.struct((i - 1).alias("pos"),
                                                       F.array_join(F.slice(F.col("toks"), i, n), " ").alias("g")))
        outs.append(field_rows.select("doc_id", "field", toks.alias("toks"))
                    .filter(F.size("toks") >= n)
                    .select("doc_id", "field", F.explode(grams).alias("x"))
                    .select("doc_id", "field", F.col("x.pos").alias("pos"), F.lit(n).alias("n"),
                            F.col("x.g").alias("shingle")))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def _counted(field_rows: DataFrame, min_n: int, max_n: int, analyzer: str) -> DataFrame:
    """Counted shingles: added up per piece of texts where these are read, then per bucket of shingles.

    A piece sends a bucket one row with its shingles, so neither occurrences nor documents are shuffled, and a
    frequent shingle is one entry per piece. Buckets have about BUCKET_CHARS of the texts each. Rows that share
    their document with another row are counted by occurrences.
    """
    spark = field_rows.sparkSession
    by_rows = lambda rows: shingles(rows, min_n, max_n, analyzer).groupBy("n", "shingle").agg(
        F.count(F.lit(1)).cast("bigint").alias("freq"), F.countDistinct("doc_id").cast("bigint").alias("docs"))
    if analyzer != "plain":  # removed stop words leave gaps
        return by_rows(field_rows)
    per_doc = field_rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("text")).alias("chars"))
    repeated = F.col("doc_id").isNotNull() & (F.col("rows") > 1)
    chars, again = per_doc.agg(F.coalesce(F.sum("chars"), F.lit(0)), F.count_if(repeated)).first()
    once = field_rows
    if again:
        ids = written(per_doc.filter(repeated).select("doc_id"), "repeated-documents")
        once = field_rows.join(ids, "doc_id", "left_anti")
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")  # rows are whole texts
    toks = once.select(analyze(F.col("text"), analyzer).alias("toks"), F.col("doc_id").isNotNull().cast("int").alias("doc"))
    pieces = toks.mapInArrow(_shingle_pieces(min_n, max_n, -(-chars // BUCKET_CHARS) or 1),
                             "n int, bucket int, shingles string, freq array<int>, docs array<int>")
    out = pieces.groupBy("n", "bucket").applyInArrow(_add_shingles, "n int, shingle string, freq bigint, docs bigint")
    if not again:
        return out
    return (out.unionByName(by_rows(field_rows.join(ids, "doc_id", "left_semi"))).groupBy("n", "shingle")
            .agg(F.sum("freq").alias("freq"), F.sum("docs").alias("docs")))


def _shingle_pieces(min_n: int, max_n: int, buckets: int):
    """Arrow batches (toks, doc: 1 if the text's row counts as a document) -> each piece's shingles by bucket."""
    def piece(held):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        table = pa.Table.from_batches(held)
        lists, doc = table.column("toks").combine_chunks(), table.column("doc").to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        coded = lists.flatten().dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        hashed = pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False)  # the same in every piece
        at, gram = np.arange(len(code)), code.copy()  # where n-grams begin, and their numbers by place
        for n in range(1, max_n + 1):
            if n > 1:
                at = at[at + n <= len(code)]
                at = at[row[at] == row[at + n - 1]]
            if not len(at):
                return
            key = gram[at] * len(words) + code[at + n - 1] if n > 1 else code
            order = np.argsort(key, kind="stable")  # places, and so rows, stay ascending
            new = np.diff(key[order], prepend=-1) != 0
            gram[at[order]] = np.cumsum(new) - 1
            if n < min_n:
                continue
            start = np.flatnonzero(new)
            of = row[at[order]]
            docs = np.add.reduceat((new | (np.diff(of, prepend=-1) != 0)) * doc[of], start)
            freq = np.diff(start, append=len(order))
            first = at[order[start]]
            mixed = np.zeros(len(first), dtype=np.uint64)
            for k in range(n):
                mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashed[code[first + k]]
            bucket = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
            dealt = np.argsort(bucket, kind="stable")
            first, bucket = first[dealt], bucket[dealt]
            begin = np.flatnonzero(np.diff(bucket, prepend=-1))
            lists_of = lambda values: pa.ListArray.from_arrays(pa.array(np.append(begin, len(first)).astype(np.int32)), values)
            joined = pc.binary_join_element_wise(*[words.take(pa.array(code[first + k])) for k in range(n)], " ")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(begin), n, dtype=np.int32)), pa.array(bucket[begin]), pc.binary_join(lists_of(joined), "\n"),
                 lists_of(pa.array(freq[dealt].astype(np.int32))), lists_of(pa.array(docs[dealt].astype(np.int32)))],
                names=["n", "bucket", "shingles", "freq", "docs"])

    def run(batches):
        held, tokens_held = [], 0
        for batch in batches:
            held.append(batch)
            tokens_held += len(batch.column("toks").flatten())
            if tokens_held >= PIECE_TOKENS:
                yield from piece(held)
                held, tokens_held = [], 0
        if held:
            yield from piece(held)

    return run


def _add_shingles(table):
    """Pieces of one bucket (n, bucket, shingles, freq, docs) -> (n, shingle, freq, docs)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    shingle = pa.chunked_array([c.flatten() for c in pc.split_pattern(table.column("shingles"), "\n").chunks])
    whole = lambda name: pa.chunked_array([c.flatten() for c in table.column(name).chunks]).cast(pa.int64())
    added = pa.table({"shingle": shingle, "freq": whole("freq"), "docs": whole("docs")}).group_by("shingle", use_threads=False).aggregate(
        [("freq", "sum"), ("docs", "sum")])
    n = pa.repeat(table.column("n")[0], added.num_rows)
    return pa.table({"n": n, "shingle": added["shingle"], "freq": added["freq_sum"], "docs": added["docs_sum"]})


def edge_ngrams(terms: Column, min_len: int = 3, max_len: int = 10) -> Column:
    """DOC-24: lower-cased prefixes of length min_len..min(max_len, len) of every token."""
    return F.flatten(F.transform(
        terms, lambda t: F.when(F.length(t) >= min_len, F.transform(
            F.sequence(F.lit(min_len), F.least(F.lit(max_len), F.length(t))),
            lambda i: F.substring(F.lower(t), 1, i))).otherwise(F.array().cast("array<string>"))))
