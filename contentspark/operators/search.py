"""Bulk full-text search (TXT-1..18) and scoring (SCR-1..11).

Shape: a *table of queries* ``(query_id, query)`` against a :class:`TextIndex`
of documents -> ``(query_id, doc_id, score)``. Every clause is an equi-join
of query terms with the index on ``term`` followed by grouped aggregation;
there are no cross joins and no per-query driver loops. Queries are whole
texts of any length.

Scoring (our fixed definitions, see SURVEY 2.0):
  BM25 per (term, field): idf * tf*(k1+1) / (tf + k1*(1-b+b*len/avg_len)),
  idf = ln(1 + (N - df + 0.5)/(df + 0.5)), k1 = 1.2, b = 0.75, N = docs with
  the field. ``best_fields`` multi-match = max over fields of
  weight * field score; ``cross_fields`` = per term max over fields plus
  tie * the other fields, blended df = max df over the fields; ``bool should``
  = sum of the matching clauses' boosted scores.
Phrase: all query positions at the same offset ``pos - qpos``; the phrase
frequency replaces tf and the summed idf of its terms replaces idf.
Fuzzy: per query token, vocabulary terms within the edit budget are found
through keys that two strings within k edits must share (see
:func:`fuzzy_expand`) and verified with ``levenshtein``; a token scores as its
best expansion.

Clauses that need all terms start from each query's rarest terms (phrase, cross-fields AND): only
documents that hold these meet the query's other terms. A tile of an AND match first finds
the documents that hold all terms of a query, by bits, and adds up only theirs.

Matches (OR and AND, exact and fuzzy) are added up in tiles of a block of documents
and a block of queries (:func:`_tiles`), unless their hits are counted to be few: what is shuffled are the postings of the
queries' terms, once per block of queries, and never the hits, whose number is that
of the queries times that of the documents. A frequent term is spread over all blocks.

Skew: postings are one row per (term, document, field), in document order as they
are read, so a term of most documents is spread over all files; query-time joins on
a hot term are split by adaptive execution.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field as dc_field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentspark.operators.analysis import analyze
from contentspark.session import written

K1 = 1.2
B = 0.75
TILE_DOCS = 1024  # documents and queries that one task's tile of a match has about
TILE_QUERIES = 512
BROADCAST_ROWS = 500_000  # rows of a query's side (terms, keys, candidates) that a lookup may broadcast
RAREST = 3  # terms of a query that a document has to hold before its other terms are looked at
TILE_HITS = 2_000_000  # hits that a tile adds up at a time


def few(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written and counted, as the small side of a join: broadcast if they are few, shuffled otherwise.

    Left to a plan's estimate, the postings are shuffled before the true size of this side is known.
    """
    rows = written(rows, name)
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


# ---------------------------------------------------------------- index


def _text_postings(batches):
    """Arrow batches (doc_id, field, toks) -> postings: each row's tokens grouped by term."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column("toks")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = batch.column("toks").flatten()
        row = np.repeat(np.arange(len(sizes)), sizes)
        pos = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        real = flat.is_valid().to_numpy(zero_copy_only=False)  # removed stop words are null, and keep their place
        row, pos, coded = row[real], pos[real], flat.drop_null().dictionary_encode()
        if not len(row):
            continue
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        key = row * len(coded.dictionary) + code
        order = np.argsort(key, kind="stable")  # positions stay ascending
        start = np.flatnonzero(np.diff(key[order], prepend=-1))
        first = order[start]  # a term's first occurrence
        of = row[first]
        tf = np.diff(start, append=len(order))
        head = np.searchsorted(row, np.arange(len(sizes)))
        yield pa.RecordBatch.from_arrays([
            coded.dictionary.take(pa.array(code[first])), batch.column("doc_id").take(pa.array(of)), batch.column("field").take(pa.array(of)),
            pa.array(first == head[of]), pa.array(np.bincount(row, minlength=len(sizes))[of].astype(np.int64)), pa.array(tf.astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(np.append(start, len(order)).astype(np.int32)), pa.array(pos[order].astype(np.int32)))],
            names=["term", "doc_id", "field", "opens", "len", "tf", "positions"])


@dataclass
class TextIndex:
    """Postings of a document set under one analyzer.

    ``postings``: (term, doc_id, field, opens, len, tf, positions), one
    row per term, document and field. ``len`` is the token count of the (doc,
    field), ``opens`` marks the row of its first token (one per non-empty
    field, which counts documents without a distinct). :meth:`build` writes
    the postings once to the shared checkpoint folder: every clause of a
    search then scans that Parquet table instead of re-tokenizing the corpus,
    and the lineage is cut (a lost executor does not re-run the analysis).
    """

    postings: DataFrame
    analyzer: str = "plain"
    df_table: DataFrame | None = None  # (field, term, df), written by materialize
    stats_table: DataFrame | None = None  # (field, n_docs, avg_len), written by materialize
    path: str | None = None  # where materialize wrote the tables
    _keys: dict = dc_field(default_factory=dict, repr=False)

    @classmethod
    def build(cls, field_rows: DataFrame, analyzer: str = "plain") -> "TextIndex":
        """Postings of field rows, written to the shared checkpoint folder; each text is grouped where it is read, no shuffle.

        Only rows that share (doc_id, field) with another row are shuffled: postings of theirs that agree in
        term, length and head are one.
        """
        spark = field_rows.sparkSession
        if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")  # rows are whole texts
        toks = field_rows.select("doc_id", "field", analyze(F.col("text"), analyzer).alias("toks"))
        types = dict(toks.dtypes)
        raw = written(toks.mapInArrow(_text_postings, f"term string, doc_id {types['doc_id']}, field {types['field']}, opens boolean, "
                                                      "len bigint, tf bigint, positions array<int>"), "postings")
        repeated = raw.filter("opens").groupBy("doc_id", "field").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        if repeated.isEmpty():
            return cls(raw, analyzer)
        repeated = written(repeated, "repeated-rows")
        same = raw["doc_id"].eqNullSafe(repeated["doc_id"]) & raw["field"].eqNullSafe(repeated["field"])
        merged = raw.join(repeated, same, "left_semi").groupBy("term", "doc_id", "field", "opens", "len").agg(
            F.sum("tf").alias("tf"), F.array_sort(F.flatten(F.collect_list("positions"))).alias("positions"))
        return cls(written(raw.join(repeated, same, "left_anti").unionByName(merged), "postings"), analyzer)

    def materialize(self) -> "TextIndex":
        """Write document frequencies and statistics, read from the written postings, under the shared checkpoint folder."""
        import os
        import uuid

        from contentspark.session import checkpoint_dir

        spark = self.postings.sparkSession
        path = os.path.join(checkpoint_dir(spark), f"index-{uuid.uuid4().hex}")
        self.term_df().write.mode("overwrite").parquet(os.path.join(path, "df"))
        self.stats().coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "stats"))
        return TextIndex(self.postings, self.analyzer, spark.read.parquet(os.path.join(path, "df")),
                         spark.read.parquet(os.path.join(path, "stats")), path)

    def vocab_keys(self, max_k: int) -> DataFrame:
        """(vterm, key) fuzzy keys of the vocabulary for budgets up to ``max_k``.

        Built once per index and budget; written next to a materialized index.
        """
        if max_k not in self._keys:
            vk = vocabulary_keys(self.vocabulary(), max_k)
            if self.path:
                import os

                p = os.path.join(self.path, f"vocab_keys_{max_k}")
                vk.write.mode("overwrite").parquet(p)
                vk = vk.sparkSession.read.parquet(p)
            self._keys[max_k] = vk
        return self._keys[max_k]

    def impact_tables(self) -> tuple[DataFrame, DataFrame]:
        """(term, field, doc_id, impact) and (term, field, most, df) for :mod:`topk`.

        ``impact`` is a posting's BM25 score, ``most`` a term's largest. Built once per index, from the
        written postings where there are any.
        """
        if "impacts" not in self._keys:
            rows = self.postings.join(self.term_df(), ["field", "term"]).join(F.broadcast(self.stats()), "field")
            impact = bm25(F.col("tf"), F.col("len"), F.col("avg_len"), F.col("df"), F.col("n_docs"))
            impacts = written(rows.select("term", "field", "doc_id", impact.alias("impact")), "impacts")
            most = impacts.groupBy("term", "field").agg(F.max("impact").alias("most"), F.count(F.lit(1)).alias("df"))
            self._keys["impacts"] = impacts, written(most, "largest-impacts")
        return self._keys["impacts"]

    def occurrences(self) -> DataFrame:
        """(doc_id, field, term, pos): one row per token."""
        return self.postings.select("doc_id", "field", "term", F.explode("positions").alias("pos"))

    def term_df(self) -> DataFrame:
        """(field, term, df): documents per term and field (stored when materialized)."""
        if self.df_table is not None:
            return self.df_table
        return self.postings.groupBy("field", "term").agg(F.count(F.lit(1)).cast("bigint").alias("df"))

    def stats(self) -> DataFrame:
        """(field, n_docs, avg_len) over documents where the field is not empty."""
        if self.stats_table is not None:
            return self.stats_table
        s = self.postings.groupBy("field").agg(F.count_if("opens").cast("bigint").alias("n_docs"),
                                               F.sum("tf").cast("bigint").alias("n_tok"))
        return s.select("field", "n_docs", (F.col("n_tok") / F.col("n_docs")).alias("avg_len"))

    def postings_for(self, terms: DataFrame) -> DataFrame:
        """Postings restricted to a set of terms (semi join before anything else)."""
        return self.postings.join(few(terms.select("term").distinct(), "lookup-terms"), "term", "left_semi")

    def vocabulary(self) -> DataFrame:
        return self.term_df().select("term").distinct()


_CATALOG: dict = {}


def input_signature(df: DataFrame) -> tuple:
    """(folder, modification time, files, bytes) of every table a DataFrame reads.

    One status and one content summary per table folder, whatever its number of files.
    """
    spark = df.sparkSession
    conf, out = spark._jsc.hadoopConfiguration(), []
    for folder in sorted({f.rpartition("/")[0] if f.rpartition("/")[0].endswith(".parquet") else f for f in df.inputFiles()}):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(conf)
        total = fs.getContentSummary(path)
        out.append((folder, fs.getFileStatus(path).getModificationTime(), total.getFileCount(), total.getLength()))
    return tuple(out)


def cached_index(key: str, field_rows: DataFrame, analyzer: str = "plain") -> TextIndex:
    """A materialized index shared by every query of the session over the same inputs.

    ``key`` names the document set and field definition; the input files'
    signature is part of the cache key, so a changed table rebuilds the index.
    """
    k = (key, analyzer, input_signature(field_rows), field_rows.sparkSession.sparkContext.applicationId)
    idx = _CATALOG.get(k)
    if idx is None:
        idx = TextIndex.build(field_rows, analyzer).materialize()
        _CATALOG[k] = idx
    return idx


def bm25(tf: Column, length: Column, avg_len: Column, df: Column, n_docs: Column) -> Column:
    idf = F.log(1.0 + (n_docs - df + 0.5) / (df + 0.5))
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / avg_len))


def idf(df: Column, n_docs: Column) -> Column:
    return F.log(1.0 + (n_docs - df + 0.5) / (df + 0.5))


# ---------------------------------------------------------------- query terms


def query_terms(queries: DataFrame, analyzer: str = "plain") -> DataFrame:
    """(query_id, term, qpos) of every analyzed query token."""
    return (queries.select("query_id", F.posexplode(analyze(F.col("query"), analyzer)).alias("qpos", "term"))
            .filter(F.col("term").isNotNull()))


def distinct_query_terms(qt: DataFrame) -> DataFrame:
    """(query_id, term, n_terms): distinct terms per query and how many there are."""
    d = qt.select("query_id", "term").distinct()
    n = d.groupBy("query_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_terms"))
    return d.join(n, "query_id")


def _scored(qt: DataFrame, index: TextIndex, fields: list[str], term_col: str = "term",
            only: DataFrame | None = None) -> DataFrame:
    """(query_id, doc_id, field, <qt cols>, score) for every (query term, doc, field) hit.

    ``qt`` has ``term_col`` = the index term to look up (an expansion for fuzzy).
    ``only``: candidates (query_id, doc_id[, field]) that hits are restricted to.
    """
    post = _postings(qt.select(F.col(term_col).alias("term")), index, fields, only)
    df = index.term_df().filter(F.col("field").isin(fields))
    stats = F.broadcast(index.stats().filter(F.col("field").isin(fields)))  # one row per field
    hits = (qt.join(post.drop("positions").withColumnRenamed("term", term_col), _on(only, [term_col]))
            .join(df.withColumnRenamed("term", term_col), ["field", term_col])
            .join(stats, "field"))
    return hits.withColumn("score", bm25(F.col("tf"), F.col("len"), F.col("avg_len"), F.col("df"), F.col("n_docs")))


def _on(only: DataFrame | None, keys: list[str]) -> list[str]:
    return keys if only is None else ["query_id", *keys]


def _postings(terms: DataFrame, index: TextIndex, fields: list[str], only: DataFrame | None) -> DataFrame:
    """Postings of ``terms`` in ``fields``; with candidates, one row per candidate (query_id, doc_id[, field])."""
    post = index.postings_for(terms).filter(F.col("field").isin(fields)).drop("part", "opens")
    if only is None:
        return post
    keys = [c for c in ("doc_id", "field") if c in only.columns]
    return post.join(few(only.select("query_id", *keys), "candidates"), keys)


def candidates(qt: DataFrame, index: TextIndex, fields: list[str], per_field: bool, term_col: str = "term") -> DataFrame:
    """(query_id, doc_id[, field]) that hold the query's ``RAREST`` rarest terms; queries with an unknown term have none.

    ``qt``: (query_id, term, ...); with ``term_col`` another column, a term stands for all its index
    terms there (fuzzy expansions). Rarity is the document frequency summed over these and the fields.
    """
    terms = qt.select("query_id", "term", F.col(term_col).alias("lookup")).distinct()
    dft = index.term_df().filter(F.col("field").isin(fields)).groupBy(F.col("term").alias("lookup")).agg(
        F.sum("df").alias("df"))
    per_term = terms.join(dft, "lookup", "left").groupBy("query_id", "term").agg(
        F.sum(F.coalesce("df", F.lit(0))).alias("n"))
    rare = (per_term.groupBy("query_id").agg(F.min("n").alias("n"), F.slice(F.array_sort(F.collect_list(F.struct("n", "term"))), 1, RAREST).alias("t"))
            .filter("n > 0").select("query_id", F.size("t").alias("n_rare"), F.explode("t.term").alias("rare")))
    rare = rare.join(terms.withColumnRenamed("term", "rare"), ["query_id", "rare"]).withColumnRenamed("lookup", "term")
    keys = ["query_id", *(["doc_id", "field"] if per_field else ["doc_id"])]
    post = index.postings_for(rare).filter(F.col("field").isin(fields))
    found = post.join(rare, "term").groupBy(*keys, "n_rare").agg(F.count_distinct("rare").alias("n"))
    return found.filter("n = n_rare").select(*keys)


def _add_up(weights: list[float], fuzzy: bool, every: bool, fields: list[str] | None = None):
    """Best-fields scores of one tile: its postings (doc_id, f, vid, score) and query terms (query_id, tid, vid, n_terms).

    With ``fields``, a row per matching field instead, named by them.
    """
    def run(left, right):
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([pa.field("query_id", right.schema.field("query_id").type), pa.field("doc_id", left.schema.field("doc_id").type),
                            *([pa.field("field", pa.string())] if fields else []), pa.field("score", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        def coded(table, name):
            chunk = table.column(name).combine_chunks().dictionary_encode("encode")
            return chunk.indices.to_numpy(zero_copy_only=False).astype(np.int64), chunk.dictionary

        def spread(sorted_keys, wanted):
            """(row of wanted, place in sorted_keys) of every equal pair, in pieces of about TILE_HITS."""
            begin, end = np.searchsorted(sorted_keys, wanted, "left"), np.searchsorted(sorted_keys, wanted, "right")
            total = np.cumsum(end - begin)
            at = 0
            while at < len(wanted):
                upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + TILE_HITS, "right")))
                n = (end - begin)[at:upto]
                yield np.repeat(np.arange(at, upto), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[at:upto], n)
                at = upto

        def distinct(a, b):
            """The distinct pairs of two columns, in order, as rows."""
            (a, i), (b, j) = np.unique(a, return_inverse=True), np.unique(b, return_inverse=True)
            i, j = np.divmod(np.unique(i * len(b) + j), len(b))
            return np.stack([a[i], b[j]], axis=1)

        def holders(cell, vid, n_cells, of_vid, tid, query, n_terms, n_queries):
            """Whether a posting's cell holds all terms of some query: each term is a row of bits, one per cell."""
            tids, place = np.unique(tid, return_inverse=True)
            pairs = distinct(of_vid, place)
            held = np.zeros((len(tids), n_cells), dtype=bool)
            for hit, pair in spread(pairs[:, 0], vid):
                held[pairs[pair, 1], cell[hit]] = True
            bits = np.packbits(held, axis=1)
            own = distinct(query, place)
            begin = np.searchsorted(own[:, 0], np.arange(n_queries + 1))
            need = np.zeros(n_queries, dtype=np.int64)
            need[query] = n_terms
            whole = np.zeros(bits.shape[1], dtype=np.uint8)
            for a, b, n in zip(begin[:-1], begin[1:], need):
                if b - a >= n:  # otherwise the index lacks a term
                    whole |= np.bitwise_and.reduce(bits[own[a:b, 1]], axis=0)
            return np.unpackbits(whole, count=n_cells).astype(bool)[cell]

        doc, docs = coded(left, "doc_id")
        query, queries = coded(right, "query_id")
        column = lambda table, name: table.column(name).to_numpy().astype(np.int64)
        cell, vid, score = doc * len(weights) + column(left, "f"), column(left, "vid"), left.column("score").to_numpy()
        tid = column(right, "tid")
        if every:
            kept = holders(cell, vid, len(docs) * len(weights), column(right, "vid"), tid, query, column(right, "n_terms"), len(queries))
            cell, vid, score = cell[kept], vid[kept], score[kept]
        if fuzzy and len(cell):  # a token scores as its best expansion in a document's field
            pairs = distinct(column(right, "vid"), tid)
            tids, place = np.unique(pairs[:, 1], return_inverse=True)
            order = np.argsort(cell, kind="stable")
            cell, vid, score = cell[order], vid[order], score[order]
            best = []
            for hit, pair in spread(pairs[:, 0], vid):
                key, s = cell[hit] * len(tids) + place[pair], score[hit]
                order = np.lexsort((s, key))
                last = np.flatnonzero(np.diff(key[order], append=-1))
                best.append((key[order][last], s[order][last]))
            key, score = (np.concatenate(x) for x in zip(*best))
            order = np.lexsort((score, key))  # a cell that two pieces share
            last = np.flatnonzero(np.diff(key[order], append=-1))
            key, score = key[order][last], score[order][last]
            cell, vid = key // len(tids), tids[key % len(tids)]
            own = distinct(tid, query)
            tid, holder = own[:, 0], own[:, 1]
        else:
            order = np.argsort(tid, kind="stable")
            tid, holder = tid[order], query[order]
        total = np.zeros(len(docs) * len(weights) * len(queries))
        count = np.zeros(len(total), dtype=np.int64)
        for hit, at in spread(tid, vid):
            key = cell[hit] * len(queries) + holder[at]
            total += np.bincount(key, weights=score[hit], minlength=len(total))
            count += np.bincount(key, minlength=len(total))
        shape = (len(docs), len(weights), len(queries))
        total, count = total.reshape(shape), count.reshape(shape)
        found = count > 0
        if every:
            need = np.zeros(len(queries), dtype=np.int64)
            need[query] = column(right, "n_terms")
            found = count == need
        if fields:
            d, f, q = np.nonzero(found)
            return pa.Table.from_arrays([queries.take(pa.array(q)), docs.take(pa.array(d)), pa.array(fields).take(pa.array(f)),
                                         pa.array(total[d, f, q] * np.array(weights)[f])], schema=schema)
        total = np.where(found, total * np.array(weights)[None, :, None], -np.inf).max(axis=1)
        d, q = np.nonzero(found.any(axis=1))
        return pa.Table.from_arrays([queries.take(pa.array(q)), docs.take(pa.array(d)), pa.array(total[d, q])], schema=schema)

    return run


def _tiles(qt: DataFrame, index: TextIndex, weights: Mapping[str, float], fuzzy: bool, every: bool,
           per_field: bool = False) -> DataFrame:
    """(query_id, doc_id, score) of best_fields matches, added up in tiles of documents and queries; ``per_field``:
    (query_id, doc_id, field, score) of every field that matches.

    ``qt``: (query_id, term, n_terms, vterm), ``vterm`` the index term that is looked up. The work of a tile
    is bounded by its documents' postings of its queries' terms; both sides are dealt by hashes. Many queries
    with rare terms have fewer hits than tiles would be dealt rows; these are joined instead.
    """
    fields = list(weights)
    qt = written(qt.select("query_id", "term", "n_terms", "vterm").distinct(), "query-terms")
    numbered = lambda c, name: written(qt.select(F.col(c).alias("v")).distinct().select(
        "v", F.monotonically_increasing_id().alias(name)), f"{name}-numbers")
    vids = numbered("vterm", "vid")
    tids = numbered("term", "tid") if fuzzy else vids.withColumnRenamed("vid", "tid")
    pairs = (qt.join(tids.withColumnRenamed("v", "term"), "term").join(vids.withColumnRenamed("v", "vterm"), "vterm")
             .select("query_id", "tid", "vid", "n_terms"))
    n_docs = index.stats().agg(F.max("n_docs")).first()[0] or 0
    n_queries = qt.agg(F.count_distinct("query_id")).first()[0]
    parts = int(qt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    doc_blocks = max(-(-n_docs // TILE_DOCS), min(parts, n_docs), 1)
    query_blocks = max(-(-n_queries // TILE_QUERIES), 1)
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every_block = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    lookups = index.term_df().filter(F.col("field").isin(fields)).withColumnRenamed("term", "v").join(vids, "v")
    lookups = lookups.join(F.broadcast(index.stats()), "field").withColumn("f", F.array_position(F.lit(fields), F.col("field")).cast("int") - 1)
    lookups = written(lookups.withColumnRenamed("v", "term"), "lookups")
    if _fewer_hits(pairs, lookups, query_blocks, doc_blocks):
        return _joined(qt, index, weights, lookups, fuzzy, every, per_field)
    score = bm25(F.col("tf"), F.col("len"), F.col("avg_len"), F.col("df"), F.col("n_docs"))
    left = (index.postings.select("term", "field", "doc_id", "tf", "len").join(lookups, ["term", "field"])
            .select(block("doc_id", doc_blocks).alias("db"), "doc_id", "f", "vid", score.alias("score"))
            .select(every_block(query_blocks).alias("qb"), "*"))
    right = pairs.select(block("query_id", query_blocks).alias("qb"), every_block(doc_blocks).alias("db"), "*")
    schema = f"query_id {dict(qt.dtypes)['query_id']}, doc_id {dict(left.dtypes)['doc_id']}, {'field string, ' if per_field else ''}score double"
    return left.groupBy("db", "qb").cogroup(right.groupBy("db", "qb")).applyInArrow(
        _add_up([float(weights[f]) for f in fields], fuzzy, every, fields if per_field else None), schema)


def _fewer_hits(pairs: DataFrame, lookups: DataFrame, query_blocks: int, doc_blocks: int) -> bool:
    """Whether the hits are fewer than the rows that tiles are dealt: each posting once per block of queries, each
    query term once per block of documents (rare terms, as order numbers)."""
    found = lookups.groupBy("vid").agg(F.sum("df").alias("df"))
    per = pairs.groupBy("vid").agg(F.count(F.lit(1)).alias("n")).join(found, "vid", "left").agg(
        F.sum(F.col("n") * F.coalesce("df", F.lit(0))).cast("double"), F.sum("df").cast("double"), F.sum("n")).first()
    hits, postings, terms = (x or 0 for x in per)
    return hits <= postings * query_blocks + terms * doc_blocks


def _joined(qt: DataFrame, index: TextIndex, weights: Mapping[str, float], lookups: DataFrame, fuzzy: bool, every: bool,
            per_field: bool) -> DataFrame:
    """What :func:`_tiles` gives, by a join of the queries' terms with their postings and a row per hit."""
    asked = qt.join(lookups.withColumnRenamed("term", "vterm").drop("vid", "f"), "vterm").withColumnRenamed("term", "token")
    asked = few(asked.withColumnRenamed("vterm", "term"), "lookups-of-queries")
    score = bm25(F.col("tf"), F.col("len"), F.col("avg_len"), F.col("df"), F.col("n_docs"))
    hits = index.postings.select("term", "field", "doc_id", "tf", "len").join(asked, ["term", "field"]).select(
        "query_id", "doc_id", "field", "token", "n_terms", score.alias("score"))
    keys = ["query_id", "doc_id", "field"]
    if fuzzy:  # a token scores as its best expansion in a document's field
        hits = hits.groupBy(*keys, "token", "n_terms").agg(F.max("score").alias("score"))
    out = hits.groupBy(*keys).agg(F.sum("score").alias("score"), F.count(F.lit(1)).alias("matched"), F.max("n_terms").alias("n_terms"))
    if every:
        out = out.filter(F.col("matched") == F.col("n_terms"))
    out = out.select(*keys, (F.col("score") * _weight(F.col("field"), weights)).alias("score"))
    return out if per_field else out.groupBy("query_id", "doc_id").agg(F.max("score").alias("score"))


def _weight(field_col: Column, weights: Mapping[str, float]) -> Column:
    w = F.lit(1.0)
    for f, v in weights.items():
        w = F.when(field_col == f, F.lit(float(v))).otherwise(w)
    return w


# ---------------------------------------------------------------- fuzzy


def fuzzy_budget(token_len: Column, fuzziness) -> Column:
    """Edit budget per query token: fixed int, or 'auto' = 0/1/2 for len <=2 / 3-5 / >5."""
    if fuzziness == "auto":
        return F.when(token_len <= 2, 0).when(token_len <= 5, 1).otherwise(2)
    return F.lit(int(fuzziness))


# Terms up to this length get deletion keys (at most L*L/2 + L + 1 short strings), longer ones
# k + 1 segments: both are lossless. Deletion keys fit better, but a vocabulary has many of them.
DELETION_LENGTH = 7


def deletion_keys(term: Column, k: int) -> Column:
    """All strings obtained by deleting up to k (<= 2) characters of ``term``, the term included."""
    n = F.length(term)
    cut = lambda s, i: F.concat(F.substring(s, 1, i - 1), F.substring(s, i + 1, 1 << 20))
    one = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: cut(term, i))
    keys = F.array(term)
    if k >= 1:
        keys = F.concat(keys, one)
    if k >= 2:
        keys = F.concat(keys, F.flatten(F.transform(one, lambda s: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), lambda j: cut(s, j)))))
    return F.array_distinct(keys)


def _segment(term: Column, k: int, i: int) -> Column:
    """Segment i of k + 1 equal parts of a string."""
    begin = F.floor(F.length(term) * i / (k + 1)).cast("int")
    return F.substring(term, begin + 1, F.floor(F.length(term) * (i + 1) / (k + 1)).cast("int") - begin)


def vocabulary_keys(vocabulary: DataFrame, max_k: int) -> DataFrame:
    """(vterm, key) of a vocabulary (term) for edit budgets up to ``max_k``.

    Short terms: ``d:`` and the deletion keys. Long terms: for each budget, their length and each of
    k + 1 segments; one of them survives k edits and stands within k characters of its place.
    """
    term, n = F.col("term"), F.length("term")
    keys = F.when(n <= DELETION_LENGTH, F.transform(deletion_keys(term, max_k), lambda x: F.concat(F.lit("d:"), x)))
    segments = [F.concat_ws(":", F.lit(f"s{k}.{i}"), n, _segment(term, k, i)) for k in range(1, max_k + 1) for i in range(k + 1)]
    exact = F.concat(F.lit("e:"), term)
    return vocabulary.select(term.alias("vterm"), F.explode(keys.otherwise(F.array(exact, *segments))).alias("key"))


def _query_keys(term: Column, k: int) -> Column:
    """Keys of a query token with budget k that meet :func:`vocabulary_keys`."""
    n = F.length(term)
    keys = F.when(n <= DELETION_LENGTH + k, F.transform(deletion_keys(term, k), lambda x: F.concat(F.lit("d:"), x))).otherwise(
        F.array().cast("array<string>"))
    if k == 0:
        return F.when(n <= DELETION_LENGTH, keys).otherwise(F.array(F.concat(F.lit("e:"), term)))
    wide = 2 * k + 1  # lengths that the vocabulary term may have, and places where its segment may stand

    def probe(x: Column) -> Column:
        length, i, shift = n + x % wide - k, F.floor(x / wide).cast("int") % (k + 1), F.floor(x / (wide * (k + 1))).cast("int") - k
        begin = F.floor(length * i / (k + 1)).cast("int")
        size = F.floor(length * (i + 1) / (k + 1)).cast("int") - begin
        key = F.concat_ws(":", F.concat(F.lit(f"s{k}."), i.cast("string")), length, F.substring(term, begin + shift + 1, size))
        return F.when((length > DELETION_LENGTH) & (begin + shift >= 0), key)

    probes = F.transform(F.sequence(F.lit(0), F.lit(wide * wide * (k + 1) - 1)), probe)
    return F.when(n > DELETION_LENGTH - k, F.concat(keys, F.array_distinct(F.array_compact(probes)))).otherwise(keys)


def fuzzy_expand(qt: DataFrame, vocabulary: DataFrame, fuzziness, vocab_keys: DataFrame | None = None) -> DataFrame:
    """qt + ``vterm``: vocabulary terms within the token's edit budget (the token itself when present).

    Equi-join on keys that strings within k edits share (never a cross join), then exact verification.
    ``vocab_keys`` (vterm, key) may come precomputed from the index.
    """
    max_k = 2 if fuzziness == "auto" else int(fuzziness)
    if max_k > 2:
        raise ValueError("edit budgets above 2 are not supported")
    terms = qt.select("term").distinct().withColumn("k", fuzzy_budget(F.length("term"), fuzziness))
    keys = F.when(F.col("k") == 0, _query_keys(F.col("term"), 0))
    for k in range(1, max_k + 1):
        keys = keys.when(F.col("k") == k, _query_keys(F.col("term"), k))
    # The queries' keys are few, the vocabulary's grow with the documents, and are made by all tasks.
    qk = few(terms.select("term", "k", F.explode(keys).alias("key")), "query-keys")
    parts = int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    vk = vocab_keys if vocab_keys is not None else vocabulary_keys(vocabulary.repartition(parts, "term"), max_k)
    edits = F.levenshtein(F.col("term"), F.col("vterm"), max_k)  # -1: more than max_k
    pairs = qk.join(vk, "key").filter((edits >= 0) & (edits <= F.col("k"))).select("term", "k", "vterm").distinct()
    return qt.join(pairs.drop("k"), "term")


# ---------------------------------------------------------------- clauses


def match(queries: DataFrame, index: TextIndex, weights: Mapping[str, float], operator: str = "or",
          fuzziness=0, analyzer: str | None = None) -> DataFrame:
    """TXT-1/2/6: best_fields multi-match -> (query_id, doc_id, score).

    operator 'and': every distinct query term in the same field.
    """
    qt = distinct_query_terms(query_terms(queries, analyzer or index.analyzer))
    fuzzy = fuzziness not in (0, "0", None)
    if fuzzy:
        max_k = 2 if fuzziness == "auto" else int(fuzziness)
        qt = fuzzy_expand(qt, index.vocabulary(), fuzziness, index.vocab_keys(max_k))
    else:
        qt = qt.withColumn("vterm", F.col("term"))
    return _tiles(qt, index, weights, fuzzy, operator == "and")


def field_scores(queries: DataFrame, index: TextIndex, fields: list[str], analyzer: str | None = None) -> DataFrame:
    """(query_id, doc_id, field, score): the OR match of every field on its own, for weights that differ by document (SCR-1/2)."""
    qt = distinct_query_terms(query_terms(queries, analyzer or index.analyzer)).withColumn("vterm", F.col("term"))
    return _tiles(qt, index, dict.fromkeys(fields, 1.0), False, False, per_field=True)


def phrase_offsets(queries: DataFrame, index: TextIndex, fields: list[str], analyzer: str | None = None) -> DataFrame:
    """(query_id, doc_id, field, len, offsets) of the documents that hold all the query's terms.

    ``offsets``: for each query position the array of ``pos - qpos``, shortest array first. Candidates
    come from the query's rarest term; a row's size is bounded by one document's postings.
    """
    qt = query_terms(queries, analyzer or index.analyzer)
    npos = qt.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_pos"))
    post = _postings(qt, index, fields, candidates(qt, index, fields, per_field=True))
    rows = post.join(qt, ["query_id", "term"]).select(
        "query_id", "doc_id", "field", "len", "qpos", "positions")
    all_terms = (rows.groupBy("query_id", "doc_id", "field", "len").agg(F.collect_list(F.struct("qpos", "positions")).alias("at"))
                 .join(npos, "query_id").filter(F.size("at") == F.col("n_pos")))
    shifted = F.transform("at", lambda x: F.transform(x["positions"], lambda p: p - x["qpos"]))
    sized = F.array_sort(F.transform(shifted, lambda a: F.struct(F.size(a).alias("n"), a.alias("a"))))
    return all_terms.select("query_id", "doc_id", "field", "len", F.transform(sized, lambda x: x["a"]).alias("offsets"))


def _phrase_score(freqs: DataFrame, queries: DataFrame, index: TextIndex, weights: Mapping[str, float],
                  analyzer: str | None) -> DataFrame:
    """freqs (query_id, doc_id, field, pf) -> best_fields phrase score."""
    fields = list(weights)
    qt = query_terms(queries, analyzer or index.analyzer).select("query_id", "term").distinct()
    df = index.term_df().join(qt.select("term").distinct(), "term", "left_semi").filter(F.col("field").isin(fields))
    stats = F.broadcast(index.stats().filter(F.col("field").isin(fields)))
    sum_idf = (qt.join(df, "term").join(stats, "field")
               .groupBy("query_id", "field").agg(F.sum(idf(F.col("df"), F.col("n_docs"))).alias("sum_idf")))
    s = (freqs.join(sum_idf, ["query_id", "field"]).join(stats, "field")
         .withColumn("score", F.col("sum_idf") * F.col("pf") * (K1 + 1)
                     / (F.col("pf") + K1 * (1 - B + B * F.col("len") / F.col("avg_len"))))
         .withColumn("score", F.col("score") * _weight(F.col("field"), weights)))
    return s.groupBy("query_id", "doc_id").agg(F.max("score").alias("score"))


def phrase(queries: DataFrame, index: TextIndex, weights: Mapping[str, float], analyzer: str | None = None
           ) -> DataFrame:
    """TXT-3: exact phrase (consecutive positions) -> (query_id, doc_id, score)."""
    off = phrase_offsets(queries, index, list(weights), analyzer)
    starts = F.aggregate("offsets", F.get("offsets", F.lit(0)), lambda found, a: F.array_intersect(found, a))
    pf = off.select("query_id", "doc_id", "field", F.size(starts).cast("double").alias("pf"), "len").filter("pf > 0")
    return _phrase_score(pf, queries, index, weights, analyzer)


def sloppy_phrase(queries: DataFrame, index: TextIndex, weights: Mapping[str, float], slop: int = 5,
                  analyzer: str | None = None) -> DataFrame:
    """TXT-4: phrase within ``slop`` position moves.

    Match iff some anchor offset d has every query position occurring with an
    offset in [d, d+slop] (the spread of the chosen offsets is <= slop).
    Frequency = number of distinct valid anchors. Anchors are tried against the
    shortest array first, so few of them reach the others.
    """
    off = phrase_offsets(queries, index, list(weights), analyzer)
    near = lambda a, d: F.exists(a, lambda x: (x >= d) & (x <= d + slop))
    anchors = F.filter(F.array_distinct(F.flatten("offsets")), lambda d: near(F.get("offsets", F.lit(0)), d))
    off = off.withColumn("anchors", anchors)
    anchors = F.filter("anchors", lambda d: F.forall("offsets", lambda a: near(a, d)))
    pf = off.select("query_id", "doc_id", "field", F.size(anchors).cast("double").alias("pf"), "len").filter("pf > 0")
    return _phrase_score(pf, queries, index, weights, analyzer)


def cross_fields(queries: DataFrame, index: TextIndex, fields: list[str], operator: str = "and",
                 tie: float = 0.5, analyzer: str | None = None) -> DataFrame:
    """TXT-5: terms may be spread over fields; blended df = max df over the fields; weights 1 (SCR-4)."""
    qt = distinct_query_terms(query_terms(queries, analyzer or index.analyzer))
    only = candidates(qt, index, fields, per_field=False) if operator == "and" else None
    hits = _scored(qt, index, fields, only=only)
    blended = index.term_df().filter(F.col("field").isin(fields)).groupBy("term").agg(F.max("df").alias("bdf"))
    h = (hits.join(blended, "term")
         .withColumn("score", bm25(F.col("tf"), F.col("len"), F.col("avg_len"), F.col("bdf"), F.col("n_docs"))))
    per_term = (h.groupBy("query_id", "doc_id", "term", "n_terms")
                .agg(F.max("score").alias("best"), F.sum("score").alias("total")))
    per_term = per_term.withColumn("score", F.col("best") + tie * (F.col("total") - F.col("best")))
    out = per_term.groupBy("query_id", "doc_id", "n_terms").agg(F.sum("score").alias("score"),
                                                                F.count(F.lit(1)).alias("matched"))
    if operator == "and":
        out = out.filter(F.col("matched") == F.col("n_terms"))
    return out.select("query_id", "doc_id", "score")


def bool_should(clauses: list[tuple[DataFrame, float]]) -> DataFrame:
    """Sum of boosted clause scores per (query, doc); a doc matches when any clause does."""
    parts = [c.select("query_id", "doc_id", (F.col("score") * F.lit(float(b))).alias("score")) for c, b in clauses]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("query_id", "doc_id").agg(F.sum("score").alias("score"))


def match_everything(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """TXT-7: an empty search text applies no text clause; every document scores 1."""
    return docs.select(F.col(id_col).alias("doc_id"), F.lit(1.0).alias("score"))


# ---------------------------------------------------------------- algorithms (UDF-5 registry)


def algo_default(queries, index, weights, analyzer=None):
    """TXT-9 ('default'/3.4): phrase x4 + AND x2 + OR fuzzy(1) x1."""
    return bool_should([(phrase(queries, index, weights, analyzer), 4.0),
                        (match(queries, index, weights, "and", 0, analyzer), 2.0),
                        (match(queries, index, weights, "or", 1, analyzer), 1.0)])


def algo_350(queries, index, weights, analyzer=None):
    """TXT-10 (3.5): phrase x3 + phrase slop 5 x1."""
    return bool_should([(phrase(queries, index, weights, analyzer), 3.0),
                        (sloppy_phrase(queries, index, weights, 5, analyzer), 1.0)])


def algo_400(queries, index, weights, analyzer=None):
    """TXT-11 (4.0, the default): phrase x3 + AND fuzzy auto x1 + cross_fields AND x1 (weights 1)."""
    return bool_should([(phrase(queries, index, weights, analyzer), 3.0),
                        (match(queries, index, weights, "and", "auto", analyzer), 1.0),
                        (cross_fields(queries, index, list(weights), "and", 0.5, analyzer), 1.0)])


ALGORITHMS = {"default": algo_default, "3.4": algo_default, "3.5": algo_350, "4.0": algo_400}


def register_algorithm(name: str, fn) -> None:
    """UDF-5: add a scoring function ``(queries, index, weights, analyzer) -> (query_id, doc_id, score)``."""
    ALGORITHMS[name] = fn


def search(queries: DataFrame, index: TextIndex, weights: Mapping[str, float], algorithm: str = "4.0",
           analyzer: str | None = None) -> DataFrame:
    """Run a registered algorithm; unknown names fall back to the default (4.0)."""
    return ALGORITHMS.get(algorithm, algo_400)(queries, index, weights, analyzer)


# ---------------------------------------------------------------- score adjustments


def decay_factor(date_col: Column, as_of, scale_days: float = 14.0, decay: float = 0.25,
                 offset_days: float = 7.0) -> Column:
    """SCR-7: exp decay on |as_of - date| (days) beyond ``offset``, plus 0.001."""
    age_days = F.abs(F.unix_timestamp(F.lit(as_of).cast("timestamp_ntz").cast("timestamp"))
                     - F.unix_timestamp(date_col.cast("timestamp"))) / 86400.0
    lam = math.log(decay) / scale_days
    return F.exp(F.lit(lam) * F.greatest(F.lit(0.0), age_days - offset_days)) + F.lit(0.001)


def apply_weights(hits_per_field: DataFrame, weights: DataFrame) -> DataFrame:
    """SCR-1/2/6: multiply per-(post_type, field) scores by the weighting table; disabled fields drop.

    ``hits_per_field``: (query_id, doc_id, post_type, field, score); weights:
    (post_type, field, enabled, weight). Weight 0 leaves the boost at 1. The
    weights table is one row per (type, field): broadcast.
    """
    w = F.broadcast(weights.filter(F.col("enabled")).select(
        "post_type", "field", F.when(F.col("weight") == 0, F.lit(1)).otherwise(F.col("weight")).alias("w")))
    return (hits_per_field.join(w, ["post_type", "field"])
            .withColumn("score", F.col("score") * F.col("w")).drop("w"))


def top_k(hits: DataFrame, k: int, score_col: str = "score", id_col: str = "doc_id") -> DataFrame:
    """SRT-10: k best documents per query (score desc, id asc) with ``rank``."""
    w = Window.partitionBy("query_id").orderBy(F.col(score_col).desc(), F.col(id_col).asc())
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def milli(score: Column) -> Column:
    """Score as an integer of thousandths (stable across engines)."""
    return F.round(score * 1000).cast("bigint")


# ---------------------------------------------------------------- highlight / excerpt

# Allowed highlight tags.
HIGHLIGHT_TAGS = ["mark", "span", "strong", "em", "i"]


def highlight(text: Column, terms: list[str], tag: str = "mark", css_class: str = "search-highlight") -> Column:
    """TXT-16: wrap whole-token, case-insensitive matches of ``terms`` in ``<tag class>``."""
    import re

    if tag not in HIGHLIGHT_TAGS:
        tag = "mark"
    if not terms:
        return text
    alt = "|".join(re.escape(t) for t in sorted(set(terms), key=len, reverse=True))
    pattern = rf"(?iu)(?<![\p{{L}}\p{{N}}])({alt})(?![\p{{L}}\p{{N}}])"
    return F.regexp_replace(text, pattern, f'<{tag} class="{css_class}">$1</{tag}>')


def highlight_terms(text: Column, terms: Column, tag: str = "mark", css_class: str = "search-highlight") -> Column:
    """TXT-16 over hit rows: ``terms`` is a per-row array of analyzed query tokens.

    Tokens are letter/digit runs, so they need no regex escaping.
    """
    if tag not in HIGHLIGHT_TAGS:
        tag = "mark"
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])("), F.array_join(terms, "|"),
                       F.lit(r")(?![\p{L}\p{N}])"))
    return F.when(F.size(terms) > 0, F.regexp_replace(text, pattern, F.lit(f'<{tag} class="{css_class}">$1</{tag}>'))) \
        .otherwise(text)


def excerpt(text: Column, words: int = 55, more: str = " […]") -> Column:
    """TXT-17: the first ``words`` space-separated words, plus a marker when cut."""
    parts = F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " ")
    return F.when(F.size(parts) > words, F.concat(F.array_join(F.slice(parts, 1, words), " "), F.lit(more))) \
        .otherwise(F.array_join(parts, " "))

