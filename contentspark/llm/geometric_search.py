"""Ranked lexical search over posting lists that are cut into geometric blocks.

A document's vector holds an impact for each term (the term's weight times its saturated
frequency, whole numbers); a query's score is the inner product with its term counts.

1. One pass over the texts counts the terms that the queries use, and writes a forward index
   row for every document. Term weights come from one grouped count over that index.
2. Queries are dealt to groups of at most ``GROUP_POSTINGS`` (query, term) pairs, or one query;
   a group is what a task holds in memory, and its terms are numbered from the rarest.
3. Each task cuts the documents it reads into segments. In a segment, each term's posting list
   is clustered by document similarity (inner products of hashed impact vectors with centres
   taken from the list) into blocks of about ``BLOCK`` documents. A block's summary is the
   coordinatewise maximum of its documents' vectors, over the terms that some query of the group
   has together with the list's term, from that term on: a document is looked for in the list
   of the first (rarest) term that it shares with a query, so that its later terms bound its
   score there, and lists of frequent terms need narrow summaries.
4. The blocks with the highest bounds of each query, over all segments, are scored first; the k-th
   of those scores (and its doc_id) is the query's threshold everywhere. Every other block is
   skipped only if its exact bound is below that threshold, or equal to it with no doc_id small
   enough to win the tie. Documents of the blocks that are left are scored through the forward
   index, and each query's best are ranked.

No document of the result can be lost: its score is at most the bound of its block in the list
of its first term, and at least the threshold.

Defined results: a null or empty text has no terms and is not counted; a query without terms, or
whose terms no document holds, has no rows. Rows that share a doc_id are documents each, as are
rows without doc_id, which come last among equal scores; queries that share an item_id are
searched each. Fewer than k documents with a score above 0 give all. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contentspark.llm.common import BROADCAST_ROWS, by_key, materialize, small_batches
from contentspark.llm.ranks import positions

GROUP_POSTINGS = 1 << 16  # (query, term) pairs of a group of queries
SEGMENT_ROWS = 4096       # documents of a segment, at most
SEGMENT_CELLS = 1 << 24   # and documents x terms of the group in it, at most
BLOCK = 64                # documents of a block, about
SKETCH = 64               # coordinates of a hashed impact vector
FIRST_BLOCKS = 8          # blocks that are scored for a query's threshold
LAST = np.iinfo(np.int64).max  # stands for a null doc_id, which comes last

# Fixed values of the contract: letters and digits are kept, A-Z lower-cased, other ASCII parts terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(text: str | None) -> Counter:
    """The terms of a text as UTF-8 bytes, with their numbers."""
    return Counter((text or "").encode("utf-8", "replace").translate(TERM_BYTES).split())


def _count(vocabulary):
    """Rows (id, text) to (row, id, n, words, tfs); words outside the broadcast ``vocabulary`` are counted in n alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if vocabulary is None else vocabulary.value
        row = TaskContext.get().partitionId() << 33
        for b in batches:
            counts = [term_counts(t) for t in b["text"].to_pylist()]
            words = [list(c) if known is None else list(c.keys() & known) for c in counts]
            tfs = [np.fromiter((c[w] for w in ws), np.int32, len(ws)) for c, ws in zip(counts, words)]
            yield pa.record_batch(
                [pa.array(range(row, row + b.num_rows), pa.int64()), b["id"], pa.array([c.total() for c in counts], pa.int64()),
                 pa.array(words, pa.list_(pa.binary())), pa.array(tfs, pa.list_(pa.int32()))],
                names=["row", "id", "n", "words", "tfs"])
            row += b.num_rows

    return run


COUNTED = "row bigint, id bigint, n bigint, words array<binary>, tfs array<int>"


def counted(table: DataFrame, key: str, vocabulary: DataFrame | None, label: str) -> DataFrame:
    """The forward index (row, id, n, terms, tfs) of a table's texts, in the terms of ``vocabulary`` (word, term)."""
    spark = table.sparkSession
    texts = table.select(F.col(key).cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    if vocabulary is None:
        return materialize(texts.mapInArrow(_count(None), COUNTED), label)
    few = vocabulary.count() <= BROADCAST_ROWS
    if few:
        known = {bytes(r["word"]): r["term"] for r in vocabulary.collect()}
        shared = spark.sparkContext.broadcast(known)

        def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            terms = shared.value
            for b in _count(shared)(batches):
                ids = [np.fromiter((terms[w] for w in ws), np.int64, len(ws)) for ws in b["words"].to_pylist()]
                yield pa.record_batch([b["row"], b["id"], b["n"], pa.array(ids, pa.list_(pa.int64())), b["tfs"]],
                                      names=["row", "id", "n", "terms", "tfs"])

        return materialize(texts.mapInArrow(numbered, "row bigint, id bigint, n bigint, terms array<bigint>, tfs array<int>"), label)
    rows = materialize(texts.mapInArrow(_count(None), COUNTED), f"{label}-words")
    found = rows.select("row", F.explode(F.arrays_zip("words", "tfs")).alias("p")).select("row", "p.words", "p.tfs")
    found = found.join(vocabulary, found.words == vocabulary.word).groupBy("row").agg(
        F.collect_list(F.struct("term", "tfs")).alias("p"))
    return materialize(rows.select("row", "id", "n").join(found, "row", "left").select(
        "row", "id", "n", F.coalesce(F.col("p.term"), F.array().cast("array<bigint>")).alias("terms"),
        F.coalesce(F.col("p.tfs"), F.array().cast("array<int>")).alias("tfs")), label)


class Group:
    """A group of queries: terms numbered from the rarest, the queries' counts, the term weights."""

    def __init__(self, rows: list, documents: int, length: int):
        terms = {r["term"]: (r["df"], r["weight"]) for r in rows}
        self.terms = np.array(sorted(terms, key=lambda t: (terms[t][0], t)), np.int64)
        self.weights = np.array([terms[t][1] for t in self.terms.tolist()], np.int64)
        self.queries = np.array(sorted({r["query"] for r in rows}), np.int64)
        self.documents, self.length = documents, length
        self._sorted = np.argsort(self.terms)
        q = np.searchsorted(self.queries, [r["query"] for r in rows])
        t = self.local(np.array([r["term"] for r in rows], np.int64))
        order = np.lexsort((t, q))
        self.q, self.t = q[order], t[order]
        self.tf = np.array([r["tf"] for r in rows], np.int64)[order]
        self.start = np.searchsorted(self.q, np.arange(len(self.queries) + 1))
        by_term = np.argsort(self.t, kind="stable")
        self.of_term = np.split(by_term, np.searchsorted(self.t[by_term], np.arange(1, len(self.terms))))
        self._lists: dict[int, tuple] = {}

    def local(self, terms: np.ndarray) -> np.ndarray:
        """Numbers of terms in this group, -1 for others."""
        at = np.minimum(np.searchsorted(self.terms, terms, sorter=self._sorted), len(self.terms) - 1)
        found = self._sorted[at]
        return np.where(self.terms[found] == terms, found, -1)

    def of_list(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The queries that have a term, the terms from it on that they have, and their counts of those (queries x terms)."""
        if term not in self._lists:
            at = self.of_term[term]  # rows of the pairs; a query's rows stand in order of term
            ends = self.start[self.q[at] + 1]
            rows = np.concatenate([np.arange(a, b) for a, b in zip(at, ends)])
            columns, place = np.unique(self.t[rows], return_inverse=True)
            counts = np.zeros((len(at), len(columns)), np.int64)
            counts[np.repeat(np.arange(len(at)), ends - at), place] = self.tf[rows]
            self._lists[term] = self.q[at], columns, counts
        return self._lists[term]

    def impacts(self, terms: np.ndarray, tfs: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 75 + 25 * n * self.documents // self.length
        tfs = tfs.astype(np.int64)
        return self.weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 12 * m))


def products(counts: np.ndarray, most: np.ndarray) -> np.ndarray:
    """counts @ most.T exactly."""
    if int(counts.sum(axis=1).max(initial=0)) * int(most.max(initial=0)) < 1 << 53:
        return (counts.astype(np.float64) @ most.T.astype(np.float64)).astype(np.int64)
    return counts @ most.T


def cluster(sketches: np.ndarray) -> np.ndarray:
    """A block number for each document of a list: that of the centre nearest to it, cut where a cluster is large."""
    n = len(sketches)
    if n <= BLOCK:
        return np.zeros(n, np.int64)
    centres = sketches[:: BLOCK]  # documents of the list, evenly spread over it
    near = np.argmax(sketches @ centres.T, axis=1)
    order = np.argsort(near, kind="stable")
    first = np.searchsorted(near[order], near[order])
    piece = (np.arange(n) - first) // BLOCK
    label = np.empty(n, np.int64)
    label[order] = np.cumsum(np.concatenate([[0], (np.diff(near[order]) != 0) | (np.diff(piece) != 0)]))
    return label


LISTS = "term int, docs binary, starts binary, least binary, most binary"


def _index(shared, segment_rows: int):
    """Forward rows to posting lists in geometric blocks: a row per segment and term."""
    def segment(g: Group, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        row, ids = t["row"].to_numpy(), t["id"].fill_null(LAST).to_numpy()
        lists = t["terms"].combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        doc = np.repeat(np.arange(len(row)), lengths)
        term = g.local(lists.flatten().to_numpy())
        impact = g.impacts(np.maximum(term, 0), t["tfs"].combine_chunks().flatten().to_numpy(), np.repeat(t["n"].to_numpy(), lengths))
        keep = term >= 0
        doc, term, impact = doc[keep], term[keep], impact[keep]
        vectors = np.zeros((len(row), len(g.terms)), np.int64)
        vectors[doc, term] = impact
        mixed = term * 2654435761 % (1 << 32)
        sketches = np.zeros((len(row), SKETCH), np.float32)
        np.add.at(sketches, (doc, mixed >> 8 & (SKETCH - 1)), np.where(mixed >> 20 & 1, impact, -impact).astype(np.float32))
        sketches /= np.maximum(np.linalg.norm(sketches, axis=1, keepdims=True), 1e-9)
        by_term = np.argsort(term, kind="stable")
        cuts = np.flatnonzero(np.diff(term[by_term], prepend=-1))
        out: dict[str, list] = {"term": [], "docs": [], "starts": [], "least": [], "most": []}
        for a, b in zip(cuts, [*cuts[1:], len(by_term)]):
            held = doc[by_term[a:b]]
            number = int(term[by_term[a]])
            label = cluster(sketches[held])
            order = np.argsort(label, kind="stable")
            held = held[order]
            starts = np.searchsorted(label[order], np.arange(label.max() + 1)).astype(np.int64)
            _, columns, _ = g.of_list(number)
            out["term"].append(number)
            out["docs"].append(row[held].tobytes())
            out["starts"].append(starts.tobytes())
            out["least"].append(np.minimum.reduceat(ids[held], starts).tobytes())
            out["most"].append(np.maximum.reduceat(vectors[np.ix_(held, columns)], starts, axis=0).tobytes())
        kinds = [pa.int32()] + [pa.binary()] * 4
        return pa.record_batch([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, parts, held = shared.value, [], 0
        for b in batches:
            while b.num_rows:
                take = b.slice(0, segment_rows - held)
                parts.append(take)
                held += take.num_rows
                b = b.slice(take.num_rows)
                if held == segment_rows:
                    yield segment(g, parts)
                    parts, held = [], 0
        if held:
            yield segment(g, parts)

    return run


def _read(batches: Iterator[pa.RecordBatch], g: Group) -> Iterator[tuple]:
    """Each list's queries, their blocks' bounds (queries x blocks), smallest doc_ids, documents and starts."""
    for b in batches:
        for r in b.to_pylist():
            q, columns, counts = g.of_list(r["term"])
            starts = np.frombuffer(r["starts"], np.int64)
            most = np.frombuffer(r["most"], np.int64).reshape(len(starts), len(columns))
            yield q, products(counts, most), np.frombuffer(r["least"], np.int64), np.frombuffer(r["docs"], np.int64), starts


def _best_blocks(shared, blocks: int):
    """The blocks with the highest bounds of each query among a task's lists: (query, bound, docs)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        best: list[list] = [[] for _ in g.queries]
        worst = np.zeros(len(g.queries), np.int64)
        for q, bounds, _, docs, starts in _read(batches, g):
            at = np.argmax(bounds, axis=1)  # one block of a list, for lists of other terms hold other documents
            top = bounds[np.arange(len(q)), at]
            for i in np.flatnonzero(top > worst[q]):
                x = q[i]
                end = starts[at[i] + 1] if at[i] + 1 < len(starts) else len(docs)
                best[x].append((int(top[i]), docs[starts[at[i]]:end].copy()))
                if len(best[x]) > blocks:
                    best[x].remove(min(best[x], key=lambda e: e[0]))
                if len(best[x]) == blocks:
                    worst[x] = min(e[0] for e in best[x])
        rows = [(x, bound, d) for x, of in enumerate(best) for bound, d in of]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                               pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["q", "bound", "docs"])

    return run


def _open_blocks(shared, least_score: np.ndarray, least_id: np.ndarray):
    """The blocks that no query's threshold closes: (q, docs)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        out_q, out_docs = [], []
        for q, bounds, least, docs, starts in _read(batches, g):
            kth = least_score[q][:, None]
            going = (bounds > kth) | ((bounds == kth) & (least[None, :] <= least_id[q][:, None]))
            ends = np.append(starts[1:], len(docs))
            for i, b in zip(*np.nonzero(going)):
                out_q.append(q[i])
                out_docs.append(docs[starts[b]:ends[b]])
            if len(out_q) > 2000:
                yield pa.record_batch([pa.array(out_q, pa.int32()), pa.array(out_docs, pa.list_(pa.int64()))], names=["q", "docs"])
                out_q, out_docs = [], []
        yield pa.record_batch([pa.array(out_q, pa.int32()), pa.array(out_docs, pa.list_(pa.int64()))], names=["q", "docs"])

    return run


def _score(shared):
    """Forward rows with the queries to score them for, to (q, doc_id, score)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        vector = np.zeros(len(g.terms), np.int64)
        for b in batches:
            out_q, out_id, out_score = [], [], []
            for doc_id, n, terms, tfs, qs in zip(*(b[c].to_pylist() if c == "id" else b[c] for c in ("id", "n", "terms", "tfs", "qs"))):
                term = g.local(terms.values.to_numpy())
                keep = term >= 0
                vector[term[keep]] = g.impacts(term[keep], tfs.values.to_numpy()[keep], np.int64(n.as_py()))
                for q in np.unique(qs.values.to_numpy()):
                    a, e = g.start[q], g.start[q + 1]
                    out_score.append(int(g.tf[a:e] @ vector[g.t[a:e]]))
                    out_q.append(q)
                    out_id.append(doc_id)
                vector[term[keep]] = 0
            yield pa.record_batch([pa.array(out_q, pa.int32()), pa.array(out_id, pa.int64()), pa.array(out_score, pa.int64())],
                                  names=["q", "doc_id", "score"])

    return run


def _best(scores: DataFrame, k: int) -> DataFrame:
    """Each query's k best rows, with rank."""
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return scores.where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _scored(forward: DataFrame, blocks: DataFrame, shared, label: str) -> DataFrame:
    """(q, doc_id, score) of every document in blocks (q, docs)."""
    pairs = blocks.select("q", F.explode("docs").alias("row")).distinct()
    wanted = materialize(pairs.groupBy("row").agg(F.collect_list("q").alias("qs"), F.count("*").alias("pairs")), label)
    n = wanted.agg(F.sum("pairs")).first()[0] or 0
    met = forward.join(by_key(wanted.drop("pairs"), n), "row").select("id", "n", "terms", "tfs", "qs")
    return met.mapInArrow(_score(shared), "q int, doc_id bigint, score bigint")


def weight(documents: int) -> Column:
    """A term's weight from its df."""
    return F.floor(1000 * F.log((F.lit(2 * documents + 2).cast("double")) / (2 * F.col("df") + 1).cast("double"))).cast("long")


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents (doc_id, text) of every item (item_id, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    asked = counted(items, "item_id", None, "rank-items")
    pairs = asked.select(F.col("row").alias("query"), F.col("id").alias("item_id"), F.explode(F.arrays_zip("words", "tfs")).alias("p"))
    pairs = pairs.select("query", "item_id", F.col("p.words").alias("word"), F.col("p.tfs").alias("tf"))
    words = pairs.select("word").distinct().withColumn("all", F.lit(0))
    vocabulary = materialize(positions(words, "all", [F.col("word")], "rank-words").select("word", F.col("index").alias("term")),
                             "rank-vocabulary")
    forward = counted(docs, "doc_id", vocabulary, "rank-forward")
    documents, length = forward.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = forward.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    df = materialize(df.withColumn("weight", weight(documents)), "rank-weights")
    queries = pairs.join(vocabulary, "word").join(df, "term").select("query", "item_id", "term", "tf", "df", "weight")
    sizes = queries.groupBy("query", "item_id").agg(F.count("*").alias("n")).withColumn("all", F.lit(0))
    sizes = positions(sizes, "all", [F.col("query")], "rank-queries")
    before = Window.partitionBy("part").orderBy("index")
    # A group starts anew with every GROUP_POSTINGS pairs, counted in parts of as many queries.
    sizes = sizes.withColumn("part", F.expr(f"index div {GROUP_POSTINGS}")).withColumn(
        "group", F.floor(F.sum("n").over(before) / GROUP_POSTINGS))
    queries = materialize(queries.join(sizes.select("query", "part", "group"), "query"), "rank-pairs")
    results = None
    for group in queries.select("part", "group").distinct().orderBy("part", "group").collect():
        of = queries.where((F.col("part") == group["part"]) & (F.col("group") == group["group"]))
        found = search_group(forward, of, documents, length, k)
        results = found if results is None else results.unionByName(found)
    if results is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return results


def search_group(forward: DataFrame, queries: DataFrame, documents: int, length: int, k: int) -> DataFrame:
    """The search for one group of queries (query, item_id, term, tf, df, weight)."""
    spark = forward.sparkSession
    g = Group(queries.select("query", "term", "tf", "df", "weight").collect(), documents, length)
    shared = spark.sparkContext.broadcast(g)
    segment = max(1, min(SEGMENT_ROWS, SEGMENT_CELLS // len(g.terms)))
    lists = materialize(forward.select("row", "id", "n", "terms", "tfs").mapInArrow(_index(shared, segment), LISTS), "rank-lists")

    first = lists.mapInArrow(_best_blocks(shared, FIRST_BLOCKS), "q int, bound bigint, docs array<bigint>")
    highest = Window.partitionBy("q").orderBy(F.col("bound").desc())
    first = first.withColumn("place", F.row_number().over(highest)).where(F.col("place") <= FIRST_BLOCKS)
    seen = _best(_scored(forward, first, shared, "rank-first"), k).where(F.col("rank") == k).collect()
    least_score, least_id = np.ones(len(g.queries), np.int64), np.full(len(g.queries), LAST)
    for r in seen:
        least_score[r["q"]] = r["score"]
        least_id[r["q"]] = LAST if r["doc_id"] is None else r["doc_id"]

    blocks = lists.mapInArrow(_open_blocks(shared, least_score, least_id), "q int, docs array<bigint>")
    best = materialize(_best(_scored(forward, blocks, shared, "rank-open"), k), "rank-best")
    names = spark.createDataFrame([(i, int(q)) for i, q in enumerate(g.queries)], "q int, query long")
    ids = queries.select("query", "item_id").distinct()
    return best.join(F.broadcast(names), "q").join(ids, "query").select(
        "item_id", F.col("rank").cast(T.IntegerType()).alias("rank"), "doc_id", "score")
