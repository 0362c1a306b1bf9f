"""Exact top-k search by inner product, with block-at-a-time pruning.

Vectors are quantised to integers, floor(1024 * x) per component. A term is a dimension; its
weight in a document may be negative, so a block keeps each term's largest and smallest weight.

1. Documents are range-partitioned by vec_id; a partition's rows in order are cut into
   document-range blocks. A block is one row: its forward index (ids and the matrix of
   weights) and its terms' maxima and minima.
2. Queries are dealt to batches. Every pair of (range of blocks, query batch) is a tile, one
   group of a cogrouped shuffle: both sides of a tile have a bounded number of rows, whatever
   the table's size. The queries are a stated set that is held against all rows.
3. In a tile, blocks are ordered for each query by the sum of its terms' best products with
   the block's extremes, which no document of the block can exceed. Blocks are scored through
   their forward index in that order until the bound falls below the query's k-th score
   (an equal bound is still scored: ties go to the smaller id).
4. The tiles' top k are ranked per query; Spark keeps k rows per query and task before it
   shuffles them.

Scores are exact: products of integers are summed as doubles only where every sum is below
2**53, and as whole numbers of any size otherwise; components and scores are cut to 64 bits.

Defined results: vectors that are null or hold null or non-finite components, and rows without
vec_id, take no part. A shorter vector counts as padded with zeros; an empty one scores 0.
Rows that share a vec_id are candidates each; the least of their vectors is the query, and
none of them is its candidate. Fewer than k candidates give all. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contentspark.llm.common import materialize

SCALE = 1024
BLOCK_ROWS = 512
RANGE_ROWS = 8192     # rows of a range of blocks, on average
BATCH_QUERIES = 1024  # queries of a batch, on average


def quantised(vector: Column) -> Column:
    """floor(1024 * x) of every component, null for a vector that takes no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long"))
    return F.when(vector.isNotNull() & usable, whole)


def _matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


BLOCK = "range int, block int, width int, ids binary, weights binary, most binary, least binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts the sorted rows of a partition into blocks."""
    def row(part: int, n: int, ids: list, vectors: list) -> pa.RecordBatch:
        m = _matrix(vectors, max(map(len, vectors)))
        values = (part, n, m.shape[1], np.array(ids, dtype=np.int64).tobytes(), m.tobytes(),
                  m.max(axis=0).tobytes() if m.shape[1] else b"", m.min(axis=0).tobytes() if m.shape[1] else b"")
        kinds = (pa.int32(),) * 3 + (pa.binary(),) * 4
        names = [x.split()[0] for x in BLOCK.split(", ")]
        return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    ids, vectors, part, n = [], [], None, 0
    for batch in batches:
        for p, i, v in zip(batch["part"].to_pylist(), batch["vec_id"].to_pylist(), batch["v"].to_pylist()):
            part = p
            ids.append(i)
            vectors.append(v)
            if len(ids) == BLOCK_ROWS:
                yield row(part, n, ids, vectors)
                ids, vectors, n = [], [], n + 1
    if ids:
        yield row(part, n, ids, vectors)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integer matrices, exactly, as int64."""
    largest = lambda m: max(int(m.max(initial=0)), -int(m.min(initial=0)))
    if max(1, a.shape[1]) * largest(a) * largest(b) < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def search_tile(blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], query_ids: np.ndarray,
                queries: np.ndarray, k: int) -> tuple[list[tuple[int, int, int]], int]:
    """(query, id, score) of each query's k best documents of the blocks, and how many (query, block) pairs were scored."""
    most, least = np.stack([b[2] for b in blocks]), np.stack([b[3] for b in blocks])
    bounds = _products(np.maximum(queries, 0), most) + _products(np.minimum(queries, 0), least)
    order = np.argsort(-bounds, axis=1, kind="stable")
    n = len(query_ids)
    ids, scores = [np.empty(0, np.int64)] * n, [np.empty(0, np.int64)] * n
    scored, active = 0, np.arange(n)
    for step in range(len(blocks)):
        now = order[active, step]
        kth = np.array([scores[q][-1] if len(scores[q]) >= k else np.iinfo(np.int64).min for q in active])
        going = bounds[active, now] >= kth  # bounds only fall from here on
        active, now = active[going], now[going]
        if not len(active):
            break
        scored += len(active)
        for b in np.unique(now):  # a block is scored for all queries that have come to it
            of = active[now == b]
            found = _products(queries[of], blocks[b][1])
            for q, s in zip(of, found):
                other = blocks[b][0] != query_ids[q]
                i, s = np.concatenate([ids[q], blocks[b][0][other]]), np.concatenate([scores[q], s[other]])
                best = np.lexsort((i, ~s))[:k]  # ~s falls as s rises, and can't overflow
                ids[q], scores[q] = i[best], s[best]
    return [(int(q), int(i), int(s)) for q, x, y in zip(query_ids, ids, scores) for i, s in zip(x, y)], scored


def _tile(k: int):
    def run(blocks: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(blocks) and len(queries):
            vectors = [np.asarray(v, dtype=np.int64) for v in queries["q"]]
            width = max([int(blocks["width"].max()), *map(len, vectors)])
            index = []
            for b in blocks.itertuples():
                read = lambda raw, shape, w=b.width: np.pad(
                    np.frombuffer(raw, dtype=np.int64).reshape(shape, w), ((0, 0), (0, width - w)))
                ids = np.frombuffer(b.ids, dtype=np.int64)
                weights = read(b.weights, len(ids))
                index.append((ids, weights, weights.max(axis=0) if width > b.width else read(b.most, 1)[0],
                              weights.min(axis=0) if width > b.width else read(b.least, 1)[0]))
            rows, _ = search_tile(index, queries["query_id"].to_numpy(), _matrix(vectors, width), k)
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row of vectors (vec_id, embedding) its k best others."""
    rows = vectors.where(F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding")).alias("v")).where("v IS NOT NULL")
    rows = materialize(rows, "topk-vectors")
    queries = materialize(rows.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q")), "topk-queries")
    ranges = max(1, -(-rows.count() // RANGE_ROWS))
    batches = max(1, -(-queries.count() // BATCH_QUERIES))
    blocks = materialize(
        rows.repartitionByRange(ranges, "vec_id").sortWithinPartitions("vec_id")
        .select(F.spark_partition_id().alias("part"), "vec_id", "v").mapInArrow(_blocks, BLOCK), "topk-blocks")
    last = blocks.agg(F.max("range")).first()[0] or 0
    left = blocks.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
    right = queries.withColumn("batch", F.pmod(F.hash("query_id"), F.lit(batches))).withColumn("range", F.explode(F.sequence(F.lit(0), F.lit(last))))
    tiles = left.groupBy("range", "batch").cogroup(right.groupBy("range", "batch")).applyInPandas(
        _tile(k), "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return tiles.withColumn("rank", F.row_number().over(best).cast(T.IntegerType())).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
