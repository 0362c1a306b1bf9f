"""Exact duplicates by exchanging Golomb-coded fingerprints.

1. Each input task cuts its rows into blocks. A block sorts its distinct
   fingerprints, cuts them by owner (the top bits) and sends each owner one
   message: the gaps between sorted fingerprints, Golomb-Rice coded.
2. Each owner decodes its messages and returns, for each, a bitmap of the
   fingerprints that another message holds as well.
3. Blocks read their bitmaps; rows whose fingerprint is marked (or repeats in
   the block itself) are suspects. Only their texts are shuffled, and grouped by
   the text's bytes, so that no fingerprint clash can join different texts.

Documents leave step 1 as digests; the texts of unique documents never move.
Many copies of one text collapse to one fingerprint in a message and to one row
in a task's partial aggregation before the text shuffle.

Defined results: null text counts as empty; empty texts are equal to each other.
A null doc_id is larger than any other (it stays only where no copy has an id).
Rows that repeat both doc_id and text all count in ``group_size`` and all carry
``kept``; ``deduplicate`` keeps one of them. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentspark.llm.common import by_key, materialize, one_space, whole_text

BLOCK_ROWS = 65_536          # documents whose fingerprints one block holds
OWNER_FINGERPRINTS = 1 << 22  # fingerprints that one owner is to hold, if MAX_OWNER_BITS allows
MIN_OWNER_BITS, MAX_OWNER_BITS = 6, 12
SPARE_BITS = 16              # a unique document is suspected with a chance of about 2**-16


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted distinct non-negative int64 values as gaps: unary quotients, then remainders of k bits."""
    n = len(values)
    if n == 0:
        return b""
    gaps = np.diff(values, prepend=-1).astype(np.uint64) - np.uint64(1)
    mean = (int(values[-1]) + 1) / n
    k = max(0, math.floor(math.log2(max(1.0, mean * math.log(2)))))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + n, dtype=np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    low = gaps & np.uint64((1 << k) - 1)
    remainders = np.empty((n, k), dtype=np.uint8)
    for bit in range(k):
        remainders[:, bit] = (low >> np.uint64(k - 1 - bit)) & np.uint64(1)
    head = np.array([n, k, len(unary)], dtype="<u8").tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(remainders).tobytes()


def golomb_decode(code: bytes) -> np.ndarray:
    """The values of ``golomb_encode`` as int64."""
    if not code:
        return np.empty(0, dtype=np.int64)
    n, k, length = (int(x) for x in np.frombuffer(code, dtype="<u8", count=3))
    split = 24 + (length + 7) // 8
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(code[24:split], dtype=np.uint8), count=length))
    gaps = (np.diff(ones, prepend=-1) - 1) << k
    if k:
        bits = np.unpackbits(np.frombuffer(code[split:], dtype=np.uint8), count=n * k).reshape(n, k)
        gaps = gaps + bits.astype(np.int64) @ (np.int64(1) << np.arange(k - 1, -1, -1, dtype=np.int64))
    return np.cumsum(gaps + 1) - 1


MESSAGES = ("block string, owner int, code binary, rank array<int>, "
            "doc_id array<bigint>, hash array<bigint>, sha array<string>")


def _messages(bits: int, owner_bits: int):
    """Block rows of one task: for each owner the coded fingerprints and, beside them, the rows they stand for."""
    shift = bits - owner_bits

    def block_rows(name: str, parts: list[pa.Table]) -> pa.RecordBatch:
        t = pa.concat_tables(parts)
        hashes = t["hash"].to_numpy()
        prints = (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(prints, kind="stable")
        t, prints = t.take(pa.array(order)), prints[order]
        owners = prints >> shift
        cuts = np.flatnonzero(np.diff(owners, prepend=-1))
        out = {"block": [], "owner": [], "code": [], "rank": [], "doc_id": [], "hash": [], "sha": []}
        for a, b in zip(cuts, [*cuts[1:], len(prints)]):
            values, rank = np.unique(prints[a:b] & ((1 << shift) - 1), return_inverse=True)
            part = t.slice(a, b - a)
            out["block"].append(name)
            out["owner"].append(int(owners[a]))
            out["code"].append(golomb_encode(values))
            out["rank"].append(rank.astype(np.int32))
            for c in ("doc_id", "hash", "sha"):
                out[c].append(part[c].combine_chunks())
        arrays = [pa.array(out["block"], pa.string()), pa.array(out["owner"], pa.int32()),
                  pa.array(out["code"], pa.binary()), pa.array(out["rank"], pa.list_(pa.int32()))]
        sizes = np.cumsum([0, *map(len, out["doc_id"])]).astype(np.int32)
        for c in ("doc_id", "hash", "sha"):
            arrays.append(pa.ListArray.from_arrays(pa.array(sizes), pa.concat_arrays(out[c])))
        return pa.record_batch(arrays, names=list(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, held, parts = TaskContext.get().partitionId(), 0, 0, []
        for b in batches:
            if b.num_rows:
                parts.append(pa.Table.from_batches([b]))
                held += b.num_rows
            if held >= BLOCK_ROWS:
                yield block_rows(f"{task}-{n}", parts)
                n, held, parts = n + 1, 0, []
        if held:
            yield block_rows(f"{task}-{n}", parts)

    return run


def _bitmaps(messages: pd.DataFrame) -> pd.DataFrame:
    """An owner's answer: for each message the fingerprints that occur in another one too."""
    values = [golomb_decode(c) for c in messages["code"]]
    every = np.concatenate(values)
    order = np.argsort(every, kind="stable")
    same = every[order[1:]] == every[order[:-1]]
    twice = np.zeros(len(every), dtype=bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    cuts = np.cumsum([len(v) for v in values])[:-1]
    return pd.DataFrame({"block": messages["block"], "owner": messages["owner"],
                         "bitmap": [np.packbits(x).tobytes() for x in np.split(twice, cuts)]})


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the blocks, each with whether its fingerprint repeats anywhere."""
    for batch in batches:
        for row in batch.to_pylist():
            rank = np.asarray(row["rank"])
            marked = np.unpackbits(np.frombuffer(row["bitmap"], dtype=np.uint8))[rank] > 0
            marked |= np.bincount(rank)[rank] > 1
            yield pa.record_batch(
                [pa.array(row["doc_id"], pa.int64()), pa.array(row["hash"], pa.int64()),
                 pa.array(row["sha"], pa.string()), pa.array(marked)],
                names=["doc_id", "hash", "sha", "suspect"])


def exact_groups(docs: DataFrame, total: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, text_hash.

    ``docs`` needs doc_id and text. The fingerprint's width follows the number of
    documents (``SPARE_BITS`` more than its logarithm); ``text_hash`` is the
    64-bit hash it is cut from.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), one_space(whole_text()).alias("norm"))
    hashed = docs.withColumn("hash", F.xxhash64("norm"))
    total = docs.count() if total is None else total
    owner_bits = min(MAX_OWNER_BITS, max(MIN_OWNER_BITS, math.ceil(math.log2(max(1, total / OWNER_FINGERPRINTS)))))
    bits = min(60, max(owner_bits + 1, math.ceil(math.log2(max(2, total))) + SPARE_BITS))

    blocks = materialize(
        hashed.select("doc_id", "hash", F.sha2("norm", 256).alias("sha"))
        .mapInArrow(_messages(bits, owner_bits), MESSAGES), "fingerprint-blocks")
    answers = (blocks.select("block", "owner", "code").groupBy("owner")
               .applyInPandas(_bitmaps, "block string, owner int, bitmap binary"))
    rows = materialize(
        blocks.drop("code").join(answers, ["block", "owner"]).select("rank", "doc_id", "hash", "sha", "bitmap")
        .mapInArrow(_suspects, "doc_id bigint, hash bigint, sha string, suspect boolean"), "fingerprint-rows")

    marked = materialize(rows.where("suspect").select("hash").distinct(), "suspect-hashes")
    groups = (hashed.join(by_key(marked), "hash", "left_semi")
              .groupBy("hash", "norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
              .select("hash", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size"))
    alone = rows.where("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha", "hash")
    grouped = rows.where("suspect").join(groups, ["hash", "sha"]).select(
        "doc_id", "keep_id", "group_size", "sha", "hash")
    return alone.unionByName(grouped).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"), F.col("hash").alias("text_hash"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one row for each distinct normalised text, all columns and texts as they were."""
    found = materialize(exact_groups(docs), "exact-groups")
    gone = found.where("not kept").select(F.col("doc_id").alias("_dedup_id"), F.col("text_hash").alias("_dedup_hash"))
    twice = (found.where("kept and group_size > 1").groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"))
             .where("n > 1").select(F.col("doc_id").alias("_dedup_id"), F.col("text_hash").alias("_dedup_hash")))
    text_hash = F.xxhash64(one_space(whole_text()))
    same = F.col("doc_id").eqNullSafe(F.col("_dedup_id")) & (text_hash == F.col("_dedup_hash"))
    rest = docs.join(by_key(gone, gone.count()), same, "left_anti")
    repeats = twice.count()
    if repeats:  # rows that repeat both id and text: one of each stays
        again = by_key(twice, repeats)
        one = (docs.join(again, same, "left_semi").withColumn("_dedup_hash", text_hash)
               .dropDuplicates(["doc_id", "_dedup_hash"]).drop("_dedup_hash"))
        rest = rest.join(again, same, "left_anti").unionByName(one)
    return rest
