"""SimHash near-duplicates: fingerprints compared bit-sliced, within groups that share some of their bits.

1. Every text's fingerprint is made where the text is: XXH64 (seed 42) of each four-word shingle,
   a bit set where more than half of the hashes have it. Equal fingerprints become one row
   (partial counts first, so any number of copies costs a row per task).
2. Two fingerprints that differ in ``RADIUS`` bits or fewer agree in one of ``RADIUS + 1`` groups of
   bits at least. A fingerprint goes to one bucket for each group (13 bits each). A bucket
   of more than ``BUCKET`` fingerprints is split again in the same way over the bits that its
   members may still differ in, up to ``SPLITS`` times; so buckets stay small at any number of
   documents, and no pair within the radius is lost.
3. A bucket is compared bit-sliced: 64 fingerprints are a block, stored as 64 bit planes (word j
   holds bit j of all). A fingerprint is compared with all of a block at once: each plane's
   differences are added to vertical counters by carry-save steps, and a (fingerprint, block)
   pair is abandoned once every lane's counter has passed the radius. Buckets that are still
   large are cut into chunks, and pairs of chunks are compared apart from each other.
4. A task links what it found by a spanning forest, so a bucket gives fewer edges than it has
   members. Components over fingerprints give each document the smallest doc_id reachable.

Defined results: null counts as empty text; a text without words has fingerprint zero and is linked like
any other; one of fewer than four words has its word sequence as the only shingle. A row
without doc_id is linked like any other but names no component: its component_id is the smallest
doc_id reachable, null if there is none. Rows that share a doc_id are documents each. An empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentspark.llm.common import by_key, materialize, shuffle_partitions, small_batches, whole_text
from contentspark.llm.components import connected_components

RADIUS = 4      # the vertical counters are laid out for it
SHINGLE = 4
SEED = 42
BUCKET = 4096   # fingerprints of a bucket that are compared without splitting it again
SPLITS = 3      # times that bits are shared out: 13, 23, then 31 bits of a bucket agree
CHUNK = 2048    # fingerprints of a chunk of a bucket
PAIRS = 1 << 16  # (fingerprint, block) pairs that one pass of the counters holds
LANES = 64


def fingerprint(text: str) -> int:
    """The 64-bit fingerprint of a text, unsigned."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: only A-Z change, only \\x20 and \\x09-\\x0D part words
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - SHINGLE + 1)
    last = ends[min(SHINGLE, len(words)) - 1:]
    hashes = np.fromiter((xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())),
                         np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 8192):
        part = hashes[i:i + 8192]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        prints = np.fromiter((fingerprint(t) for t in b["text"].to_pylist()), np.uint64, b.num_rows)
        yield pa.record_batch([b["doc_id"], pa.array(prints.view(np.int64))], names=["doc_id", "fp"])


def bit_groups(mask: int) -> list[int]:
    """The bits outside ``mask``, shared out to RADIUS + 1 groups, each with ``mask`` added."""
    free = [j for j in range(64) if not mask >> j & 1]
    cuts = [len(free) * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    return [mask | sum(1 << j for j in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def planes(prints: np.ndarray) -> np.ndarray:
    """(blocks, 64) words: bit i of word j is bit j of the block's i-th fingerprint. The last block is padded."""
    blocks = -(-len(prints) // LANES)
    padded = np.zeros(blocks * LANES, np.uint64)
    padded[:len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(blocks, LANES, 8), axis=2, bitorder="little")
    words = np.packbits(np.ascontiguousarray(bits.transpose(0, 2, 1)), axis=2, bitorder="little")
    return words.view("<u8").reshape(blocks, 64)


def within_radius(queries: np.ndarray, of: np.ndarray, sliced: np.ndarray, lanes: np.ndarray,
                  block: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs (fingerprint ``queries[of[p]]``, block ``block[p]``) of the sliced blocks with lanes within the radius.

    Returns the numbers p that have any, their words of lanes, and how many (pair, plane) steps were made.
    """
    live = np.arange(len(of))
    q, b, used = queries[of], block, lanes[block]
    c1, c2, c4, over = (np.zeros(len(of), np.uint64) for _ in range(4))
    ones, work = ~np.uint64(0), 0
    for j in range(64):
        work += len(live)
        differ = sliced[b, j] ^ np.where(q >> np.uint64(j) & np.uint64(1), ones, np.uint64(0))
        carry = c1 & differ      # carry-save: each counter keeps its bit and hands on a carry
        c1 ^= differ
        carry2 = c2 & carry
        c2 ^= carry
        over |= c4 & carry2      # beyond 7
        c4 ^= carry2
        over |= c4 & (c1 | c2)   # 5, 6 or 7: a lane that has passed the radius stays so
        if j % 8 == 7:
            going = (~over & used) != 0
            if not going.all():  # abandon blocks all of whose lanes have passed it
                live, q, b, used, c1, c2, c4, over = (x[going] for x in (live, q, b, used, c1, c2, c4, over))
                if not len(live):
                    break
    return live, ~over & used, work


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that links (a, b) connect each of n nodes with."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        while True:
            up = new[new]
            if (up == new).all():
                break
            new = up
        if (new == label).all():
            break
        label = new
        differ = label[a] != label[b]
        a, b = a[differ], b[differ]
    return label


def _edges(groups: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges of groups (first chunk, second chunk; the same array for one chunk with itself), compared together."""
    prints, sliced, lanes, of, block = [], [], [], [], []
    n = blocks = 0
    for first, second in groups:
        s = planes(second)
        held = np.full(len(s), ~np.uint64(0), np.uint64)
        if len(second) % LANES:
            held[-1] = (np.uint64(1) << np.uint64(len(second) % LANES)) - np.uint64(1)
        if first is second:  # a fingerprint meets its own block and later ones
            pairs = [np.arange(i // LANES, len(s)) for i in range(len(first))]
            lengths = [len(p) for p in pairs]
            of.append(n + np.repeat(np.arange(len(first)), lengths))
            block.append(blocks + np.concatenate(pairs))
            prints.append(first)
            base = n + np.arange(len(s)) * LANES
        else:
            of.append(n + np.repeat(np.arange(len(first)), len(s)))
            block.append(blocks + np.tile(np.arange(len(s)), len(first)))
            prints += [first, second]
            base = n + len(first) + np.arange(len(s)) * LANES
        sliced.append(s)
        lanes.append(np.stack([held, base.astype(np.uint64)]))
        n, blocks = n + len(first) + (0 if first is second else len(second)), blocks + len(s)
    prints, sliced, lanes = np.concatenate(prints), np.concatenate(sliced), np.concatenate(lanes, axis=1)
    of, block = np.concatenate(of), np.concatenate(block)
    ends_a, ends_b = [], []
    for i in range(0, len(of), PAIRS):
        o, b = of[i:i + PAIRS], block[i:i + PAIRS]
        found, words, _ = within_radius(prints, o, sliced, lanes[0], b)
        if len(found):
            bits = np.unpackbits(words.view(np.uint8).reshape(len(words), 8), axis=1, bitorder="little")
            at, lane = np.nonzero(bits)
            x, y = o[found[at]], lanes[1][b[found[at]]].astype(np.int64) + lane
            kept = x != y
            label = forest(x[kept], y[kept], n)  # a pass gives at most an edge for each node
            moved = np.flatnonzero(label != np.arange(n))
            ends_a.append(moved)
            ends_b.append(label[moved])
    if not ends_a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    label = forest(np.concatenate(ends_a), np.concatenate(ends_b), n)
    moved = np.flatnonzero(label != np.arange(n))
    return prints[moved], prints[label[moved]]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (mask, value, first, second, chunk, fp) of whole groups to edges (a, b) between fingerprints."""
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        nonlocal held, size
        a, b = _edges(held)
        held, size = [], 0
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def group(rows: np.ndarray) -> None:
        nonlocal size
        first, second, chunk = rows[0, 2], rows[0, 3], rows[:, 4]
        prints = rows[:, 5].view(np.uint64)
        pair = (prints, prints) if first == second else (prints[chunk == first], prints[chunk == second])
        if len(rows) > 1 and len(pair[0]) and len(pair[1]):
            held.append(pair)
            size += len(pair[0]) * -(-len(pair[1]) // LANES)

    rest = np.empty((0, 6), np.int64)
    for batch in batches:
        rows = np.column_stack([batch[c].to_numpy() for c in ("mask", "value", "first", "second", "chunk", "fp")])
        rows = np.concatenate([rest, np.ascontiguousarray(rows)])
        cuts = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
        for a, b in zip([0, *cuts], cuts):
            group(np.ascontiguousarray(rows[a:b]))
            if size >= PAIRS:
                yield flush()
        rest = rows[cuts[-1]:] if len(cuts) else rows
    if len(rest):
        group(np.ascontiguousarray(rest))
    if held:
        yield flush()


def links(prints: DataFrame) -> DataFrame:
    """(a, b): edges that connect the distinct fingerprints (fp) which chains of RADIUS or fewer differing bits connect."""
    masks = [0]
    rows, done = prints.select("fp", F.lit(0).cast("long").alias("mask")), None
    for split in range(SPLITS):
        groups = {signed(m): [signed(g) for g in bit_groups(m)] for m in masks}
        masks = sorted({g for m in masks for g in bit_groups(m)})
        choice = F.coalesce(*[F.when(F.col("mask") == m, F.array(*map(F.lit, g))) for m, g in groups.items()])
        rows = rows.withColumn("mask", F.explode(choice)).withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        rows = materialize(rows, f"simhash-split-{split}")
        sizes = rows.groupBy("mask", "value").agg(F.count("*").alias("n")).where("n > 1")
        sizes = materialize(sizes, f"simhash-buckets-{split}")
        small = sizes.where(F.col("n") <= BUCKET) if split + 1 < SPLITS else sizes
        ready = rows.join(by_key(small), ["mask", "value"])
        done = ready if done is None else done.unionByName(ready)
        large = sizes.where(F.col("n") > BUCKET).drop("n")
        if split + 1 == SPLITS or large.isEmpty():
            break
        rows = rows.join(by_key(large), ["mask", "value"], "left_semi").select("fp", "mask")
    chunks = F.ceil(F.col("n") / CHUNK).cast("long")
    done = done.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("fp"), "chunks"))
    done = done.withColumn("other", F.explode(F.expr("sequence(0L, chunks - 1)"))).select(
        "mask", "value", F.least("chunk", "other").alias("first"), F.greatest("chunk", "other").alias("second"), "chunk", "fp")
    key = ["mask", "value", "first", "second"]
    return (done.repartition(shuffle_partitions(prints.sparkSession), *key).sortWithinPartitions(*key)
            .mapInArrow(_compare, "a bigint, b bigint"))


def near_components(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = materialize(docs.mapInArrow(_fingerprints, "doc_id bigint, fp bigint"), "simhash-prints")
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    edges = materialize(links(prints), "simhash-links")
    roots = connected_components(edges, "a", "b", "simhash").select(F.col("node").alias("fp"), "root")
    roots = materialize(roots, "simhash-roots")
    least = prints.join(roots, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    found = prints.join(roots.join(by_key(least), "root"), "fp", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id"))
    found = materialize(found, "simhash-components")
    return rows.join(by_key(found), "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
