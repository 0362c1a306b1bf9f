"""Similarity join on word n-gram sets: MinHash banding, then verification on the full sets.

Words are the lower-cased runs between white space ([\\x20\\x09-\\x0D]), n-grams are
five words in a row (a text of one to four words is one n-gram). Two documents
are linked when the Jaccard similarity of their n-gram sets is 0.8 or more.

1. One scan makes each document's set digest and band hashes. The numbers of
   bands and rows follow from the target recall (``banding``).
2. Documents with equal sets form one class; its smallest doc_id stands for it.
3. Band hashes are shuffled; members of a bucket are joined to the bucket's
   smallest member (one row each, never all pairs), and the connected parts of
   that graph contain every pair that shares a band.
4. Each part is verified on the full n-gram sets. A part is cut into chunks of a
   bounded number of n-grams and every pair of chunks is one group of the
   shuffle, so no part, however large, meets in one task. Inside a group the
   intersections are counted exactly by a matrix product; a group returns each
   member's number of links and a spanning forest of the links, not the pairs.
5. Components of the forests are the near-duplicate classes.

Work of step 4 grows with the square of a part's n-grams divided by the chunk
size in shuffled rows; copies don't count, they are one member.

Defined results: null or wordless texts have no n-grams and no links, and are
classes of their own. Rows without doc_id get null class ids. Rows that share a
doc_id count as one document. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentspark.llm.common import by_key, materialize, shuffle_partitions, small_batches, whole_text
from contentspark.llm.components import connected_components
from contentspark.llm.ranks import positions

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999       # of pairs at exactly SIMILARITY; more similar ones are found more often
MAX_HASHES = 150     # bands times rows
CHUNK_GRAMS = 1 << 16
SLICE_BYTES = 1 << 19
COLUMN_SLAB = 8192
_ODD = np.uint64(0x9E3779B97F4A7C15)


def banding(similarity: float = SIMILARITY, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective rows whose bands reach ``recall`` at ``similarity`` within ``most`` hashes."""
    best = None
    for rows in range(1, most + 1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-min(similarity**rows, 1 - 1e-12))))
        if bands * rows <= most:
            best = bands, rows
    if best is None:
        raise ValueError(f"no banding within {most} hashes reaches a recall of {recall}")
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, _ODD)]))


def gram_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """For each text its sorted distinct n-gram hashes (uint64); whole slices of texts are hashed at once."""
    texts = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    a = 0
    while a < len(texts):
        limit = (ends[a - 1] if a else 0) + SLICE_BYTES
        b = max(a + 1, int(np.searchsorted(ends, limit, side="right")))
        yield from _slice_sets(texts.slice(a, b - a), lengths[a:b], words)
        a = b


def _slice_sets(texts: pa.Array, lengths: np.ndarray, words: int) -> Iterator[np.ndarray]:
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    none = np.empty(0, dtype=np.uint64)
    if offsets[-1] == offsets[0]:
        yield from (none for _ in range(len(texts)))
        return
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    space = (data == 32) | ((data >= 9) & (data <= 13))
    before = np.empty(len(data) + 1, dtype=bool)  # whether a word may begin here
    before[0], before[1:] = True, space
    starts_of_texts = (offsets - offsets[0])[:-1]
    before[starts_of_texts] = True
    starts = np.flatnonzero(before[:-1] & ~space)
    if not len(starts):
        yield from (none for _ in range(len(texts)))
        return
    spans = np.diff(starts, append=len(data))
    within = np.arange(starts[0], len(data)) - np.repeat(starts, spans)
    weighted = (data[starts[0]:].astype(np.uint64) + np.uint64(1)) * _powers(int(spans.max()))[within]
    weighted[space[starts[0]:]] = 0
    hashes = _mix(np.add.reduceat(weighted, starts - starts[0]))
    n_words = np.diff(np.searchsorted(starts, (offsets - offsets[0])))
    n = len(hashes) - words + 1
    if n > 0:
        grams = np.zeros(n, dtype=np.uint64)
        for i in range(words):
            grams = grams * _ODD + hashes[i:i + n]
        grams = _mix(grams)
    at = 0
    for count in n_words:
        if count >= words:
            yield np.unique(grams[at:at + count - words + 1])
        elif count:
            g = np.full(1, count, dtype=np.uint64)
            for h in hashes[at:at + count]:
                g = g * _ODD + h
            yield _mix(g)
        else:
            yield none
        at += count


class Sketcher:
    """MinHash band hashes of n-gram sets; the same numbers on every executor."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(20240229)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        x = (grams >> np.uint64(32)).astype(np.uint32)[:, None]
        least = np.full(len(self.a), 0xFFFFFFFF, dtype=np.uint32)
        for i in range(0, len(x), 1024):
            np.minimum(least, (x[i:i + 1024] * self.a + self.b).min(axis=0), out=least)
        out = np.arange(1, self.bands + 1, dtype=np.uint64)
        for row in least.reshape(self.bands, self.rows).T:
            out = _mix(out * _ODD + row)
        return out.view(np.int64)


SKETCH = "doc_id bigint, digest binary, grams int, bands array<bigint>"


def _sketches(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(bands, rows)
        for batch in batches:
            digests, sizes, found = [], [], []
            for grams in gram_sets(batch["text"]):
                sizes.append(len(grams))
                digests.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
                found.append(sketch(grams) if len(grams) else [])
            yield pa.record_batch(
                [batch["doc_id"], pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()),
                 pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "digest", "grams", "bands"])

    return run


MEMBER = "rep bigint, part bigint, chunk int, chunks int, grams binary"


def _member_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams = pa.array([g.tobytes() for g in gram_sets(batch["text"])], pa.binary())
        yield pa.record_batch([batch["rep"], batch["part"], batch["chunk"], batch["chunks"], grams],
                              names=["rep", "part", "chunk", "chunks", "grams"])


def intersections(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of every left set with every right set (None: left with left), exactly."""
    sets = left if right is None else left + right
    _, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = uses > 1  # n-grams of one set only are in no intersection with another
    place = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(sets) - len(left) if right is not None else len(left)), dtype=np.float32)
    for a in range(0, int(shared.sum()), COLUMN_SLAB):
        i, j = np.searchsorted(column, (a, a + COLUMN_SLAB))
        m = np.zeros((len(sets), min(COLUMN_SLAB, int(shared.sum()) - a)), dtype=np.float32)
        m[row[i:j], column[i:j] - a] = 1
        out += m[:len(left)] @ (m if right is None else m[len(left):]).T
    return out


def _forest(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix the smallest id that it is connected with."""
    label = ids.copy()
    top = np.iinfo(np.int64).max
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], top).min(axis=1))
        if (new == label).all():
            return label
        label = new


def _verify(similarity: float):
    """Links of each group (part, first chunk, second chunk): per member the number and a forest edge."""

    def links(rows: list[tuple[int, int, bytes]], first: int, second: int):
        seen, ids, chunk, sets = set(), [], [], []
        for rep, c, grams in rows:
            if (rep, grams) not in seen:
                seen.add((rep, grams))
                ids.append(rep)
                chunk.append(c)
                sets.append(np.frombuffer(grams, dtype=np.uint64))
        ids, chunk = np.array(ids, dtype=np.int64), np.array(chunk)
        order = np.argsort(chunk, kind="stable")
        ids, chunk, sets = ids[order], chunk[order], [sets[i] for i in order]
        cut = len(sets) if first == second else int((chunk == first).sum())
        if len(sets) < 2 or not cut or (first != second and cut == len(sets)):
            return
        size = np.array([len(s) for s in sets], dtype=np.float64)
        linked = np.zeros((len(sets), len(sets)), dtype=bool)
        if first == second:
            common = intersections(sets, None)
            linked |= common * (1 + similarity) >= similarity * (size[:, None] + size) - 1e-6
        else:
            common = intersections(sets[:cut], sets[cut:])
            part = common * (1 + similarity) >= similarity * (size[:cut, None] + size[cut:]) - 1e-6
            linked[:cut, cut:], linked[cut:, :cut] = part, part.T
        linked &= ids[:, None] != ids
        root = _forest(linked, ids)
        for i in np.flatnonzero(linked.any(axis=1)):
            yield int(ids[i]), int(len(np.unique(ids[linked[i]]))), int(root[i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found):
            return pa.record_batch([pa.array([f[i] for f in found], pa.int64()) for i in range(3)],
                                   names=["rep", "links", "root"])

        key, rows, found = None, [], []
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("part", "first", "second", "rep", "chunk", "grams")]
            for part, first, second, rep, chunk, grams in zip(*columns):
                if (part, first, second) != key:
                    if rows:
                        found.extend(links(rows, *key[1:]))
                    key, rows = (part, first, second), []
                rows.append((rep, chunk, grams))
            if len(found) > 10_000:
                yield out(found)
                found = []
        if rows:
            found.extend(links(rows, *key[1:]))
        yield out(found)

    return run


def near_classes(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id, set_id, set_size, n_links.

    ``set_id`` is the smallest doc_id with the same n-gram set and ``set_size`` how many
    rows have that set; ``n_links`` counts the other sets that are linked to it;
    ``class_id`` is the smallest doc_id of all that links connect.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = materialize(docs.mapInArrow(_sketches(*banding(similarity, recall)), SKETCH), "sketches")
    usable = rows.where("doc_id IS NOT NULL AND grams > 0")
    sets = materialize(usable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("set_size")),
                       "gram-sets")
    reps = usable.join(sets, (usable.digest == sets.digest) & (usable.doc_id == sets.rep), "left_semi")
    reps = reps.dropDuplicates(["doc_id", "digest"])
    banded = materialize(reps.select(F.col("doc_id").alias("rep"), F.explode("bands").alias("band")), "bands")
    buckets = (banded.groupBy("band").agg(F.min("rep").alias("centre"), F.max("rep").alias("last"))
               .where("centre != last").select("band", "centre"))
    edges = banded.join(buckets, "band").where("rep != centre").select("rep", "centre")
    parts = connected_components(edges, "rep", "centre", "candidates")

    members = parts.select(F.col("node").alias("rep"), F.col("root").alias("part")).join(
        reps.groupBy(F.col("doc_id").alias("rep")).agg(F.sum("grams").alias("grams")), "rep")
    chunks = members.groupBy("part").agg(F.ceil(F.sum("grams") / CHUNK_GRAMS).cast("int").alias("chunks"))
    members = materialize(members.join(chunks, "part").select(
        "rep", "part", F.pmod(F.hash("rep"), "chunks").cast("int").alias("chunk"), "chunks"), "members")
    payload = docs.join(by_key(members), docs.doc_id == members.rep).select("rep", "part", "chunk", "chunks", "text")
    work = (payload.mapInArrow(_member_sets, MEMBER)
            .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
            .select("part", F.least("chunk", "other").alias("first"), F.greatest("chunk", "other").alias("second"),
                    "rep", "chunk", "grams"))
    n = shuffle_partitions(spark)
    found = materialize(
        work.repartition(n, "part", "first", "second").sortWithinPartitions("part", "first", "second")
        .mapInArrow(_verify(similarity), "rep bigint, links bigint, root bigint"), "links")
    classes = connected_components(found, "rep", "root", "classes")
    linked = (found.groupBy("rep").agg(F.sum("links").alias("n_links"))
              .join(classes.withColumnRenamed("node", "rep"), "rep", "left"))
    table = sets.join(linked, "rep", "left").select(
        "digest", F.col("rep").alias("set_id"), "set_size", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("root", "rep").alias("class_id"))
    with_grams = usable.select("doc_id", "digest").join(table, "digest").select(
        "doc_id", "class_id", "set_id", "set_size", "n_links")
    without = rows.where("doc_id IS NULL OR grams = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("set_id"),
        F.lit(1).cast("long").alias("set_size"), F.lit(0).cast("long").alias("n_links"))
    return with_grams.unionByName(without)


def one_of_each_class(docs: DataFrame) -> DataFrame:
    """``docs`` without those that a smaller doc_id of the same class stands for.

    Where texts share a doc_id, each (doc_id, text) is a document of its own here, numbered in the order
    of doc_id, so that a text goes only if one that stays stands for it. Rows without doc_id stay.
    """
    text_hash = F.xxhash64(whole_text())
    rows = materialize(docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("_near_id"), text_hash.alias("_near_hash")).distinct(), "near-rows")
    if rows.groupBy("_near_id").count().where("count > 1").isEmpty():
        gone = near_classes(docs).where("doc_id != class_id").select(F.col("doc_id").alias("_near_id")).distinct()
        gone = materialize(gone, "near-copies")
        return docs.join(by_key(gone), F.col("doc_id") == F.col("_near_id"), "left_anti")
    numbers = positions(rows.withColumn("all", F.lit(0)), "all", [F.col("_near_id"), F.col("_near_hash")], "near-numbers")
    numbers = materialize(numbers.select("_near_id", "_near_hash", F.col("index").alias("_near_number")), "near-numbered")
    same = (F.col("doc_id") == F.col("_near_id")) & (text_hash == F.col("_near_hash"))
    found = near_classes(docs.join(by_key(numbers), same).select(F.col("_near_number").alias("doc_id"), "text"))
    gone = found.where("doc_id != class_id").select(F.col("doc_id").alias("_near_number")).distinct()
    gone = materialize(numbers.join(gone, "_near_number").select("_near_id", "_near_hash"), "near-copies")
    return docs.join(by_key(gone), same, "left_anti")
