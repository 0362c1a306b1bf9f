"""Quality classifier: perplexity under an interpolated modified Kneser-Ney n-gram model.

The model's symbols are characters, so that counts stay few and no word is out of
vocabulary: a run of white space is one space; a word equal to the one before it is
one repeat mark and takes the space in front with it (each mark is about as improbable
as it is rare, so stuttering text is dear); symbols from 4000 up share 90 classes. A symbol has 12 bits, an n-gram of order 4
is one long: its context is ``code >> 12``, its suffix the low bits.

1. One scan counts the n-grams of all documents, those of trusted ones apart.
   Tasks add up slices of about half a million characters before the shuffle.
2. Count tables of every order are sharded by n-gram and joined order by order
   (count, context total and context discount mass, lower order's probability),
   which gives the log probability of each n-gram that the corpus has.
3. A second scan adds up each document's cost where its text is read, with the log
   probabilities of the n-grams that occur most often (all of them, if they are counted
   to be few), which every task has as arrays. Only occurrences of the other, rare
   n-grams are rows, which meet the rest of the table by a shuffle.
4. Texts that a model was trained on look better to it than unseen ones, so fences
   are set from held-out perplexities: trusted documents fall into ``FOLDS`` by the hash
   of their text (copies stay together), and each fold is scored by a model of the others.
5. A document is rejected if its log perplexity is above its language's fence:
   the trusted documents' upper quantile plus ``SLACK`` times the distance from
   the median to it. Short texts scatter more, so quantiles are taken of the
   distance to the language's median in units of sqrt(1 + PIVOT / symbols).
   A language with n trusted documents moves from the quantiles of all trusted
   documents to its own with n: its median counts n to ``MIDDLE_PRIOR``, its upper
   quantile n to ``REACH_PRIOR`` of the distances of all to their languages' medians
   (to the median of all, as far as the language's own is not known).

Trusted documents: those labelled with quality 1; all of them train the model and set
the quantiles. Their ids are an array that every task has, unless they are counted to be
more than ``ID_ROWS``; then they are joined by a shuffle.

Defined results: null or empty texts have no perplexity and no threshold (null) and are
rejected: there is nothing in them to keep. A language without trusted documents (null
included) uses the quantiles of all trusted documents, so that text in a script
that no trusted document has is rejected; one trusted document raises its language's
fence half way to its own held-out perplexity. Without trusted documents in every
fold everything that has text is kept. Rows that agree in doc_id, lang and
text give one row, with the figures of one of them. Repeated or contradicting labels: quality 1 wins. Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentspark.llm.common import BROADCAST_ROWS, by_key, materialize, small_batches, whole_text

ORDER = 4
QUANTILE = 0.99
SLACK = 1.0
FOLDS = 2               # parts of the trusted documents, each scored by a model of the others
MIDDLE_PRIOR = 1.0      # documents that the median of all counts as in a language's median
REACH_PRIOR = 1 / (1 - QUANTILE)  # the same for the upper quantile: documents of which one is beyond it
PIVOT = 200.0           # symbols of a text whose perplexity scatters sqrt(2) times as much as a long one's
TABLE_ROWS = 2 * BROADCAST_ROWS  # most frequent n-grams whose log probabilities every task has (32 bytes each)
ID_ROWS = 8 * BROADCAST_ROWS     # trusted ids up to which every task has them (8 bytes each)
LEVELS = 4                       # steps in which numbers of occurrences double, to tell frequent n-grams from rare ones
SLICE_CHARS = 1 << 19
BITS = 12
FIRST_CLASS, CLASSES = 4000, 90
REPEAT, BEGIN = 4094, 4095


def symbols(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(symbol, text index) of the texts one after the other, each after order - 1 begin marks."""
    gap = order - 1
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.array([len(t) for t in texts])
    text = np.repeat(np.arange(len(texts)), lengths)
    space = (points == 32) | ((points >= 9) & (points <= 13))
    first = np.ones(len(points), dtype=bool)  # the first character of a text
    first[1:] = text[1:] != text[:-1]
    start = ~space & (first | np.concatenate([[True], space[:-1]]))
    keep = ~space | first | np.concatenate([[True], ~space[:-1]])
    out = np.where(space, 32, np.where(points < FIRST_CLASS, points, FIRST_CLASS + points % CLASSES)).astype(np.int64)
    at = np.flatnonzero(start)
    if len(at) > 1:
        spans = np.diff(at, append=len(points))
        within = np.arange(at[0], len(points)) - np.repeat(at, spans)
        weight = (points[at[0]:].astype(np.uint64) + np.uint64(1)) * _powers(int(spans.max()))[within]
        weight[space[at[0]:]] = 0
        word = np.add.reduceat(weight, at - at[0])
        again = np.concatenate([[False], (word[1:] == word[:-1]) & (text[at[1:]] == text[at[:-1]])])
        out[at[again]] = REPEAT
        blank = space[at[0]:]
        keep[at[0]:] &= ~(np.repeat(again, spans) & (within > 0) & ~blank)  # the rest of the word
        keep[at[0]:] &= ~(np.repeat(np.append(again[1:], False), spans) & blank)  # the space in front of it
    out, text = out[keep], text[keep]
    begins = np.searchsorted(text, np.arange(len(texts)))
    out = np.insert(out, np.repeat(begins, gap), BEGIN)
    text = np.insert(text, np.repeat(begins, gap), np.repeat(np.arange(len(texts)), gap))
    return out, text


def _powers(n: int) -> np.ndarray:
    odd = np.full(n, 0xD6E8FEB86659FD93, dtype=np.uint64)
    odd[0] = 1
    return np.multiply.accumulate(odd)


def ngram_codes(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram code, text index) of every symbol of the texts."""
    s, text = symbols(texts, order)
    code = s.copy()
    for back in range(1, order):
        code[back:] |= s[:-back] << (BITS * back)
    real = s != BEGIN
    return code[real], text[real]


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    texts = batch["text"].to_pylist()
    a = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SLICE_CHARS:
            yield a, texts[a:i]
            a = i
            size = 0
        size += len(t)
    if texts:
        yield a, texts[a:]


def _among(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in sorted_keys, whether it is there) of every key."""
    if not len(sorted_keys):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def _count(trusted=None):
    """Arrow batches (doc_id, fold, text) -> (code, n, n0, ...): occurrences in all texts, in those of each fold.

    ``trusted``: the sorted ids of trusted documents, shared with all tasks; without it ``fold`` is -1 for the others.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold = batch["fold"].to_numpy(zero_copy_only=False)
            if trusted is not None:
                ids = batch["doc_id"]
                known = _among(trusted.value, ids.fill_null(0).to_numpy(zero_copy_only=False))[1]
                fold = np.where(known & ids.is_valid().to_numpy(zero_copy_only=False), fold, -1)
            for a, texts in _slices(batch):
                code, text = ngram_codes(texts)
                distinct, n = np.unique(code * (FOLDS + 1) + fold[a + text] + 1, return_counts=True)
                code, of = np.divmod(distinct, FOLDS + 1)
                yield pa.record_batch([pa.array(code), pa.array(n), *(pa.array(np.where(of == f + 1, n, 0)) for f in range(FOLDS))],
                                      names=["code", "n", *(f"n{f}" for f in range(FOLDS))])

    return run


def _costs(table, names: list[str]):
    """Arrow batches (doc_id, lang, text_hash, text) -> a row per document: n_symbols, its costs, and its n-grams without one.

    ``table``: (sorted codes, an array of log probabilities for each of ``names``), shared with all tasks. ``rare`` has
    the codes that it lacks, ``times`` how often the text has them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, logs = table.value
        for batch in batches:
            for a, texts in _slices(batch):
                code, text = ngram_codes(texts)
                distinct, inverse = np.unique(code, return_inverse=True)
                at, known = _among(codes, distinct)
                total = lambda values: np.bincount(text, weights=values[inverse], minlength=len(texts))  # noqa: E731, B023
                cost = [total(np.where(known, -log[at], 0.0) if len(codes) else np.zeros(len(distinct))) for log in logs]
                rest = np.flatnonzero(~known[inverse])
                order = rest[np.lexsort((inverse[rest], text[rest]))]
                new = np.flatnonzero(np.diff(text[order], prepend=-1) | np.diff(inverse[order], prepend=-1))
                rare, times, of = distinct[inverse[order[new]]], np.diff(new, append=len(order)), text[order[new]]
                begin = pa.array(np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32))
                doc = pa.array(a + np.arange(len(texts)))
                yield pa.record_batch(
                    [*(batch[c].take(doc) for c in ("doc_id", "lang", "text_hash")), pa.array(np.bincount(text, minlength=len(texts))),
                     *(pa.array(c) for c in cost), *(pa.ListArray.from_arrays(begin, pa.array(x, pa.int64())) for x in (rare, times))],
                    names=["doc_id", "lang", "text_hash", "n_symbols", *names, "rare", "times"])

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney's D1, D2, D3+ from the numbers of n-grams seen 1 to 4 times."""
    if not (n1 and n2 and n3):
        return 0.5, 0.75, 0.75  # too few n-grams to estimate them
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(x, 0.05), k - 0.05) for k, x in zip((1, 2, 3), d))


def log_probabilities(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(code, logp) for every n-gram of ``counts`` (code, c); c counts trusted text and may be 0.

    The highest order uses the counts, lower ones the numbers of distinct symbols
    in front. Each order is joined with its contexts and the next lower order.
    """
    mask = lambda k: (1 << (BITS * k)) - 1
    seen = {order: counts.where("c > 0")}
    needed = {order: counts}
    for k in range(order - 1, 0, -1):
        suffix = F.col("code").bitwiseAND(F.lit(mask(k)).cast("long")).alias("code")
        seen[k] = seen[k + 1].groupBy(suffix).agg(F.count("*").alias("c"))
        needed[k] = needed[k + 1].select(suffix).distinct().join(seen[k], "code", "left").select(
            "code", F.coalesce("c", F.lit(0)).alias("c"))
        needed[k] = materialize(needed[k], f"counts-{k}")
        seen[k] = needed[k].where("c > 0")
    lower = None
    for k in range(1, order + 1):
        one = seen[k].agg(*[F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
        d1, d2, d3 = discounts(*one)
        cut = F.when(F.col("c") <= 0, 0.0).when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        contexts = seen[k].groupBy(F.shiftright("code", BITS).alias("context")).agg(
            F.sum("c").cast("double").alias("total"), F.sum(cut).alias("mass"))
        rows = needed[k].withColumns({"context": F.shiftright("code", BITS),
                                      "suffix": F.col("code").bitwiseAND(F.lit(mask(k - 1)).cast("long")),
                                      "kept": F.greatest(F.col("c") - cut, F.lit(0.0))})
        rows = rows.join(contexts, "context", "left")
        if lower is None:
            rows = rows.withColumn("below", F.lit(1.0 / (1 << BITS)))
        else:
            rows = rows.join(lower.select(F.col("code").alias("suffix"), F.col("p").alias("below")), "suffix")
        p = F.when(F.col("total").isNull(), F.col("below")).otherwise(
            (F.col("kept") + F.col("mass") * F.col("below")) / F.col("total"))
        lower = materialize(rows.select("code", p.alias("p")), f"probabilities-{k}")
    return lower.select("code", F.ln("p").alias("logp"))


def trusted_ids(labels: DataFrame, most: int | None = None) -> DataFrame:
    """Ids of the documents that the model is fitted on: all, or the first ``most`` by hash."""
    ids = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("_trusted_id")).distinct()
    return ids if most is None else ids.orderBy(F.xxhash64("_trusted_id"), "_trusted_id").limit(most)


def perplexities(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, text_hash, n_symbols, log_perplexity, trusted, held_out.

    ``held_out`` is a trusted document's log perplexity under the model of the other folds.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ids = materialize(trusted_ids(labels), "trusted")
    n_ids = ids.count()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       whole_text().alias("text"))
    folds = range(FOLDS)
    marked = docs.select("doc_id", F.pmod(F.xxhash64("text"), F.lit(FOLDS).cast("long")).alias("fold"), "text")
    shared = None
    if n_ids <= ID_ROWS:
        shared = spark.sparkContext.broadcast(np.sort(_columns(ids)[0]))
    else:
        marked = marked.join(ids, marked.doc_id == ids._trusted_id, "left").select(
            "doc_id", F.when(F.col("_trusted_id").isNotNull(), F.col("fold")).otherwise(-1).alias("fold"), "text")
    counts = materialize(marked.mapInArrow(_count(shared), "code bigint, n bigint, " + ", ".join(f"n{f} bigint" for f in folds))
                         .groupBy("code").agg(F.sum("n").alias("n"), *[F.sum(f"n{f}").alias(f"c{f}") for f in folds]), "ngram-counts")
    every = sum((F.col(f"c{f}") for f in folds), F.lit(0))
    table = log_probabilities(counts.select("code", every.alias("c")))
    filled = counts.agg(*[F.sum(f"c{f}") for f in folds]).first()
    testable = sum(bool(c) for c in filled) == FOLDS
    if testable:
        for f in folds:
            others = log_probabilities(counts.where(every > 0).select("code", (every - F.col(f"c{f}")).alias("c")))
            table = table.join(others.withColumnRenamed("logp", f"logp{f}"), "code", "left")
        table = materialize(table, "log-probabilities")
    logs = {"cost": "logp"} | {f"cost{f}": f"logp{f}" for f in folds if testable}
    frequent, rare = _by_frequency(table, counts)
    # An n-gram that no trusted document has is without a held-out probability: only trusted documents have such a cost.
    codes, *values = _columns(frequent.select("code", *[F.coalesce(c, F.lit(0.0)) for c in logs.values()]))
    order = np.argsort(codes)
    scored = docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        _costs(spark.sparkContext.broadcast((codes[order], [v[order] for v in values])), list(logs)),
        f"doc_id bigint, lang string, text_hash bigint, n_symbols bigint, {', '.join(f'{c} double' for c in logs)}, rare array<bigint>, times array<bigint>")
    keys = ["doc_id", "lang", "text_hash"]
    if rare is not None:
        scored = materialize(scored, "document-costs")
    parts = scored.select(*keys, "n_symbols", F.lit(1).alias("one"), *logs)
    if rare is not None:
        left = scored.select(*keys, F.explode(F.arrays_zip("rare", "times")).alias("g")).select(
            *keys, F.col("g.rare").alias("code"), F.col("g.times").alias("times")).join(rare, "code")
        parts = parts.unionByName(left.select(
            *keys, F.lit(0).cast("long").alias("n_symbols"), F.lit(0).alias("one"),
            *[F.coalesce(-F.col("times") * F.col(log), F.lit(0.0)).alias(c) for c, log in logs.items()]))
    scored = parts.groupBy(*keys).agg((F.sum("n_symbols") / F.sum("one")).cast("long").alias("n_symbols"),
                                      *[(F.sum(c) / F.sum("one")).alias(c) for c in logs])
    per_symbol = lambda c: F.when(F.col("n_symbols") > 0, F.col(c) / F.col("n_symbols"))
    held = F.lit(None).cast("double")
    for f in folds if testable else []:
        held = F.when(F.pmod("text_hash", F.lit(FOLDS).cast("long")) == f, per_symbol(f"cost{f}")).otherwise(held)
    trusted = F.col("_trusted_id").isNotNull()
    ids = by_key(ids, n_ids)
    return scored.join(ids, scored.doc_id == ids._trusted_id, "left").select(
        "doc_id", "lang", "text_hash", "n_symbols", per_symbol("cost").alias("log_perplexity"),
        trusted.alias("trusted"), F.when(trusted, held).alias("held_out"))


def _columns(rows: DataFrame) -> list[np.ndarray]:
    """The columns of a table without nulls whose rows are counted to be few."""
    return [c.to_numpy() for c in rows.toArrow().columns]


def _by_frequency(table: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``table`` in two: the at most ``TABLE_ROWS`` n-grams that occur most often, and the others (None: there are none)."""
    if table.count() <= TABLE_ROWS:
        return table, None
    table = materialize(table.join(counts.select("code", F.floor(F.log2("n") * LEVELS).alias("level")), "code"), "levels")
    least, held = None, 0
    for level, n in sorted(table.groupBy("level").count().collect(), reverse=True):
        held += n
        if held > TABLE_ROWS:
            break
        least = level
    frequent = F.lit(False) if least is None else F.col("level") >= least
    return table.where(frequent).drop("level"), table.where(~frequent).drop("level")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, text_hash, n_symbols, perplexity, threshold, kept.

    ``threshold`` is the perplexity that a text of this language and length may have.
    """
    scored = materialize(perplexities(docs, labels), "perplexities")
    trusted = scored.where("trusted AND held_out IS NOT NULL")
    scatter = F.when(F.col("n_symbols") > 0, F.sqrt(1 + PIVOT / F.col("n_symbols")))
    off = (F.col("held_out") - F.col("middle")) / scatter
    median, upper = F.percentile_approx("held_out", 0.5, 10_000), F.percentile_approx(off, QUANTILE, 10_000)
    middle = trusted.groupBy("lang").agg(median.alias("middle"))
    apart = trusted.join(F.broadcast(middle), trusted.lang.eqNullSafe(middle.lang)).drop(middle.lang)
    fences = apart.groupBy("lang").agg(F.count("*").alias("n"), F.first("middle").alias("middle"), upper.alias("reach"))
    within = apart.agg(upper).first()[0]
    all_middle = trusted.agg(median).first()[0]
    all_reach = trusted.withColumn("middle", F.lit(all_middle).cast("double")).agg(upper).first()[0]
    out = scored.join(F.broadcast(fences.withColumnRenamed("lang", "_lang")),
                      F.col("lang").eqNullSafe(F.col("_lang")), "left")
    n = F.coalesce("n", F.lit(0))

    def shrunk(own: str, pooled: Column, prior: float) -> Column:
        return (n * F.coalesce(own, F.lit(0.0)) + prior * pooled) / (n + prior)

    within, all_middle, all_reach = (F.lit(x).cast("double") for x in (within, all_middle, all_reach))
    reach = within + (all_reach - within) * MIDDLE_PRIOR / (n + MIDDLE_PRIOR)
    limit = shrunk("middle", all_middle, MIDDLE_PRIOR) + (1 + SLACK) * shrunk("reach", reach, REACH_PRIOR) * scatter
    return out.select(
        "doc_id", "lang", "text_hash", "n_symbols", F.exp("log_perplexity").alias("perplexity"),
        F.exp(limit).alias("threshold"),
        (F.col("log_perplexity").isNotNull() & F.coalesce(F.col("log_perplexity") <= limit, F.lit(True))).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that the classifier rejects."""
    gone = materialize(judge(docs, labels).where("not kept").select(
        F.col("doc_id").alias("_reject_id"), F.col("text_hash").alias("_reject_hash")), "rejected")
    same = F.col("doc_id").eqNullSafe(F.col("_reject_id")) & (F.xxhash64(whole_text()) == F.col("_reject_hash"))
    return docs.join(by_key(gone), same, "left_anti")
