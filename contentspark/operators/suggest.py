"""Suggestion, completion, spelling and related items (SUG-1..8).

Completion: an edge n-gram table ``(doc_id, field, prefix, token)`` (DOC-24) is
equi-joined with the query tokens on their first 10 characters - every token,
compared whole, must prefix some token of the document.

Spelling (SUG-4/5/6): noisy channel. Candidates per query token come from the
fuzzy expansion (deletion keys + levenshtein, 'auto' budget); all of them form a
lattice, and a phrase scores the sum of its words' log P(w) (add-one smoothed
unigram), log P(w | the word chosen before it) and a penalty per edit (and one
for keeping a word the corpus never saw). The best paths come from a list
Viterbi per query; only bigrams that the corpus has are edges.

Related (SUG-7): more-like-this. Per source document its ``n_terms`` best tf-idf terms
(``row_number`` per document) form a query; candidates must match at least the share
``min_match`` of them (found through the rarest ones); score = sum of BM25 of matched
terms; the source is excluded; the ``k`` best per source.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contentspark.functions.text import tokens
from contentspark.operators.analysis import edge_ngrams
from contentspark.operators.search import B, K1, TextIndex, few, fuzzy_expand
from contentspark.session import written

MIN_PREFIX, MAX_PREFIX = 3, 10
BROADCAST_ROWS = 500_000  # query tokens that a completion may broadcast


def prefix_index(field_rows: DataFrame, min_len: int = MIN_PREFIX) -> DataFrame:
    """DOC-24 over field rows: distinct (doc_id, field, prefix, token), prefixes of min_len..10 characters."""
    toks = field_rows.select("doc_id", "field", F.explode(F.array_distinct(tokens(F.col("text")))).alias("token"))
    # Tokens are dealt by document before they get their prefixes: a token's prefixes differ from each other, and what is
    # counted per document needs no further shuffle.
    toks = toks.repartition("doc_id").distinct()
    return toks.select("doc_id", "field", F.explode(edge_ngrams(F.array("token"), min_len, MAX_PREFIX)).alias("prefix"),
                       "token")


def query_prefix_tokens(queries: DataFrame) -> DataFrame:
    """(query_id, ptok, pkey, n_tokens): query tokens, whole, with the key (10 characters at most) they are joined by."""
    t = queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("query")))).alias("ptok"))
    n = t.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_tokens"))
    return t.withColumn("pkey", F.substring("ptok", 1, MAX_PREFIX)).join(n, "query_id")


def complete(queries: DataFrame, prefixes: DataFrame) -> DataFrame:
    """SUG-1: (query_id, doc_id, matched_fields) where every query token prefixes a doc token.

    The join is on the first 10 characters; longer tokens are compared whole behind it. ``prefixes``
    should have prefixes from one character up if queries may hold such short tokens. The prefixes are
    never broadcast (their size is that of the documents, whatever a plan's estimate says); the query
    tokens are, if their counted rows are few.
    """
    qt = written(query_prefix_tokens(queries), "prefix-queries")
    if qt.count() <= BROADCAST_ROWS:
        qt = F.broadcast(qt)
    else:
        prefixes = prefixes.hint("merge")
    hits = prefixes.join(qt, (F.col("pkey") == F.col("prefix")) & F.startswith("token", F.col("ptok")))
    # One set per query and document: no more entries than the query has tokens, or the document fields.
    per = hits.groupBy("query_id", "doc_id", "n_tokens").agg(F.size(F.collect_set("ptok")).cast("long").alias("m"),
                                                             F.size(F.collect_set("field")).cast("long").alias("matched_fields"))
    return per.filter(F.col("m") == F.col("n_tokens")).select("query_id", "doc_id", "matched_fields")


def suggest_field_weights(weights: dict[str, float], suggest_fields: list[str]) -> dict[str, float]:
    """SUG-2: n-gram sub-fields join the fuzzy clause with weight - 1 (at least 1; smallest wins)."""
    out = dict(weights)
    for f in suggest_fields:
        base = f.rsplit(".", 1)[0]
        w = max(1.0, weights.get(base, 1.0) - 1)
        out[f] = min(out.get(f, w), w)
    return out


def completion_top_k(matches: DataFrame, posts: DataFrame, k: int, types=("post", "page", "product"),
                     statuses=("publish",)) -> DataFrame:
    """SUG-3: per prefix query the k best public objects (more matched fields, newer, smaller id)."""
    p = posts.filter(F.col("post_type").isin(list(types)) & F.col("post_status").isin(list(statuses)))
    # Both sides grow with the documents: joined by a shuffle, not by a broadcast that a small file's estimate suggests.
    m = matches.join(p.select(F.col("id").alias("doc_id"), "post_date").hint("merge"), "doc_id")
    w = Window.partitionBy("query_id").orderBy(F.col("matched_fields").desc(), F.col("post_date").desc(),
                                               F.col("doc_id").asc())
    return m.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# ---------------------------------------------------------------- spelling

EDIT_PENALTY = math.log(0.05)  # log-probability of one edit
UNSEEN_PENALTY = 3 * math.log(0.05)  # keeping a word the corpus never saw costs like three edits
MIN_SCORE = 0.0001
LIST_JOINTS = 65_536  # neighbouring words of queries that a word's list has at most, about


def language_model(shingle_rows: DataFrame, postings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(unigrams(term, c), bigrams(w1, w2, c), totals(n_tokens, vocab)) from the corpus."""
    uni = postings.groupBy("term").agg(F.sum("tf").cast("double").alias("c"))
    bi = (shingle_rows.filter(F.col("n") == 2)
          .select(F.split("shingle", " ").getItem(0).alias("w1"), F.split("shingle", " ").getItem(1).alias("w2"))
          .groupBy("w1", "w2").agg(F.count(F.lit(1)).cast("double").alias("c")))
    totals = uni.agg(F.sum("c").alias("n_tokens"), F.count(F.lit(1)).cast("double").alias("vocab"))
    return uni, bi, totals


def spelling_lattice(queries: DataFrame, vocabulary: DataFrame, uni: DataFrame, bi: DataFrame, totals: DataFrame
                     ) -> tuple[DataFrame, DataFrame]:
    """The lattice of all positions' candidates, as nodes and edges.

    Nodes (query_id, pos, term, vterm, own, norm): a candidate's log P(w) with its edit penalties, and
    log(c(w) + vocabulary). Edges (query_id, pos, prev, vterm, logp): the pairs of neighbouring candidates
    that the corpus has as bigrams; every other pair costs -norm of its first word, so no pair has to be
    written down for it.
    """
    qt = queries.select("query_id", F.posexplode(tokens(F.col("query"))).alias("pos", "term"))
    found = fuzzy_expand(qt.select("term").distinct(), vocabulary, "auto").select("term", "vterm")
    words = found.unionByName(qt.select("term", F.col("term").alias("vterm"))).distinct()  # keeping a word is always possible
    n_tok, vocab = totals.select("n_tokens").scalar(), totals.select("vocab").scalar()  # scalar subqueries
    c = F.coalesce("c", F.lit(0.0))
    own = (F.log((c + 1) / (n_tok + vocab)) + F.levenshtein("term", "vterm") * F.lit(EDIT_PENALTY)
           + F.when(F.col("c").isNull(), F.lit(UNSEEN_PENALTY)).otherwise(0.0))
    words = words.join(uni.select(F.col("term").alias("vterm"), "c"), "vterm", "left").select(
        "term", "vterm", own.alias("own"), F.log(c + vocab).alias("norm"))
    nodes = written(qt.join(words, "term").select("query_id", "pos", "term", "vterm", "own", "norm"), "lattice")
    # A pair of neighbouring query words is a joint. A bigram is an edge of the joints that its first word may open and its
    # second one may close: every word has the list of its joints, so no row is made of a bigram that fits none.
    at = qt.select("query_id", "pos", "term").distinct()
    met = written(at.select("query_id", (F.col("pos") + 1).alias("pos"), F.col("term").alias("first")).join(at, ["query_id", "pos"]), "neighbours")
    joints = written(met.select("first", "term").distinct().withColumn("joint", F.monotonically_increasing_id()), "joints")
    blocks = -(-joints.count() // LIST_JOINTS) or 1
    block = F.pmod(F.xxhash64("joint"), F.lit(blocks)).alias("block")
    known = written(nodes.select("term", "vterm", "norm").distinct(), "lattice-words")
    opens = few(known.join(joints.select(F.col("first").alias("term"), "joint"), "term").groupBy(F.col("vterm").alias("w1"), "norm", block)
                 .agg(F.collect_list("joint").alias("opens")), "opening-words")
    closes = few(known.join(joints.select("term", "joint"), "term").groupBy(F.col("vterm").alias("w2"), block)
                  .agg(F.collect_list("joint").alias("closes")), "closing-words")
    fits = bi.join(opens, "w1").join(closes, ["w2", "block"])
    edges = fits.select(F.explode(F.array_intersect("opens", "closes")).alias("joint"), F.col("w1").alias("prev"), F.col("w2").alias("vterm"),
                        (F.log(F.col("c") + 1) - F.col("norm")).alias("logp"))
    edges = edges.join(joints, "joint").join(met, ["first", "term"])
    return nodes, written(edges.select("query_id", "pos", "prev", "vterm", "logp"), "lattice-edges")


def _viterbi(k: int):
    """The k best paths of one query's lattice by list Viterbi, with their gain over the query itself."""
    def best(entries: list) -> list:
        return sorted(entries, key=lambda e: (-round(e[0], 9), e[1]))[:k]

    def run(nodes: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        positions: dict[int, list] = {}
        for pos, term, vterm, own, norm in zip(nodes["pos"], nodes["term"], nodes["vterm"], nodes["own"], nodes["norm"]):
            positions.setdefault(pos, []).append((term, vterm, own, norm))
        seen: dict[tuple, dict] = {}
        for pos, prev, vterm, logp in zip(edges["pos"], edges["prev"], edges["vterm"], edges["logp"]):
            seen.setdefault((pos, vterm), {})[prev] = logp
        paths: dict[str, list] = {}
        said, last, before = 0.0, None, {}
        for pos in sorted(positions):
            term = positions[pos][0][0]
            own = {v: o for _, v, o, _ in positions[pos]}
            said += own[term] + (0.0 if last is None else seen.get((pos, term), {}).get(last, -before[last]))
            if last is None:
                paths = {v: [(o, (v,))] for v, o in own.items()}
            else:
                unseen = sorted(((s - before[p], path, p) for p, entries in paths.items() for s, path in entries),
                                key=lambda e: (-round(e[0], 9), e[1]))
                step = {}
                for v, o in own.items():
                    met = seen.get((pos, v), {})
                    entries = [(s + logp + o, (*path, v)) for p, logp in met.items() for s, path in paths[p]]
                    left = k
                    for s, path, p in unseen:
                        if left and p not in met:
                            entries.append((s + o, (*path, v)))
                            left -= 1
                        elif not left:
                            break
                    step[v] = best(entries)
                paths = step
            last, before = term, {v: n for _, v, _, n in positions[pos]}
        top = best([e for entries in paths.values() for e in entries])
        return pd.DataFrame({"query_id": nodes["query_id"].iloc[0], "rank": range(1, len(top) + 1),
                             "suggestion": [" ".join(path) for _, path in top], "gain": [round(s - said, 9) for s, _ in top]})

    return run


def best_phrases(lattice: tuple[DataFrame, DataFrame], k: int = 1) -> DataFrame:
    """SUG-4/6: (query_id, rank, suggestion, gain): the k likeliest phrases of every query, the query itself among them.

    A word's neighbours are the ones chosen with it, and any number of words may change. One group is one
    query's lattice: its words and their candidates.
    """
    nodes, edges = lattice
    schema = f"query_id {dict(nodes.dtypes)['query_id']}, rank int, suggestion string, gain double"
    return nodes.groupBy("query_id").cogroup(edges.groupBy("query_id")).applyInPandas(_viterbi(k), schema)


def _said(queries: DataFrame) -> DataFrame:
    return queries.select("query_id", F.array_join(tokens(F.col("query")), " ").alias("query"))


def spelling(queries: DataFrame, phrases: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """SUG-4/5: (query_id, query, suggestion, score) - the likeliest phrase when it is not the query.

    gain = log-likelihood improvement over the query; score = 1 - exp(-gain) in (0, 1); suggestions with
    score <= ``min_score`` drop.
    """
    out = phrases.filter("rank = 1").join(_said(queries), "query_id").withColumn("score", 1.0 - F.exp(-F.col("gain")))
    return out.filter((F.col("suggestion") != F.col("query")) & (F.col("score") > min_score)).select(
        "query_id", "query", "suggestion", "score")


def alternatives(queries: DataFrame, phrases: DataFrame, k: int) -> DataFrame:
    """SUG-6: (query_id, rank, suggestion, score) - up to ``k`` whole phrases that are likelier than the query.

    ``phrases`` are the k + 1 best, which may hold the query itself.
    """
    better = phrases.join(_said(queries), "query_id").filter((F.col("suggestion") != F.col("query")) & (F.col("gain") > 0))
    w = Window.partitionBy("query_id").orderBy("rank")
    return better.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "suggestion", (1.0 - F.exp(-F.col("gain"))).alias("score"))


def only_when_empty(suggestions: DataFrame, hits: DataFrame) -> DataFrame:
    """SUG-6: keep suggestions only for queries without any hit (left anti join)."""
    return suggestions.join(hits.select("query_id").distinct(), "query_id", "left_anti")


# ---------------------------------------------------------------- related

TILE_DOCS, TILE_SOURCES = 65_536, 262_144  # documents and sources that a tile has at most, about
LEAST_TILES, LEAST_DOCS, LEAST_SOURCES = 32, 16_384, 512  # few tiles are split further, down to so many documents and sources
LONG_LIST = 8192  # postings of a term before which a threshold is worth its search


def _most_related(k: int):
    """The k best documents of every source in one tile: documents (doc_id, tids, tfs, norm), sources (source_id, need, tids, idfs).

    A source's terms are met from the one of fewest documents on. A document that first occurs in the last ``need`` - 1
    of them matches too few; one that first occurs where all that is left adds up to less than the k-th best score found
    so far is not among the best. From there on only documents that were met before are looked up.
    """
    def run(left, right):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        id_type = left.schema.field("doc_id").type
        schema = pa.schema([("source_id", id_type), ("doc_id", id_type), ("score", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()

        def lists(table, name):
            col = table.column(name).combine_chunks()
            return col.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(col).to_numpy(zero_copy_only=False)

        left = left.sort_by("doc_id")  # places in the tile are in the order of ties
        docs, sources = left.column("doc_id").combine_chunks(), right.column("source_id").combine_chunks()
        own = pc.fill_null(pc.index_in(sources, value_set=docs), -1).to_numpy(zero_copy_only=False)
        (tid, n), (tf, _) = lists(left, "tids"), lists(left, "tfs")
        row = np.repeat(np.arange(len(docs), dtype=np.int32), n)
        part = tf * (K1 + 1)
        part /= tf + left.column("norm").to_numpy()[row]
        order = np.argsort(tid, kind="stable")
        tid, row, part = tid[order], row[order], part[order]
        del order, tf
        (wanted, n), (idf, _) = lists(right, "tids"), lists(right, "idfs")
        begin, end = np.searchsorted(tid, wanted, "left"), np.searchsorted(tid, wanted, "right")  # a term has one row per document
        first, need = np.append(0, np.cumsum(n)), np.maximum(right.column("need").to_numpy(), 1)
        size = end - begin
        terms, of = np.unique(begin[size > 0], return_index=True)  # what a term adds does not depend on the source
        by_term, until = idf[size > 0][of], end[size > 0][of]
        worth = np.zeros(len(size))  # at most, by a source's term
        for a, b, w in zip(terms.tolist(), until.tolist(), by_term.tolist()):
            part[a:b] *= w
        if len(terms):
            heads = np.flatnonzero(np.diff(tid, prepend=tid[0] - 1))
            worth[size > 0] = np.maximum.reduceat(part, heads)[np.searchsorted(heads, begin[size > 0])]
        del tid
        match = 2.0 ** np.ceil(np.log2(worth.max(initial=0.0) * n.max(initial=0) + 2))  # added for each term that matches; scores stay below
        part += match
        score = np.zeros(len(docs))

        def looked_up(cand, s, j):
            """Adds term ``j`` of a source to the scores of some documents."""
            rows = row[begin[j]:end[j]]
            at = np.minimum(np.searchsorted(rows, cand), len(rows) - 1)
            hit = rows[at] == cand
            s[hit] += part[begin[j] + at[hit]]

        def threshold(cand, rest, least, itself):
            """The k-th best score among documents that lead so far; with too few of them none is known."""
            s = score[cand]
            if len(cand) > 8 * k:
                lead = np.sort(np.argpartition(s, len(s) - 8 * k)[-8 * k:])
                cand, s = cand[lead], s[lead]
            for j in rest:
                looked_up(cand, s, j)
            m = np.floor(s / match)
            s = (s - m * match)[(m >= least) & (cand != itself)]
            return np.partition(s, len(s) - k)[len(s) - k] if len(s) >= k else -np.inf

        out = []
        present = np.append(0, np.cumsum(size > 0))
        for i in np.flatnonzero(present[first[1:]] - present[first[:-1]] >= need).tolist():
            mine = np.arange(first[i], first[i + 1])
            mine = mine[size[mine] > 0]
            mine = mine[np.argsort(size[mine], kind="stable")].tolist()
            least, c, best_known = need[i], len(mine), -np.inf
            rest = np.append(np.cumsum(worth[mine][::-1])[::-1], 0.0) + 1e-5  # more than rounding takes
            for x in range(c - least + 1):
                j = mine[x]
                if x and size[j] >= LONG_LIST:
                    best_known = max(best_known, threshold(np.flatnonzero(score > 0), mine[x:], least, own[i]))
                    if rest[x] < best_known:
                        break
                score[row[begin[j]:end[j]]] += part[begin[j]:end[j]]
            else:
                x = c - least + 1
            cand = np.flatnonzero(score > 0)
            for j in mine[x:]:
                if len(cand) * 8 > size[j]:
                    score[row[begin[j]:end[j]]] += part[begin[j]:end[j]]
                    s = score[cand]
                else:
                    s = score[cand]
                    looked_up(cand, s, j)
                    score[cand] = s
                x += 1
                m = np.floor(s / match)
                cand = cand[(m + (c - x) >= least) & (s - m * match + rest[x] >= best_known)]
            s = score[cand]
            m = np.floor(s / match)
            kept = (m >= least) & (cand != own[i])
            found, s = cand[kept], np.floor((s - m * match)[kept] * 1e6 + 0.5) / 1e6
            if len(found) > k:
                best = s >= np.partition(s, len(s) - k)[len(s) - k]
                found, s = found[best], s[best]
                best = np.lexsort((found, -s))[:k]
                found, s = found[best], s[best]
            out.append((np.full(len(found), i), found, s))
            score[:] = 0
        if not out:
            return schema.empty_table()
        source, found, s = (np.concatenate(x) for x in zip(*out))
        return pa.Table.from_arrays([sources.take(pa.array(source)), docs.take(pa.array(found)), pa.array(s)], schema=schema)

    return run


def _best_terms(n_terms: int, min_match: float):
    """Arrow batches (doc_id, tids, tfs, idfs) -> (source_id, need, tids, idfs): the terms of largest tf * idf that others have too."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            flat = lambda c: batch.column(c).flatten().to_numpy(zero_copy_only=False)  # noqa: E731, B023
            tid, idf = flat("tids"), flat("idfs")
            n = pc.list_value_length(batch.column("tids")).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((tid, -(flat("tfs") * idf), row))
            rank = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            best = order[(rank < n_terms) & (tid[order] % 2 == 1)]
            size = np.bincount(row[best], minlength=len(n))
            some = np.flatnonzero(size)
            begin = pa.array(np.append(0, np.cumsum(size[some])).astype(np.int32))
            need = np.ceil(np.minimum(n[some], n_terms) * min_match).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(some)), pa.array(need), *(pa.ListArray.from_arrays(begin, pa.array(x[best])) for x in (tid, idf))],
                names=["source_id", "need", "tids", "idfs"])

    return run


def related(index: TextIndex, sources: DataFrame, fields: list[str], n_terms: int, min_match: float,
            k: int, among: DataFrame | None = None) -> DataFrame:
    """SUG-7: (source_id, doc_id, score, rank) - k most similar documents per source document.

    Tag and category names are fields like any other. ``among`` (doc_id) restricts the candidates, e.g.
    to some post types. Scores are added up in tiles of a block of documents and a block of sources,
    which keep each source's ``k`` best: no pair of documents is shuffled or written, only the documents'
    terms (once per block of sources) and the sources' terms (once per block of documents).
    """
    post = index.postings.filter(F.col("field").isin(fields))
    tf = written(post.groupBy("doc_id", "term").agg(F.sum("tf").alias("tf")), "related-tf")
    n_docs = tf.select("doc_id").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    # Numbers in the order of terms, odd ones for terms of several documents: others find none, but count in ``need``.
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).orderBy("term")
    numbers = written(df.select("term", (F.monotonically_increasing_id() * 2 + (F.col("df") > 1).cast("long")).alias("tid"),
                                F.log(1.0 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")), "related-numbers")
    lengths = post.filter("opens").groupBy("doc_id").agg(F.sum("len").alias("len"))
    avg = lengths.agg(F.avg("len")).scalar()
    marked = lambda ids, name: ids.select("doc_id").distinct().withColumn(name, F.lit(True))
    per_doc = tf.join(numbers, "term").groupBy("doc_id").agg(F.collect_list(F.struct("tid", "tf", "idf")).alias("t"))
    per_doc = per_doc.join(lengths, "doc_id").join(marked(sources, "asked"), "doc_id", "left")
    per_doc = per_doc.withColumn("among", F.lit(True)) if among is None else per_doc.join(marked(among, "among"), "doc_id", "left")
    all_docs = written(per_doc.select("doc_id", "asked", "among", F.col("t.tid").alias("tids"), F.col("t.tf").cast("array<int>").alias("tfs"),
                                      F.col("t.idf").alias("idfs"), (K1 * (1 - B + B * F.col("len") / avg)).alias("norm")), "related-docs")
    docs = all_docs.filter("among").select("doc_id", "tids", "tfs", "norm")
    asked = written(all_docs.filter("asked").select("doc_id", "tids", "tfs", "idfs").mapInArrow(
        _best_terms(n_terms, min_match), f"source_id {dict(docs.dtypes)['doc_id']}, need bigint, tids array<bigint>, idfs array<double>"),
        "related-sources")
    n, m = docs.count(), asked.count()
    doc_blocks = max(-(-n // TILE_DOCS), min(-(-n // LEAST_DOCS), 4), 1)
    source_blocks = max(-(-m // TILE_SOURCES), min(-(-LEAST_TILES // doc_blocks), -(-m // LEAST_SOURCES)), 1)
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every_block = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = docs.select(block("doc_id", doc_blocks).alias("db"), every_block(source_blocks).alias("sb"), "*")
    right = asked.select(every_block(doc_blocks).alias("db"), block("source_id", source_blocks).alias("sb"), "*")
    id_type = dict(docs.dtypes)["doc_id"]
    per = left.groupBy("db", "sb").cogroup(right.groupBy("db", "sb")).applyInArrow(
        _most_related(k), f"source_id {id_type}, doc_id {id_type}, score double").withColumn("score", F.round("score", 6))
    wr = Window.partitionBy("source_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return per.withColumn("rank", F.row_number().over(wr)).filter(F.col("rank") <= k).select("source_id", "doc_id", "score", "rank")
