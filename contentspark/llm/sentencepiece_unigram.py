"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie of pieces.

The vocabulary comes from a SentencePiece model file (a parameter; never trained or
copied here). Its log scores are used as they are; a file whose scores are ranks
(BPE files count 0, -1, -2, ...; all scores are whole numbers) gets log probabilities by
Zipf's law, log p = -log(rank) - log(sum of 1 / rank).

Encoding: spaces become the marker U+2581, one marker goes in front, and of all ways to
cut the text into pieces the one with the highest sum of scores wins (of equal ones the
piece that starts earlier). A character that no piece covers, and a literal U+2581, costs
the lowest score less 10 and becomes its UTF-8 bytes' pieces. No piece has a marker behind
another character, so a text is cut before its markers and equal stretches share one
search (a bounded cache in each Python
worker; new stretches are searched together, one trie step for all of them at a time).

Decoding: piece bytes are joined, markers become spaces, the first one is dropped; invalid
UTF-8 becomes U+FFFD. ``decode(encode(t)) == t`` for every text.

Each row is encoded where it is read; nothing is shuffled. The trie is broadcast, its
size is bounded by the vocabulary file.

Defined results: null and empty texts have no pieces and decode to the empty text. Texts
of any length are searched whole, in time linear in the length. Rows are independent:
repeated rows give repeated results, null doc_ids stay null, extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentspark.llm.common import small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_ENTRIES = 150_000
SHORT = 48       # characters of a stretch that is cached and searched together with others
TOGETHER = 8192  # stretches of similar length that are searched at once
SLICE_CHARS = 1 << 19  # texts that are encoded at once, but for longer ones
TRIES = 100  # free slots of the double array that a node tries before it goes to the end


class Vocabulary:
    """Pieces of a model: text, log score and kind (piece, byte, other) by id."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        self.pieces, self.kinds = pieces, kinds
        known = [i for i, k in enumerate(kinds) if k == "piece"]
        if known and all(scores[i] <= 0 and scores[i] == int(scores[i]) for i in known):
            by_rank = sorted(known, key=lambda i: (-scores[i], i))
            norm = math.log(sum(1 / r for r in range(1, len(known) + 1)))
            scores = list(scores)
            for rank, i in enumerate(by_rank, 1):
                scores[i] = -math.log(rank) - norm
        self.scores = scores

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(p.get_piece_size())
        kind = lambda i: "byte" if p.is_byte(i) else "other" if p.is_control(i) or p.is_unknown(i) or p.is_unused(i) else "piece"
        return cls([p.id_to_piece(i) for i in ids], [p.get_score(i) for i in ids], [kind(i) for i in ids])


def double_array(words: dict[str, int]) -> tuple[dict[str, int], np.ndarray, np.ndarray, np.ndarray]:
    """(character codes, base, check, value) of a trie over ``words``.

    The child of node s by code c is t = base[s] + c, if check[t] == s. value[t] is the
    id of the word that ends at t, or -1. Node 0 is the root.
    """
    often = Counter(ch for w in words for ch in w)
    characters = {ch: i + 1 for i, (ch, _) in enumerate(often.most_common())}  # low codes overlap well
    base, check, value, onward = [0], [0], [-1], [1]  # onward: towards the next free slot

    def grow(n: int) -> None:
        old = len(check)
        if n >= old:
            more = n + 1024 - old
            base.extend([0] * more)
            check.extend([-1] * more)
            value.extend([-1] * more)
            onward.extend(range(old, old + more))

    def free(x: int) -> int:
        grow(x)
        while onward[x] != x:
            grow(onward[x])
            onward[x] = onward[onward[x]]
            x = onward[x]
        return x

    grow(0)
    end, queue = 1, [(0, sorted(words), 0)]
    for node, below, depth in queue:  # grows while it is read
        children: dict[int, list[str]] = {}
        for w in below:
            if len(w) == depth:
                value[node] = words[w]
            else:
                children.setdefault(characters[w[depth]], []).append(w)
        if not children:
            continue
        codes = sorted(children)
        slot, tries = free(codes[0] + 1), 0
        grow(slot + codes[-1])
        while any(check[slot - codes[0] + c] >= 0 for c in codes):
            tries += 1
            slot = free(slot + 1) if tries < TRIES else max(end, codes[0] + 1)  # behind all others there is room
            grow(slot + codes[-1])
        base[node] = slot - codes[0]
        for c in codes:
            t = base[node] + c
            check[t], onward[t] = node, t + 1
            queue.append((t, children[c], depth + 1))
        end = max(end, t + 1)
    return characters, *(np.array(x[:end], dtype=np.int32) for x in (base, check, value))


class Tokenizer:
    """Encodes and decodes with the arrays of a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        words = {p: i for i, (p, k) in enumerate(zip(vocabulary.pieces, vocabulary.kinds)) if k == "piece"}
        self.characters, *self.arrays = double_array(words)
        self.scores = vocabulary.scores
        self.unknown = min((vocabulary.scores[i] for i in words.values()), default=0.0) - UNKNOWN_PENALTY
        byte_ids = {int(p[3:-1], 16): i for i, (p, k) in enumerate(zip(vocabulary.pieces, vocabulary.kinds)) if k == "byte"}
        if len(byte_ids) != 256:
            raise ValueError("the vocabulary has no byte pieces to fall back on")
        self.bytes_to_ids = [byte_ids[b] for b in range(256)]
        self.first_byte, self.last_byte = min(byte_ids.values()), max(byte_ids.values())
        self.raw = [p.replace(MARKER, " ").encode() if k == "piece" else bytes([int(p[3:-1], 16)]) if k == "byte" else b""
                    for p, k in zip(vocabulary.pieces, vocabulary.kinds)]
        # Where a text may be cut without changing the search: before a marker, and around line ends.
        cut = not any(re.search(f"[^{MARKER}]{MARKER}", p) for p in words)
        lines = "\n" if not any("\n" in p for p in words) else ""
        self.units = re.compile(f"{MARKER}*[^{MARKER}{lines}]+|{MARKER}+|\n" if cut else r"(?s:.+)")
        # Arrays for many searches at once: codes by code point, room for any step from the last slot.
        self.codes = np.zeros(max([0, *map(ord, self.characters)]) + 2, dtype=np.int32)
        for ch, c in self.characters.items():
            self.codes[ord(ch)] = c
        room = len(self.characters) + 1
        self.padded = [np.concatenate([self.arrays[0], np.zeros(room, np.int32)]),
                       *(np.concatenate([x, np.full(room, -1, np.int32)]) for x in self.arrays[1:])]
        self.score_array = np.array(self.scores)

    def ready(self) -> Tokenizer:
        """In a worker: plain lists for single searches and an empty cache."""
        self.lists = [a.tolist() for a in self.arrays]
        self.cache = {}
        return self

    def search(self, unit: str, literal: str = "") -> list[int]:
        """Ids of the best segmentation of ``unit``; characters of ``literal`` are spelled in bytes."""
        base, check, value = self.lists
        code = [0 if ch in literal else self.characters.get(ch, 0) for ch in unit]
        n, size, scores, unknown = len(unit), len(check), self.scores, self.unknown
        best, came, piece = [0.0] + [-math.inf] * n, [0] * (n + 1), [-1] * (n + 1)
        for i in range(n):
            here, node, single = best[i], 0, False
            for j in range(i, n):
                c = code[j]
                t = base[node] + c
                if not c or t >= size or check[t] != node:
                    break
                node = t
                v = value[node]
                if v >= 0:
                    single = single or j == i
                    s = here + scores[v]
                    if s > best[j + 1]:
                        best[j + 1], came[j + 1], piece[j + 1] = s, i, v
            if not single and here + unknown > best[i + 1]:
                best[i + 1], came[i + 1], piece[i + 1] = here + unknown, i, -1
        out, at = [], n
        while at:
            if piece[at] >= 0:
                out.append(piece[at])
            else:
                out.extend(self.bytes_to_ids[b] for b in reversed(unit[at - 1].encode("utf-8", "replace")))
            at = came[at]
        return out[::-1]

    def search_all(self, units: list[str]) -> list[bytes]:
        """``search`` for many short units at once: each step of the trie is taken for all of them together."""
        base, check, value = self.padded
        lengths = np.array([len(u) for u in units])
        n, longest = len(units), int(lengths.max())
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        code = np.zeros((n, longest), dtype=np.int32)
        code[np.arange(longest) < lengths[:, None]] = self.codes[np.minimum(points, len(self.codes) - 1)]
        best = np.full((n, longest + 1), -np.inf)
        best[:, 0] = 0
        came = np.zeros((n, longest + 1), dtype=np.int64)
        piece = np.full((n, longest + 1), -1, dtype=np.int64)
        for i in range(longest):
            rows = np.flatnonzero(lengths > i)
            single, node = np.zeros(n, dtype=bool), np.zeros(len(rows), dtype=np.int64)
            every = rows
            for j in range(i, longest):
                c = code[rows, j]
                t = base[node] + c
                ok = (c > 0) & (check[t] == node)
                rows, node = rows[ok], t[ok]
                if not len(rows):
                    break
                v = value[node]
                hit = v >= 0
                r, v = rows[hit], v[hit]
                if j == i:
                    single[r] = True
                s = best[r, i] + self.score_array[v]
                up = s > best[r, j + 1]
                r = r[up]
                best[r, j + 1], came[r, j + 1], piece[r, j + 1] = s[up], i, v[up]
            r = every[~single[every]]
            s = best[r, i] + self.unknown
            up = s > best[r, i + 1]
            r = r[up]
            best[r, i + 1], came[r, i + 1], piece[r, i + 1] = s[up], i, -1
        at, path, spelled = lengths.copy(), [], np.zeros(n, dtype=bool)
        every = np.arange(n)
        while (at > 0).any():  # back from the end; rows that are through get -2
            p = np.where(at > 0, piece[every, at], -2)
            spelled |= p == -1
            path.append(p)
            at = np.where(at > 0, came[every, at], 0)
        ids = np.array(path[::-1]).T
        real = ids >= 0
        ends = np.cumsum(real.sum(axis=1)) * 4
        flat = ids[real].astype("<i4").tobytes()
        out = [flat[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        for i in np.flatnonzero(spelled):
            out[i] = np.array(self.search(units[i]), dtype="<i4").tobytes()
        return out

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit integers."""
        spelled = np.array([self.bytes_to_ids[b] for b in MARKER.encode()], dtype="<i4").tobytes()
        cut = []
        for text in texts:
            if not text:
                cut.append([])
            elif MARKER not in text:
                cut.append(self.units.findall(MARKER + text.replace(" ", MARKER)))
            else:  # literal markers are spelled in bytes: None stands for one
                first, *rest = text.split(MARKER)
                units = self.units.findall(MARKER + first.replace(" ", MARKER))
                for part in rest:
                    units += [None, *self.units.findall(part.replace(" ", MARKER))]
                cut.append(units)
        cache = self.cache
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        cache[None] = spelled
        new = sorted(set().union(*cut) - cache.keys(), key=len)
        short = next((i for i, u in enumerate(new) if len(u) > SHORT), len(new))
        for a in range(0, short, TOGETHER):
            units = new[a:min(short, a + TOGETHER)]
            cache.update(zip(units, self.search_all(units)))
        long = {u: np.array(self.search(u), dtype="<i4").tobytes() for u in new[short:]}
        if long:
            return [b"".join(cache[u] if u in cache else long[u] for u in units) for units in cut]
        return [b"".join(map(cache.__getitem__, units)) for units in cut]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; ids outside the vocabulary and control pieces give nothing."""
        raw = self.raw
        try:
            out = b"".join(map(raw.__getitem__, ids))
        except IndexError:
            out = b"".join(raw[i] for i in ids if i < len(raw))
        return out.decode("utf-8", "replace").removeprefix(" ")


_IN_WORKER: dict[int, Tokenizer] = {}


def _local(shared: Broadcast) -> Tokenizer:
    """The broadcast tokenizer, with its cache kept between a worker's tasks."""
    tokenizer = shared.value
    if id(tokenizer) not in _IN_WORKER:
        _IN_WORKER.clear()
        _IN_WORKER[id(tokenizer)] = tokenizer.ready()
    return tokenizer


def _share(df: DataFrame, model: str) -> Broadcast:
    small_batches(df.sparkSession)
    return df.sparkSession.sparkContext.broadcast(Tokenizer(Vocabulary.load(model)))


ENCODED = "doc_id bigint, n_tokens bigint, n_byte_tokens bigint, ids array<int>, round_trip boolean"


def _encode(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _local(shared)
        a, b = tokenizer.first_byte, tokenizer.last_byte
        for batch in batches:
            sizes = np.cumsum(pc.utf8_length(batch["text"]).to_numpy(zero_copy_only=False))
            i = 0
            while i < batch.num_rows:
                j = max(i + 1, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + SLICE_CHARS, side="right")))
                texts = batch["text"].slice(i, j - i).to_pylist()
                codes = tokenizer.encode_all(texts)
                ids = np.frombuffer(b"".join(codes), dtype="<i4")
                offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in codes])])
                in_bytes = np.concatenate([[0], np.cumsum((ids >= a) & (ids <= b))])[offsets]
                same = [tokenizer.decode(ids[x:y].tolist()) == t for x, y, t in zip(offsets, offsets[1:], texts)]
                yield pa.record_batch(
                    [batch["doc_id"].slice(i, j - i), pa.array(np.diff(offsets)), pa.array(np.diff(in_bytes)),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32))),
                     pa.array(same, pa.bool_())],
                    names=["doc_id", "n_tokens", "n_byte_tokens", "ids", "round_trip"])
                i = j

    return run


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_byte_tokens, ids, and whether the ids decode to the text."""
    shared = _share(docs, model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_encode(shared), ENCODED)


def _decode(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _local(shared)
        for batch in batches:
            texts = [tokenizer.decode([i for i in x if i is not None and i >= 0]) for x in batch["ids"].to_pylist()]
            yield pa.record_batch([batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text of rows with doc_id and ids (null: no pieces)."""
    shared = _share(encoded, model)
    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(_decode(shared), "doc_id bigint, text string")
