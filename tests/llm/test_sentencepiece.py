"""SentencePiece: round trips, the library's own Unigram search, brute force, edge cases."""

import itertools
import math

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from contentspark.llm import sentencepiece_unigram as op

TEXTS = ["", " ", "  Hello  world\n\tnew lines\n\n", "Grüße und café, ñandú", "漢字 かな 🤗🤗", "▁x▁ ▁▁", "<s> <0x41>",
         "the quick brown fox's 12,345.67 tokens", "x" * 5000, " " * 3000, "\x00\x01​﻿", "ab " * 4000,
         "thntstble onhehe ouoi éçèê ciónue verbeit"]


@pytest.fixture(scope="module")
def vocabulary():
    return op.Vocabulary.load()


@pytest.fixture(scope="module")
def tokenizer(vocabulary):
    return op.Tokenizer(vocabulary).ready()


def ids_of(tokenizer, text):
    return np.frombuffer(tokenizer.encode_all([text])[0], dtype="<i4").tolist()


def small(pieces):
    names = [f"<0x{b:02X}>" for b in range(256)] + list(pieces)
    return op.Vocabulary(names, [0.0] * 256 + list(pieces.values()), ["byte"] * 256 + ["piece"] * len(pieces))


@pytest.mark.parametrize("text", TEXTS)
def test_round_trip(tokenizer, text):
    assert tokenizer.decode(ids_of(tokenizer, text)) == text


@given(st.lists(st.text(max_size=60), max_size=8))
@settings(max_examples=150, deadline=None)
def test_round_trip_of_any_text(tokenizer, texts):
    for text, code in zip(texts, tokenizer.encode_all(texts)):
        assert tokenizer.decode(np.frombuffer(code, dtype="<i4").tolist()) == text


def test_same_ids_as_the_library_in_unigram_mode():
    raw = open(op.MODEL, "rb").read()
    assert raw.count(b"\x18\x02 \x80\xfa\x01") == 1  # the trainer's model type: 2 is BPE, 1 is Unigram
    library = sentencepiece.SentencePieceProcessor(model_proto=raw.replace(b"\x18\x02 \x80\xfa\x01", b"\x18\x01 \x80\xfa\x01"))
    v = op.Vocabulary.load()
    v.scores = [library.get_score(i) for i in range(library.get_piece_size())]
    t = op.Tokenizer(v).ready()
    for text in ["the quick brown fox", "a the he heat there", "Grüße und café, ñandú", "Hello world", "tokens of text",
                 "les chevaux sont partis", "ciónue verbeit ouoi", "internationalization's end."]:
        best, *rest = library.nbest_encode_as_ids(text, 2)  # its lattice search
        total = lambda ids: sum(v.scores[i] for i in ids)
        mine = ids_of(t, text)
        assert mine == best or total(mine) == total(best), text


def test_best_of_all_segmentations():
    pieces = {"▁": -2.0, "a": -3.0, "b": -3.1, "c": -4.0, "ab": -4.5, "bc": -4.6, "abc": -8.0, "▁a": -3.3, "ca": -5.9, "aab": -6.5}
    t = op.Tokenizer(small(pieces)).ready()
    for word in ("".join(w) for n in range(1, 7) for w in itertools.product("abc", repeat=n)):
        marked = "▁" + word
        best = [0.0] + [-math.inf] * len(marked)
        for j in range(1, len(marked) + 1):
            best[j] = max(best[i] + pieces.get(marked[i:j], -math.inf) for i in range(j))
        got = ids_of(t, word)
        assert "".join(t_ for t_ in [list(pieces)[i - 256] for i in got]) == marked
        assert sum(list(pieces.values())[i - 256] for i in got) == pytest.approx(best[-1])
        assert t.search(marked) == got


def test_trie_finds_every_piece_and_nothing_else(vocabulary):
    words = {p: i for i, (p, k) in enumerate(zip(vocabulary.pieces, vocabulary.kinds)) if k == "piece"}
    codes, base, check, value = op.double_array(words)

    def find(w):
        node = 0
        for ch in w:
            t = base[node] + codes.get(ch, 10**6)
            if t >= len(check) or check[t] != node:
                return -1
            node = t
        return value[node]

    assert all(find(w) == i for w, i in words.items())
    assert all(find(w + "q") == words.get(w + "q", -1) for w in list(words)[:3000])


def test_scores_are_log_probabilities(vocabulary):
    real = [math.exp(s) for s, k in zip(vocabulary.scores, vocabulary.kinds) if k == "piece"]
    assert sum(real) == pytest.approx(1)


def test_frames(spark, tokenizer):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, "no id", "x", 1), (7, None, "x", 1), (3, TEXTS[3], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    out = op.encode(docs)
    got = out.collect()
    assert len(got) == len(rows) and all(r.round_trip and r.n_tokens == len(r.ids) for r in got)
    assert sorted(r.ids for r in got) == sorted(ids_of(tokenizer, t or "") for _, t, *_ in rows)
    back = sorted(((r.doc_id is None, r.doc_id, r.text) for r in op.decode(out).collect()), key=str)
    assert back == sorted(((i is None, i, t or "") for i, t, *_ in rows), key=str)
    assert op.encode(docs.limit(0)).count() == 0
    bad = spark.createDataFrame([(1, [0xC3 + 3, 99999, None, -5]), (2, None)], "doc_id long, ids array<int>")
    assert sorted(r.text for r in op.decode(bad).collect()) == ["", "�"]
