"""Kneser-Ney classifier against a plain implementation; junk goes, clean and odd rows get defined results."""

import math
import random
import re
from collections import Counter

import pytest

from contentspark.llm import kneser_ney as op


def plain_symbols(text, order=op.ORDER):
    out, last = [], None
    for token in re.findall(r"[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+", text or ""):
        if token[0] in " \t\n\v\f\r":
            out.append(32)
        elif token == last:
            out[-1] = op.REPEAT  # in place of the space
        else:
            out += [ord(c) if ord(c) < op.FIRST_CLASS else op.FIRST_CLASS + ord(c) % op.CLASSES for c in token]
            last = token
    return [op.BEGIN] * (order - 1) + out


def grams(text, k, order=op.ORDER):
    s = plain_symbols(text)
    return [tuple(s[i - k + 1:i + 1]) for i in range(order - 1, len(s))]


class Plain:
    """Interpolated modified Kneser-Ney, straight from its definition."""

    def __init__(self, texts, order=op.ORDER):
        self.order = order
        self.c = {order: Counter(g for t in texts for g in grams(t, order))}
        for k in range(order - 1, 0, -1):
            self.c[k] = Counter(g[1:] for g in self.c[k + 1])
        self.d = {k: op.discounts(*[sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]) for k, c in self.c.items()}
        self.total, self.mass = {}, {}
        for k, c in self.c.items():
            self.total[k], self.mass[k] = Counter(), Counter()
            for g, n in c.items():
                self.total[k][g[:-1]] += n
                self.mass[k][g[:-1]] += self.d[k][min(n, 3) - 1]

    def p(self, g):
        k = len(g)
        if k == 0:
            return 1 / 4096
        below = self.p(g[1:])
        if not self.total[k][g[:-1]]:
            return below
        n = self.c[k][g]
        kept = n - self.d[k][min(n, 3) - 1] if n else 0
        return (kept + self.mass[k][g[:-1]] * below) / self.total[k][g[:-1]]

    def log_perplexity(self, text):
        g = grams(text, self.order)
        return -sum(math.log(self.p(x)) for x in g) / len(g)


WORDS = {"en": "the of and to in water river stone green house walks under over light".split(),
         "de": "der die und zu im wasser fluss stein haus geht unter über licht grün".split()}


def clean(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n)).capitalize() + "."


def corpus():
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(160):
        lang = rng.choice(["en", "de"])
        t = clean(rng, lang, rng.choice([12, 60, 200]))
        good = i % 5 != 0
        if not good:
            t = [t.upper().replace(" ", "!! "), " | ".join(t.split()), "Xq " * 60, re.sub(r"(\w) ", r"\1%%% ", t)][i // 5 % 4]
        rows.append((i, t, lang, 9))
        if i % 3:
            labels.append((i, int(good), 0))
    return rows, labels


DOCS, LABELS = "doc_id long, text string, lang string, code int", "doc_id long, quality int, toxic int"
ODD = [(900, None, "en", 0), (901, "", None, 0), (902, " \n ", "en", 0), (903, "Wasser 漢字 " * 5000, "xx", 0),
       (None, "the water of the river", "en", 0), (904, "The stone and the house.", "en", 0),
       (904, "The stone and the house.", "en", 0), (905, "the the the", None, 0)]


@pytest.mark.parametrize("texts", [["a  b\n b b c"], ["", " ", "x", "x x", "\n\nx  x ", "é漢 é漢"], ["ab ab", "ab ab"]])
def test_symbols(texts):
    s, t = op.symbols(texts)
    assert [list(s[t == i]) for i in range(len(texts))] == [plain_symbols(x) for x in texts]


def test_perplexity_matches_definition(spark):
    rows, labels = corpus()
    good = {i for i, q, _ in labels if q}
    model = Plain([t for i, t, *_ in rows if i in good])
    found = op.perplexities(spark.createDataFrame(rows + ODD, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len(rows) + len(ODD) - 1  # one row is repeated
    texts = {i: t for i, t, *_ in rows + ODD}
    for r in found:
        if texts[r.doc_id]:
            assert r.log_perplexity == pytest.approx(model.log_perplexity(texts[r.doc_id]), rel=1e-9)
        else:
            assert r.log_perplexity is None


def test_junk_goes_and_clean_stays(spark):
    rows, labels = corpus()
    docs, marks = spark.createDataFrame(rows + ODD, DOCS), spark.createDataFrame(labels, LABELS)
    kept = {r.doc_id for r in op.keep_good(docs, marks).collect()}
    assert {i for i in range(160) if i % 5} <= kept
    assert not kept & {i for i in range(160) if i % 5 == 0}
    assert {900, 901} & kept == set() and {None, 904} <= kept


def test_no_labels_and_no_documents(spark):
    rows, _ = corpus()
    none = spark.createDataFrame([], LABELS)
    assert op.keep_good(spark.createDataFrame(rows, DOCS), none).count() == len(rows)
    assert op.judge(spark.createDataFrame([], DOCS), none).count() == 0


def test_sample_is_bounded(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)] * 2 + [(None, 1, 0), (99, 0, 0)], LABELS)
    assert op.trusted_ids(labels, 20).count() == 20 and op.trusted_ids(labels).count() == 50


def rare(rng, n):
    """Clean text of a language that shares its letters, and junk in them."""
    words = "talo vesi kivi joki ja on kun yli alla mutta sana ilta".split()
    return " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."


@pytest.mark.parametrize("n", [0, 1, 5])
def test_languages_with_few_trusted_documents(spark, n):
    rng = random.Random(9)
    rows, labels = corpus()
    rows += [(1000 + i, rare(rng, 120), "fi", 9) for i in range(30)]
    rows += [(2000 + i, "".join(rng.choice("QZ#%|{}~^") for _ in range(600)), "fi", 9) for i in range(5)]
    labels += [(1000 + i, 1, 0) for i in range(n)]
    found = {r.doc_id: r for r in op.judge(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    assert not any(found[2000 + i].kept for i in range(5))
    if n:
        assert all(found[1000 + i].kept for i in range(30))
    else:  # the fence of all trusted documents
        scored = op.perplexities(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()
        held = sorted(r.held_out for r in scored if r.trusted)
        middle = held[(len(held) - 1) // 2]
        scale = lambda r: math.sqrt(1 + op.PIVOT / r.n_symbols)
        off = sorted((r.held_out - middle) / scale(r) for r in scored if r.trusted)
        reach = off[math.ceil(op.QUANTILE * len(off)) - 1] * (1 + op.SLACK)
        for i in range(30):
            assert math.log(found[1000 + i].threshold) == pytest.approx(middle + reach * scale(found[1000 + i]))


def test_held_out_perplexity_is_of_the_other_folds(spark):
    rows, labels = corpus()
    good = {i for i, q, _ in labels if q}
    found = op.perplexities(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    fold = {r.doc_id: r.text_hash % op.FOLDS for r in found}
    model = {f: Plain([t for i, t, *_ in rows if i in good and fold[i] != f]) for f in range(op.FOLDS)}
    texts = {i: t for i, t, *_ in rows}
    for r in found:
        if r.doc_id in good:
            assert r.held_out == pytest.approx(model[fold[r.doc_id]].log_perplexity(texts[r.doc_id]), rel=1e-9)
        else:
            assert r.held_out is None


def test_repeated_rows_count_once(spark):
    rows, labels = corpus()
    short = "The stone."
    docs = spark.createDataFrame(rows + [(None, short, "en", 9)] * 40 + [(900, short, "en", 9)], DOCS)
    once, many = (next(r for r in op.judge(docs, spark.createDataFrame(labels, LABELS)).collect() if r.doc_id == i)
                  for i in (900, None))
    assert many.n_symbols == once.n_symbols == len(plain_symbols(short)) - op.ORDER + 1
    assert many.threshold == pytest.approx(once.threshold) and many.perplexity == pytest.approx(once.perplexity)


def test_all_trusted_documents_count(spark):
    labels = spark.range(400_100).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert op.trusted_ids(labels).count() == 400_100


def test_many_ngrams_and_ids_shuffle_neither_texts_nor_frequent_ngrams(spark, monkeypatch):
    from contentspark.llm import common

    rows, labels = corpus()
    docs, marks = spark.createDataFrame(rows + ODD, DOCS), spark.createDataFrame(labels, LABELS)
    as_dict = lambda df: {(r.doc_id, r.lang, r.text_hash): r for r in df.collect()}
    whole = as_dict(op.perplexities(docs, marks))
    written = {}

    def kept(df, label):
        written[label] = df
        return common.materialize(df, label)

    monkeypatch.setattr(op, "materialize", kept)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(op, "TABLE_ROWS", 200)
    parts = as_dict(op.perplexities(docs, marks))
    assert "Join" not in written["ngram-counts"]._jdf.queryExecution().optimizedPlan().toString()  # texts stay where they are read
    rare = [n for r in written["document-costs"].collect() for n in r.times]
    assert 0 < sum(rare) < sum(r.n_symbols for r in whole.values()) / 4
    assert parts.keys() == whole.keys()
    for key, r in whole.items():
        for name in ("n_symbols", "log_perplexity", "trusted", "held_out"):
            assert parts[key][name] == (pytest.approx(r[name], rel=1e-9) if r[name] is not None else None), (key, name)


def test_texts_without_symbols_are_judged(spark):
    rows, labels = corpus()
    docs, marks = spark.createDataFrame(rows + ODD, DOCS), spark.createDataFrame(labels + [(900, 1, 0), (901, 1, 0)], LABELS)
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"  # a division by zero is an error
    found = {r.doc_id: r for r in op.judge(docs, marks).collect()}
    for i in (900, 901):
        assert (found[i].n_symbols, found[i].perplexity, found[i].threshold, found[i].kept) == (0, None, None, False)
    assert found[904].kept and found[904].threshold > 1
