"""License scans: base places against a plain search, shifted copies of license texts, odd texts."""

import random
import re

import pytest

from contentspark.llm import license_scan as op

MIT = op.LICENSE_TEXTS[6][0]


def plain(text):
    words = re.findall(op.WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = sorted((i, label) for phrase, label in op.PHRASES for i in range(len(words))
                    if words[i:i + len(phrase.split())] == phrase.split())
    return (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
            ",".join(sorted({x for _, x in places})))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, row int, label string")


def corpus():
    rng = random.Random(6)
    parts = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "GNU General Public License", "Apache-License",
             "CC BY-NC", "MIT  License", "the", "é漢", "x", "gnu general gnu general public license"]
    rows = [(i, rng.choice([" ", "\n", ", "]).join(rng.choice(parts) for _ in range(rng.randrange(0, 25)))) for i in range(150)]
    return rows + [(900, None), (901, ""), (902, "..."), (None, "cc by"), (903, "mit license " * 9000), (904, "mit license"),
                   (904, "mit license"), (905, "w" * 100_000), (906, "ÀPACHE license"), (907, "a" * 60_000 + " cc by")]


def test_base_places_against_plain_search(spark):
    rows = corpus()
    got = sorted((str(r.doc_id), r.n_words, r.n_base, str(r.first_word), str(r.last_word), r.base_labels)
                 for r in op.scan(frame(spark, rows)).collect())
    want = sorted((str(i), n, b, str(f), str(last), labels) for i, t in rows for n, b, f, last, labels in [plain(t)])
    assert got == want


@pytest.mark.parametrize("change, labels", [
    (lambda w: w, "mit"),
    (lambda w: w[:8] + ["inserted", "words"] + w[8:], "mit"),
    (lambda w: w[:10] + w[12:], "mit"),
    (lambda w: ["x"] * 30 + [x.upper() for x in w] + ["y"], "mit"),
    (lambda w: w[:9], ""),
    (lambda w: w[::-1], ""),
    (lambda w: w[:13] + ["z"] * 60 + w[13:], ""),
])
def test_copies_of_a_license_text(spark, change, labels):
    r = op.scan(frame(spark, [(1, " ".join(change(MIT.split())))])).first()
    assert r.labels == labels and (r.score >= op.COVER) == bool(labels) and 0 <= r.score <= 1 and r.n_base == 0


def test_lines_of_the_corpus_and_empty(spark):
    lines = [(1, "Licensed under CC BY-NC 4.0.\nText."), (2, "Released under the MIT License."),
             (3, "This work is licensed under the GNU General Public License, version 3."), (4, "Plain text of the water.")]
    got = {r.doc_id: (r.base_labels, r.labels, r.score) for r in op.scan(frame(spark, lines)).collect()}
    assert got == {1: ("cc-by", "cc-by,cc-by-nc", 1.0), 2: ("mit", "mit", 1.0), 3: ("gpl", "gpl", 1.0), 4: ("", "", 0.0)}
    assert op.scan(frame(spark, [])).count() == 0
