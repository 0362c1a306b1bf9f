"""The pipeline: each stage against a brute-force version on what the stage before it wrote, and odd inputs."""

import random
import re

import pytest
from pyspark.sql import functions as F
from test_kneser_ney import Plain
from test_kneser_ney import clean as sentence
from test_mixing import picked_rows, plain_targets
from test_ngram_join import brute as near_brute

import corpus_pipeline as pipeline
from contentspark.llm import kneser_ney, mixing
from contentspark.llm import sentencepiece_unigram as sp

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def corpus():
    rng, rows, labels = random.Random(11), [], []
    for i in range(150):
        lang = rng.choice(["en", "de"])
        text = sentence(rng, lang, rng.choice([40, 120]))
        if i % 10 == 3:
            text = text.upper().replace(" ", "!! ")
        if i % 10 == 4:
            text = rows[-3][1]
        if i % 10 == 5:
            text = rows[-4][1].replace(" ", "  ")
        if i % 10 == 6:
            lang, w = rows[-6][2], rows[-6][1].split()
            w[len(w) // 2] = "house" if lang == "en" else "haus"
            text = " ".join(w)
        rows.append((i, text, lang, f"src{i % 4}", len(text)))
        if i % 2:
            labels.append((i, int("!!" not in text), 0))
    return rows + [(900, None, "en", None, 0), (901, "", None, "src1", 0), (3, "!! " * 50, "xx", "src2", 150)], labels


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """The rows each stage got and gave."""
    rows, labels = corpus()
    sf = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        given = docs
        stage(spark, given, sf).write.parquet(f"{sf}/{name}")
        docs = spark.read.parquet(f"{sf}/{name}")
        out[name] = [r.asDict() for r in given.collect()], [r.asDict() for r in docs.collect()]
    return sf, labels, out


def test_stages_keep_the_columns(written):
    for name, (given, got) in written[2].items():
        if name != "tokens":
            assert list(got[0]) == ["doc_id", "text", "lang", "source", "n_chars"]
        assert got


def test_quality(written):
    _, labels, out = written
    given, got = out["quality"]
    good = {i for i, q, _ in labels if q}
    model = Plain([r["text"] for r in given if r["doc_id"] in good])
    kept = {r["doc_id"] for r in got}
    assert kept == {r["doc_id"] for r in given if r["text"] and "!!" not in r["text"]}
    worst = max(model.log_perplexity(r["text"]) for r in got)
    assert all(model.log_perplexity(r["text"]) > worst for r in given if r["text"] and r["doc_id"] not in kept)


def test_exact(written):
    given, got = written[2]["exact_dedup"]
    want = {}
    for r in given:
        want[norm(r["text"])] = min(r["doc_id"], want.get(norm(r["text"]), r["doc_id"]))
    assert sorted(r["doc_id"] for r in got) == sorted(want.values()) and len(got) < len(given)


def test_near(written):
    given, got = written[2]["near_dedup"]
    want = [i for i, c, *_ in near_brute([(r["doc_id"], r["text"]) for r in given]) if i == c]
    assert sorted(r["doc_id"] for r in got) == sorted(want) and len(got) < len(given)


def test_mix(spark, written):
    given, got = written[2]["mixing"]
    words = lambda rows: sum(len(re.findall(mixing.WORD, r["text"] or "")) for r in rows)
    sizes = {s: words([r for r in given if r["source"] == s]) for s in {r["source"] for r in given}}
    for source, target in plain_targets(sizes).items():
        assert abs(words([r for r in got if r["source"] == source]) - target) <= 1.5 * mixing.BLOCK_WORDS
    want, _ = picked_rows(spark.read.parquet(f"{written[0]}/near_dedup"))
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted(want)


def test_tokens(written):
    given, got = written[2]["tokens"]
    t = sp.Tokenizer(sp.Vocabulary.load()).ready()
    assert len(given) == len(got) and all(r["round_trip"] for r in got)
    assert sorted(t.decode(r["ids"]) for r in got) == sorted(r["text"] for r in given)


def test_run_equals_its_stages(spark, written):
    sf, _, out = written
    rows = pipeline.run(spark, sf).select("doc_id", "ids").collect()
    assert sorted((r.doc_id, r.ids) for r in rows) == sorted((r["doc_id"], r["ids"]) for r in out["tokens"][1])


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_extra_columns_stay(spark, written):
    sf = written[0]
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumns({"rep": F.lit(1), "hash": F.lit("x"), "kept": F.lit(True)})
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns[5:] == ["rep", "hash", "kept"], name
    assert docs.count() > 0 and kneser_ney.ORDER == 4
