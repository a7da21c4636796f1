"""The pipeline against a plain Python version of its stages, on a small table."""

import random

import pytest

import corpus_pipeline
from pulsemark.llm import decontaminate, spiece, vocab
from tests.llm.test_encoders import fewest_edits
from tests.llm.test_text_and_joins import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark_module, tmp_path_factory):
    random.seed(11)
    names = {"en": "the and of house river walks green seldom window under".split(),
             "de": "der und ist haus fluss geht grün selten fenster unter".split()}

    def prose(lang, n):
        return " ".join(random.choice(names[lang]) + random.choice("abcdefgh") * (random.random() < 0.7) for _ in range(n))
    items = [prose("en", 20) for _ in range(3)]
    banner = "Read more of our great stories on this very site"
    rows = []

    def add(text, lang="en"):
        rows.append((len(rows), text, lang, "s", len(text or "")))
    for k in range(24):
        lang = "en" if k % 3 else "de"
        lines = [prose(lang, 30) for _ in range(3)]
        if k % 4 == 0:
            lines.insert(random.randrange(4), banner)
        if k in (5, 6):
            lines[1] += " " + items[k - 5].upper()
        add("\n".join(lines), lang)
    for k in (1, 3):
        copy = rows[k][1].split(" ")
        copy[7] = "changed"
        add(" ".join(copy))
        add(rows[k][1])
    add(None)
    add("")
    add("12 34 !")
    add(banner)
    add("short and alone")
    add("x" * 3000, None)
    folder = str(tmp_path_factory.mktemp("run"))
    spark_module.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as node").write.parquet(f"{folder}/documents.parquet")
    spark_module.createDataFrame([(k, t) for k, t in enumerate(items)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return folder, rows, items, banner


@pytest.fixture(scope="module")
def spark_module():
    from pulsemark.session import local_session

    return local_session("4", "pulsemark-tests")


def test_stages_against_plain_python(spark_module, tables):
    folder, rows, items, banner = tables
    want = [(k, t) for k, t, *_ in rows if t and any(c.isalpha() for c in t)]
    want = [(k, "\n".join(x for x in t.split("\n") if x != banner)) for k, t in want]
    want = [(k, t) for k, t in want if t.strip()]
    want = [(k, t) for (k, t), (_, _, first) in zip(want, sorted(brute(want))) if k == first]
    plain = [decontaminate.normalized(x) for x in items]
    want = [(k, t) for k, t in want if not any(
        fewest_edits(x, decontaminate.normalized(t)) <= decontaminate.budget(len(x), decontaminate.Q, decontaminate.PERCENT)
        for x in plain)]
    encoder = spiece.Encoder(vocab.load())
    got = corpus_pipeline.run(spark_module, folder).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r.piece_ids) for r in got] == [(k, t, encoder.encode(t)) for k, t in want]
    assert all(r.n_chars == len(r.text) for r in got)
    gone = {k for k, *_ in rows} - {r.doc_id for r in got}
    assert {5, 6, 25, 27, 28, 29, 30, 31} <= gone and len(gone) == 10


def test_empty_table(spark_module, tables, tmp_path):
    folder, *_ = tables
    docs = spark_module.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark_module, docs, folder)
        assert docs.count() == 0, name
    assert docs.columns == [*corpus_pipeline.COLUMNS, "piece_ids"]


def test_stages_of_the_contract():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "near_duplicates", "decontamination", "sentencepiece"]
    assert corpus_pipeline.ORACLE_SQL is None
