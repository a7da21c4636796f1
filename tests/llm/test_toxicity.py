"""Nearest labelled examples against brute force, and held-out accuracy."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import MEDIUM
from pyspark.sql import functions as F

from pulsemark.llm import catalog, toxicity
from pulsemark.llm.text import runs


def plain_words(text):
    lowered = text.translate({k: k + 32 for k in range(65, 91)})
    return re.findall("[0-9a-z\x80-\U0010FFFF]+", lowered)


def test_counts_equal_plain_python():
    rng = random.Random(2)
    terms = ["a", "été", "bad", "x9"]
    texts = ["".join(rng.choice(["a", "A", "bad", "été", " ", ".", "-", "x9", "\n", "Bad!"]) for _ in range(rng.randrange(12)))
             for _ in range(400)] + ["", "a" * 1000]
    lexicon, base = toxicity.Lexicon(terms), 0
    for lo, hi, data, at in runs(pa.array(texts), 300):
        got = {(int(r) + lo, terms[t]): int(n) for r, t, n in zip(*lexicon.counts(data, at))}
        assert got == {(k, w): plain_words(texts[k]).count(w) for k in range(lo, hi) for w in terms
                       if w in plain_words(texts[k])}
        base += hi - lo
    assert base == len(texts)


@pytest.mark.parametrize("block", [1, 4, 64])
def test_nearest_equals_brute_force(block):
    rng = np.random.default_rng(block)
    for count, n_terms in ((0, 3), (1, 1), (50, 6), (700, 40)):
        vectors = np.where(rng.random((count, n_terms)) < 0.12, rng.integers(1, 4, (count, n_terms)), 0).astype(float)
        length = np.linalg.norm(vectors, axis=1, keepdims=True)
        vectors = vectors / np.where(length > 0, length, 1)
        row, term = np.nonzero(vectors)
        bounds = np.searchsorted(row, np.arange(count + 1))
        index = toxicity.BlockMaxIndex(bounds, term, vectors[row, term], n_terms, block)
        for _ in range(60):
            asked = np.where(rng.random(n_terms) < 0.2, rng.random(n_terms), 0)
            asked[rng.integers(n_terms)] = 1
            asked /= np.linalg.norm(asked)
            at = np.flatnonzero(asked)
            best, near = index.nearest(at, asked[at], 7)
            truth = np.round(vectors @ asked, 12)
            order = [e for e in np.lexsort((np.arange(count), -truth)) if truth[e] > 0][:7]
            assert best.tolist() == order and np.allclose(near, truth[order])


def test_bounds_spare_blocks():
    rng = np.random.default_rng(0)
    terms = rng.integers(0, 200, 20_000)
    index = toxicity.BlockMaxIndex(np.arange(20_001), terms, np.ones(20_000), 200)
    index.nearest(np.array([3, 9]), np.array([0.9, 0.436]), 5)
    assert index.opened <= 2 * toxicity.OPEN < index.n_blocks / 10


def test_isotonic():
    x, y = toxicity.isotonic(np.array([1.0, 2, 3, 4, 4]), np.array([0.0, 1, 0, 1, 1]))
    assert x.tolist() == [1, 2.5, 4] and y.tolist() == [0, 0.5, 1]
    rng = np.random.default_rng(1)
    x, y = toxicity.isotonic(rng.random(500), rng.integers(0, 2, 500).astype(float))
    assert (np.diff(x) > 0).all() and (np.diff(y) > 0).all()


def fixture(spark):
    rows = [(k, ("you idiot, bad " if k % 5 == 0 else "a fine day ") + f"word{k % 7} note{k % 3}", "x") for k in range(200)]
    docs = spark.createDataFrame([*rows, (None, "IDIOT", "n"), (900, None, "y"), (901, "", "y"), (901, "", "y"),
                                  (902, "so idiot " * 50_000, "z")], "id long, text string, score string")
    labels = spark.createDataFrame([(k, int(k % 5 == 0), "q") for k in range(200)] + [(None, 1, "q"), (900, None, "q")],
                                   "id long, bad int, text string")
    return docs, labels


def test_edge_rows(spark):
    docs, labels = fixture(spark)
    model = toxicity.fit(docs, labels, "id", "bad")
    assert model.terms and "idiot" in model.terms
    got = toxicity.grade(docs, model, ["id", "text"]).collect()
    assert len(got) == 205
    by = {(r.id, (r.text or "")[:9]): r for r in got}
    assert by[(None, "IDIOT")].score > 0.9 and by[(None, "IDIOT")].terms == ["idiot"]
    assert {e.label for e in by[(None, "IDIOT")].evidence} == {1} and len(by[(None, "IDIOT")].evidence) == toxicity.K
    for key in ((900, ""), (901, "")):
        assert by[key].evidence == [] and 0 <= by[key].score < 0.3
    assert by[(902, "so idiot ")].score > 0.9 and by[(1, "a fine da")].score < 0.3
    with pytest.raises(ValueError, match="score"):
        toxicity.grade(docs, model, ["score"])


def test_few_or_no_labels(spark):
    docs, labels = fixture(spark)
    for some, rate in ((labels.limit(0), 0.0), (labels.where("bad = 1"), 1.0)):
        model = toxicity.fit(docs, some, "id", "bad")
        assert model.terms == []
        assert {r.score for r in toxicity.grade(docs, model, ["id"]).collect()} == {rate}
    assert toxicity.grade(docs.limit(0), model, ["id"]).collect() == []


def test_examples_are_bounded_if_ids_repeat(spark):
    docs, labels = fixture(spark)
    model = toxicity.fit(docs.unionByName(docs), labels, "id", "bad", fit_rows=100)
    assert len(model.ids) == 100


def test_query_on_held_out_rows(spark):
    got = catalog.op11_toxicity(spark, MEDIUM)
    rows = got.join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert got.count() == 1000 and got.where("score < 0 or score > 1 or predicted <> int(score >= 0.3)").count() == 0
    held = got.where(F.col("held_out") != (catalog.remainder("doc_id", 4) == 2))
    assert held.count() == 0
    hit = ((rows.predicted == 1) & (rows.toxic == 1)).sum()
    assert hit / (rows.predicted == 1).sum() > 0.8
    said = rows.terms.map(len) > 0  # some toxic documents of the table hold no word that others hold
    assert hit / (rows.toxic[said] == 1).sum() > 0.9
