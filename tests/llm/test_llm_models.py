import itertools
import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulsemark.llm import catalog, langid, lm, quality, vocab
from pulsemark.llm.text import Words, plain

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def test_lm_base_and_gain(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows}
    tokens = {r.doc_id: words_of(r.text) + [None] for r in rows}
    count = Counter(t for k, ts in tokens.items() if not held[k] for t in ts)
    n, v = sum(count.values()), len(count)
    got = catalog.op1_lm_scoring(spark, SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        ts = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(ts), n)
        assert r.n_known == sum(count[t] > 0 for t in ts)
        assert r.base_score == pytest.approx(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in ts))
    held_out = [r for r in got if r.held_out]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


def test_lm_cases(spark):
    rows = [(1, False, "a b a"), (2, True, None), (3, True, ""), (None, None, "b c"), (1, False, "a b a"), (5, True, "z " * 5000)]
    df = spark.createDataFrame(rows, "id long, held_out boolean, text string").selectExpr("*", "1 as block", "'x' as word")
    got = sorted(((r.id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in lm.score_texts(df).collect()))
    assert got == [(0, False, 3, 3, 11), (1, False, 4, 4, 11), (1, False, 4, 4, 11), (2, True, 1, 1, 11),
                   (3, True, 1, 1, 11), (5, True, 5001, 1, 11)]
    assert lm.score_texts(df.where("false")).count() == 0
    none = lm.score_texts(df.where("held_out")).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in none)


def test_lm_is_normalised_and_learns():
    random = np.random.default_rng(1)
    tokens = np.zeros(lm.CLASSES)
    tokens[:4] = 1000
    w = np.tile([0, 1, 2, 3], 20_000)
    model = lm.Bilinear.start(tokens)
    trainer = lm.Trainer(model, tokens, 1)
    before = model.log_probs(np.array([2]), np.array([1]))
    trainer.learn(w[2:], w[1:-1], w[:-2])
    c1, c2 = random.integers(0, lm.CLASSES, (2, 50))
    assert np.allclose(np.exp(model.log_probs(c1, c2).astype(float)).sum(axis=1), 1, atol=1e-4)
    assert model.log_probs(np.array([2]), np.array([1]))[0, 3] > before[0, 3] + 0.5
    planes = random.integers(0, 2**31, 99)
    assert (lm._numbers(lm._planes(planes)) == planes).all()


def test_lm_holds_few_bytes_per_token():
    """Making a block and scoring it, which an executor does in several workers at once."""
    words = [f"w{k * k % 4093}" for k in range(400_000)]
    texts = pa.array([" ".join(words[lo: lo + 500]) for lo in range(0, len(words), 500)])
    block, (data, at) = lm._Block(), plain(texts)
    block.add(list(range(len(texts))), np.arange(len(texts)) % 7 == 2, data, at)
    tracemalloc.start()
    row = block.row(1)
    made = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    hashes, seen = (row.column(k)[0].values.to_numpy() for k in (5, 6))
    counts = lm.Counts(int(seen.sum()), len(hashes), np.sort(hashes.view(np.uint64)[:300]), np.arange(300),
                       np.ones(lm.CLASSES), np.ones(lm.CLASSES))

    class Shared:
        value = counts, lm.Bilinear.start(counts.class_tokens)

    block, dictionary = pa.table(row), pa.table({"at": np.arange(len(hashes)), "c": seen.astype(np.int64)})
    tracemalloc.start()
    scored = lm._score(Shared)(block, dictionary)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    tokens = sum(scored["n_tokens"].to_pylist())
    assert tokens == len(words) + len(texts) and made < 45 * tokens
    assert held < 80 * tokens + 40e6, held / tokens  # a step's log probabilities, of a fixed size, come on top


def test_forward_sums_all_segmentations():
    pieces = vocab.Pieces({"▁a": 0, "ab": 1, "b": 2, "▁ab": 3, "é": 4, "ba": 5, "abb": 6}, {}, [], 0, 7)
    table = langid.PieceTable(pieces)
    probs = np.random.default_rng(3).random((table.size, 2)) / table.size
    names = {p: k + 256 for k, p in enumerate(x for x in pieces.ids)}
    for word in ("a", "ab", "abbab", "bé", "abababab" * 20):
        data = np.frombuffer(word.encode(), np.uint8)
        words = Words(data, np.array([0, len(data)]), lower=False)
        got = langid.log_words(table, probs, words, np.array([0]))[0]
        raw = word.encode()
        totals = np.zeros((len(raw) + 1, 2), object)
        totals[0] = 1.0
        from fractions import Fraction
        total = [[Fraction(1), Fraction(1)]] + [[Fraction(0)] * 2 for _ in raw]
        for j in range(1, len(raw) + 1):
            for i in range(j):
                part = raw[i:j]
                options = [part[0]] if j - i == 1 else []
                text = part.decode("utf-8", "ignore")
                if text.encode() == part:
                    number = names.get(("▁" if i == 0 else "") + text)
                    options += [number] if number is not None else []
                for lang, number in itertools.product(range(2), options):
                    total[j][lang] += total[i][lang] * Fraction(float(probs[number, lang]))
        want = [float(math.log(t.numerator) - math.log(t.denominator)) for t in total[-1]]
        assert got == pytest.approx(want, rel=1e-9)


def test_language_of_held_out_documents(spark):
    rows = catalog.op4_language_id(spark, SMALL).join(
        spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == 200 and all(0 <= r.score <= 1 for r in rows)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held_out = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held_out) >= 0.97 * len(held_out)


def test_language_cases(spark):
    docs = spark.createDataFrame(
        [(1, "the house and the tree", "en"), (2, "das haus und der baum", "de"), (3, None, "en"), (4, "x", None)],
        "doc_id long, text string, lang string")
    model = langid.fit(docs)
    asked = spark.createDataFrame(
        [(1, "The house"), (2, "der BAUM und"), (3, None), (4, ""), (5, "123 . 4"), (None, "the tree " * 9000),
         (7, "é" * 500)], "doc_id long, text string").selectExpr("*", "'de' as lang")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(asked, model, ["doc_id"]).collect()}
    assert got[1][0] == got[None][0] == "en" and got[2][0] == "de" and got[7][0] in ("de", "en")
    assert got[3] == got[4] == got[5] == ("und", 0.0)
    assert langid.predict(asked.where("false"), model, ["doc_id"]).count() == 0
    empty = langid.fit(docs.where("false"))
    assert {r.lang_pred for r in langid.predict(asked, empty, ["doc_id"]).collect()} == {"und"}


def test_ordinal_fit_by_finite_differences():
    random = np.random.default_rng(0)
    features = [np.unique(random.integers(0, 40, 12)) for _ in range(600)]
    true = random.normal(0, 1.5, 40)
    grades = np.array([int(s > -1) + int(s > 1) for s in (true[f].sum() + random.logistic() * 0.3 for f in features)])
    model = quality.fit_model(grades, features, top=2)
    assert model.thresholds[0] < model.thresholds[1]
    scores = np.array([model.weights[f].sum() for f in features])
    tails = model.at_least(scores)
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert (np.round(tails.sum(axis=1)) == grades).mean() > 0.85

    def loss(weights, cuts):
        s = np.array([weights[f].sum() for f in features])
        full = np.column_stack([np.ones(len(s)), quality.Model(weights, cuts).at_least(s), np.zeros(len(s))])
        at = np.arange(len(s))
        return -np.log(full[at, grades] - full[at, grades + 1]).mean() + quality.PENALTY / 2 * (weights ** 2).sum()
    best = loss(model.weights.astype(float), model.thresholds)
    for k in range(0, 40, 9):  # near a minimum in every direction
        for step in (-0.3, 0.3):
            moved = model.weights.astype(float)
            moved[k] += step
            assert loss(moved, model.thresholds) > best - 1e-4


def test_quality_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    grades = catalog.grades(labels)
    model = quality.fit(docs, grades.where("doc_id % 4 <> 0"), top=2)
    rows = quality.grade(docs, model, ["doc_id"]).join(grades.where("doc_id % 4 = 0"), "doc_id").collect()
    assert all(0 <= r.p_at_least_2 <= r.p_at_least_1 <= 1 for r in rows)
    right = [abs(r.expected_grade - r.grade) < 0.5 for r in rows]
    assert sum(right) / len(right) > 0.8


def test_quality_cases(spark):
    docs = spark.createDataFrame([(1, "good words here"), (2, "bad words here"), (None, "good")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 2), (2, 0), (3, 1), (None, 1), (1, None)], "doc_id long, grade int")
    model = quality.fit(docs, labels, top=2)
    asked = spark.createDataFrame([(1, None), (2, ""), (3, " "), (4, "x " * 20000), (4, "x")], "doc_id long, text string")
    got = quality.grade(asked.withColumn("_text", F.lit(1)), model, ["doc_id"]).collect()
    assert len(got) == 5 and {r.expected_grade for r in got if r.doc_id < 4} == {0.0}
    assert quality.grade(asked.where("false"), model, ["doc_id"]).count() == 0
    assert quality.fit(docs.where("false"), labels.where("false"), top=2).thresholds.shape == (2,)
