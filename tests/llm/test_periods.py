"""Periodic runs against a plain search of all lags."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SMALL

from pulsemark.llm import catalog, periods

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=12):
    """All runs (start, length, period) by their definition."""
    n, best = len(words), {}
    for lag in range(1, n // 2 + 1):
        i = 0
        while i + lag < n:
            if words[i] != words[i + lag]:
                i += 1
                continue
            j = i
            while j + lag < n and words[j] == words[j + lag]:
                j += 1
            if j - i + lag >= max(least, 2 * lag):
                best.setdefault((i, j + lag), lag)
            i = j
    return sorted((s, e - s, q) for (s, e), q in best.items())


def plain_collapsed(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def some_words(rng):
    n, kinds = rng.choice([0, 1, 11, 12, 30, 80, 300]), rng.choice([1, 2, 3, 8, 60])
    words = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randrange(4) if n > 20 else 0):
        a, p = rng.randrange(n), rng.randrange(1, n // 3)
        for i in range(a, min(n, a + rng.randrange(2 * p, 6 * p + 12))):
            words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("rounds", [0, 1, 12])
def test_scan_equals_plain_search(rounds):
    rng = random.Random(rounds)
    for _ in range(150):
        texts = [some_words(rng) for _ in range(rng.choice([1, 3]))]
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        codes = np.array([w + 100 * i for i, t in enumerate(texts) for w in t], np.int64)
        if not len(codes):
            continue
        found = periods.scan(codes, *periods.split(codes, bounds, rounds=rounds))
        want = sorted((int(bounds[i]) + s, int(bounds[i]) + s + n, q)
                      for i, t in enumerate(texts) for s, n, q in plain_runs(t))
        assert sorted(map(tuple, found.tolist())) == want


def test_every_word_of_a_segment_occurs_twice():
    rng = random.Random(1)
    codes = np.array([rng.randrange(400) for _ in range(3000)], np.int64)
    for rounds in (0, 12):
        lo, hi = periods.split(codes, np.array([0, 3000]), 2, rounds)
        assert len(lo)
        for a, b in zip(lo, hi):
            assert np.unique(codes[a:b], return_counts=True)[1].min() >= 2
    assert [x.tolist() for x in periods.split(codes, np.array([0, 3000]), 2, 0)] == [lo.tolist(), hi.tolist()]


def test_long_texts_end_soon():
    same = np.zeros(300_000, np.int64)
    assert periods.scan(same, *periods.split(same, np.array([0, 300_000]))).tolist() == [[0, 300_000, 1]]
    peeled = np.array([x for i in range(2, 60_000) for x in (i, i - 1)], np.int64)  # one word is rare at a time
    assert len(periods.split(peeled, np.array([0, len(peeled)]))[0]) == 0


def test_edge_rows(spark):
    loop = "x " + "é Ab ab " * 20 + "y"
    rows = [(1, loop, "kept"), (1, loop, None), (None, None, "a"), (2, "", "b"), (3, " \n\t ", "c"),
            (4, "a" * 300_000, "d"), (5, "w\x00 " * 12, "e"), (6, "w " * 11, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `t` string").withColumnRenamed("t", "k1")
    found = periods.find_runs(docs, ["doc_id", "k1"]).collect()
    by = {r.k1: r for r in found}
    assert len(found) == 8
    for key in ("kept", None):
        assert [tuple(x) for x in by[key].runs] == [(1, 60, 3)] and by[key].collapsed == "x é Ab ab y"
    assert all(by[k].runs == [] and by[k].collapsed == "" for k in "abc")
    assert by["d"].collapsed == "a" * 300_000 and [tuple(x) for x in by["e"].runs] == [(0, 12, 1)]
    assert by["f"].runs == [] and by["f"].collapsed == " ".join("w" * 11)
    assert periods.find_runs(docs.limit(0), ["doc_id"]).collect() == []
    with pytest.raises(ValueError, match="runs"):
        periods.find_runs(docs.withColumn("runs", docs.k1), ["runs"])


def test_query_equals_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in catalog.op13_periodic_runs(spark, SMALL).collect()}
    assert len(got) == len(docs)
    edited = 0
    for d in docs:
        words = WORD.findall(d.text or "")
        n, h = len(words), zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and n:
            g, edited = h // 10, edited + 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        found = plain_runs(words)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        text = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        r = got[d.doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapsed(words, found).encode()).hexdigest()
    assert edited > 5
