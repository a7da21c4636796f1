"""Alignment of tokenizers against plain Python over all pairs of tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from tokenizers import Tokenizer

from pulsemark.llm import alignment, catalog


def spans(sizes):
    ends = np.cumsum(sizes).tolist()
    return list(zip([0, *ends], ends))


def plain_alignment(a, b):
    """Groups as token places and all overlapping pairs, by definition, for two lists of token sizes."""
    x, y = spans(a), spans(b)
    cuts = sorted({e for _, e in x} & {e for _, e in y})
    groups = [([i for i, (s, e) in enumerate(x) if lo < e <= hi], [j for j, (s, e) in enumerate(y) if lo < e <= hi])
              for lo, hi in zip([0, *cuts], cuts)]
    links = [(i, j) for i, (s, e) in enumerate(x) for j, (t, f) in enumerate(y) if s < f and t < e]
    return groups, links


def some_sizes(rng, total, most):
    out = []
    while total:
        out.append(min(total, rng.randrange(1, most + 1)))
        total -= out[-1]
    return out


def test_align_equals_all_pairs():
    rng = random.Random(3)
    for _ in range(300):
        totals = [rng.choice([0, 1, 2, 7, 40, 120]) for _ in range(rng.choice([1, 4]))]
        a, b = ([some_sizes(rng, n, rng.choice([1, 2, 5, 30])) for n in totals] for _ in "ab")
        flat = [np.array([x for t in side for x in t], np.int64) for side in (a, b)]
        counts = [np.array([len(t) for t in side], np.int64) for side in (a, b)]
        a_group, b_group, a_at, b_at = alignment.align(*flat, *counts)
        groups, links, i, j = [], [], 0, 0
        for x, y in zip(a, b):
            g, pairs = plain_alignment(x, y)
            groups += [([i + k for k in p], [j + k for k in q]) for p, q in g]
            links += [(i + p, j + q) for p, q in pairs]
            i, j = i + len(x), j + len(y)
        assert list(zip(a_at.tolist(), b_at.tolist())) == links
        assert [(np.flatnonzero(a_group == k).tolist(), np.flatnonzero(b_group == k).tolist())
                for k in range(len(groups))] == groups


def test_long_interval_without_a_cut():
    a = np.full(200_000, 2, np.int64)
    b = np.array([1, *[2] * 199_999, 1], np.int64)
    a_group, b_group, a_at, _ = alignment.align(a, b, np.array([len(a)]), np.array([len(b)]))
    assert a_group.max() == b_group.max() == 0 and len(a_at) == len(a) + len(b) - 1


def test_byte_alphabet_covers_all_bytes():
    assert sorted(alignment.byte_alphabet().values()) == list(range(256))


TEXTS = ["Hello world", None, "", "naïve café 你好 🙂 \x00 x", "a ▁ b", "<|endoftext|> </s> <s>", " \n\t ", "x" * 20_000,
         "tokenization " * 5000, "Hello world"]


def plain_rows(texts):
    """The query's columns but for the id, in plain Python."""
    import sentencepiece
    first = Tokenizer.from_file(alignment.BYTE_LEVEL)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECES)
    alphabet = alignment.byte_alphabet()
    coded, held = [], Counter()
    for text in texts:
        a = first.encode(" " + (text or ""), add_special_tokens=False)
        x = [bytes(alphabet[c] for c in t) for t in a.tokens]
        ids = second.encode(text or "")
        y = [bytes([int(p[3:-1], 16)]) if second.is_byte(k) else p.replace("▁", " ").encode()
             for k, p in ((k, second.id_to_piece(k)) for k in ids)]
        wanted = b" " + (text or "").encode()
        if not text or b"".join(x) != wanted or b"".join(y) != wanted:
            coded.append(([], [], [], []))
            continue
        i, sx, sy, links = 0, spans([len(t) for t in x]), spans([len(t) for t in y]), []
        for p, (s, e) in enumerate(sx):
            while i and sy[i][0] > s:
                i -= 1
            while i < len(sy) and sy[i][1] <= s:
                i += 1
            j = i
            while j < len(sy) and sy[j][0] < e:
                links.append((a.ids[p], ids[j]))
                j += 1
        cuts = sorted({e for _, e in sx} & {e for _, e in sy})
        groups, p, q = [], 0, 0
        for c in cuts:
            m, n = p, q
            while p < len(sx) and sx[p][1] <= c:
                p += 1
            while q < len(sy) and sy[q][1] <= c:
                q += 1
            groups.append((a.ids[m:p], ids[n:q]))
        coded.append((a.ids, ids, groups, links))
        held.update(set(links))
    most = {}
    for (a, _), n in held.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for a, b, groups, links in coded:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((len(a), len(b), len(groups), len(links), hashlib.sha256(text.encode()).hexdigest() if a else "",
                    sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links)))
    return out


@pytest.mark.parametrize("hot", [3, alignment.HOT])
def test_edge_rows(spark, hot):
    rows = [(None if k == 4 else k // 2, text, "x") for k, text in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "id long, text string, key string").repartition(3)
    found = alignment.aligned(docs, ["id", "key", "text"])
    got = alignment.with_link_counts(found, hot).collect()
    want = sorted(zip([(r[0] is None, r[0] or 0, r[1] or "") for r in rows], plain_rows(TEXTS)))
    assert sorted(((r.id is None, r.id or 0, r.text or ""),
                   (r.n_a, r.n_b, r.n_groups, r.n_links, hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "",
                    r.n_best, r.count_sum)) for r in got) == want
    by = {r.text: r for r in got}
    assert by["a ▁ b"].n_a == 0 and by["a ▁ b"].groups == "" and by["<|endoftext|> </s> <s>"].n_a > 3
    assert all(r.key == "x" for r in got)


def test_units_are_found_once_and_as_in_whole_texts(monkeypatch):
    rng = random.Random(7)
    parts = ["the", "er", "x", " ", " ", " ", "  ", "\n", " \n", "\n ", "日", "🙂", "...", "'s", "12", "\xa0", "\u3000", "\x1c", "▁", "y" * 101]
    texts = ["".join(rng.choices(parts, weights=[9] * 18 + [1, 1], k=rng.randrange(40))) for _ in range(2000)]
    coders = alignment.Encoders(alignment.BYTE_LEVEL, alignment.PIECES)
    want = coders.encode(texts)
    for remembered in (alignment.REMEMBERED, 20_000):
        monkeypatch.setattr(alignment, "REMEMBERED", remembered)
        aligner, seen = alignment._Aligner(coders), 0
        for lo in range(0, len(texts), 100):
            found, rows = aligner.parts(texts[lo:lo + 100])
            seen += len(rows)
            for row, (a, b) in zip(rows, want[lo:lo + 100]):
                whole = aligner.find(*(np.array(x, np.int64) for x in (a, b)), *(np.array([len(x)]) for x in (a, b)))
                assert found.sizes[:, row].sum(axis=1).tolist() == whole.sizes[:, 0].tolist()
                assert ";".join(found.spelt[k] for k in row) == whole.spelt[0]
                at = np.concatenate([[0], np.cumsum(found.sizes[3])])
                assert [x for k in row for x in found.links[at[k]:at[k + 1]].tolist()] == whole.links.tolist()
        assert seen == len(texts)
    again, coded = ["one two three"] * 500, []
    encode = coders.encode
    monkeypatch.setattr(coders, "encode", lambda texts: coded.extend(texts) or encode(texts))
    aligner = alignment._Aligner(coders)
    for _ in range(3):
        aligner.parts(again)
    assert sum(map(len, coded)) == len("one two three")


def test_empty_table_and_clashes(spark):
    docs = spark.createDataFrame([], "id long, text string, n_a long")
    assert alignment.with_link_counts(alignment.aligned(docs, ["id"])).collect() == []
    with pytest.raises(ValueError, match="n_a"):
        alignment.aligned(docs, ["n_a"])


def test_query_equals_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in catalog.op12_tokenizer_alignment(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for d, want in zip(docs, plain_rows([d.text for d in docs])):
        r = got[d.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum) == want


def test_byte_level_encoder_equals_library():
    coders = alignment.Encoders(alignment.BYTE_LEVEL, alignment.PIECES)
    library = Tokenizer.from_file(alignment.BYTE_LEVEL)
    library.encode_special_tokens = True
    rng, entries = random.Random(11), [t.decode("utf-8", "ignore") for t in coders.a_bytes if t]
    points = [chr(c) for c in range(1, 0x3000)] + list("  \n\t'sdllve") * 200 + ["🙂", "你", "<|endoftext|>"] * 50
    texts = ["".join(rng.choice(rng.choice([entries, points])) for _ in range(rng.randrange(1, 60))) for _ in range(8000)]
    texts += ["".join(rng.choice("abcdeinorst' ") for _ in range(200)) for _ in range(1000)]
    for text, e in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False)):
        assert coders.a.encode_ordinary(text) == e.ids
        assert b"".join(coders.a_bytes[k] for k in e.ids) == text.encode()
