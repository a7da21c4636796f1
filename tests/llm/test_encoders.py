import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsemark.llm import chat, decontaminate, lz_print, spiece, token_counts, vocab

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pieces():
    return vocab.load()


@pytest.fixture(scope="module")
def encoder(pieces):
    return spiece.Encoder(pieces)


@given(st.text("ab the▁日é\x00\t\n 𝔘", max_size=40))
@settings(max_examples=200, deadline=None)
def test_round_trip(text):
    encoder = test_round_trip.encoder = getattr(test_round_trip, "encoder", None) or spiece.Encoder(vocab.load())
    assert encoder.decode(encoder.encode(text)) == text


def test_best_scores_against_a_plain_search(encoder, pieces):
    random.seed(4)
    for _ in range(60):
        text = "".join(random.choices(["the", "er", "in", "a", "x", " ", "  ", "ü", "日", "ing"], k=12)).strip() or "a"
        marked = ("▁" + text.replace(" ", "▁"))
        best = [0.0] + [-1e18] * len(marked)
        for end in range(1, len(marked) + 1):
            best[end] = best[end - 1] + encoder.floor
            for start in range(max(0, end - 20), end):
                score = pieces.scores.get(marked[start:end])
                if score is not None:
                    best[end] = max(best[end], best[start] + score)
        ids, total, run = encoder.encode(text), 0.0, bytearray()
        for number in ids:
            if number in encoder.single:
                run.append(encoder.single[number])
            else:
                total += pieces.scores[encoder.texts[number]]
        total += len(run.decode()) * encoder.floor
        assert total == pytest.approx(best[-1])


def test_scores_equal_the_library_as_unigrams(encoder, pieces):
    sentencepiece = pytest.importorskip("sentencepiece")
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto()
    with open(vocab.PIECES, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        p.score = pieces.scores.get(p.piece, p.score)
    library = sentencepiece.SentencePieceProcessor()
    library.LoadFromSerializedProto(proto.SerializeToString())
    for text in ("the house and the tree", "Straße über den Fluss", "la maison et l'arbre", "x1y2 tokenization"):
        mine, other = encoder.encode(text), library.encode(text)
        assert sum(pieces.scores[encoder.texts[k]] for k in mine) == pytest.approx(
            sum(pieces.scores[encoder.texts[k]] for k in other))


def test_encode_frames(spark):
    rows = [(1, "a b"), (None, None), (1, "a b"), (2, ""), (3, "ü 日 ▁" * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as _text")
    got = spiece.encode(df, ["doc_id"]).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in got) == sorted((k or 0, t or "") for k, t in rows)
    assert all(len(r.piece_ids) == 0 for r in got if r.doc_id in (None, 2))
    assert spiece.encode(df.where("false"), ["doc_id"]).count() == 0


def greedy(word, pieces):
    start, count = 0, 0
    marked = vocab.SPACE + word
    while start < len(marked):
        end = len(marked)
        while end > start and marked[start:end] not in pieces:
            end -= 1
        if end == start:
            return 1, 1
        if marked[start:end] == vocab.SPACE and start == 0 and vocab.SPACE not in pieces:
            return 1, 1
        count, start = count + 1, end
    return count, 0


@given(st.sets(st.text("ab", min_size=1, max_size=4), max_size=8), st.sets(st.text("ab", max_size=4), max_size=8),
       st.text("abc", min_size=1, max_size=14))
@settings(max_examples=300, deadline=None)
def test_longest_match_against_greedy(inner, first, word):
    pieces = inner | {vocab.SPACE + x for x in first}
    assert token_counts.LongestMatch(pieces).count(word) == greedy(word, pieces)


def test_token_counts_of_documents(spark, pieces):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40).union(
        spark.createDataFrame([(-1, None, "", "", 0), (-2, "", "", "", 0), (-3, "日 ☃☃ x", "", "", 0)],
                              "doc_id long, text string, lang string, source string, n_chars long"))
    docs = docs.cache()
    got = {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in token_counts.count_tokens(docs, ["doc_id"]).collect()}
    names = set(pieces.ids)
    for r in docs.collect():
        counts = [greedy(w, names) for w in (r.text or "").split()]
        assert got[r.doc_id] == (len(counts), sum(c for c, _ in counts), sum(u for _, u in counts))


def plain_phrases(text):
    known, start, ends = set(), 0, []
    for end in range(1, len(text) + 1):
        if text[start:end] not in known:
            known.add(text[start:end])
            ends.append(end)
            start = end
    return ends + ([len(text)] if start < len(text) else [])


@given(st.text("abc", max_size=200), st.text("abc", max_size=80))
@settings(max_examples=200, deadline=None)
def test_phrases_and_edits(text, other):
    assert lz_print.phrases(text, set()) == plain_phrases(text)
    printed = lz_print.Printed(text)
    edited, fingerprint = printed.edited(other)
    half = len(text) // 2
    assert edited == text[:len(text) - half] + other[:half]
    assert fingerprint.tolist() == lz_print.Printed(edited).print.tolist()


def test_likeness_follows_the_overlap_of_phrase_sets():
    random.seed(1)
    words = ["".join(random.choices("abcdefgh", k=5)) for _ in range(400)]
    base = " ".join(random.choices(words, k=3000))
    for cut in (0, 4000, 9000):
        other = base[:len(base) - cut] + "".join(random.choices("mnopqr", k=cut))
        sets = []
        for text in (base, other):
            ends = plain_phrases(text)
            sets.append({text[a:b] for a, b in zip([0, *ends], ends)})
        true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        assert abs(lz_print.likeness(lz_print.Printed(base).print, lz_print.Printed(other).print) - true) < 0.2
    empty = np.zeros(0, np.uint32)
    assert lz_print.likeness(empty, empty) == 1 and lz_print.likeness(empty, lz_print.Printed("ab").print) == 0


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_fingerprints_of_next_rows(spark, parts):
    random.seed(parts)
    rows = [(k * 7 % 50, "".join(random.choices("abé ", k=random.choice([0, 1, 9, 90])))) for k in range(50)]
    rows += [(60, None), (61, "x"), (None, "nameless text")]
    df = spark.createDataFrame(rows, "id long, text string").selectExpr("*", "1 as part", "'q' as place")
    got = {r.id: r for r in lz_print.fingerprints_with_next(df, parts).collect()}
    assert len(got) == len(rows)
    ordered = sorted(rows, key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    for k, (number, text) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own = lz_print.Printed(text).print
        r = got[number]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == lz_print.digest(own)
        assert r.near_next == lz_print.likeness(own, lz_print.Printed(after).print)
        assert r.near_edited == lz_print.likeness(own, lz_print.Printed(edited).print)


def test_fingerprints_of_repeated_and_single_rows(spark):
    df = spark.createDataFrame([(5, "ab")] * 3 + [(4, "c")], "id long, text string")
    got = lz_print.fingerprints_with_next(df, 2).collect()
    assert sorted(r.edited_sha256 for r in got) == sorted(
        hashlib.sha256(x).hexdigest() for x in (b"aa", b"aa", b"ac", b"c"))
    one = lz_print.fingerprints_with_next(df.where("id = 4")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert lz_print.fingerprints_with_next(df.where("false")).count() == 0


def test_phrases_of_long_repeats_and_edits_of_them():
    random.seed(8)
    noise = "".join(random.choices("abcdefgh ", k=30_000))
    for text in ("ab" * 30_000, noise + "q" * 40_000 + noise, "x" * 8191, "".join(map(chr, range(50_000, 70_000)))):
        assert lz_print.phrases(text, set()) == plain_phrases(text)
        edited, fingerprint = lz_print.Printed(text).edited(noise)
        assert fingerprint.tolist() == lz_print.Printed(edited).print.tolist()


def test_texts_of_a_batch_are_hashed_together(monkeypatch):
    random.seed(9)
    hashed = []
    plain_hashes = lz_print.span_hashes
    texts = ["".join(random.choices("abé \0", k=random.choice([0, 1, 30, 900]))) for _ in range(300)]
    monkeypatch.setattr(lz_print, "span_hashes", lambda *args: hashed.append(1) or plain_hashes(*args))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(300)), pa.array(texts), pa.array([False] * 300), pa.array([k // 250 for k in range(300)])],
        ["id", "text", "tail", "part"])
    rows = [r for b in lz_print._walk([batch.slice(0, 170), batch.slice(170)]) for r in b.to_pylist()]
    assert len(hashed) <= 4
    assert [r["id"] for r in rows] == [k for k in range(299) if k != 249]
    for r in rows:
        own, after = (lz_print.Printed(texts[k]) for k in (r["id"], r["id"] + 1))
        edited, fingerprint = own.edited(after.text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (lz_print.digest(own.print), lz_print.digest(fingerprint))
        assert r["near_edited"] == lz_print.likeness(own.print, fingerprint)
        assert r["near_next"] == lz_print.likeness(own.print, after.print)


CHARS = st.lists(st.sampled_from([*"\\<>[]/SI s\n", "[INST]", "</s>", "<<SYS>>", "INST]"]), max_size=12).map("".join)


@given(CHARS)
@settings(max_examples=200, deadline=None)
def test_escapes(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROLS)
    render = chat.compile_template(chat.TEMPLATE)
    reader = chat.Reader()
    for role in ("user", "assistant", "system", "[INST]"):
        for piece, marked in render([{"role": role, "text": text}]):
            reader.feed(piece, marked)
        reader.finish_turn()
    want = "".join(f"{role}\n{text}\n" for role in ("user", "assistant", "system", "[INST]"))
    assert reader.digest.hexdigest() == hashlib.sha256(want.encode()).hexdigest()
    assert (reader.loss_chars, reader.turns) == (len(text), 4)


def shown(template, *messages):
    return "".join(t for t, _ in chat.compile_template(template)(list(messages)))


def test_template_language():
    m = {"role": "user", "text": " Hi "}
    assert shown("a{{ 'b' + 'c' }}{{ 1 + 2 }}") == "abc3"
    assert shown("{% for m in messages %}{{ loop.index }}{{ m.text | trim | upper }};{% endfor %}", m, m) == "1HI;2HI;"
    assert shown("{% set x = 'y' %}{% if x == 'y' and not false %}1{% elif true %}2{% else %}3{% endif %}") == "1"
    assert shown("{% if 2 < 1 or 'b' in 'abc' %}{{ none }}x{% endif %}") == "x"
    assert shown("{% for m in messages %}{{ m.__class__ }}{{ m.nothing }}{% endfor %}", m) == ""
    folded = chat.fold(chat.parse("a{{ 'b' + 'c' }}{% if 1 == 1 %}d{% else %}e{% endif %}f"))
    assert folded.children == (chat.Node("constant", "abcdf"),)
    pieces = list(chat.compile_template("x{% generation %}y{{ 'z' }}{% endgeneration %}")([]))
    assert "".join(t for t, marked in pieces if marked) == "yz"
    for bad in ("{% for m in other %}{% endfor %}", "{{ open('f') }}", "{% if x %}", "{{ a b }}", "{{ x | eval }}",
                "{% import os %}", "{{ }}", "{% endfor %}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)


def test_conversation_cases(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "é" * 30000), (None, 0, None, "x"), (2, 5, "tool", "</s>"),
            (2, 5, "tool", "</s>"), (3, None, "user", "late"), (3, 1, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as n_turns")
    got = {r.conv_id: r for r in chat.check_format(df).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 2, None: 1, 2: 2, 3: 2}
    assert got[2].turns_sha256 == hashlib.sha256(b"tool\n</s>\n" * 2).hexdigest()
    assert got[3].turns_sha256 == hashlib.sha256(b"user\nlate\nuser\n\n").hexdigest()
    assert got[1].loss_chars == 30000 and got[1].loss_sha256 == hashlib.sha256(("é" * 30000).encode()).hexdigest()
    assert chat.check_format(df.where("false")).count() == 0
    whole = chat.render(df).where("conv_id = 2").orderBy("piece").collect()
    assert "".join(r.text for r in whole) == "<<ROLE>>tool<</ROLE>><\\/s></s>" * 2


def fewest_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_leaks_against_full_alignment():
    random.seed(8)
    letters = "abcdefghij "
    for q, percent in ((4, 10), (5, 8), (10, 8)):
        items = [(k, decontaminate.normalized("".join(random.choices(letters, k=random.choice([3, 30, 60, 120])))))
                 for k in range(12)]
        items = [x for x in items if x[1]]
        texts = [None, ""]
        for _ in range(40):
            _, item = random.choice(items)
            body = list(item)
            for _ in range(random.choice([0, 1, 2, 4, 8, 14])):
                at = random.randrange(len(body) or 1)
                kind = random.random()
                if kind < 0.4:
                    body[at:at + 1] = random.choice(letters)
                elif kind < 0.7:
                    del body[at:at + 1]
                else:
                    body.insert(at, random.choice(letters))
            around = ["".join(random.choices(letters, k=random.choice([0, 5, 80]))) for _ in range(2)]
            texts.append(around[0] + "".join(body) + around[1])
        index = decontaminate.Index.build(items, q, percent)
        got = {(k, o): e for k, (o, e, _) in decontaminate.search(index, texts)}
        want = {}
        for k, text in enumerate(texts):
            text = decontaminate.normalized(text)
            for o, (_, item) in enumerate(items):
                allowed = 0 if len(item) < q else decontaminate.budget(len(item), q, percent)
                edits = fewest_edits(item, text)
                if edits <= allowed:
                    want[(k, o)] = edits
        assert got == want


def test_leaks_of_frames(spark):
    item = "the quick brown fox jumps over the lazy dog and runs away"
    docs = spark.createDataFrame(
        [(1, f"so THE quick\nbrown fox jumps over the lazy dog and runs away it is"), (2, None), (3, ""), (4, "the quick fox"),
         (None, item), (1, item), (5, "z" * 200000 + item.replace("lazy", "lzy"))], "id long, text string")
    bench = spark.createDataFrame([(7, item), (8, item), (9, None), (10, " ")], "item_id long, text string")
    got = sorted((r.id or 0, r.item_id, r.edits) for r in decontaminate.find_leaks(docs, bench).collect())
    assert got == sorted((k, i, e) for k, e in ((1, 0), (0, 0), (1, 0), (5, 1)) for i in (7, 8))
    assert decontaminate.find_leaks(docs.where("false"), bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.where("false")).count() == 0
    split = decontaminate.BLOCK_CHARS
    try:
        decontaminate.BLOCK_CHARS = 40
        assert sorted((r.id or 0, r.item_id, r.edits) for r in decontaminate.find_leaks(docs, bench).collect()) == got
    finally:
        decontaminate.BLOCK_CHARS = split


def test_sentencepiece_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(spiece, "REMEMBERED", 5000)
    encoder, fresh = spiece.Encoder(vocab.load()), spiece.Encoder(vocab.load())
    texts = [" ".join(f"word{k}x{j}" for j in range(40)) + "   " + "y" * 3000 + " 你好" * 50 for k in range(30)]
    for text in texts:
        assert encoder.encode(text) == spiece.Encoder.encode(fresh, text)
        for memory in (encoder.spans, encoder.words):
            size = sum(190 + 2 * len(a) + len(b) for a, b in memory.items())
            assert size == memory.held <= 5000 + 190 + 6 * spiece.LONGEST and all(len(a) <= spiece.LONGEST for a in memory)


def test_sentencepiece_encodes_new_words_together():
    random.seed(6)
    parts = ["the", "er", "in", "a", "x", "ü", "日", "ing", "\n", "🙂", "....", "\0"]
    words = sorted({"".join(random.choices(parts, k=random.randrange(1, 20))) for _ in range(3000)})
    encoder, fresh = spiece.Encoder(vocab.load()), spiece.Encoder(vocab.load())
    together, found = encoder.words_together(words)
    assert sorted(together) == words and found == [fresh.words[w] for w in together]
    for one in ("a", "🙂", "addEventListener"):
        assert encoder.words_together([one]) == ([one], [fresh.words[one]])
    single = []
    encoder.words.encode = lambda word: single.append(word) or fresh.word(word)
    texts = [" ".join(words[k:k + 300]) for k in range(0, len(words), 300)] + ["", " lead", "two  blanks", "▁", "y" * 300, "end "]

    class Shared:
        value = encoder
    ids = [x for *_, (x, _) in spiece._start(Shared)(pa.array(texts)) for x in x.to_pylist()]
    assert ids == [fresh.encode(x) for x in texts]
    assert all(len(w) > spiece.LONGEST or not w for w in single)


def test_sentencepiece_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b", "p", "q"), (None, None, "r", None)], "doc_id long, text string, _text string, t string")
    got = spiece.encode(docs, ["doc_id", "_text", "t"]).collect()
    assert [(r.doc_id, r._text, r.t, r.decoded) for r in got] == [(1, "p", "q", "a b"), (None, "r", None, "")]
    with pytest.raises(ValueError, match="decoded"):
        spiece.encode(docs.withColumn("decoded", docs.t), ["decoded"])


def test_sentencepiece_encodes_few_bytes_at_once():
    words = " ".join(f"w{k}" for k in range(4000))
    texts = pa.array([words] * 200 + ["", "a b", words * 40, "c"] + [""] * 600)

    class Shared:
        value = spiece.Encoder(vocab.load())
    parts = list(spiece._start(Shared)(texts))
    assert [lo for lo, *_ in parts] == [0] + [hi for _, hi, _ in parts[:-1]] and parts[-1][1] == len(texts)
    sizes = [(hi - lo, sum(len(x) for x in texts[lo:hi].to_pylist())) for lo, hi, _ in parts]
    assert all(n == 1 or size <= 1 << 19 for n, size in sizes) and sum(size > 1 << 19 for _, size in sizes) == 1
    assert [x for *_, (_, decoded) in parts for x in decoded.to_pylist()] == texts.to_pylist()
    assert list(spiece._start(Shared)(texts[:0])) == []


def test_sentencepiece_sends_a_kept_text_once(spark):
    rows = [(1, "a b", None), (2, None, "x"), (None, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = spiece.encode(docs, ["lang", "text", "doc_id"])
    assert got.columns == ["lang", "text", "doc_id", "piece_ids", "decoded"]
    assert sorted(((r.doc_id, r.text, r.lang) for r in got.collect()), key=str) == sorted(rows, key=str)
    assert [r.decoded for r in spiece.encode(docs, []).orderBy("decoded").collect()] == ["", "", "a b"]
    plan = got._jdf.queryExecution().analyzed().toString()
    sent = next(line for line in plan.split("\n") if "Project" in line)
    assert sent.count("text#") == 1, plan
    numbers = spiece.encode(docs.selectExpr("doc_id", "doc_id as text"), ["text"])  # a text of another type keeps it
    assert sorted(((r.text, r.decoded) for r in numbers.collect()), key=str) == [(1, "1"), (2, "2"), (None, "")]
