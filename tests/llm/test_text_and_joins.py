import hashlib
import random
import re
import subprocess
import sys
import time
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.compare import compare, connect
from pulsemark.llm import catalog, lines, ngram_join, text
from pulsemark.llm.components import connected
from pulsemark.llm.text import Memory, Words, plain, runs, sum_by_row

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@given(st.lists(st.one_of(st.none(), st.text("aAbé \t\n\x0b\x85日", max_size=30)), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_of_rows(texts):
    seen = {}
    rows = []
    for lo, hi, data, at in runs(pa.array(texts, pa.string()), limit=16):
        words = Words(data, at)
        for row in range(hi - lo):
            found = []
            for k in range(words.bounds[row], words.bounds[row + 1]):
                word = words.text(k).translate(LOWER)
                found.append(word)
                assert seen.setdefault(word, words.hashes[k]) == words.hashes[k]
            rows.append(found)
    assert rows == [words_of(t) for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_memory_and_sums():
    data, at = plain(pa.array(["a b a", None, "c"]))
    words = Words(data, at)
    memory = Memory(1, limit=2)
    for _ in range(3):  # forgetting does not change what is found
        rows = memory.look_up(words, lambda picked: np.array([ord(words.text(k)) for k in picked]).reshape(-1, 1))
        assert rows[:, 0].tolist() == [97, 98, 97, 99]
    assert sum_by_row(rows, words.bounds)[:, 0].tolist() == [97 * 2 + 98, 0, 99]


def brute(rows, n=5, percent=80):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    index = defaultdict(list)
    for k, s in enumerate(sets):
        hits = Counter(j for g in s for j in index[g])
        for j, c in hits.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                parent[root(k)] = root(j)
        for g in s:
            index[g].append(k)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[root(k)].append(rows[k][0])
    low = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return sorted(((rows[k][0], len(sets[k]), low[root(k)]) for k in range(len(rows))), key=repr)


def test_components_against_brute_force(spark):
    random.seed(5)
    vocabulary = ["w%d" % k for k in range(300)]
    passage = " ".join(random.choices(vocabulary, k=40))
    rows = []
    for group in range(12):
        base = random.choices(vocabulary, k=random.choice([4, 7, 60, 150]))
        for _ in range(random.choice([1, 2, 12])):
            copy = [random.choice(vocabulary) if random.random() < 0.03 else w for w in base]
            rows.append((len(rows), (passage + " " if group % 3 == 0 else "") + " ".join(copy)))
    rows += [(900, None), (901, ""), (902, " \n\t "), (903, "one two"), (904, "One  TWO"), (904, "one two"),
             (None, "one two"), (None, "alone here"), (905, rows[0][1]), (906, "x " * 3000), (907, "x " * 2999)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'z' as node", "1 as component_id")
    got = sorted(map(tuple, ngram_join.near_components(df).collect()), key=repr)
    assert got == brute(rows)


def test_components_of_an_empty_table(spark):
    assert ngram_join.near_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_star_components(spark):
    random.seed(2)
    chain = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (7, 7), (101, 100)]
    random.shuffle(chain)
    got = {r.node: r.label for r in connected(spark.createDataFrame(chain, "a long, b long"), len(chain)).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


@pytest.mark.parametrize("name", ["op7_chat_format", "op9_ngram_jaccard_join", "op10_line_dedup"])
def test_query_agrees_with_sql(spark, name):
    ok, _, note = compare(spark, connect(SMALL), SMALL, name, catalog.QUERIES[name], catalog.ORACLE[name])
    assert ok, note


def plain_words(seed, n):
    """Words of one document's own."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def both(spark, rows):
    """Texts after line deduplication by id, from Spark and, equal to them, from the query's SQL."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in lines.drop_recurring(docs).collect()}
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    for k, n, dropped, digest in con.sql(
            f"SELECT doc_id, n_lines, n_dropped, text_sha256 FROM ({catalog.ORACLE['op10_line_dedup']})").fetchall():
        text = got[k].text
        assert (got[k].n_lines, got[k].n_dropped) == (n, dropped)
        assert (hashlib.sha256(text.encode()).hexdigest() if text is not None else None) == digest
    return {k: r.text for k, r in got.items()}


BANNER = "Copyright by the makers of this site"


def test_lines_edge_rows(spark):
    own = {k: plain_words(k, 20) + "\n{}\n" + plain_words(100 + k, 20) for k in range(6)}
    rows = [(k, own[k].format(BANNER + f"\nRead {k} of {k * 7} comments below")) for k in range(5)]
    rows += [(20, None), (21, ""), (22, "\n\n"), (None, own[5].format(BANNER)), (23, BANNER), (23, BANNER), (24, BANNER + "\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "9 as n_lines", "'k' as hash", "1 as k", "2 as drop", "3 as x", "4 as _key", "5 as _drop", "'r' as row")
    out = lines.drop_recurring(df).collect()
    assert out[0].asDict().keys() == {*df.columns, "n_dropped"} and len(out) == len(rows)
    got = defaultdict(list)
    for r in out:
        got[r.doc_id].append((r.text, r.n_lines, r.n_dropped, r.hash + r.row, r.k + r.drop + r.x + r._key + r._drop))
    rest = ("kr", 15)
    for k in range(5):
        assert got[k] == [(own[k].format("").replace("\n\n", "\n"), 4, 2, *rest)]
    assert got[20] == [(None, 0, 0, *rest)] and got[21] == [("", 1, 0, *rest)] and got[22] == [("\n\n", 3, 0, *rest)]
    assert got[None] == [(own[5].format("").replace("\n\n", "\n"), 3, 1, *rest)]
    assert got[23] == [("", 1, 1, *rest)] * 2 and got[24] == [("", 2, 1, *rest)]
    assert lines.drop_recurring(df.limit(0)).count() == 0


def test_lines_of_footers_and_banners(spark):
    footer = "Terms of use\nPrivacy and cookies of this site\nWrite to us at any time"
    rows = [(k, plain_words(k, 40) + "\n" + plain_words(-k - 1, 20) + "\n" + footer) for k in range(40)]
    rows += [(100 + k, plain_words(100 + k, 20) + "\n\n" + BANNER + "\n\n" + plain_words(900 + k, 20)) for k in range(40)]
    got = both(spark, rows)
    assert all(got[k] == plain_words(k, 40) + "\n" + plain_words(-k - 1, 20) for k in range(40))
    assert all(got[100 + k] == plain_words(100 + k, 20) + "\n\n\n" + plain_words(900 + k, 20) for k in range(40))


def test_lines_of_copies(spark):
    page = "\n".join(plain_words(7000 + k, 15) for k in range(8))
    near = [page.replace(plain_words(7000 + k % 8, 15), plain_words(7000 + k % 8, 14) + f" edit {plain_words(k, 1)}") for k in range(30)]
    rows = [(k, page) for k in range(30)] + [(100 + k, text) for k, text in enumerate(near)]
    assert both(spark, rows) == dict(rows)  # all lines recur, but in copies alone
    rows = [(k, plain_words(k, 30) + "\n" + BANNER) for k in range(10)] + [(100 + k, page + "\n" + BANNER) for k in range(30)]
    got = both(spark, rows)
    assert all(BANNER not in text for text in got.values()) and all(got[100 + k] == page for k in range(30))
    assert all(got[k] == plain_words(k, 30) for k in range(10))
    rows = [(k, plain_words(k, 30) + "\n" + BANNER) for k in range(2)]
    assert both(spark, rows) == dict(rows)  # two documents are too few


def test_lines_generalise_fields(spark):
    names = ["ann", "bob", "cy", "dee"]
    rows = [(k, f"note {k}x\n{plain_words(k, 20)}\nthe session of user {n} was closed by the server\nend {n}")
            for k, n in enumerate(names)]
    got = both(spark, rows)
    assert got == {k: f"{plain_words(k, 20)}\nend {n}" for k, n in enumerate(names)}


def test_lines_several_templates_in_a_leaf(spark):
    def name(k):
        return "".join("abcdefghij"[int(d)] for d in str(k))
    kinds = [(40, "the session of user {} was closed by the main server"), (12, "the session of user {} could not reach its own host"),
             (12, "the session of user {} asked twice for another shared file"), (5, "the session of user {} had then been idle all day")]
    texts = [line.format(name(k)) for n, line in kinds for k in range(100 * n, 101 * n)]
    texts += ["the session of user zz was like no other session here", "the session of user yy went on for hours and hours"]
    rows = [(k, f"{plain_words(k, 30)}\n{line}\n{plain_words(-k - 1, 9)}") for k, line in enumerate(texts)]
    got = {k: text.split("\n")[1:-1] for k, text in both(spark, rows).items()}
    assert [k for k in sorted(got) if got[k]] == [len(texts) - 2, len(texts) - 1]


def test_lines_position_of_many_values_is_a_field(spark):
    towns = [plain_words(k, 1) for k in range(400, 420)]
    rows = [(k, f"{plain_words(k, 40)}\nsend our news and offers to {towns[k % 20]} and also to {towns[k * 7 // 20 % 20]} by mail each week")
            for k in range(100)]
    assert both(spark, rows) == {k: plain_words(k, 40) for k in range(100)}


def test_lines_of_one_text_take_time_in_proportion(spark):
    rows = [(k, "\n".join(f"{plain_words(50_000 * k + j, 3)}." for j in range(10_000)) + "\n" + BANNER) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    lines.drop_recurring(docs.limit(0)).count()  # compiled before
    began = time.perf_counter()
    out = lines.drop_recurring(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("h")).collect()
    took = time.perf_counter() - began
    assert {tuple(r) for r in out} == {(k, 10_001, 1, hashlib.sha256(t[:-len(BANNER) - 1].encode()).hexdigest()) for k, t in rows}
    assert took < 30, took


def test_batches_of_long_texts_end_at_a_size(spark):
    names = ["spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize"]
    for name in names:
        spark.conf.unset(name)
    docs = spark.range(0, 1500, 1, 1).selectExpr("id as doc_id", "repeat(concat('w', id, ' '), 1000) as text")
    assert ngram_join.near_components(docs).count() == 1500

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])
    found = docs.select("text").mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in found) == 1500 and max(r.size for r in found) < 1_200_000
    assert int(spark.conf.get(names[1])) <= 512
    for name in names:  # what is smaller stays
        spark.conf.set(name, "64")
    text.light_batches(spark)
    assert [spark.conf.get(name) for name in names] == ["64", "64"]
    spark.conf.set(names[0], "16k")
    text.light_batches(spark)
    assert spark.conf.get(names[0]) == "16k"
    for name in names:
        spark.conf.unset(name)


def test_a_task_that_measures_sets_holds_little_and_gives_it_back():
    code = """
import re, sys, tracemalloc
import numpy as np, pyarrow as pa
from pulsemark.llm import ngram_join
def held():
    return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024
def batches(count):
    for k in range(count):
        texts = [" ".join(f"w{k * 77 + r * 13 + i * i % 997}" for i in range(300)) for r in range(500)]
        yield pa.RecordBatch.from_arrays([pa.array(range(500)), pa.array(texts)], ["id", "text"])
def rows(count):
    return sum(b.num_rows for b in ngram_join._measure(5)(batches(count)))
rows(1)
before = held()
got = rows(24)
after = held()
tracemalloc.start()
rows(8)
print(got, after - before, tracemalloc.get_traced_memory()[1] / 1e6)
"""
    said = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], capture_output=True, text=True, check=True)
    rows, more, peak = said.stdout.split()
    assert int(rows) == 24 * 500 + ngram_join.SKETCH // ngram_join.SLOT
    assert float(more) < 25 and float(peak) < 38, said.stdout


def test_counts_of_a_task_are_those_of_its_shingles():
    texts = ["a b c d e f g", None, "", "a b c d e f g", "x y", "q " * 40]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    out = pa.Table.from_batches(ngram_join._measure(5)([batch, batch.slice(2, 2)]))
    slots = out.filter(pc.is_valid(out["slot"]))
    assert slots["slot"].to_pylist() == list(range(ngram_join.SKETCH // ngram_join.SLOT))
    counts = np.concatenate([np.frombuffer(x, np.int32) for x in slots["counts"].to_pylist()])
    want = np.zeros(ngram_join.SKETCH, np.int64)
    for found in ngram_join.shingle_sets(pa.array(texts + texts[2:4]), 5):
        want += np.bincount((found & np.uint64(ngram_join.SKETCH - 1)).astype(np.int64), minlength=ngram_join.SKETCH)
    assert (counts == want).all() and want.sum() == 3 * 3 + 1 + 1
    assert out.filter(pc.is_null(out["slot"]))["n"].to_pylist() == [3, 0, 0, 3, 1, 1, 0, 3]
    assert not pa.Table.from_batches(ngram_join._measure(5)([batch.slice(1, 2)]))["slot"].drop_null().to_pylist()
