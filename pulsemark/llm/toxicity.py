"""Toxicity from the nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

Words are lower-cased runs of ASCII letters and digits and of all characters beyond ASCII. The terms are words whose
presence goes with the label (likelihood ratio) among the examples, a bounded sample of labelled rows; how many
documents hold a term is counted over all documents. A text is a vector of (1 + ln tf) * ln(1 + N / df) over its terms.

The examples lie in blocks of similar ones. Every term has its postings by block and its largest weight in each; the
sum of these over a text's terms bounds all similarities in a block. Blocks are opened by falling bound until none
can hold a nearer example, so the ``k`` nearest are exact. Their labels vote with weights 1 / (MARGIN + distance). The
share of votes is turned into a probability by isotonic regression on the examples, each left out of its own vote.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.llm.columns import add_columns, quoted
from pulsemark.llm.text import prefix_sums, runs, span_hashes
from pulsemark.session import cut

#: Examples and terms at most; the index holds no more than their product.
FIT_ROWS, TERMS = 20_000, 1_000
#: A term is in so many examples at least, its likelihood ratio reaches this, and label 1 is so many times as frequent,
#: or as rare, where it stands as elsewhere. Words that most texts hold tell little and would make all texts neighbours.
MIN_DOCS, MIN_RATIO, MIN_LIFT = 3, 15.0, 2.0
#: Neighbours that vote, examples in a block, blocks opened at once.
K, BLOCK, OPEN = 15, 64, 4
#: Added to every distance before a vote is weighted by its inverse.
MARGIN = 0.1
#: Room for rounding when a bound is compared with a similarity.
_SLACK = 1e-9

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def words_of(text):
    """The words of a text column as an array, the same ones as ``Lexicon`` finds."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lowered, F.lit(r"([0-9a-z\x{80}-\x{10FFFF}]+)"))


class Lexicon:
    """Finds given terms in runs of texts."""

    def __init__(self, terms: Sequence[str]):
        data = [t.encode() for t in terms]
        at = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
        hashes = span_hashes(prefix_sums(np.frombuffer(b"".join(data), np.uint8), False), at[:-1], at[1:])
        order = np.argsort(hashes)
        self.hashes, self.numbers, self.size = hashes[order], order, len(data)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    def counts(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, times) of the terms in the rows with these bytes and offsets, by row and term."""
        inside = np.concatenate([[False], _WORD[data], [False]])
        first = np.flatnonzero(inside[1:-1] & ~inside[:-2])
        last = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        # A word that goes on from one row into the next is two.
        cuts = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
        cuts = np.unique(cuts[inside[cuts] & inside[cuts + 1]])
        first, last = np.sort(np.concatenate([first, cuts])), np.sort(np.concatenate([last, cuts]))
        if not self.size or not len(first):
            none = np.zeros(0, np.int64)
            return none, none, none
        hashes = span_hashes(prefix_sums(data, True), first, last)
        some = np.flatnonzero(self.maybe[(hashes >> np.uint64(48)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[some]), self.size - 1)
        good = self.hashes[place] == hashes[some]
        term = self.numbers[place[good]]
        row = np.searchsorted(at, first[some[good]], "right") - 1
        pairs, times = np.unique(row * self.size + term, return_counts=True)
        return pairs // self.size, pairs % self.size, times


def weights(lexicon: Lexicon, idf: np.ndarray, data: np.ndarray, at: np.ndarray):
    """Rows' terms and normalised weights: (bounds of rows, terms, weights)."""
    row, term, times = lexicon.counts(data, at)
    weight = (1 + np.log(times)) * idf[term] if len(term) else np.zeros(0)
    bounds = np.searchsorted(row, np.arange(len(at)))
    length = np.sqrt(np.bincount(row, weights=weight ** 2, minlength=len(at) - 1)) if len(row) else np.zeros(len(at) - 1)
    return bounds, term, weight / length[row] if len(row) else weight


class BlockMaxIndex:
    """Exact nearest examples of sparse unit vectors."""

    def __init__(self, bounds: np.ndarray, terms: np.ndarray, values: np.ndarray, n_terms: int, block: int = BLOCK):
        count = len(bounds) - 1
        owner = np.repeat(np.arange(count), np.diff(bounds))
        # Examples with the same heaviest terms lie together, so that bounds are tight.
        heavy = np.lexsort((terms, -values, owner))
        first = np.full(count, n_terms)
        second = np.full(count, n_terms)
        starts, sizes = bounds[:-1], np.diff(bounds)
        first[sizes > 0] = terms[heavy[starts[sizes > 0]]]
        second[sizes > 1] = terms[heavy[starts[sizes > 1] + 1]]
        top = np.zeros(count)
        top[sizes > 0] = values[heavy[starts[sizes > 0]]]
        self.order = np.lexsort((-top, second, first))  # place to example
        place = np.empty(count, np.int64)
        place[self.order] = np.arange(count)
        self.block, self.n_blocks = block, max(1, -(-count // block))
        by = np.lexsort((place[owner], terms))
        self.places, self.values = place[owner][by], values[by]
        cell = terms[by] * self.n_blocks + self.places // block
        self.at = np.searchsorted(cell, np.arange(n_terms * self.n_blocks + 1))
        self.cells, begin = np.unique(cell, return_index=True)  # the blocks of each term
        self.most = np.maximum.reduceat(self.values, begin) if len(cell) else np.zeros(0)
        self.of_term = np.searchsorted(self.cells, np.arange(n_terms + 1) * self.n_blocks)
        self.opened = 0

    def nearest(self, terms: np.ndarray, values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Examples and similarities of the ``k`` nearest that share a term; ties go to the first examples."""
        lists, sizes = _ranges(self.of_term[terms], self.of_term[terms + 1])
        bound = np.bincount(self.cells[lists] % self.n_blocks, weights=self.most[lists] * np.repeat(values, sizes),
                            minlength=self.n_blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[: np.count_nonzero(bound)]
        best, near, step, at = np.zeros(0, np.int64), np.zeros(0), OPEN, 0
        while at < len(order) and (len(near) < k or bound[order[at]] >= near[-1] - _SLACK):
            some = order[at: at + step]
            cell = (terms[:, None] * self.n_blocks + some[None, :]).ravel()
            lists, sizes = _ranges(self.at[cell], self.at[cell + 1])
            place = self.places[lists]
            found, back = np.unique(place, return_inverse=True)
            total = np.bincount(back, weights=self.values[lists] * np.repeat(np.repeat(values, len(some)), sizes))
            best = np.concatenate([best, self.order[found]])
            near = np.concatenate([near, np.round(total, 12)])
            keep = np.lexsort((best, -near))[:k]
            best, near = best[keep], near[keep]
            self.opened += len(some)
            at, step = at + step, 2 * step
        return best, near


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [start, end), one after another, and the ranges' sizes."""
    sizes = ends - starts
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes), sizes


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising function nearest to the points, by pooling neighbours that fall."""
    values, back = np.unique(x, return_inverse=True)
    sums, counts = np.bincount(back, weights=y), np.bincount(back).astype(float)
    pools: list[list[float]] = []  # sum, count, sum of x
    for v, s, n in zip(values, sums, counts):
        pools.append([s, n, v * n])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[2] / p[1] for p in pools]), np.array([p[0] / p[1] for p in pools])


@dataclass
class Model:
    terms: list[str]
    idf: np.ndarray
    ids: list[str | None]
    labels: np.ndarray
    index: BlockMaxIndex
    lone: float  # rate of examples without a term
    knots: tuple[np.ndarray, np.ndarray]
    k: int

    def vote(self, best: np.ndarray, near: np.ndarray) -> float:
        weight = 1 / (MARGIN + 1 - np.minimum(near, 1))
        return float((weight * self.labels[best]).sum() / weight.sum())

    def score(self, best: np.ndarray, near: np.ndarray) -> float:
        """The probability of label 1 from the nearest examples; the rate of examples without a term if there are none."""
        return float(np.interp(self.vote(best, near), *self.knots)) if len(best) else self.lone


def _select(examples: DataFrame, n_terms: int, min_docs: int, min_ratio: float, min_lift: float) -> list[str]:
    """The words that tell most about the label among the examples: rows (text, label)."""
    totals = examples.agg(F.count("*").alias("n"), F.sum("label").alias("n1")).first()
    n, n1 = totals.n, totals.n1 or 0
    if not 0 < n1 < n:
        return []
    held = examples.select("label", F.explode(F.array_distinct(words_of("text"))).alias("word")).groupBy("word").agg(
        F.count("*").alias("m"), F.sum("label").alias("m1")).where(F.col("m") >= min_docs)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    m, m1, rate = F.col("m"), F.col("m1"), n1 / n
    ratio = 2 * (part(m1, m * rate) + part(m - m1, m * (1 - rate)) + part(n1 - m1, (n - m) * rate)
                 + part(n - n1 - m + m1, (n - m) * (1 - rate)))
    # The rate of label 1 with the word against that without it, each with one more example of the base rate.
    lift = ((m1 + rate) / (m + 1)) / ((n1 - m1 + rate) / (n - m + 1))
    best = held.select("word", ratio.alias("ratio"), lift.alias("lift")).where(
        (F.col("ratio") >= min_ratio) & ((F.col("lift") >= min_lift) | (F.col("lift") <= 1 / min_lift)))
    return [r.word for r in best.orderBy(F.desc("ratio"), "word").limit(n_terms).collect()]


def _held(docs: DataFrame, terms: list[str]) -> tuple[int, np.ndarray]:
    """Documents, and how many of them hold each term, over all documents."""
    def count(batches):
        lexicon, held, n = Lexicon(terms), np.zeros(len(terms), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, data, at in runs(batch.column(0)):
                held += np.bincount(lexicon.counts(data, at)[1], minlength=len(terms))
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([held.tolist()])], ["n", "held"])

    parts = docs.select(F.col("text").cast("string").alias("t")).mapInArrow(count, "n bigint, held array<bigint>")
    totals = parts.select("n", F.posexplode_outer("held").alias("term", "m")).groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("m").alias("m")).collect()
    held = np.zeros(len(terms))
    for r in totals:
        held[r.term] = r.m
    return max((r.n for r in totals), default=0), held


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", label_column: str = "toxic",
        fit_rows: int = FIT_ROWS, n_terms: int = TERMS, k: int = K) -> Model:
    """Learn from the rows of ``labels`` (id, label 0 or 1); terms are counted in all ``docs`` (id, text).

    A label or id that is null teaches nothing, of several labels of one id the largest counts. ``fit_rows`` labelled ids at
    most are examples, drawn by a hash of the id, and so many rows at most if ids repeat in ``docs``. Null texts are
    examples without a term. Without examples of both labels there are no terms, and every score is the rate of label 1
    (0 without examples).
    """
    named = labels.select(F.col(quoted(id_column)).alias("id"), F.col(quoted(label_column)).cast("int").alias("label"))
    named = named.where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    mixed = F.xxhash64(F.lit("example"), "id")
    drawn = cut(named.orderBy(mixed, "id").limit(fit_rows))
    rows = docs.select(F.col(quoted(id_column)).alias("id"), F.col("text").cast("string").alias("text"))
    examples = cut(rows.join(F.broadcast(drawn), "id"))
    terms = _select(examples, n_terms, MIN_DOCS, MIN_RATIO, MIN_LIFT)
    n, held = _held(docs, terms) if terms else (0, np.zeros(0))
    idf = np.log1p(n / np.maximum(held, 1))
    kept = examples.orderBy(mixed, "id", F.xxhash64("text")).limit(fit_rows) if examples.count() > fit_rows else examples
    found = add_columns(kept, ["id", "label"], "terms array<int>, weights array<double>", lambda: _vectors(terms, idf)).toPandas()
    found = found.assign(id=found.id.astype(str)).sort_values(["id", "label"], kind="stable")
    sizes = found.terms.map(len).to_numpy(np.int64) if len(found) else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    flat = [np.concatenate([*found[c], np.zeros(0)]) for c in ("terms", "weights")]
    term, value = flat[0].astype(np.int64), flat[1].astype(float)
    label = found.label.to_numpy(float)
    index = BlockMaxIndex(bounds, term, value, len(terms))
    bare = label[sizes == 0]
    model = Model(terms, idf, found.id.tolist(), label, index, float(bare.mean()) if len(bare) else 0.0,
                  (np.array([0.0, 1.0]), np.array([0.0, 1.0])), k)
    votes, truth = [], []
    for e in np.flatnonzero(sizes):
        at = slice(bounds[e], bounds[e + 1])
        best, near = index.nearest(term[at], value[at], k + 1)
        other = best != e
        if other.any():
            votes.append(model.vote(best[other][:k], near[other][:k]))
            truth.append(label[e])
    if votes:
        model.knots = isotonic(np.array(votes), np.array(truth))
    return model


def _vectors(terms: list[str], idf: np.ndarray):
    lexicon = Lexicon(terms)

    def make(texts: pa.Array) -> Iterator[tuple[int, int, list[pa.Array]]]:
        for lo, hi, data, at in runs(texts):
            bounds, term, weight = weights(lexicon, idf, data, at)
            offsets = pa.array(bounds.astype(np.int32))
            yield lo, hi, [pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                           pa.ListArray.from_arrays(offsets, pa.array(weight.astype(float)))]
    return make


_NEAR = pa.struct([("id", pa.string()), ("similarity", pa.float64()), ("label", pa.int32())])


def _scores(shared):
    model: Model = shared.value
    lexicon, known = Lexicon(model.terms), {}

    def make(texts: pa.Array) -> Iterator[tuple[int, int, list[pa.Array]]]:
        for lo, hi, data, at in runs(texts):
            bounds, term, weight = weights(lexicon, model.idf, data, at)
            out = []
            for a, b in zip(bounds, bounds[1:]):
                key = (term[a:b].tobytes(), np.round(weight[a:b], 12).tobytes())
                if key not in known:
                    if len(known) > 20_000:
                        known.clear()
                    best, near = model.index.nearest(term[a:b], weight[a:b], model.k) if b > a else (term[:0], weight[:0])
                    known[key] = (model.score(best, near), best, near)
                out.append(known[key])
            sizes = np.array([len(best) for _, best, _ in out], np.int64)
            best = np.concatenate([*(x for _, x, _ in out), np.zeros(0, np.int64)]).astype(np.int64)
            near = np.concatenate([*(x for _, _, x in out), np.zeros(0)])
            items = pa.StructArray.from_arrays(
                [pa.array([model.ids[e] for e in best], pa.string()), pa.array(near),
                 pa.array(model.labels[best].astype(np.int32))], fields=list(_NEAR))
            held = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)),
                                            pa.array([model.terms[t] for t in term], pa.string()))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield lo, hi, [pa.array([s for s, _, _ in out], pa.float64()), pa.ListArray.from_arrays(offsets, items), held]
    return make


def grade(docs: DataFrame, model: Model, keep: Sequence[str], text_column: str = "text") -> DataFrame:
    """The columns ``keep`` of every row, ``score`` (0 to 1), ``evidence`` and ``terms``, from the whole text alone.

    ``evidence`` has the nearest examples that share a term (id, similarity, label), nearest first, ties by id;
    ``terms`` the text's terms. A text without a term, empty or null ones too, has the rate of the examples without a
    term and no evidence. Repeated rows are scored each, an empty table gives an empty result. A kept column may not
    be called like a new one, any other column may be there.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return add_columns(docs, keep, "score double, evidence array<struct<id:string,similarity:double,label:int>>, "
                       "terms array<string>", lambda: _scores(shared), text_column)
