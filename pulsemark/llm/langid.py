"""Language identification with unigram pieces, marginalised over all segmentations.

The vocabulary is fixed and public. Each language has a probability per piece, fitted by expectation
maximisation; a forward pass sums the probabilities of all ways to cut a word into pieces, and a text is
the product of its words. Byte pieces make every word possible.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.llm import vocab
from pulsemark.llm.text import Memory, Words, gives_back, light_batches, prefix_sums, released, runs, span_hashes, sum_by_row

#: The fit takes about this many documents of each language, drawn by hash; everything else sees all rows.
FIT_DOCS = 600
#: Rounds of expectation maximisation, and what each piece counts beforehand.
ROUNDS, PRIOR = 2, 0.05
_START = np.uint64(0x5851F42D4C957F2D)  # sets pieces at the start of a word apart


class PieceTable:
    """Numbers of pieces by hash. The 256 byte pieces come first."""

    def __init__(self, pieces: vocab.Pieces):
        texts = {p: k for k, p in enumerate(x for x in pieces.ids if x.lower() == x)}
        data = [p.removeprefix(vocab.SPACE).encode() for p in texts]
        joined = np.frombuffer(b"".join(data), np.uint8)
        at = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
        hashes = span_hashes(prefix_sums(joined, False), at[:-1], at[1:])
        hashes[[p.startswith(vocab.SPACE) for p in texts]] ^= _START
        real = np.array([len(x) > 0 for x in data])
        numbers = np.arange(len(data))[real] + 256
        order = np.argsort(hashes[real])
        self.hashes, self.numbers = hashes[real][order], numbers[order]
        self.size = len(data) + 256
        self.longest = int(max(map(len, data)))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, -1 for none."""
        out = np.full(hashes.shape, -1, np.int32)
        hits = np.flatnonzero(self.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
        wanted = hashes[hits]
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        good = self.hashes[at] == wanted
        out[hits[good]] = self.numbers[at[good]]
        return out


def _steps(table: PieceTable, data: np.ndarray, sums: np.ndarray, starts: np.ndarray, length: int):
    """For words of one length: per end j and start i the words a piece fits, and its number."""
    for j in range(1, length + 1):
        yield j, j - 1, None, data[starts + (j - 1)].astype(np.int32)
        for i in range(max(0, j - table.longest), j):
            hashes = span_hashes(sums, starts + i, starts + j)
            if i == 0:
                hashes ^= _START
            number = table.find(hashes)
            at = np.flatnonzero(number >= 0)
            if len(at):
                yield j, i, at, number[at]


def log_words(table: PieceTable, probs: np.ndarray, words: Words, picked: np.ndarray) -> np.ndarray:
    """Natural logarithms of the picked words' probabilities, one column per language.

    Runs over all words of a length at once; each position is scaled by its largest value, so that long
    words do not underflow.
    """
    out = np.zeros((len(picked), probs.shape[1]))
    lengths = words.ends[picked] - words.starts[picked]
    for length in np.unique(lengths):
        of = np.flatnonzero(lengths == length)
        step = max(1, (1 << 18) // int(length + 1))  # keeps the arrays of a step near 8 MB
        for lo in range(0, len(of), step):
            some = of[lo: lo + step]
            out[some] = _forward(table, probs, words, words.starts[picked[some]], int(length))
    return out


def _forward(table, probs, words, starts, length):
    width = table.longest
    alpha = np.zeros((min(length, width) + 1, len(starts), probs.shape[1]))
    ring = len(alpha)
    alpha[0] = 1.0
    scale = np.zeros((len(starts), probs.shape[1]))
    current = 0
    for j, i, at, number in _steps(table, words.data, words.sums, starts, length):
        if j != current:
            if current and current % 8 == 0:
                scale += _rescale(alpha, current, ring)
            current = j
            alpha[j % ring] = 0
        if at is None:
            alpha[j % ring] += alpha[i % ring] * probs[number]
        else:
            alpha[j % ring, at] += alpha[i % ring, at] * probs[number]
    return np.log(alpha[length % ring]) + scale


def _rescale(alpha, j, ring):
    """Divide all kept positions by the size of position j; its logarithm."""
    size = np.maximum(alpha[j % ring], 1e-300)
    alpha /= size
    return np.log(size)


def _expected(table, probs, words, starts, length, weights, counts):
    """Add the expected uses of each piece in these words, weighted, to ``counts`` (one language)."""
    steps = list(_steps(table, words.data, words.sums, starts, length))
    alpha, beta = (np.zeros((length + 1, len(starts))) for _ in range(2))
    alpha[0], beta[length] = 1.0, 1.0
    scale = 1.0 / max(float(np.median(probs)), 1e-9) ** 0.5  # per byte; keeps long words in range
    for j, i, at, number in steps:
        at = slice(None) if at is None else at
        alpha[j, at] += alpha[i, at] * probs[number] * scale ** (j - i)
    for j, i, at, number in reversed(steps):
        at = slice(None) if at is None else at
        beta[i, at] += beta[j, at] * probs[number] * scale ** (j - i)
    total = alpha[length]
    good = (total > 0) & np.isfinite(total)
    share = np.where(good, weights / np.where(good, total, 1), 0)
    for j, i, at, number in steps:
        at = slice(None) if at is None else at
        uses = alpha[i, at] * probs[number] * scale ** (j - i) * beta[j, at] * share[at]
        counts += np.bincount(number, weights=np.nan_to_num(uses), minlength=len(counts))


def fit_pieces(table: PieceTable, words: list[str], weights: np.ndarray) -> np.ndarray:
    """Piece probabilities of one language from its words and their counts."""
    data = "\n".join(words).encode()
    parsed = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), lower=False)
    lengths = parsed.ends - parsed.starts
    probs = np.full(table.size, 1.0 / table.size)
    for _ in range(ROUNDS):
        counts = np.full(table.size, PRIOR)
        for length in np.unique(lengths[lengths <= 64]):
            of = np.flatnonzero(lengths == length)
            for lo in range(0, len(of), 20_000):
                some = of[lo: lo + 20_000]
                _expected(table, probs, parsed, parsed.starts[some], int(length), weights[some], counts)
        probs = counts / counts.sum()
    return probs


@dataclass
class Model:
    languages: list[str]
    probs: np.ndarray  # pieces by languages
    table: PieceTable


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, path: str = vocab.PIECES) -> Model:
    """Fit on rows (doc_id, text, lang); rows without a language or with an empty text teach nothing.

    A language with more than ``fit_docs`` rows is represented by about so many, drawn by a hash of the id.
    """
    table = PieceTable(vocab.load(path))
    known = docs.where("lang is not null and text is not null")
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((table.size, 0)), table)
    rate = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, fit_docs / n))])
    drawn = known.where(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 20)) < rate[F.col("lang")] * (1 << 20))
    counted = drawn.select("lang", F.explode(F.split("text", r"[\x20\x09-\x0D]+")).alias("word")).where(
        "word <> ''").groupBy("lang", "word").agg(F.count("*").alias("n")).toPandas()
    languages = sorted(counted.lang.unique())
    columns = []
    for lang in languages:
        part = counted[counted.lang == lang]
        words = pc.utf8_lower(pa.array(part.word.tolist())).to_pylist()
        columns.append(fit_pieces(table, words, part.n.to_numpy(float)))
    return Model(languages, np.stack(columns, axis=1), table)


def _predict(shared, places, kept):
    def run(batches):
        model = shared.value
        memory = Memory(len(model.languages))
        names = np.array([*model.languages, "und"], object)
        for batch in released(batches):
            best, score = [], []
            lowered = pc.utf8_lower(pc.fill_null(batch.column(0), "").cast(pa.large_string()))
            for lo, hi, data, at in runs(lowered):
                words = Words(data, at, lower=False)
                if model.languages and len(words.starts):
                    logs = memory.look_up(words, lambda picked: log_words(model.table, model.probs, words, picked))
                    sums = sum_by_row(logs, words.bounds)
                    top = sums.argmax(axis=1)
                    share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                else:
                    top, share = np.full(hi - lo, len(names) - 1), np.zeros(hi - lo)
                best.append(top)
                score.append(share)
            best, score = np.concatenate(best or [[]]).astype(int), np.concatenate(score or [[]])
            letters = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            best, score = np.where(letters, best, len(names) - 1), np.where(letters, score, 0.0)
            score = np.where(best == len(names) - 1, 0.0, score)
            rest = [batch.column(k) for k in places]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(names[best].tolist(), pa.string()), pa.array(score, pa.float64())],
                [*kept, "lang_pred", "score"])
    return gives_back(run)


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row with ``lang_pred`` and ``score``, from the column ``text`` alone.

    ``score`` is the posterior probability of the predicted language under equal priors. A text that is null
    or has no letter is `und` with score 0, and so is every text if the model has no language. Ties go to
    the first language in alphabetical order. No column in ``keep`` may be called lang_pred or score.
    """
    shared = light_batches(docs.sparkSession).sparkContext.broadcast(model)
    others = [c for c in keep if c != "text"]  # a text that is kept travels once
    places = [0 if c == "text" else 2 + others.index(c) for c in keep]
    asked = docs.select(
        F.col("text").alias("_text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"), *others)
    schema = docs.select(*keep).schema
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return asked.mapInArrow(_predict(shared, places, schema.names), f"{kept}, lang_pred string, score double")
