"""Scoring texts with a log-bilinear language model over word classes, trained with noise-contrastive estimation.

Words are counted over all training texts. The most frequent words and the end of text are classes of their
own; the rest fall into classes by their last two bytes. The log-bilinear model predicts the next class from
the two before it; within a class a word has its smoothed relative frequency, with one share for all unknown
words, so that the probabilities of all known words and `unknown` sum to one.

Texts are cut once into blocks that hold their words as numbers in the block's own dictionary. Counting,
training and scoring read the blocks; only the dictionaries are shuffled by word. Every task trains on its
blocks from one start and the results are averaged by tokens. A task holds one block at a time, its tokens and classes
in the narrowest numbers that they fit in.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsemark.llm.text import _LOWER, Words, give_back, gives_back, light_batches, mix, released, runs
from pulsemark.session import cut

#: Classes: words of their own, and classes of word endings.
FREQUENT, ENDINGS = 320, 192
CLASSES = FREQUENT + ENDINGS
#: Width of the model, noise samples per batch, tokens per batch, step size.
WIDTH, NOISE, BATCH, RATE = 40, 96, 4096, 0.15
#: Bytes of text in a block.
BLOCK_BYTES = 1 << 24
END = np.uint64(0x5E0F0E0D0C0B0A09)
#: Parameters per row when models are averaged.
SLICE = 4096
_BLOCKS = "block long, ids array<long>, held array<boolean>, lengths binary, tokens binary, words array<long>, " \
          "seen array<int>, endings array<short>"


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2**31 as four planes of bytes, the high ones mostly zero, which compress well."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes | pa.Buffer) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct values, where each comes first, and every value's place among them, as ``np.unique`` has them."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.ones(len(values), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    found, first = ordered[new], order[new]
    del ordered
    back = np.empty(len(values), np.int32)
    back[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return found, first, back


class _Block:
    def __init__(self):
        self.ids, self.held, self.hashes, self.lengths, self.endings, self.bytes = [], [], [], [], [], 0

    def add(self, ids, held, data, at):
        words = Words(data, at)
        tail = _LOWER[data[words.ends - 1]].astype(np.uint64)
        before = np.where(words.ends - words.starts > 1, _LOWER[data[words.ends - 2]], 0).astype(np.uint64)
        endings = (mix((before << np.uint64(8)) | tail) % np.uint64(ENDINGS)).astype(np.int16)
        self.hashes.append(np.insert(words.hashes, words.bounds[1:], END))
        self.endings.append(np.insert(endings, words.bounds[1:], 0))
        self.lengths.append(np.diff(words.bounds) + 1)
        self.ids.extend(ids)
        self.held.append(held)
        self.bytes += len(data)

    def row(self, number: int) -> pa.RecordBatch:
        hashes, held, lengths = (np.concatenate(x) for x in (self.hashes, self.held, self.lengths))
        self.hashes = []
        found, first, back = _distinct(hashes)
        del hashes
        order = np.argsort(-np.bincount(back), kind="stable")  # small numbers for frequent words
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        tokens = place[back]
        seen = np.bincount(tokens[~np.repeat(held, lengths)], minlength=len(order)).astype(np.int32)
        endings = np.concatenate(self.endings)[first[order]]
        values = [[number], [self.ids], [held], [_planes(lengths)], [_planes(tokens)],
                  [found[order].view(np.int64)], [seen], [endings]]
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary(),
                 pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int16())]
        names = ["block", "ids", "held", "lengths", "tokens", "words", "seen", "endings"]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)


def _into_blocks(batches):
    number, block = TaskContext.get().partitionId() << 32, _Block()
    for batch in released(batches):
        ids = batch.column(0).to_pylist()
        held = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for lo, hi, data, at in runs(batch.column(2)):
            block.add(ids[lo:hi], held[lo:hi], data, at)
            if block.bytes >= BLOCK_BYTES:
                yield block.row(number)
                number, block = number + 1, _Block()
    if block.ids:
        yield block.row(number)


@dataclass
class Counts:
    """What scoring needs of the training corpus besides each word's own count."""

    tokens: int          # N
    words: int           # V
    frequent: np.ndarray  # hashes of the words with classes of their own, sorted
    of: np.ndarray        # their classes
    class_tokens: np.ndarray
    class_words: np.ndarray

    def classes(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
        return np.where(self.frequent[at] == hashes, self.of[at], FREQUENT + endings).astype(np.int16)


def _counts(words: DataFrame) -> Counts:
    once = words.where("first")
    total = once.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    top = once.where((F.col("c") > 0) & (F.col("word") != int(END.view(np.int64)))).orderBy(
        F.desc("c"), "word").limit(FREQUENT - 1).collect()
    hashes = np.array([int(END.view(np.int64))] + [r.word for r in top], np.int64).view(np.uint64)
    by_ending = once.where("c > 0").groupBy("ending").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in by_ending:
        class_tokens[FREQUENT + r.ending], class_words[FREQUENT + r.ending] = r.n, r.v
    ends = once.where(F.col("word") == int(END.view(np.int64))).agg(F.sum("c")).first()[0] or 0
    own = [(ends, 0)] + [(r.c, r.ending) for r in top]
    for k, (n, ending) in enumerate(own):
        class_tokens[k], class_words[k] = n, 1
        if n:
            class_tokens[FREQUENT + ending] -= n
            class_words[FREQUENT + ending] -= 1
    order = np.argsort(hashes)
    return Counts(int(total.n or 0), int(total.v or 0), hashes[order], order, class_tokens, class_words)


class Bilinear:
    """The log-bilinear class model; its parameters lie in one flat array."""

    def __init__(self, flat: np.ndarray):
        self.flat, k, w = flat, CLASSES, WIDTH
        self.context, self.target = flat[: k * w].reshape(k, w), flat[k * w: 2 * k * w].reshape(k, w)
        self.bias, self.mixing = flat[2 * k * w: 2 * k * w + k], flat[2 * k * w + k:].reshape(2, w)

    @classmethod
    def start(cls, class_tokens: np.ndarray) -> Bilinear:
        """Small weights of a fixed seed; the biases are the classes' log frequencies."""
        flat = np.random.default_rng(7).normal(0, 0.1, 2 * CLASSES * WIDTH + CLASSES + 2 * WIDTH).astype(np.float32)
        model = cls(flat)
        model.bias[:] = np.log((class_tokens + 1) / (class_tokens + 1).sum())
        model.mixing[:] = 1
        return model

    def predicted(self, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
        return self.context[c1] * self.mixing[0] + self.context[c2] * self.mixing[1]

    def log_probs(self, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
        """Normalised log probabilities of all classes after the contexts, one row each."""
        scores = self.predicted(c1, c2) @ self.target.T + self.bias
        scores -= scores.max(axis=1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def _scatter(out: np.ndarray, at: np.ndarray, values: np.ndarray):
    """Add rows of values to the rows ``at`` of out."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    out[at[first]] += np.add.reduceat(values[order], first, axis=0)


class Trainer:
    """Noise-contrastive estimation with adaptive steps over batches of (class, two classes before)."""

    def __init__(self, model: Bilinear, class_tokens: np.ndarray, seed: int):
        self.model, self.random = model, np.random.default_rng(seed)
        self.noise = (class_tokens + 1) / (class_tokens + 1).sum()
        self.cumulated = np.cumsum(self.noise)
        self.log_noise = np.log(NOISE * self.noise).astype(np.float32)
        self.squares = np.full(len(model.flat), 1e-4, np.float32)
        self.tokens = 0

    def learn(self, w: np.ndarray, c1: np.ndarray, c2: np.ndarray):
        for lo in range(0, len(w), BATCH):
            self._step(w[lo: lo + BATCH], c1[lo: lo + BATCH], c2[lo: lo + BATCH])
        self.tokens += len(w)

    def _step(self, w, c1, c2):
        m, grads = self.model, Bilinear(np.zeros_like(self.model.flat))
        drawn = np.minimum(np.searchsorted(self.cumulated, self.random.random(NOISE)), CLASSES - 1)
        r1, r2 = m.context[c1], m.context[c2]
        q = r1 * m.mixing[0] + r2 * m.mixing[1]
        real = np.einsum("ij,ij->i", q, m.target[w]) + m.bias[w] - self.log_noise[w]
        fake = q @ m.target[drawn].T + (m.bias[drawn] - self.log_noise[drawn])
        pull = 1 / (1 + np.exp(np.clip(real, -30, 30)))
        push = -1 / (1 + np.exp(-np.clip(fake, -30, 30)))
        dq = pull[:, None] * m.target[w] + push @ m.target[drawn]
        _scatter(grads.target, w, pull[:, None] * q)
        np.add.at(grads.target, drawn, push.T @ q)
        grads.bias += np.bincount(w, weights=pull, minlength=CLASSES)
        np.add.at(grads.bias, drawn, push.sum(axis=0))
        _scatter(grads.context, c1, dq * m.mixing[0])
        _scatter(grads.context, c2, dq * m.mixing[1])
        grads.mixing[0] += (dq * r1).sum(axis=0)
        grads.mixing[1] += (dq * r2).sum(axis=0)
        grads.flat /= len(w)
        self.squares += grads.flat ** 2
        m.flat += RATE * grads.flat / np.sqrt(self.squares)


def _contexts(classes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two tokens before each token; the end of text stands before a text."""
    c1, c2 = np.roll(classes, 1), np.roll(classes, 2)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    c1[starts] = 0
    c2[starts] = 0
    c2[(starts + 1)[lengths > 1]] = 0
    return c1, c2


def _unpacked(batch: pa.RecordBatch, k: int, counts: Counts):
    """Classes of a block's words, and its tokens, text lengths and held-out flags."""
    names = batch.schema.names

    def of(name):
        return batch.column(names.index(name))[k]
    hashes = of("words").values.to_numpy().view(np.uint64)
    classes = counts.classes(hashes, of("endings").values.to_numpy().astype(np.int64))
    held = of("held").values.to_numpy(zero_copy_only=False).astype(bool)
    return classes, _numbers(of("tokens").as_buffer()), _numbers(of("lengths").as_buffer()), held


def _train(shared):
    def run(batches):
        counts = shared.value
        model = Bilinear.start(counts.class_tokens)
        trainer = Trainer(model, counts.class_tokens, TaskContext.get().partitionId())
        for batch in released(batches):
            for k in range(batch.num_rows):
                classes, tokens, lengths, held = _unpacked(batch, k, counts)
                w = classes[tokens]
                del tokens
                c1, c2 = _contexts(w, lengths)
                mine = ~np.repeat(held, lengths)
                trainer.learn(w[mine], c1[mine], c2[mine])
        if trainer.tokens:
            rows = [model.flat[lo: lo + SLICE].astype(np.float64) * trainer.tokens
                    for lo in range(0, len(model.flat), SLICE)]
            task = TaskContext.get().partitionId()
            yield _sums(range(len(rows)), [task] * len(rows), rows, [float(trainer.tokens)] * len(rows))
    return run


def _sums(slices, tasks, rows, tokens):
    return pa.RecordBatch.from_arrays(
        [pa.array(list(slices), pa.int32()), pa.array(list(tasks), pa.int32()),
         pa.array([x.tobytes() for x in rows], pa.binary()), pa.array(list(tokens), pa.float64())],
        ["slice", "task", "sums", "tokens"])


def _added(batches):
    sums, tokens, tasks = {}, {}, {}
    for batch in batches:
        for piece, task, data, n in zip(*(batch.column(k).to_pylist() for k in range(4))):
            new = np.frombuffer(data)
            sums[piece] = sums[piece] + new if piece in sums else new
            tokens[piece] = tokens.get(piece, 0) + n
            tasks[piece] = task
    if sums:
        yield _sums(sums, tasks.values(), sums.values(), tokens.values())


def _averaged(trained: DataFrame, class_tokens: np.ndarray) -> Bilinear:
    """Mean of the tasks' models by tokens, added up in two steps; one model reaches the driver."""
    schema = "slice int, task int, sums binary, tokens double"
    once = trained.repartition("slice", F.col("task") % 64).mapInArrow(_added, schema)
    rows = once.repartition("slice").mapInArrow(_added, schema).collect()
    model = Bilinear.start(class_tokens)
    for r in rows:
        model.flat[r.slice * SLICE: (r.slice + 1) * SLICE] = np.frombuffer(r.sums) / r.tokens
    return model


def _score(shared):
    def run(block: pa.Table, dictionary: pa.Table) -> pa.Table:
        counts, model = shared.value
        order = np.argsort(dictionary.column("at").to_numpy())
        c = dictionary.column("c").to_numpy()[order].astype(np.float64)
        outs = {name: [] for name in ("id", "held_out", "n_tokens", "n_known", "base_score", "score")}
        for batch in block.to_batches():
            for k in range(batch.num_rows):
                classes, tokens, lengths, held = _unpacked(batch, k, counts)
                base = np.log10((c + 1) / (counts.tokens + counts.words + 1))
                inside = np.log10((c + 1) / (counts.class_tokens + counts.class_words + 1)[classes])
                inside[classes < FREQUENT] = 0
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                outs["id"].extend(batch.column(batch.schema.names.index("ids"))[k].as_py())
                outs["held_out"].append(held)
                outs["n_tokens"].append(lengths.astype(np.int64))
                outs["n_known"].append(np.add.reduceat((c > 0)[tokens], starts, dtype=np.int64))
                outs["base_score"].append(np.add.reduceat(base[tokens], starts))
                w = classes[tokens]
                steps = _class_logs(model, w, *_contexts(w, lengths))
                steps /= np.log(10)
                steps += inside[tokens]
                outs["score"].append(np.add.reduceat(steps, starts))
        ids = pa.array(outs.pop("id"), pa.int64())
        out = pa.table({"id": ids, **{name: np.concatenate(v) for name, v in outs.items()}})
        give_back()
        return out
    return run


def _class_logs(model: Bilinear, w, c1, c2) -> np.ndarray:
    """Log probability of each class after its context; each distinct context is normalised once."""
    pair = c1.astype(np.int32) * np.int32(CLASSES) + c2
    contexts = np.flatnonzero(np.bincount(pair, minlength=CLASSES ** 2))
    place = np.empty(CLASSES ** 2, np.int32)
    place[contexts] = np.arange(len(contexts))
    back, step = place[pair], 4096
    del pair
    part = (back // np.int32(step)).astype(np.uint8)  # at most CLASSES ** 2 / step of them
    out = np.empty(len(w), np.float64)
    for lo in range(0, len(contexts), step):
        some = contexts[lo: lo + step]
        logs = model.log_probs(some // CLASSES, some % CLASSES)
        of = np.flatnonzero(part == lo // step)
        out[of] = logs[back[of] - lo, w[of]]
    return out


def score_texts(docs: DataFrame) -> DataFrame:
    """Scores of rows (id, held_out, text) by a model of the rows that are not held out.

    Text is lower-cased (A-Z); tokens are the words and one end per text; null counts as empty. Returns id,
    held_out, n_tokens, n_known (tokens seen in training), train_tokens, base_score (log10 of the add-one
    unigram estimate) and score (log10 probability by the model). Repeated rows are scored each; a null
    held_out counts as false. Without training rows the model knows no word and every class is alike. An empty
    table gives an empty result.
    """
    spark = light_batches(docs.sparkSession)
    rows = docs.select("id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "text")
    blocks = cut(rows.mapInArrow(gives_back(_into_blocks), _BLOCKS))
    listed = blocks.select("block", F.posexplode(F.arrays_zip("words", "seen", "endings")).alias("at", "z")).select(
        "block", "at", F.col("z.words").alias("word"), F.col("z.seen").alias("seen"), F.col("z.endings").alias("ending"))
    of_word = Window.partitionBy("word")
    words = cut(listed.select(
        "block", "at", "word", "ending", F.sum("seen").over(of_word).alias("c"),
        (F.row_number().over(of_word.orderBy("block")) == 1).alias("first")))
    counts = _counts(words)
    trained = cut(blocks.mapInArrow(
        gives_back(_train(spark.sparkContext.broadcast(counts))), "slice int, task int, sums binary, tokens double"))
    model = _averaged(trained, counts.class_tokens)
    scored = blocks.groupBy("block").cogroup(words.select("block", "at", "c").groupBy("block")).applyInArrow(
        _score(spark.sparkContext.broadcast((counts, model))),
        "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        "id", "held_out", "n_tokens", "n_known", F.lit(counts.tokens).cast("long").alias("train_tokens"),
        "base_score", "score")
