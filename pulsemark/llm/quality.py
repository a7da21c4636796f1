"""Quality of texts by ordinal regression with cumulative links on hashed features.

One set of weights over hashed text features and ordered thresholds give, for every grade, the probability
that a text is at least that good. Features are the distinct words without signs around them, their distinct
beginnings, the distinct ends of words in a sign, and coarse shapes of the whole text, so that a long text is
not judged by the number of its words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.llm.text import Words, mix, runs, short_batches, span_hashes, sum_by_row

#: Hashed features.
FEATURES = 1 << 20
#: The fit takes about this many labelled rows, drawn by hash.
FIT_ROWS = 8000
#: Features of fewer fitted rows get no weight; penalty, step and number of steps of the fit.
MIN_ROWS, PENALTY, STEP, STEPS = 6, 1e-3, 0.05, 200
#: Bytes in the beginnings of words.
BEGINNINGS = (4, 6)
_SIGN = np.ones(256, bool)
_SIGN[48:58] = _SIGN[65:91] = _SIGN[97:123] = _SIGN[128:] = False
_KINDS = mix(np.arange(11, 15, dtype=np.uint64))


def _features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of the rows, in order of rows, and where each row's begin."""
    n_rows = len(words.bounds) - 1
    counts = np.diff(words.bounds)
    row = np.repeat(np.arange(n_rows), counts)
    starts, ends = words.starts.copy(), words.ends.copy()
    for _ in range(4):  # up to four signs on either side do not count
        starts += _SIGN[words.data[starts]] & (starts + 1 < ends)
        ends -= _SIGN[words.data[ends - 1]] & (starts + 1 < ends)
    named = [span_hashes(words.sums, starts, ends) % np.uint64(FEATURES)]
    of = [row]
    for size in BEGINNINGS:
        longer = ends - starts > size
        at = starts[longer]
        named.append(mix(_KINDS[3] ^ span_hashes(words.sums, at, at + size)) % np.uint64(FEATURES))
        of.append(row[longer])
    last, tail = words.data[words.ends - 1], words.ends - words.starts
    second = words.data[np.maximum(words.ends - 2, words.starts)]
    signed = _SIGN[last] & (tail > 1)
    tails = mix(_KINDS[0] ^ (last.astype(np.uint64) << np.uint64(8) | second))[signed] % np.uint64(FEATURES)
    size = mix(_KINDS[1] + np.minimum(np.log2(counts + 1), 20).astype(np.uint64))
    rows = np.concatenate([*of, row[signed], np.arange(n_rows)])
    found = np.concatenate([*named, tails, size % np.uint64(FEATURES)])
    keys = np.unique(rows.astype(np.uint64) * np.uint64(FEATURES) + found)
    rows, found = (keys // np.uint64(FEATURES)).astype(np.int64), keys % np.uint64(FEATURES)
    bounds = np.searchsorted(rows, np.arange(n_rows + 1))
    # How varied the words are, in eighths, from the distinct features just counted.
    varied = np.minimum(8 * np.diff(bounds) // np.maximum(counts, 1), 8).astype(np.uint64)
    extra = mix(_KINDS[2] + varied * np.uint64(2)) % np.uint64(FEATURES)
    return np.insert(found, bounds[1:], extra).astype(np.int64), bounds + np.arange(n_rows + 1)


def _listed(batches):
    for batch in batches:
        rows = []
        for lo, hi, data, at in runs(batch.column(1)):
            found, bounds = _features(Words(data, at))
            rows.extend(found[bounds[k]: bounds[k + 1]].astype(np.int32).tobytes() for k in range(hi - lo))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["grade", "features"])


@dataclass
class Model:
    """Weights of the features and the ascending thresholds between the grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """Per score the probabilities of grade 1 or more, 2 or more and so on."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))


def fit_model(grades: np.ndarray, features: list[np.ndarray], top: int) -> Model:
    """Maximum likelihood with a ridge penalty by adaptive gradient steps over all rows.

    P(grade >= k) = logistic(score - threshold k); the thresholds stay ordered as sums of positive gaps.
    """
    sizes = np.array([len(x) for x in features], np.int64)
    flat = np.concatenate([*features, np.zeros(0, np.int32)]).astype(np.int32)
    often = np.bincount(flat, minlength=FEATURES) >= MIN_ROWS
    row = np.repeat(np.arange(len(grades), dtype=np.int32), sizes)[often[flat]]
    flat = flat[often[flat]]
    used = np.flatnonzero(often)
    flat = (np.cumsum(often) - 1)[flat].astype(np.int32)
    weights = np.zeros(len(used))
    share = [np.clip((grades >= k).mean() if len(grades) else 0.5, 1e-3, 1 - 1e-3) for k in range(1, top + 1)]
    first = -np.log(share[0] / (1 - share[0]))
    logits = -np.log(np.array(share) / (1 - np.array(share)))
    gaps = np.log(np.maximum(np.diff(logits), 1e-2))
    params = np.concatenate([weights, [first], gaps])
    mean, square = np.zeros_like(params), np.zeros_like(params)
    n = max(len(grades), 1)
    for step in range(1, STEPS + 1):
        w = params[: len(used)]
        widths = np.exp(params[len(used) + 1:])
        cuts = params[len(used)] + np.concatenate([[0], np.cumsum(widths)])
        score = np.bincount(row, weights=w[flat], minlength=len(grades))
        tails = 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -40, 40)))
        full = np.column_stack([np.ones(len(grades)), tails, np.zeros(len(grades))])
        at = np.arange(len(grades))
        p = np.maximum(full[at, grades] - full[at, grades + 1], 1e-12)
        slope = full * (1 - full)
        d_score = (slope[at, grades] - slope[at, grades + 1]) / p
        d_cut = np.zeros(len(cuts))
        low = grades > 0
        d_cut += np.bincount(grades[low] - 1, weights=-(slope[at, grades] / p)[low], minlength=len(cuts))
        high = grades < top
        d_cut += np.bincount(grades[high], weights=(slope[at, grades + 1] / p)[high], minlength=len(cuts))
        d_gaps = np.cumsum(d_cut[::-1])[::-1][1:] * widths
        grad = np.concatenate([np.bincount(flat, weights=d_score[row], minlength=len(used)), [d_cut.sum()], d_gaps]) / n
        grad[: len(used)] -= PENALTY * w
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad ** 2
        params = params + STEP * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    out = np.zeros(FEATURES, np.float32)
    out[used] = params[: len(used)]
    return Model(out, params[len(used)] + np.concatenate([[0], np.cumsum(np.exp(params[len(used) + 1:]))]))


def fit(docs: DataFrame, labels: DataFrame, top: int, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on documents (doc_id, text) and labels (doc_id, grade from 0 to ``top``).

    Labels with a null id, a null grade or no document teach nothing. More than ``fit_rows`` labels are
    represented by about so many, drawn by a hash of the id, which the driver holds as features.
    """
    spark = short_batches(docs.sparkSession)
    known = labels.where("doc_id is not null and grade between 0 and %d" % top).select("doc_id", "grade")
    rate = min(1.0, fit_rows / max(1, known.count()))
    drawn = known.where(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 20)) < int(rate * (1 << 20)))
    listed = docs.join(F.broadcast(drawn), "doc_id").select(F.col("grade").cast("int").alias("grade"), "text").mapInArrow(
        _listed, "grade int, features binary").collect()
    grades = np.array([r.grade for r in listed], np.int64)
    return fit_model(grades, [np.frombuffer(r.features, np.int32) for r in listed], top)


def _graded(shared, top: int):
    def run(batches):
        model = shared.value
        for batch in batches:
            scores = [np.zeros(0)]
            for lo, hi, data, at in runs(batch.column(0)):
                found, bounds = _features(Words(data, at))
                scores.append(sum_by_row(model.weights[found], bounds))
            tails = model.at_least(np.concatenate(scores))
            tails[batch.column(1).to_numpy(zero_copy_only=False).astype(bool)] = 0
            columns = [pa.array(tails.sum(axis=1)), *(pa.array(tails[:, k]) for k in range(top))]
            names = ["expected_grade", *(f"p_at_least_{k + 1}" for k in range(top))]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *columns], [*batch.schema.names[2:], *names])
    return run


def grade(docs: DataFrame, model: Model, keep: list[str], text_column: str = "text") -> DataFrame:
    """The columns ``keep`` with ``expected_grade`` and the tail probabilities ``p_at_least_k``.

    A null, empty or white text has grade 0 for certain. Each row stands alone: repeated rows and null ids
    are kept, an empty table gives an empty result. No kept column may have the new names.
    """
    top = len(model.thresholds)
    text = F.col(f"`{text_column}`")
    asked = docs.select(text.alias("_text"), (F.length(F.trim(F.coalesce(text, F.lit("")))) == 0).alias("_none"),
                        *[F.col(f"`{c}`") for c in keep])
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    tails = ", ".join(f"p_at_least_{k + 1} double" for k in range(top))
    shared = short_batches(docs.sparkSession).sparkContext.broadcast(model)
    return asked.mapInArrow(_graded(shared, top), f"{kept}expected_grade double, {tails}")
