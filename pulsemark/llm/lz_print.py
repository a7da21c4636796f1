"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into phrases, each the longest known phrase and one more character. The phrases of similar
texts overlap as their compressed forms would; the K smallest hashes of a text's distinct phrases are its
fingerprint, and the share of common ones among the K smallest of two fingerprints estimates the overlap of
the two phrase sets.

Each text is parsed by itself; the hashes, fingerprints and likenesses of many texts are computed at once in numpy.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.llm.text import mix, powers, short_batches, span_hashes
from pulsemark.session import cut

K = 64
#: Characters of texts whose fingerprints are computed at once, and characters hashed at once.
GROUP, _HASHED = 1 << 20, 1 << 18
#: Characters between two looks at the phrases' mean length, and the mean length above which a phrase is measured by steps.
_PIECE, _LONG = 1 << 13, 24


def phrases(text: str, known: set[str], start: int = 0) -> list[int]:
    """Ends of the phrases from ``start`` on; new phrases are added to ``known``.

    Every prefix of a known phrase is known, so that a phrase grows until it is new. Where phrases are long, their
    length is found by steps instead. The last phrase may be one that is known.
    """
    ends, size = [], len(text)
    add, append = known.add, ends.append
    phrase = ""
    while start < size:
        before, after = len(ends), min(size, start + _PIECE)
        for end, c in enumerate(text[start:after], start + 1):
            phrase += c
            if phrase not in known:
                add(phrase)
                append(end)
                phrase = ""
        start = after
        if (len(ends) - before) * _LONG < _PIECE and start < size:
            return ends + _by_steps(text, known, start - len(phrase))
    if phrase:
        append(size)
    return ends


def _by_steps(text: str, known: set[str], start: int) -> list[int]:
    """``phrases`` by steps up or down from a guess of the length, which follows the lengths before."""
    ends, size, guess = [], len(text), _LONG
    add, append = known.add, ends.append
    while start < size:
        end = start + guess
        if text[start:end] in known:
            while end < size:
                end += 1
                if text[start:end] not in known:
                    break
            end = min(end, size)
        else:
            end = min(end, size)
            while end - 1 > start and text[start:end - 1] not in known:
                end -= 1
        add(text[start:end])
        append(end)
        guess = max(1, (guess * 3 + end - start) // 4)
        start = end
    return ends


def _phrases_after(text: str, ends: list[int], kept: int) -> list[int]:
    """The phrases' ends of a text whose first ``kept`` characters are those of a text with the phrases' ends ``ends``."""
    ends = ends[:bisect_right(ends, kept)]
    return ends + phrases(text, {text[a:b] for a, b in zip([0, *ends], ends)}, ends[-1] if ends else 0)


def _groups(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of at most ``limit`` characters together; a longer text is a group of its own."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right")))
        yield lo, hi
        lo = hi


def fingerprints(texts: list[str], ends: list[list[int]], k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """The k smallest hashes of each text's distinct phrases, one text after the other, and the texts' bounds in them."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    cuts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ends), np.int64, len(ends)))])
    keys = np.zeros(cuts[-1], np.uint64)
    for lo, hi in _groups(sizes, _HASHED):
        before = np.cumsum(sizes[lo:hi]) - sizes[lo:hi]
        places = np.fromiter(chain.from_iterable(ends[lo:hi]), np.int64, cuts[hi] - cuts[lo])
        if len(places):
            places += np.repeat(before, np.diff(cuts[lo: hi + 1]))
            hashes = span_hashes(_sums("".join(texts[lo:hi])), np.concatenate([[0], places[:-1]]), places)
            keys[cuts[lo]: cuts[hi]] = hashes >> np.uint64(32)
    keys |= np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(cuts)) << np.uint64(32)
    keys.sort()
    keys = keys[np.diff(keys, prepend=~keys[:1]) != 0]
    owners = (keys >> np.uint64(32)).astype(np.int64)
    firsts = np.searchsorted(owners, np.arange(len(texts) + 1))
    few = np.arange(len(keys)) - firsts[owners] < k
    return keys[few].astype(np.uint32), np.concatenate([[0], np.cumsum(np.minimum(np.diff(firsts), k))])


def likenesses(values: np.ndarray, bounds: np.ndarray, left: np.ndarray, right: np.ndarray, k: int = K) -> np.ndarray:
    """``likeness`` of many pairs of fingerprints, which are given by their numbers within ``bounds``."""
    keys = []
    for side in (left, right):
        sizes = bounds[side + 1] - bounds[side]
        pairs = np.repeat(np.arange(len(side)), sizes)
        places = np.arange(len(pairs)) + (bounds[side] - np.cumsum(sizes) + sizes)[pairs]
        keys.append((pairs.astype(np.uint64) << np.uint64(32)) | values[places])
    keys = np.sort(np.concatenate(keys))
    first = np.diff(keys, prepend=~keys[:1]) != 0
    both = np.diff(np.flatnonzero(np.append(first, True))) > 1
    pairs = (keys[first] >> np.uint64(32)).astype(np.int64)
    firsts = np.searchsorted(pairs, np.arange(len(left) + 1))
    few = np.arange(len(pairs)) - firsts[pairs] < k
    common, size = np.bincount(pairs[few & both], minlength=len(left)), np.minimum(np.diff(firsts), k)
    return np.where(size > 0, common / np.maximum(size, 1), 1.0)


def _sums(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(mix(points + np.uint64(1)) * powers(len(points))[0][: len(points)], out=out[1:])
    return out


def smallest(text: str, ends: list[int], k: int = K) -> np.ndarray:
    """The k smallest 32-bit hashes of the distinct phrases."""
    if not ends:
        return np.zeros(0, np.uint32)
    last = np.array(ends)
    hashes = span_hashes(_sums(text), np.concatenate([[0], last[:-1]]), last) >> np.uint64(32)
    if len(hashes) > 4 * k:
        hashes = np.partition(hashes, 2 * k)[: 2 * k]
    return np.unique(hashes)[:k].astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated overlap of two phrase sets; two empty ones are alike."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    both = np.union1d(a, b)[:k]
    return float(np.isin(both, a[np.isin(a, b, assume_unique=True)], assume_unique=True).sum() / len(both))


class Printed:
    """One text by itself with its parse and fingerprint."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.ends = phrases(self.text, set())
        self.print = smallest(self.text, self.ends)

    def edited(self, other: str) -> tuple[str, np.ndarray]:
        """The text whose last half is replaced by the start of another, and its fingerprint.

        The phrases within the first half are parsed once for both.
        """
        text = _edit(self.text, other)
        return text, smallest(text, _phrases_after(text, self.ends, len(self.text) - len(self.text) // 2))


def digest(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


def _edit(text: str, other: str) -> str:
    """The text whose last half is replaced by the start of another."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


def _with_next(rows, waiting):
    """Results of the rows that are followed by another of their part, as columns, and the row that waits for its next."""
    items = [waiting] if waiting else []
    held, pairs = len(items) - 1, []
    for number, text, tail, part in rows:
        if held < 0 and tail:  # the tail's copy of a repeated row
            continue
        text = text or ""
        items.append((number, text, part, phrases(text, set()), None))
        if held >= 0 and items[held][2] == part:
            pairs.append((held, len(items) - 1))
        held = -1 if tail else len(items) - 1
    left, right = np.array(pairs, np.int64).reshape(-1, 2).T
    edited = [_edit(items[i][1], items[j][1]) for i, j in pairs]
    parsed = [_phrases_after(x, items[i][3], len(items[i][1]) - len(items[i][1]) // 2) for x, (i, _) in zip(edited, pairs)]
    own = items[1 if waiting else 0:]
    values, bounds = fingerprints([x[1] for x in own] + edited, [x[3] for x in own] + parsed)
    if waiting:
        values, bounds = np.concatenate([waiting[4], values]), np.append(0, bounds + len(waiting[4]))
    spelt, at = digest(values), (8 * bounds).tolist()
    prints = [spelt[a:b] for a, b in zip(at, at[1:])]
    out = ([items[i][0] for i, _ in pairs], [len(items[i][1]) for i, _ in pairs],
           [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in edited],
           [prints[i] for i, _ in pairs], prints[len(items):],
           likenesses(values, bounds, left, len(items) + np.arange(len(pairs))).tolist(),
           likenesses(values, bounds, left, right).tolist())
    return out, (*items[held][:4], values[bounds[held]: bounds[held + 1]].copy()) if held >= 0 else None


def _walk(batches):
    """Rows of (id, text, tail, part) sorted by part, then ids descending with the part's tail last."""
    waiting = None  # id, text, part, ends of phrases and fingerprint
    for batch in batches:
        out = [[], [], [], [], [], [], []]
        rows = list(zip(*(c.to_pylist() for c in batch.columns)))
        for lo, hi in _groups(np.array([len(r[1] or "") for r in rows], np.int64), GROUP):
            found, waiting = _with_next(rows[lo:hi], waiting)
            for values, more in zip(out, found):
                values.extend(more)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(out, _TYPES)],
            ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _part(number, cuts: list[int]):
    """How many of the ascending cuts lie below a number, by two steps of about the root of their count each."""
    step = max(1, int(len(cuts) ** 0.5))
    coarse, blocks = cuts[step - 1:: step], [cuts[k: k + step] for k in range(0, len(cuts), step)] or [[]]
    if len(cuts) % step == 0:
        blocks.append([])
    first = F.size(F.filter(F.array(*map(F.lit, coarse)).cast("array<bigint>"), lambda c: c < number))
    fine = F.get(F.array(*[F.array(*map(F.lit, b)).cast("array<bigint>") for b in blocks]), first)
    return first * step + F.size(F.filter(fine, lambda c: c < number))


def fingerprints_with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of rows (id, text), of their edited texts, and their likeness.

    The next row is the one with the next smaller id; after the last comes the first. The edited text has the
    last floor(n / 2) characters replaced by as many (or all) of the next row's first. Null counts as empty;
    a null id comes last; rows with one id follow each other by a hash of their text. A single row is its
    own next. An empty table gives an empty result.

    Each text is shuffled once, to one of many ranges of ids; the first row of a range also goes to the end of
    the range before.
    """
    spark = short_batches(docs.sparkSession)
    parts = parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = -(1 << 63)
    rows = docs.select("id", "text", F.coalesce("id", F.lit(least)).alias("place"), F.xxhash64("text").alias("tie"))
    known = docs.select(F.coalesce("id", F.lit(least)).cast("double").alias("p"))
    cuts = sorted({int(x) for x in known.approxQuantile("p", [k / parts for k in range(1, parts)], 0.2 / parts)}) \
        if parts > 1 else []
    rows = rows.withColumn("part", _part(F.col("place"), cuts) if cuts else F.lit(0))
    firsts = cut(rows.groupBy("part").agg(F.max(F.struct("place", F.bitwise_not("tie").alias("tie"))).alias("top")).select(
        "part", F.col("top.place").alias("place"), F.bitwise_not("top.tie").alias("tie")))
    # The range after is the next lower one with rows; the last range's is the highest.
    listed = sorted((r.part, r.place, r.tie) for r in firsts.collect())
    heads = [(listed[k][1], listed[k][2], listed[(k + 1) % len(listed)][0]) for k in range(len(listed))]
    rows = rows.select("id", "text", "place", "tie", "part", F.lit(False).alias("tail"))
    if heads:
        above = F.broadcast(spark.createDataFrame(heads, "place long, tie long, part int"))
        tails = rows.select("id", "text", "place", "tie").join(above, ["place", "tie"]).select(
            "id", "text", "place", "tie", "part", F.lit(True).alias("tail"))
        rows = rows.union(tails)
    ordered = rows.repartition("part").sortWithinPartitions("part", "tail", F.desc("place"), "tie")
    return ordered.select("id", "text", "tail", "part").mapInArrow(
        _walk, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double")
