"""Benchmark decontamination by q-gram filtering in diagonal bands and banded alignment.

Texts are compared without case and with runs of white space as one blank. A document leaks an item if some
part of it can be edited into the whole item with at most ``percent`` % of the item's characters. By the
q-gram lemma such a part shares at least m + 1 - q * (edits + 1) q-grams with the item, all on a band of
edits + 1 diagonals. Shared q-grams are counted in overlapping bands of diagonals; bands with enough of them
are aligned, and the alignment decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.llm.text import gives_back, light_batches, mix, released

Q, PERCENT = 10, 8
#: Characters of benchmark items in one index; a larger benchmark is searched in several blocks.
BLOCK_CHARS = 4_000_000
#: Characters of documents handled at once.
RUN_CHARS = 1 << 19
_WHITE = regex.compile(r"\s+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normalized(text: str | None) -> str:
    return _WHITE.sub(" ", (text or "").lower()).strip(" ")


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(points: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q characters from each place on."""
    out = np.zeros(max(0, len(points) - q + 1), np.uint64)
    for k in range(q):
        out *= _BASE
        out += points[k: k + len(out)]
    return mix(out)


def budget(m: int, q: int, percent: int) -> int:
    """Edits allowed for an item of m characters: ``percent`` %, and so few that q-grams must be shared."""
    return max(0, min(m * percent // 100, (m - q) // q))


@dataclass
class Index:
    """Items, and their q-grams sorted by hash."""

    ids: list[int]
    texts: list[str]
    hashes: np.ndarray
    owners: np.ndarray
    places: np.ndarray
    maybe: np.ndarray
    q: int
    percent: int

    @classmethod
    def build(cls, items: list[tuple[int, str]], q: int, percent: int) -> Index:
        ids, texts = [i for i, _ in items], [t for _, t in items]
        grams = [_grams(_points(t), q) for t in texts]
        owners = np.repeat(np.arange(len(texts)), [len(g) for g in grams])
        places = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, np.int64)]).astype(np.int64)
        hashes = np.concatenate([*grams, np.zeros(0, np.uint64)])
        order = np.argsort(hashes, kind="stable")
        maybe = np.zeros(1 << 24, bool)
        maybe[(hashes >> np.uint64(40)).astype(np.int64)] = True
        return cls(ids, texts, hashes[order], owners[order], places[order], maybe, q, percent)

    def __post_init__(self):
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.edits = np.array([budget(int(m), self.q, self.percent) for m in sizes], np.int64)
        self.need = np.maximum(1, sizes + 1 - self.q * (self.edits + 1))
        self.short = [k for k, m in enumerate(sizes) if 0 < m < self.q]

    def bands(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owners, lowest and highest document places of the bands that hold enough q-grams."""
        grams = _grams(points, self.q)
        at = np.flatnonzero(self.maybe[(grams >> np.uint64(40)).astype(np.int64)])
        lo = np.searchsorted(self.hashes, grams[at], "left")
        hi = np.searchsorted(self.hashes, grams[at], "right")
        counts = hi - lo
        at, lo, counts = at[counts > 0], lo[counts > 0], counts[counts > 0]
        total = int(counts.sum())
        shift = np.repeat(np.cumsum(counts) - counts, counts)
        posting = np.repeat(lo, counts) + np.arange(total) - shift
        place, owner = np.repeat(at, counts), self.owners[posting]
        diagonal = place - self.places[posting]
        width = self.edits[owner] + 1  # band b holds the diagonals from b * width to (b + 2) * width - 1
        band = diagonal // width
        owner, band, place = (np.concatenate(x) for x in ((owner, owner), (band, band - 1), (place, place)))
        order = np.lexsort((band, owner))
        owner, band, place = owner[order], band[order], place[order]
        if not len(owner):
            return owner, place, place
        first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (band[1:] != band[:-1])]))
        sizes = np.diff(np.concatenate([first, [len(owner)]]))
        good = sizes >= self.need[owner[first]]
        first = first[good]
        start = band[first] * (self.edits[owner[first]] + 1)
        return owner[first], start, start + 2 * (self.edits[owner[first]] + 1) - 1


def align(item: np.ndarray, text: np.ndarray, start: int, low: int, high: int, edits: int):
    """Fewest edits that turn the item into a part of the text along the diagonals from low to high.

    Returns (edits, end in the text) or None beyond the budget. ``start`` only shifts the result. The band is
    widened by the budget, so that paths that leave the diagonals by so much are seen.
    """
    low, high = low - edits, high + edits
    width, m = high - low + 1, len(item)
    far = edits + 1
    columns = np.arange(width)
    row = np.where((low + columns >= 0) & (low + columns <= len(text)), 0, far)  # any start is free
    padded = np.full(len(text) + 2 * (width + m) + 2, 0xFFFFFFFF, np.uint32)
    shift = width + m + 1
    padded[shift: shift + len(text)] = text
    for i in range(1, m + 1):
        ends = low + i + columns  # text characters used in each cell
        before = padded[np.clip(shift + ends - 1, 0, len(padded) - 1)]
        new = row + (before != item[i - 1])
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        new[(ends < 0) | (ends > len(text))] = far
        new = np.minimum.accumulate(new - columns) + columns  # a character of the text left out
        new[(ends < 0) | (ends > len(text))] = far
        row = np.minimum(new, far)
        if row.min() >= far:
            return None
    k = int(row.argmin())
    return (int(row[k]), start + low + m + k) if row[k] <= edits else None


def search(index: Index, texts: list[str | None]):
    """Pairs of text number and (item number, fewest edits, end), each item at most once per text."""
    plain = [normalized(t) for t in texts]
    joined = "\x00".join(plain)
    points = _points(joined)
    sizes = np.array([len(p) + 1 for p in plain])
    starts = np.cumsum(sizes) - sizes
    owners, lows, highs = index.bands(points)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for owner, low, high in zip(owners.tolist(), lows.tolist(), highs.tolist()):
        # The band's diagonals may touch two texts.
        m, edits = len(index.texts[owner]), int(index.edits[owner])
        first = int(np.searchsorted(starts, low - edits, "right")) - 1
        last = int(np.searchsorted(starts, high + m + edits, "right")) - 1
        for k in range(max(first, 0), last + 1):
            if best.get((k, owner), (1,))[0] == 0:
                continue
            at = int(starts[k])
            text = points[at: at + len(plain[k])]
            lo, hi = max(0, low - at - edits), min(len(text), high - at + m + edits)
            if hi - lo < m - edits:
                continue
            part = plain[k][lo:hi]
            exact = part.find(index.texts[owner])
            if exact >= 0:
                found = (0, lo + exact + m)
            else:
                found = align(_points(index.texts[owner]), text[lo:hi], lo, low - at - lo, high - at - lo, edits) \
                    if edits else None
            if found and ((k, owner) not in best or found < best[(k, owner)]):
                best[(k, owner)] = found
    for owner in index.short:
        for k, text in enumerate(plain):
            exact = text.find(index.texts[owner])
            if exact >= 0:
                best[(k, owner)] = (0, exact + len(index.texts[owner]))
    return [(k, (owner, *found)) for (k, owner), found in sorted(best.items())]


def _searched(shared):
    def run(batches):
        for batch in released(batches):
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            out, some, held = [], [], 0
            for number, text in zip(ids, texts):
                text = text.as_py()
                some.append((number, text))
                held += len(text or "")
                if held > RUN_CHARS:
                    out += _found(shared.value, some)
                    some, held = [], 0
            out += _found(shared.value, some)
            names = ["id", "item_id", "edits", "end"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(4)], names)
    return gives_back(run)


def _found(indexes: list[Index], rows) -> list[tuple]:
    out = []
    for index in indexes:
        for k, (owner, edits, end) in search(index, [t for _, t in rows]):
            out.append((rows[k][0], index.ids[owner], edits, end))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, percent: int = PERCENT) -> DataFrame:
    """Rows (id, item_id, edits, end) for each document (id, text) and item (item_id, text) it leaks.

    ``end`` is where the part ends in the normalised document. Items without a character are ignored; items
    shorter than q must occur unchanged. Null and empty documents leak nothing. A repeated document or a null id
    is reported each time; equal items are reported under each id. Empty tables give an empty result.

    The benchmark is the stated query set: it is read in blocks of about BLOCK_CHARS characters by hash of
    the id, each block a broadcast index and one scan of the documents.
    """
    spark = light_batches(docs.sparkSession)
    items = benchmark.select("item_id", "text")
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_CHARS))
    result = None
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        rows = sorted(((r.item_id, normalized(r.text)) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0))
        index = Index.build([r for r in rows if r[1]], q, percent)
        found = docs.select("id", "text").mapInArrow(
            _searched(spark.sparkContext.broadcast([index])), "id long, item_id long, edits long, end long")
        result = found if result is None else result.union(found)
    return result
