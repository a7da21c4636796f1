"""Periodic runs of words, found by recursive splitting at rare words and a scan of lags.

A run is a longest stretch of consecutive words in which words ``period`` apart are identical; the period is
the smallest possible one, and the stretch has at least ``LEAST`` words and two periods. Every word of a run
occurs in it twice at least. So a word that occurs once within the current segment belongs to no run, and
splits the segment; the parts are split in the same way until no word splits any. Segments shorter than a run
go. In the segments that survive all lags are scanned: short ones word by word; for lags from 2h-1 to
4h-2 the names of blocks of h words, as each stretch of equal words that is long enough covers a whole block. Windows of
h words have equal names exactly if they are equal, so results are exact but for the 64-bit hashes of words.

Both steps take time in proportion to n log(n) in the words of a text, memory too.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulsemark.llm.columns import add_columns
from pulsemark.llm.text import Words, runs

#: The least words of a run, beside two periods.
LEAST = 12
#: Rounds in which all segments are split at once; what is not stable then is split one by one.
ROUNDS = 12
#: Lags up to this are scanned word by word; longer ones by blocks of at least 8 words.
SHORT = 14
#: Pairs of windows compared at once.
PAIRS = 1 << 20


def _positions(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the segments [lo, hi), and the number of each place's segment."""
    sizes = hi - lo
    owner = np.repeat(np.arange(len(lo)), sizes)
    return np.arange(len(owner)) + np.repeat(lo - (np.cumsum(sizes) - sizes), sizes), owner


def _neighbours(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the same code before and after each place; -1 and the number of places for none."""
    order = np.argsort(codes, kind="stable")
    before, after = np.full(len(codes), -1), np.full(len(codes), len(codes))
    left, right = order[:-1], order[1:]
    same = codes[left] == codes[right]
    before[right[same]], after[left[same]] = left[same], right[same]
    return before, after


def _rare(before: np.ndarray, after: np.ndarray, lo: int, hi: int) -> int:
    """A place whose word occurs once in [lo, hi), or -1.

    Looks from both ends in turn, in blocks that double, so that the cost follows the smaller part cut off.
    """
    left, right, width = lo, hi, 64
    while left < right:
        end = min(left + width, right)
        hits = np.flatnonzero((before[left:end] < lo) & (after[left:end] >= hi))
        if len(hits):
            return left + int(hits[0])
        start = max(right - width, end)
        hits = np.flatnonzero((before[start:right] < lo) & (after[start:right] >= hi))
        if len(hits):
            return start + int(hits[-1])
        left, right, width = end, start, 2 * width
    return -1


def split(codes: np.ndarray, bounds: np.ndarray, least: int = LEAST, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The segments [lo, hi) of at least ``least`` places in which each code occurs twice or more.

    ``bounds`` are the ends of the texts; no code may occur in two texts.
    """
    before, after = _neighbours(codes)
    lo, hi = bounds[:-1], bounds[1:]
    lo, hi = lo[hi - lo >= least], hi[hi - lo >= least]
    stable: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        if not len(lo):
            break
        at, owner = _positions(lo, hi)
        rare = (before[at] < lo[owner]) & (after[at] >= hi[owner])
        broken = np.bincount(owner[rare], minlength=len(lo)) > 0
        stable.append((lo[~broken], hi[~broken]))
        at, owner = at[~rare & broken[owner]], owner[~rare & broken[owner]]
        new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(owner) != 0)])[: len(at)]
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(at)]])[: len(first)] - 1
        lo, hi = at[first], at[last] + 1
        lo, hi = lo[hi - lo >= least], hi[hi - lo >= least]
    rest, done = [(int(a), int(b)) for a, b in zip(lo, hi)], []
    while rest:
        a, b = rest.pop()
        cut = _rare(before, after, a, b) if b - a >= least else -1
        if cut >= 0:
            rest += [(a, cut), (cut + 1, b)]
        elif b - a >= least:
            done.append((a, b))
    stable.append(tuple(np.array(done, np.int64).reshape(-1, 2).T))
    lo, hi = (np.concatenate(x).astype(np.int64) for x in zip(*stable))
    order = np.argsort(lo)
    return lo[order], hi[order]


def _names(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def _blocks(names: list[np.ndarray], h: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest stretches [left, right) of places equal to those ``lag`` later, for lags from 2h-1 to 4h-2.

    ``names[k]`` has the names of all windows of 2**k places, ``ends`` the end of each place's segment.
    """
    level = h.bit_length() - 1
    window, m = names[level], len(names[0])
    blocks = np.arange(0, len(window), h)
    blocks = blocks[blocks + 3 * h - 1 <= ends[blocks]]
    padded = np.concatenate([window, np.full(m + 4 * h - len(window), -1)])
    starts, lags = [], []
    step = max(1, PAIRS // (2 * h))
    for k in range(0, len(blocks), step):
        some = blocks[k: k + step]
        places = some[:, None] + np.arange(2 * h - 1, 4 * h - 1)[None, :]
        row, lag = np.nonzero(padded[places] == window[some][:, None])
        starts.append(some[row])
        lags.append(lag + 2 * h - 1)
    start, lag = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (starts, lags))
    order = np.lexsort((start, lag))
    start, lag = start[order], lag[order]
    if not len(start):
        return start, start, lag
    new = np.concatenate([[True], (np.diff(start) != h) | (np.diff(lag) != 0)])
    first = np.flatnonzero(new)
    left, right, lag = start[first], start[np.concatenate([first[1:], [len(start)]]) - 1] + h, lag[first]
    # Neighbouring blocks differ, so that fewer than h places are to be added on each side.
    for k in range(level - 1, -1, -1):
        size, name = 1 << k, names[k]
        fits = left >= size
        fits[fits] = name[left[fits] - size] == name[left[fits] - size + lag[fits]]
        left = left - size * fits
        fits = right + lag + size <= m
        fits[fits] = name[right[fits]] == name[right[fits] + lag[fits]]
        right = right + size * fits
    return left, right, lag


def scan(codes: np.ndarray, lo: np.ndarray, hi: np.ndarray, least: int = LEAST) -> np.ndarray:
    """All runs in the segments [lo, hi): rows (start, end, period), by start and period."""
    found = []
    for longest in (2 * SHORT + 1, None):
        if longest is None:  # only segments that can hold two periods of a longer lag
            lo, hi = lo[hi - lo > 2 * SHORT], hi[hi - lo > 2 * SHORT]
        if not len(lo):
            break
        at, owner = _positions(lo, hi)
        inside = _names(codes[at] + (int(codes.max()) + 1) * owner)  # no two segments share a name
        size = int((hi - lo).max())
        if longest:
            for lag in range(1, min(SHORT, size // 2) + 1):
                equal = np.concatenate([[False], inside[lag:] == inside[:-lag], [False]])
                turns = np.flatnonzero(equal[1:] != equal[:-1])
                left, right = turns[::2], turns[1::2]
                good = right - left >= max(least - lag, lag)
                left, right = left[good], right[good]
                found.append(np.stack([at[left], at[right + lag - 1] + 1, np.full(len(left), lag)], axis=1))
            continue
        ends = np.repeat(np.cumsum(hi - lo), hi - lo)
        names, h = [inside], 1
        while 2 * (2 * h - 1) <= size:
            if 2 * h - 1 > SHORT:
                left, right, lag = _blocks(names, h, ends)
                good = right - left >= np.maximum(least - lag, lag)
                left, right, lag = left[good], right[good], lag[good]
                found.append(np.stack([at[left], at[right + lag - 1] + 1, lag], axis=1))
            name = names[-1]
            names.append(_names(name[:-h] * (int(name.max()) + 1) + name[h:]))
            h *= 2
    rows = np.concatenate([*found, np.zeros((0, 3), np.int64)]).astype(np.int64)
    # A stretch with a period has its multiples too: the smallest counts.
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.concatenate([[True], (np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0)])[: len(rows)]
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def dropped(found: np.ndarray, n: int) -> np.ndarray:
    """Which of n places some run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def joined(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of every row with one blank between them."""
    row = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))[kept]
    starts, sizes = words.starts[kept], (words.ends - words.starts)[kept]
    more = np.concatenate([row[1:] == row[:-1], [False]])[: len(row)]  # another word follows in the row
    full = sizes + more
    begin = np.cumsum(full) - full
    source = np.arange(int(full.sum())) + np.repeat(starts - begin, full)
    out = np.concatenate([words.data, np.zeros(1, np.uint8)])[source]
    out[(begin + sizes)[more]] = 0x20
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, weights=full, minlength=len(words.bounds) - 1))])
    return pa.StringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(out.tobytes()))


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _make(least: int):
    def make(texts: pa.Array) -> Iterator[tuple[int, int, list[pa.Array]]]:
        for lo, hi, data, at in runs(texts):
            words = Words(data, at, lower=False)
            text = np.repeat(np.arange(hi - lo), np.diff(words.bounds))
            names = _names(words.hashes) if len(text) else np.zeros(0, np.int64)
            codes = names + (int(names.max(initial=0)) + 1) * text
            found = scan(codes, *split(codes, words.bounds, least), least)
            owner = text[found[:, 0]]
            offsets = np.searchsorted(owner, np.arange(hi - lo + 1)).astype(np.int32)
            items = pa.StructArray.from_arrays(
                [pa.array(x) for x in (found[:, 0] - words.bounds[owner], found[:, 1] - found[:, 0], found[:, 2])],
                fields=list(_RUN))
            yield lo, hi, [pa.ListArray.from_arrays(pa.array(offsets), items), joined(words, ~dropped(found, len(text)))]
    return make


def find_runs(docs: DataFrame, keep: Sequence[str], least: int = LEAST, text_column: str = "text") -> DataFrame:
    """The columns ``keep`` of every row, all its runs (start, length, period) by start and period, and ``collapsed``.

    Words are `[^\\x20\\x09-\\x0D]+`, numbered from 0, compared as they stand. ``least`` is the least length of
    a run in words. ``collapsed`` has the words with one blank between them, without those that some run holds
    after its first period. A text that is null or has no word has no run and an empty ``collapsed``; rows with
    the same id or text are each computed by themselves, an empty table gives an empty result. Any extra columns
    may be there; a kept one may not be called runs or collapsed.
    """
    return add_columns(docs, keep, "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string",
                       lambda: _make(least), text_column)
