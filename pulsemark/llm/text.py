"""Words and hashes of Arrow text columns, computed in numpy over runs of rows.

A word is a longest run of bytes outside 0x20 and 0x09-0x0D, that is ``[^\\x20\\x09-\\x0D]+`` over the
text, as these bytes never occur inside a UTF-8 character. A word's hash is a 64-bit polynomial over its
bytes followed by a finalizer; two given words collide with a probability of about 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Bytes of text handled at once; a longer text is one run of its own.
RUN_BYTES = 1 << 19
#: Bytes of an Arrow batch, and rows that Parquet's reader holds at once, in light_batches.
BATCH_BYTES, READ_ROWS = 1 << 20, 512

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer on 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_FOLDED = _VALUE[_LOWER]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base and its inverse to the powers 0 to n at least."""
    if len(_powers[0]) <= n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, RUN_BYTES) + 2, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def prefix_sums(data: np.ndarray, lower: bool) -> np.ndarray:
    """Sums from which the hash of any piece of the bytes follows by one difference."""
    table = _FOLDED if lower else _VALUE
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers(len(data))[0][: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes of the spans [start, end) of the bytes behind ``prefix_sums``."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts])


def short_batches(spark: SparkSession, rows: int = 2000) -> SparkSession:
    """Let Arrow batches of the session hold at most so many rows.

    Texts are long, and a batch lies in the executor and in its Python worker at once, on the way in and out.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)
    return spark


def light_batches(spark: SparkSession) -> SparkSession:
    """``short_batches`` that also end at BATCH_BYTES, and Parquet read by READ_ROWS rows.

    Both limits are on what a task holds at once, in the executor and beside it. No result depends on them.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) <= BATCH_BYTES:
        spark.conf.set(name, BATCH_BYTES)
    name = "spark.sql.parquet.columnarReaderBatchSize"
    if int(spark.conf.get(name)) > READ_ROWS:
        spark.conf.set(name, READ_ROWS)
    return short_batches(spark)


def gives_back(run: Callable) -> Callable:
    """A task's function over batches that ends by returning the worker's free memory to the system.

    The worker waits beside the executor for its next task. What numpy and Python have freed would stay with it.
    """
    def whole(batches):
        yield from run(batches)
        give_back()
    return whole


def give_back() -> None:
    """Return this process's free memory to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; what Arrow keeps of earlier ones goes back to the system before each.

    A Python worker lives on after its task, beside the executor, and Arrow would keep the memory of its largest batches.
    """
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def plain(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null counts as empty."""
    column = (pc.fill_null(column, "") if column.null_count else column).cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def runs(column: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Split a text column into runs of rows of about ``limit`` bytes.

    Yields the first row, the row after the last, the bytes and the rows' offsets in them.
    """
    if not len(column):
        return
    data, at = plain(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        yield lo, hi, data[at[lo]: at[hi]], at[lo: hi + 1] - at[lo]
        lo = hi


class Words:
    """The words of a run of rows: byte spans, hashes and where each row's words begin."""

    def __init__(self, data: np.ndarray, at: np.ndarray, lower: bool = True):
        inside = ~_SPACE[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = at[:-1][at[:-1] < len(data)]  # a word never reaches over two rows
        first[cuts] = inside[cuts]
        cuts = at[1:][at[1:] > 0] - 1
        last[cuts] = inside[cuts]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, at)
        self.sums = prefix_sums(data, lower)
        self.hashes = span_hashes(self.sums, self.starts, self.ends)
        self.data = data

    def text(self, k: int) -> str:
        return self.data[self.starts[k]: self.ends[k]].tobytes().decode("utf-8", "replace")


class Memory:
    """Numbers of words by hash, kept from one run of rows to the next; forgets all when full."""

    def __init__(self, columns: int, limit: int = 300_000):
        self.columns, self.limit = columns, limit
        self.clear()

    def clear(self):
        self.hashes, self.rows = np.zeros(0, np.uint64), np.zeros((0, self.columns), np.float32)

    def look_up(self, words: Words, score) -> np.ndarray:
        """Rows of all words; ``score(picked)`` gives those of words not known yet."""
        found, first, back = np.unique(words.hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, found)
        known = np.zeros(len(found), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == found[inside]
        rows = np.zeros((len(found), self.columns), np.float32)
        rows[known] = self.rows[at[known]]
        rows[~known] = score(first[~known])
        if len(self.hashes) > self.limit:
            self.clear()
            known[:] = False
        hashes = np.concatenate([self.hashes, found[~known]])
        order = np.argsort(hashes)
        self.hashes, self.rows = hashes[order], np.concatenate([self.rows, rows[~known]])[order]
        return rows[back]


def sum_by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the values of each row, where ``bounds`` has the rows' first values."""
    sums = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]
