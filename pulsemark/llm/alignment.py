"""Alignment of two tokenizers' tokens: groups between shared cuts, and links counted over the corpus.

Both tokenizers spell the same bytes, a text behind one blank. A cut is a byte offset at which tokens of both end.
Cuts are found by divide and conquer: in an interval of tokens the common end nearest to the middle is located,
each probed end by bisection in the other tokenizer's ends, and both halves are searched in the same way. An
interval without a cut is a leaf; the tokens between neighbouring cuts are a group. Two tokens are linked if
their bytes overlap.

A blank between two characters that are no white space begins a token of both tokenizers, and so a group. The
units between such blanks are tokenized, aligned and spelt by themselves, and a task remembers what it found of them.

How many documents hold a link is counted over all documents. Links are then scored by these counts. A link that a large
share of all documents hold would put all their rows in one task, so the few hot links are sent to every task:
at most ``HOT`` links can be held ``rows / HOT`` times or more. All others meet their counts by a shuffle.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.llm.columns import add_columns, quoted
from pulsemark.llm.sizes import store
from pulsemark.session import cut

#: Public vocabularies; other paths are parameters.
BYTE_LEVEL, PIECES = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text encoded at once; a longer text is one run of its own.
RUN_BYTES = 1 << 18
#: Ends probed on each side of the middles of all intervals at once, before the rest are searched one by one.
NEAR = 8
#: Bytes of units and their results that a task remembers, and characters of a unit that is worth it.
REMEMBERED, LONGEST = 80_000_000, 100
#: What a remembered unit takes beside its text, groups and links, and units that are tokenized as one text.
_ENTRY, _SOME = 300, 64
#: Links whose counts are sent to every task.
HOT = 200_000
_BLANK = "▁"
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
# Fixed value: how byte-level vocabularies of this kind cut a text before pieces are merged.
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary.

    Printable characters of Latin-1 stand for themselves, other bytes for the characters from 256 on, in order.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(others)}}


class Encoders:
    """Both tokenizers in one task, and the bytes of their tokens.

    The byte-level file lists its merges in the order of the ids they make, so that an id is a rank and the merges
    need no table of their own.
    """

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece
        import tiktoken

        with open(byte_level, encoding="utf-8") as file:
            model = json.load(file)["model"]
        alphabet, entries = byte_alphabet(), model["vocab"]
        made = [entries["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if any(x >= y for x, y in zip(made, made[1:])):
            raise ValueError(f"{byte_level}: merges are not in the order of their ids")
        merged = set(made)  # an entry that no merge makes is a special token
        ranks = {bytes(alphabet[c] for c in e): k for e, k in entries.items() if len(e) == 1 or k in merged}
        self.a = tiktoken.Encoding("bytes", pat_str=_CUTS, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for data, k in ranks.items():
            self.a_bytes[k] = data
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.b_bytes = [self._piece(k) for k in range(self.b.vocab_size())]
        # No piece has a blank behind another character.
        self.by_units = not any(" " in self.b.id_to_piece(k).replace(_BLANK, " ").lstrip(" ") for k in range(len(self.b_bytes)))

    def _piece(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(k) else piece.replace(_BLANK, " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of each text by both; two empty lists if the text is empty or one does not spell its bytes."""
        a = [self.a.encode_ordinary(" " + t) for t in texts]
        out = []
        for text, x, y in zip(texts, a, self.b.encode(texts, num_threads=1)):
            wanted = b" " + text.encode()
            same = (text and b"".join(map(self.a_bytes.__getitem__, x)) == wanted
                    and b"".join(map(self.b_bytes.__getitem__, y)) == wanted)
            out.append((x, y) if same else ([], []))
        return out


def _nearest(a: np.ndarray, b: np.ndarray, lo: int, hi: int) -> int:
    """The place in [lo, hi) nearest to the middle at which an end of a is one of b, or -1; windows double."""
    middle, width = (lo + hi) // 2, 2 * NEAR
    while True:
        left, right = max(lo, middle - width), min(hi, middle + width + 1)
        ends = a[left:right]
        hits = np.flatnonzero(b[np.searchsorted(b, ends)] == ends)
        if len(hits):
            return left + int(hits[np.abs(left + hits - middle).argmin()])
        if left == lo and right == hi:
            return -1
        width *= 2


def shared_cuts(a: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The places in the intervals [lo, hi) of the ends a that are ends b too, by divide and conquer.

    Both are ascending, and the last of b is not less than any of a. The intervals of all texts are halved
    together, level by level.
    """
    found = []
    lo, hi = np.asarray(lo, np.int64), np.asarray(hi, np.int64)
    while len(lo := lo[(some := lo < hi)]):
        hi = hi[some]
        cuts = np.full(len(lo), -1)
        open_ = np.arange(len(lo))
        for k in range(2 * NEAR + 1):
            place = (lo[open_] + hi[open_]) // 2 + ((k + 1) // 2) * (-1 if k % 2 else 1)
            inside = (place >= lo[open_]) & (place < hi[open_])
            ends = a[np.where(inside, place, 0)]
            hit = inside & (b[np.searchsorted(b, ends)] == ends)
            cuts[open_[hit]] = place[hit]
            open_ = open_[~hit & (hi[open_] - lo[open_] > k)]
            if not len(open_):
                break
        for k in open_[hi[open_] - lo[open_] > 2 * NEAR]:
            cuts[k] = _nearest(a, b, int(lo[k]), int(hi[k]))
        halved = cuts >= 0
        found.append(cuts[halved])
        lo, hi = (np.concatenate([lo[halved], cuts[halved] + 1]), np.concatenate([cuts[halved], hi[halved]]))
    return np.sort(np.concatenate([*found, np.zeros(0, np.int64)]))


def align(a_sizes: np.ndarray, b_sizes: np.ndarray, a_counts: np.ndarray, b_counts: np.ndarray):
    """Groups and links of the tokens of several texts, one text after the other.

    Returns the group of each token of a and of b, and the places in a and in b of the linked tokens, in order
    of their bytes. ``a_sizes`` are bytes of tokens, ``a_counts`` tokens of texts; both sides spell the same bytes.
    """
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    if not len(a_ends):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    hi = np.cumsum(a_counts)
    some = np.asarray(a_counts) > 0
    last = hi[some] - 1  # texts end together
    cuts = np.sort(np.concatenate([shared_cuts(a_ends, b_ends, (hi - a_counts)[some], last), last]))
    offsets = a_ends[cuts]
    a_group, b_group = np.searchsorted(offsets, a_ends), np.searchsorted(offsets, b_ends)
    # Between two neighbouring ends of either side lie the bytes that one pair of tokens shares.
    own = np.ones(len(b_ends), bool)
    own[np.searchsorted(b_ends, offsets)] = False
    ends = np.sort(np.concatenate([a_ends, b_ends[own]]))
    return a_group, b_group, np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


def _last(groups: np.ndarray) -> np.ndarray:
    """Which tokens are the last ones of their group."""
    return np.concatenate([groups[1:] != groups[:-1], [True]])[: len(groups)]


def _spelt(a_ids, b_ids, a_group, b_group, a_bounds, b_bounds, names) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` for each text. ``names`` has each id with a comma, a bar, a semicolon and nothing behind."""
    b_mark = np.where(_last(b_group), 2, 0)
    ends = b_bounds[1:][b_bounds[1:] > b_bounds[:-1]] - 1
    b_mark[ends] = 3
    # A group's tokens of a come before those of b.
    order = np.lexsort((np.concatenate([np.zeros(len(a_ids)), np.ones(len(b_ids))]), np.concatenate([a_group, b_group])))
    codes = np.concatenate([a_ids * 4 + _last(a_group), b_ids * 4 + b_mark])[order].tolist()
    spelt = list(map(names.__getitem__, codes))
    at = (a_bounds + b_bounds).tolist()
    return ["".join(spelt[x:y]) for x, y in zip(at, at[1:])]


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    sizes = np.cumsum(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(sizes):
        before = sizes[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, before + RUN_BYTES, "right")))
        yield lo, hi
        lo = hi


_LINK = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("times", pa.int32())])


class _Found(NamedTuple):
    """What was found of several texts: numbers of tokens and groups, spelt groups, and the links (a << 20 | b) in order."""

    sizes: np.ndarray  # rows n_a, n_b, n_groups, n_links
    spelt: list[str]
    links: np.ndarray

    def and_(self, other: _Found) -> _Found:
        return _Found(np.concatenate([self.sizes, other.sizes], axis=1), self.spelt + other.spelt,
                      np.concatenate([self.links, other.links]))


_NONE = _Found(np.zeros((4, 0), np.int64), [], np.zeros(0, np.int64))


class _Aligner:
    """Finds groups and links unit by unit; a text is taken whole if one of its units is not spelt by itself."""

    def __init__(self, coders: Encoders):
        self.coders = coders
        self.names = [f"{k}{mark}" for k in range(max(len(coders.a_bytes), len(coders.b_bytes))) for mark in (",", "|", ";", "")]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (coders.a_bytes, coders.b_bytes))
        self.forget()

    def forget(self):
        self.numbers, self.known, self.held = {}, _NONE, 0  # numbers of units in known; -1 if not spelt

    def find(self, a_ids: np.ndarray, b_ids: np.ndarray, a_counts: np.ndarray, b_counts: np.ndarray) -> _Found:
        n = len(a_counts)
        a_bounds, b_bounds = (np.concatenate([[0], np.cumsum(x)]) for x in (a_counts, b_counts))
        a_group, b_group, a_at, b_at = align(self.a_sizes[a_ids], self.b_sizes[b_ids], a_counts, b_counts)
        text = np.searchsorted(a_bounds, a_at, "right") - 1
        groups = np.bincount(np.repeat(np.arange(n), a_counts)[_last(a_group)], minlength=n)
        sizes = np.array([a_counts, b_counts, groups, np.bincount(text, minlength=n)], np.int64)
        return _Found(sizes, _spelt(a_ids, b_ids, a_group, b_group, a_bounds, b_bounds, self.names),
                      (a_ids[a_at] << 20) | b_ids[b_at])  # ids take 20 bits each

    def learn(self, units: set[str]):
        """Find what is not known yet of short units."""
        new = units.difference(self.numbers)
        if self.held > REMEMBERED:
            self.forget()
            new = units
        self.numbers.update(dict.fromkeys(new, -1))
        # Some at a time are one text and are counted by the bytes at which they end; white space at an end goes on.
        plain = [u for u in new if u and not u[-1].isspace()]
        rows = [plain[k: k + _SOME] for k in range(0, len(plain), _SOME)]
        ids = self.coders.encode([" ".join(row) for row in rows])
        odd = [u for row, x in zip(rows, ids) if not x[0] for u in row] + [u for u in new if u[-1:].isspace()]
        rows += [[u] for u in odd]
        ids += self.coders.encode(odd)
        taken = [k for k, x in enumerate(ids) if x[0]]
        spelt = [u for k in taken for u in rows[k]]
        ends = np.cumsum(np.fromiter((len(u.encode()) for u in spelt), np.int64, len(spelt)) + 1)
        flat, counts = [], []
        for side, sizes in enumerate((self.a_sizes, self.b_sizes)):
            flat.append(np.fromiter(chain.from_iterable(ids[k][side] for k in taken), np.int64))
            last = np.searchsorted(np.cumsum(sizes[flat[-1]]), ends)
            counts.append(np.diff(last + 1, prepend=0))
        found = self.find(*flat, *counts)
        self.numbers.update(zip(spelt, range(len(self.known.spelt), len(self.known.spelt) + len(spelt))))
        self.known = self.known.and_(found)
        self.held += _ENTRY * len(new) + 2 * sum(map(len, new)) + sum(map(len, found.spelt)) + found.links.nbytes

    def parts(self, texts: list[str]) -> tuple[_Found, list[list[int]]]:
        """What was found of units, and the numbers of each text's units in it."""
        split = [_BETWEEN.split(t) if self.coders.by_units else [t] for t in texts]
        units = set().union(*split)
        long = [u for u in units if len(u) > LONGEST]
        self.learn(units.difference(long))
        known, ids = len(self.known.spelt), self.coders.encode(long)
        here = {u: known + k for k, (u, x) in enumerate(zip(long, ids)) if x[0]}
        number, rows = self.numbers.get, []
        for text, row in zip(texts, split):
            numbers = [number(u, -1) for u in row]
            if -1 in numbers:
                numbers = [here.get(u, -1) if k < 0 else k for u, k in zip(row, numbers)]
            if -1 in numbers:
                numbers = [known + len(ids)]
                ids += self.coders.encode([text])
            rows.append(numbers)
        if not ids:
            return self.known, rows
        counts = [np.array([len(x[side]) for x in ids], np.int64) for side in (0, 1)]
        flat = [np.fromiter(chain.from_iterable(x[side] for x in ids), np.int64) for side in (0, 1)]
        return self.known.and_(self.find(*flat, *counts)), rows


def _make(byte_level: str, pieces: str):
    aligner = _Aligner(Encoders(byte_level, pieces))

    def make(texts: pa.Array) -> Iterator[tuple[int, int, list[pa.Array]]]:
        for lo, hi in _runs(texts):
            found, rows = aligner.parts(texts.slice(lo, hi - lo).to_pylist())
            text = np.repeat(np.arange(hi - lo), [len(x) for x in rows])
            part = np.fromiter(chain.from_iterable(rows), np.int64, len(text))
            sizes = np.zeros((4, hi - lo), np.int64)
            np.add.at(sizes, (slice(None), text), found.sizes[:, part])
            held = found.sizes[3, part]
            firsts = (np.cumsum(found.sizes[3]) - found.sizes[3])[part] - (np.cumsum(held) - held)
            places = np.arange(held.sum()) + np.repeat(firsts, held)
            # Links of a text, each once with the number of times.
            links, times = np.unique((np.repeat(text, held) << 40) | found.links[places], return_counts=True)
            offsets = np.searchsorted(links >> 40, np.arange(hi - lo + 1)).astype(np.int32)
            low = (1 << 20) - 1
            items = pa.StructArray.from_arrays(
                [pa.array(x.astype(np.int32)) for x in ((links >> 20) & low, links & low, times)], fields=list(_LINK))
            spelt = found.spelt
            yield lo, hi, [*map(pa.array, sizes), pa.array([";".join([spelt[k] for k in row]) for row in rows], pa.string()),
                           pa.ListArray.from_arrays(pa.array(offsets), items)]
    return make


def aligned(docs: DataFrame, keep: Sequence[str], byte_level: str = BYTE_LEVEL, pieces: str = PIECES,
            text_column: str = "text") -> DataFrame:
    """The columns ``keep`` of every row, n_a, n_b, n_groups, n_links, ``groups`` and ``links`` (a, b, times).

    Special tokens are none: their strings are text like any other. ``groups`` spells the ids as
    `a1,a2|b1;a3|b2,b3`; ``links`` has each pair of ids once, with how often it is linked. A text that is null
    or empty, or whose tokens of one side do not spell the blank and the text (the mark of blanks itself cannot be
    spelt, for instance), has no tokens: zeros, an empty string and an empty list. Rows are computed each by itself,
    an empty table gives an empty result. Any extra columns may be there; a kept one may not be called like a new one.
    """
    return add_columns(
        docs, keep, "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
        "links array<struct<a:int,b:int,times:int>>", lambda: _make(byte_level, pieces), text_column)


def link_counts(rows: DataFrame) -> DataFrame:
    """(a, b, n, best) from the rows with ``links``: documents that hold a pair, and whether it is one of its a's most held."""
    pairs = rows.select(F.explode("links").alias("l")).select(F.col("l.a").alias("a"), F.col("l.b").alias("b"))
    counted = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
    counted = cut(counted)
    most = counted.groupBy("a").agg(F.max("n").alias("most"))
    return counted.join(F.broadcast(most), "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def with_link_counts(rows: DataFrame, hot: int = HOT) -> DataFrame:
    """The rows of ``aligned`` without ``links``, and ``n_best`` and ``count_sum``: how many of its links are
    the most held ones of their a, ties included, and the sum of the counts over all its links.

    Every row counts as a document, rows with the same id and text too. At most ``hot`` counts are broadcast, and one
    number for each id of a's vocabulary.
    """
    clash = sorted({"n_best", "count_sum"} & set(rows.columns))
    if clash:
        raise ValueError(f"the rows have columns {', '.join(clash)}")
    columns = [quoted(c) for c in rows.columns if c != "links"]
    # The key is stored, as it must be the same whenever a task runs again.
    keyed = cut(rows.select(F.struct(*columns).alias("row"), "links", F.monotonically_increasing_id().alias("key")))
    counts = cut(link_counts(keyed))
    held = counts.agg(F.count("*").alias("n"), F.sum("n").alias("rows")).first()
    least = 0 if held.n <= hot else max(1, -(-held.rows // hot))
    links = keyed.select("key", F.explode("links").alias("l")).select("key", "l.a", "l.b", "l.times")
    # Documents' sums over hot links; what is left meets the other counts in a shuffle.
    few = F.broadcast(counts.where(F.col("n") >= least))
    parts = [_sums(links.join(few, ["a", "b"]))]
    if least:
        rest = links.join(few, ["a", "b"], "left_anti")
        parts.append(_sums(rest.join(counts.where(F.col("n") < least), ["a", "b"])))
    sums = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    sums = sums.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return keyed.select("row", "key").join(sums, "key", "left").select(
        "row.*", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")])


def _sums(matched: DataFrame) -> DataFrame:
    times = F.col("times").cast("long")
    return matched.groupBy("key").agg(
        F.sum(F.when(F.col("best"), times).otherwise(0)).alias("n_best"), F.sum(times * F.col("n")).alias("count_sum"))
