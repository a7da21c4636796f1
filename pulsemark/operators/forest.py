"""Random forests without a depth limit, grown level by level over histograms.

Values are replaced by the number of their bin, as in ``boosting``. A tree's bag is a Poisson(1) weight per row, from a hash
of the row's key and the tree. Open nodes wait in a queue, the ones with most rows first. One pass serves ``QUEUE`` of
them, of several trees at once: each task adds up rows and weights by node, feature and bin, Spark sums these over the tasks
and picks the best split of each node, and the driver sees one row per node. A node of at most ``LOCAL_ROWS`` counted
rows is finished in one task, which holds these rows only. All sums are whole numbers and a node draws its features from
its own name, so that the trees depend neither on the partitioning nor on which way a node was split.

A table of at most ``SENT_CELLS`` bins is sent to every task instead, and a task grows whole trees; no row is shuffled for a tree.
In a task all nodes of one depth are split together (``grown``).

The nodes are a stored table, as they grow with the rows and the trees. The driver holds only the splits of nodes of more than
``LOCAL_ROWS`` rows. Rows to predict are led down these splits and meet the rest of each tree, a part of at most
``LOCAL_ROWS`` training rows, in one task. Where trees are whole and the rows to predict few enough to be sent, each task leads
them down some trees and adds up the shares.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.operators.boosting import added_numbers, as_matrix, binned, draws, prepared
from pulsemark.session import cut

#: Open nodes whose histograms are summed in one pass.
QUEUE = 512
#: Most rows of a node that one task finishes.
LOCAL_ROWS = 50_000
#: Rows that a pass may carry to small nodes: as many trees grow at the same time as keep to it, one at least.
CARRIED_ROWS = 20_000_000
#: Rows to predict that meet one part of a tree in one task.
SCORED_ROWS = 500_000
#: Most bins (rows times columns) of a table that is sent to every task.
SENT_CELLS = 64_000_000
#: Trees that one task grows from a table that was sent.
TREES_TOGETHER = 4
#: Cells of histograms, and rows, that are at hand at once in ``grown``.
CELLS_TOGETHER, ROWS_TOGETHER = 1 << 20, 1 << 18
#: Nodes in one row of the stored table.
PIECE = 256
#: Steps of a share in one unit when shares of many trees are added, so that the sum does not depend on their order.
SHARE_UNIT = 1 << 50


@dataclass(frozen=True)
class Settings:
    """``max_depth`` None means no limit. The minima count rows of the bag, a row drawn twice once.

    ``max_features`` is ``sqrt``, ``log2``, None for all, or a number of columns.
    """

    n_estimators: int = 500
    max_depth: int | None = None
    min_samples_split: int = 2
    min_samples_leaf: int = 5
    max_features: str | int | None = "sqrt"
    bootstrap: bool = True
    max_bin: int = 64
    seed: int = 42


@dataclass
class Tree:
    """Nodes sorted by name; the root's name is 1. A leaf has feature -1; rows with a bin up to ``cut`` go left."""

    name: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    rows: np.ndarray
    share: np.ndarray  # weighted share of label 1

    def shares(self, bins: np.ndarray, top: int = 1) -> np.ndarray:
        """The share of the leaf below the node ``top`` that each row ends in."""
        return self.share[self._walk(bins, top)]

    @cached_property
    def below(self) -> np.ndarray:
        """Places of every inner node's children, left and right."""
        inner, out = self.feature >= 0, np.zeros((len(self.name), 2), np.int64)
        for side in (False, True):
            out[inner, int(side)] = np.searchsorted(self.name, children(self.name[inner], np.full(int(inner.sum()), side)))
        return out

    def _walk(self, bins: np.ndarray, top: int) -> np.ndarray:
        at, below = np.full(len(bins), np.searchsorted(self.name, np.uint64(top))), self.below.ravel()
        inner = np.flatnonzero(self.feature[at] >= 0)
        node = at[inner]
        while len(inner):
            node = below[2 * node + (bins[inner, self.feature[node]] > self.cut[node])]
            ends = self.feature[node] < 0
            at[inner[ends]] = node[ends]
            inner, node = inner[~ends], node[~ends]
        return at

    def depth(self) -> int:
        level, deepest = np.array([1], np.uint64), 0
        while True:
            at = np.searchsorted(self.name, level)
            inner = level[self.feature[at] >= 0]
            if not len(inner):
                return deepest
            level = np.concatenate([children(inner, np.full(len(inner), side)) for side in (False, True)])
            deepest += 1


@dataclass
class Forest:
    """``nodes`` is a stored table: nodes of ``tree``, up to ``PIECE`` in a row, and by ``top`` the part of the tree that they are in."""

    columns: list[str]
    edges: list[np.ndarray]
    settings: Settings
    nodes: DataFrame | None = None
    upper: _Growing = field(default_factory=lambda: _Growing())  # the splits above the parts
    n_trees: int = 0
    whole: bool = False  # every tree is one part

    @cached_property
    def trees(self) -> list[Tree]:
        """All trees, gathered in this process: for a look at a small forest. ``predict`` does without."""
        if self.nodes is None:
            return []
        return [unfolded(part) for _, part in self.nodes.toPandas().groupby("tree")]

    def shares(self, bins: np.ndarray) -> np.ndarray:
        """The mean share of label 1 in the leaves of all trees, gathered as ``trees`` are."""
        return sum((t.shares(bins) for t in self.trees), np.zeros(len(bins))) / max(len(self.trees), 1)


def children(names: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of children: 64-bit hashes of the way from the root, as plain numbers would overflow at depth 64."""
    x = names * np.uint64(2) + right.astype(np.uint64)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def bag(keys: np.ndarray, tree: int, settings: Settings) -> np.ndarray:
    """How often each row is in a tree's bag."""
    if not settings.bootstrap:
        return np.ones(len(keys), np.int64)
    steps = np.cumsum(np.exp(-1) / np.cumprod([1, *range(1, 16)]))
    return np.searchsorted(steps, draws(keys, tree, settings.seed), "right")


def features_of(tree: int, name: int, n: int, settings: Settings) -> np.ndarray:
    """The columns that a node may be split on."""
    how = settings.max_features
    keep = {"sqrt": int(np.sqrt(n)), "log2": int(np.log2(max(n, 1))), None: n}.get(how, how)
    return np.sort(np.random.default_rng([settings.seed, tree, int(name)]).permutation(n)[:min(max(int(keep), 1), n)])


def best_split(counts: np.ndarray, features: np.ndarray, settings: Settings) -> tuple[int, int, np.ndarray] | None:
    """(feature, cut, sums of the left child) of the best split from counts[sum, feature, bin] of one node.

    The sums are rows, weight and weight of label 1. The gain is that of Gini impurity; ties go to the first feature and
    the lowest bin. A node is a leaf if it is pure, too small, or no split leaves enough rows on both sides.
    """
    total = counts[:, 0].sum(axis=1)
    n, w, y = (int(v) for v in total)
    if n < max(settings.min_samples_split, 2) or y in (0, w):
        return None
    left = np.cumsum(counts, axis=2)[:, :, :-1]
    right = total[:, None, None] - left
    fits = (left[0] >= settings.min_samples_leaf) & (right[0] >= settings.min_samples_leaf) & (left[0] > 0) & (right[0] > 0)
    if not fits.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        pure = sum(s[2] ** 2.0 / s[1] + (s[1] - s[2]) ** 2.0 / s[1] for s in (left, right))
    pure = np.where(fits, np.round(pure / w, 12), -np.inf)
    f, b = np.unravel_index(int(pure.argmax()), pure.shape)
    return int(features[f]), int(b), left[:, f, b]


def counted(bins: np.ndarray, w: np.ndarray, y: np.ndarray, features: np.ndarray, width: int) -> np.ndarray:
    """Sums (rows, weight, weight of label 1) by feature and bin."""
    out = np.zeros((3, len(features), width), np.int64)
    for k, f in enumerate(features):
        for s, value in enumerate((np.ones_like(w), w, w * y)):
            out[s, k] = np.bincount(bins[:, f], value, width).astype(np.int64)
    return out


_LOW = np.uint64(0xFFFFFFFF)
_STEP = np.uint64(2549297995355413924), np.uint64(4865540595714422341)  # of PCG64, high and low


def _seeded(words: Sequence[np.ndarray]) -> list[np.ndarray]:
    """What numpy's SeedSequence makes of four 32-bit words each: four 64-bit numbers."""
    const = 0x43B0D7E5

    def mixed(v):
        nonlocal const
        v = v ^ np.uint32(const)
        const = const * 0x931E8875 & 0xFFFFFFFF
        v = v * np.uint32(const)
        return v ^ (v >> np.uint32(16))

    pool = [mixed(w) for w in words]
    for source in range(4):
        for k in range(4):
            if source != k:
                v = np.uint32(0xCA01F9DD) * pool[k] - np.uint32(0x4973F715) * mixed(pool[source])
                pool[k] = v ^ (v >> np.uint32(16))
    out, const = [], 0x8B51F9DD
    for k in range(8):
        v = pool[k % 4] ^ np.uint32(const)
        const = const * 0x58F38DED & 0xFFFFFFFF
        v = v * np.uint32(const)
        out.append((v ^ (v >> np.uint32(16))).astype(np.uint64))
    return [out[k] | (out[k + 1] << np.uint64(32)) for k in range(0, 8, 2)]


def _stepped(high, low, add_high, add_low):
    """One step of the 128-bit generators."""
    half, (by_high, by_low) = np.uint64(32), _STEP
    a, b, c, d = low >> half, low & _LOW, by_low >> half, by_low & _LOW
    middle = a * d + ((b * d) >> half)
    carried = a * c + (middle >> half) + ((b * c + (middle & _LOW)) >> half)
    new = low * by_low + add_low
    return carried + high * by_low + low * by_high + add_high + (new < add_low), new


def features_of_all(tree: int, names: np.ndarray, n: int, settings: Settings) -> np.ndarray:
    """``features_of`` of many nodes, a row each: numpy's generators and their shuffles, side by side."""
    keep = len(features_of(tree, 1, n, settings))
    if not (0 <= settings.seed <= 0xFFFFFFFF and 0 <= tree <= 0xFFFFFFFF) or len(names) < 8:
        return np.array([features_of(tree, int(x), n, settings) for x in names], np.int64).reshape(-1, keep)
    one, half = np.uint64(1), np.uint64(32)
    words = [np.full(len(names), v, np.uint32) for v in (settings.seed, tree)]
    with np.errstate(over="ignore"):
        start_high, start_low, high, low = _seeded([*words, (names & _LOW).astype(np.uint32), (names >> half).astype(np.uint32)])
        add_high, add_low = (high << one) | (low >> np.uint64(63)), (low << one) | one
        low = add_low + start_low
        state = _stepped(add_high + start_high + (low < add_low), low, add_high, add_low)
        # A shuffle repeats a draw of the bits of i while it is above i; rows that need more draws than these are few.
        hits = [(i + 1) / (1 << i.bit_length()) for i in range(1, n)]
        length = sum(1 / p for p in hits) + 4 * sum((1 - p) / p ** 2 for p in hits) ** 0.5 + 2
        drawn = []
        while len(drawn) < length:
            state = _stepped(*state, add_high, add_low)
            x, turn = state[0] ^ state[1], state[0] >> np.uint64(58)
            x = (x >> turn) | (x << ((np.uint64(64) - turn) & np.uint64(63)))
            drawn += [(x & _LOW).astype(np.uint32), (x >> half).astype(np.uint32)]
    drawn, order, at = np.stack(drawn), np.tile(np.arange(n, dtype=np.int32), (len(names), 1)), np.arange(len(names))
    used, again = np.zeros(len(names), np.int64), np.zeros(len(names), bool)
    for i in range(n - 1, 0, -1):
        mask, k, open_ = np.uint32((1 << i.bit_length()) - 1), np.zeros(len(names), np.int64), at
        while len(open_):
            over = used[open_] >= len(drawn)
            again[open_[over]] = True
            open_ = open_[~over]
            k[open_] = drawn[used[open_], open_] & mask
            used[open_] += 1
            open_ = open_[k[open_] > i]
        k[again] = 0
        held = order[at, k]
        order[at, k] = order[:, i]
        order[:, i] = held
    out = np.sort(order[:, :keep].astype(np.int64), axis=1)
    for k in np.flatnonzero(again):
        out[k] = features_of(tree, int(names[k]), n, settings)
    return out


#: Sums (0 rows, 1 weight, 2 weight of label 1) that share a number which a float holds exactly: bits of each, and which.
_FEW, _MANY = ((17, 0, 1, 2),), ((26, 0, 1), (52, 2))


def _best_of(flat: np.ndarray, n_columns: int, rows: np.ndarray, totals: np.ndarray, features: np.ndarray,
             shared: dict, width: int, settings: Settings) -> np.ndarray:
    """``best_split`` of nodes whose rows follow one another: feature, or -1, cut, and the left child's rows, weight and weight of label 1.

    Only bins that hold rows are looked at: a cut at another bin is that at the one before. The sums of a bin share one or
    two floats, so that they are counted together.
    """
    m, keep = features.shape
    best, out = np.full(m, -np.inf), np.zeros((5, m), np.int64)
    out[0] = -1
    parts = _FEW if totals[1].max() < 1 << 17 else _MANY
    slices = [slice(lo, lo + ROWS_TOGETHER) for lo in range(0, len(rows), ROWS_TOGETHER)]
    node, place = np.repeat(np.arange(m), totals[0]), rows * n_columns
    base, values = node * width, [shared[part][rows] for part in parts]
    for k in range(keep):
        column = np.repeat(features[:, k], totals[0])
        dense = [0] * len(parts)
        for some in slices:
            cell = flat[place[some] + column[some]] + base[some]
            dense = [d + np.bincount(cell, v[some], m * width) if len(slices) > 1 else np.bincount(cell, v[some], m * width)
                     for d, v in zip(dense, values)]
        held = np.flatnonzero(dense[0])
        of = held // width
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        size, left = np.diff(np.append(first, len(of))), [None] * 3
        for (bits, *which), d in zip(parts, dense):
            sums = d[held].astype(np.int64)
            for place_, what in enumerate(which):
                here = (sums >> (bits * place_)) & ((1 << bits) - 1)
                upto = np.cumsum(here)
                left[what] = upto - np.repeat(upto[first] - here[first], size)
        right = [np.repeat(t, size) - v for t, v in zip(totals, left)]
        fits = np.flatnonzero((left[0] >= settings.min_samples_leaf) & (right[0] >= max(settings.min_samples_leaf, 1)))
        if not len(fits):
            continue
        of, held = of[fits], held[fits]
        sides = [[v[fits] for v in side] for side in (left, right)]
        pure = sum(y ** 2.0 / w + (w - y) ** 2.0 / w for _, w, y in sides)
        pure = np.round(pure / totals[1][of], 12)
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        most = np.maximum.reduceat(pure, first)
        top = np.flatnonzero(pure == np.repeat(most, np.diff(np.append(first, len(of)))))
        top = top[np.concatenate([[True], of[top[1:]] != of[top[:-1]]])]  # the lowest bin of equal ones
        better = most > best[of[first]]
        top = top[better]
        at = of[top]
        best[at] = most[better]
        out[:, at] = features[at, k], held[top] - at * width, *(v[top] for v in sides[0])
    return out


def grown(tree: int, name: int, depth: int, bins: np.ndarray, w: np.ndarray, y: np.ndarray, width: int,
          settings: Settings) -> tuple[np.ndarray, ...]:
    """All nodes below and with one node whose rows are at hand: names, features, cuts, rows and shares.

    All nodes of a depth are split together; each split is that of ``best_split``.
    """
    n_columns, flat = bins.shape[1], np.ascontiguousarray(bins).ravel()
    keep = len(features_of(tree, 1, n_columns, settings))
    least = max(settings.min_samples_split, 2 * settings.min_samples_leaf, 2)
    counts = np.ones(len(w)), w.astype(float), (w * y).astype(float)
    shared = {part: sum(counts[what] * float(1 << part[0] * k) for k, what in enumerate(part[1:])) for part in (*_FEW, *_MANY)}
    names, rows, out = np.array([name], np.uint64), np.arange(len(w)), []
    totals = np.array([[c.sum()] for c in counts]).astype(np.int64)
    while len(names):
        split, starts = np.zeros((5, len(names)), np.int64), np.cumsum(totals[0]) - totals[0]
        split[0] = -1
        open_ = np.flatnonzero((totals[0] >= least) & (totals[2] > 0) & (totals[2] < totals[1]))
        if settings.max_depth is not None and depth >= settings.max_depth:
            open_ = open_[:0]
        upto = np.cumsum(totals[0][open_])
        while len(open_):
            # As many nodes as keep to the cells and the rows that may be at hand, one at least.
            size = max(1, min(int(np.searchsorted(upto, ROWS_TOGETHER, "right")), CELLS_TOGETHER // width))
            some, open_, upto = open_[:size], open_[size:], upto[size:] - upto[size - 1: size]
            split[:, some] = _best_of(
                flat, n_columns, rows[_spans(starts[some], totals[0][some])], totals[:, some],
                features_of_all(tree, names[some], n_columns, settings) if keep < n_columns else np.tile(np.arange(keep), (len(some), 1)),
                shared, width, settings)
        out.append((names, split[0], split[1], totals[0], totals[2] / totals[1]))
        inner = np.flatnonzero(split[0] >= 0)
        n, left = totals[0][inner], split[2:, inner]
        rows = rows[_spans(starts[inner], n)]
        right = flat[rows * n_columns + np.repeat(split[0][inner], n)] > np.repeat(split[1][inner], n)
        rows = np.concatenate([rows[~right], rows[right]])  # all left children, then all right ones
        totals = np.concatenate([left, totals[:, inner] - left], axis=1)
        names = np.concatenate([children(names[inner], np.full(len(inner), side)) for side in (False, True)])
        depth += 1
    return tuple(np.concatenate(v) for v in zip(*out))


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of spans, one span after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


_NODES = "tree int, top bigint, n int, name binary, feature binary, cut binary, rows binary, share binary"
_KINDS = {"name": "<u8", "feature": "<i4", "cut": "<i4", "rows": "<i8", "share": "<f8"}


def folded(tree: int, top: int, nodes: Sequence[np.ndarray]) -> pd.DataFrame:
    """Nodes of one part of a tree, ``PIECE`` to a row."""
    arrays = [np.asarray(v).astype(kind) for v, kind in zip(nodes, _KINDS.values())]
    rows = [(tree, signed(top), len(arrays[0][lo: lo + PIECE]), *(v[lo: lo + PIECE].tobytes() for v in arrays))
            for lo in range(0, len(arrays[0]), PIECE)]
    return pd.DataFrame(rows, columns=["tree", "top", "n", *_KINDS])


def unfolded(rows: pd.DataFrame) -> Tree:
    """The nodes of such rows as a tree; columns may lack."""
    found = {c: np.frombuffer(b"".join(rows[c]), kind) if c in rows else None for c, kind in _KINDS.items()}
    order = np.argsort(found["name"])
    return Tree(*[None if v is None else v[order] for v in found.values()])


_SUMS = "slot int, place int, n bigint, w bigint, y bigint"


@dataclass
class _Open:
    tree: int
    name: int
    depth: int
    rows: int


class _Growing:
    """The inner nodes of the trees that grow, and the open nodes in which their rows end."""

    def __init__(self):
        self.split: dict[int, dict[int, tuple[int, int]]] = {}
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def add(self, tree: int, name: int, feature: int, cut_: int) -> None:
        self.split.setdefault(tree, {})[name] = feature, cut_
        self.sorted.pop(tree, None)

    def of(self, trees) -> _Growing:
        """The splits of some trees, to be sent to tasks."""
        out = _Growing()
        out.split = {t: dict(self.split[t]) for t in set(trees) if t in self.split}
        return out

    def place(self, tree: int, bins: np.ndarray) -> np.ndarray:
        """The name of the open node or leaf that each row is in."""
        at = np.ones(len(bins), np.uint64)
        if tree not in self.split:
            return at
        if tree not in self.sorted:
            found = sorted(self.split[tree].items())
            feature, cut_ = np.array([s for _, s in found]).T
            self.sorted[tree] = np.array([n for n, _ in found], np.uint64), feature, cut_
        names, feature, cut_ = self.sorted[tree]
        inner = np.arange(len(bins))
        while len(inner):
            k = np.minimum(np.searchsorted(names, at[inner]), len(names) - 1)
            here = names[k] == at[inner]
            inner, k = inner[here], k[here]
            at[inner] = children(at[inner], bins[inner, feature[k]] > cut_[k])
        return at


def _cells(growing: _Growing, queue: list[_Open], n_columns: int, width: int, settings: Settings):
    """Per task the sums of its rows by slot of the queue, feature and bin."""
    slots = {(o.tree, o.name): (k, features_of(o.tree, o.name, n_columns, settings)) for k, o in enumerate(queue)}

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            keys, y = batch["key"].to_numpy(np.int64), batch["label"].to_numpy().astype(np.int64)
            bins = as_matrix(batch["bins"])
            for tree in sorted({t for t, _ in slots}):
                w = bag(keys, tree, settings)
                drawn = np.flatnonzero(w)
                names, back = np.unique(growing.place(tree, bins[drawn]), return_inverse=True)
                order = np.argsort(back, kind="stable")
                ends = np.searchsorted(back[order], np.arange(len(names) + 1))
                for i, name in enumerate(names):
                    if (tree, int(name)) in slots:
                        slot, features = slots[tree, int(name)]
                        at = drawn[order[ends[i]:ends[i + 1]]]
                        sums = counted(bins[at], w[at], y[at], features, width)
                        held[slot] = held[slot] + sums if slot in held else sums
        for slot, sums in held.items():
            feature, bin_ = np.nonzero(sums[0])
            yield pd.DataFrame({"slot": slot, "place": feature * width + bin_, "n": sums[0, feature, bin_],
                                "w": sums[1, feature, bin_], "y": sums[2, feature, bin_]})
    return run


def _picked(queue: list[_Open], n_columns: int, width: int, settings: Settings):
    """The best split of one slot from its summed cells."""
    def run(key, cells):
        slot = int(key[0])
        features = features_of(queue[slot].tree, queue[slot].name, n_columns, settings)
        sums = np.zeros((3, len(features) * width), np.int64)
        sums[:, cells["place"].to_numpy()] = cells[["n", "w", "y"]].to_numpy().T
        sums = sums.reshape(3, len(features), width)
        n, w, y = (int(v) for v in sums[:, 0].sum(axis=1))
        split = best_split(sums, features, settings)
        f, b, left = split if split else (-1, 0, [0, 0, 0])
        return pd.DataFrame([(slot, f, b, n, int(left[0]), y / w)], columns=["slot", "feature", "cut", "rows", "left", "share"])
    return run


def packed(bins: np.ndarray, width: int) -> list[bytes]:
    """The bins of each row as bytes, which pass a shuffle and a worker faster than arrays of numbers."""
    return [row.tobytes() for row in np.ascontiguousarray(bins, _kind(width))]


def unpacked(column, n_columns: int, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), _kind(width)).reshape(-1, n_columns).astype(np.int64)


def _kind(width: int):
    return np.uint8 if width <= 1 << 8 else np.uint16 if width <= 1 << 16 else np.int64


def _carried(growing: _Growing, small: list[_Open], width: int, settings: Settings):
    """Rows of the small nodes, each with the number of its node."""
    slots = {(o.tree, o.name): k for k, o in enumerate(small)}

    def run(batches):
        for batch in batches:
            keys = batch["key"].to_numpy(np.int64)
            bins = as_matrix(batch["bins"])
            for tree in sorted({t for t, _ in slots}):
                w = bag(keys, tree, settings)
                drawn = np.flatnonzero(w)
                names, back = np.unique(growing.place(tree, bins[drawn]), return_inverse=True)
                slot = np.array([slots.get((tree, int(n)), -1) for n in names], np.int64)[back]
                drawn, slot = drawn[slot >= 0], slot[slot >= 0]
                if len(drawn):
                    yield pd.DataFrame({"slot": slot, "w": w[drawn], "y": batch["label"].to_numpy().astype(np.int64)[drawn],
                                        "bins": packed(bins[drawn], width)})
    return run


def signed(name: int) -> int:
    """The same 64 bits as Spark's numbers have them."""
    return int(np.uint64(name).astype(np.int64))


def _finish(small: list[_Open], n_columns: int, width: int, settings: Settings):
    def run(key, rows):
        o = small[int(key[0])]
        bins = unpacked(rows["bins"], n_columns, width)
        return folded(o.tree, o.name, grown(
            o.tree, o.name, o.depth, bins, rows["w"].to_numpy(), rows["y"].to_numpy(), width, settings))
    return run


def _grow(table: DataFrame, n_rows: int, trees: Sequence[int], n_columns: int, width: int, settings: Settings,
          growing: _Growing) -> DataFrame:
    """The stored nodes of some trees; their splits of large nodes are added to ``growing``.

    ``top`` is the node whose rows one task finished, the leaf itself for a large leaf, and 0 for a split large node.
    """
    done = []
    roots = [_Open(t, 1, 0, n_rows) for t in trees]  # a bag holds no more rows
    small, large = (roots, []) if n_rows <= LOCAL_ROWS else ([], roots)
    while large:
        large.sort(key=lambda o: (-o.rows, o.tree, o.name))
        queue, large = large[:QUEUE], large[QUEUE:]
        cells = table.mapInPandas(_cells(growing.of(o.tree for o in queue), queue, n_columns, width, settings), _SUMS)
        summed = cells.groupBy("slot", "place").agg(*[F.sum(c).alias(c) for c in ("n", "w", "y")])
        picked = summed.groupBy("slot").applyInPandas(
            _picked(queue, n_columns, width, settings),
            "slot int, feature int, cut int, rows bigint, left bigint, share double").toPandas()
        for r in picked.itertuples(index=False):
            o = queue[r.slot]
            deep = settings.max_depth is not None and o.depth >= settings.max_depth
            feature = -1 if deep else int(r.feature)
            done.append(folded(o.tree, o.name if feature < 0 else 0, [
                np.array([v]) for v in (np.uint64(o.name), feature, int(r.cut) if feature >= 0 else 0, int(r.rows), float(r.share))]))
            if feature < 0:
                continue
            growing.add(o.tree, o.name, feature, int(r.cut))
            for side, rows in ((False, r.left), (True, r.rows - r.left)):
                child = int(children(np.array([o.name], np.uint64), np.array([side]))[0])
                (small if rows <= LOCAL_ROWS else large).append(_Open(o.tree, child, o.depth + 1, int(rows)))
    parts = [table.sparkSession.createDataFrame(pd.concat(done), _NODES)] if done else []
    if small:
        carried = table.mapInPandas(
            _carried(growing.of(o.tree for o in small), small, width, settings), "slot int, w bigint, y bigint, bins binary")
        parts.append(carried.groupBy("slot").applyInPandas(_finish(small, n_columns, width, settings), _NODES))
    return cut(reduce(DataFrame.unionByName, parts))


def fit(rows: DataFrame, columns: Sequence[str], label: str, key: str, settings: Settings = Settings()) -> Forest:
    """M5: a forest fitted to all rows with a label 0 or 1; ``key`` names the rows for the bags.

    NULL, NaN and infinite values are missing and lie below every value. An empty table, or one without columns, gives a forest
    without trees, whose share is 0. A tree whose bag is empty is left out.
    """
    columns = list(columns)
    table, edges = prepared(rows, columns, label, key, settings.max_bin)
    forest = Forest(columns, edges, settings)
    if table is None:
        return forest
    width, n_rows = _width(edges), table.count()
    at_once = max(1, CARRIED_ROWS // n_rows)
    parts = []
    if n_rows * len(columns) <= SENT_CELLS and settings.n_estimators > 0:
        forest.nodes, forest.whole = cut(_grown_whole(table, len(columns), width, settings)), True
        forest.n_trees = forest.nodes.select("tree").distinct().count()
        return forest
    for first in range(0, settings.n_estimators, at_once):
        numbers = range(first, min(first + at_once, settings.n_estimators))
        parts.append(_grow(table, n_rows, numbers, len(columns), width, settings, forest.upper))
    if parts:
        forest.nodes = reduce(DataFrame.unionByName, parts)
        forest.n_trees = forest.nodes.select("tree").distinct().count()
    return forest


def _gathered(table: DataFrame, columns: Sequence[str]) -> dict[str, bytes]:
    """The columns, which hold bytes, of all rows of a table that is small enough to be sent, each in one piece.

    Rows come to the driver by ``toLocalIterator``, a partition at a time.
    """
    out = {c: bytearray() for c in columns}
    for row in table.select(*columns).toLocalIterator():
        for c in columns:
            out[c] += row[c]
    return {c: bytes(v) for c, v in out.items()}


def _grown_whole(table: DataFrame, n_columns: int, width: int, settings: Settings) -> DataFrame:
    """The nodes of all trees; every task has all rows, as bytes, and grows some trees."""
    spark = table.sparkSession

    def pack(batches):
        for batch in batches:
            yield pd.DataFrame({"key": [batch["key"].to_numpy("<i8").tobytes()], "y": [batch["label"].to_numpy().astype("u1").tobytes()],
                                "bins": [as_matrix(batch["bins"]).astype(_kind(width)).tobytes()]})

    sent = spark.sparkContext.broadcast(_gathered(
        table.select("key", "label", "bins").mapInPandas(pack, "key binary, y binary, bins binary"), ("key", "y", "bins")))

    def grow(batches: Iterator[pd.DataFrame]):
        keys, y = np.frombuffer(sent.value["key"], "<i8"), np.frombuffer(sent.value["y"], "u1")
        bins = np.frombuffer(sent.value["bins"], _kind(width)).reshape(-1, n_columns)
        for batch in batches:
            for tree in batch["id"]:
                w = bag(keys, int(tree), settings).astype(np.int8)  # a bag has a row fifteen times at most
                drawn = np.flatnonzero(w)
                if len(drawn):
                    yield folded(int(tree), 1, grown(int(tree), 1, 0, bins[drawn], w[drawn], y[drawn].astype(np.int8), width, settings))

    tasks = -(-settings.n_estimators // TREES_TOGETHER)
    return spark.range(0, settings.n_estimators, 1, tasks).mapInPandas(grow, _NODES)


def _width(edges: Sequence[np.ndarray]) -> int:
    return max(len(e) for e in edges) + 2


def first_splits(rows: DataFrame, columns: Sequence[str], label: str, key: str, settings: Settings = Settings()) -> pd.DataFrame:
    """How much the best first split on each column lowers Gini impurity over all rows: (feature, gain, threshold).

    A threshold is the largest value that goes left, NaN if missing values alone do. Columns that cannot be split are left out.
    """
    columns, out = list(columns), []
    table, edges = prepared(rows, columns, label, key, settings.max_bin)
    if table is not None:
        whole, width = replace(settings, bootstrap=False, max_features=None), max(len(e) for e in edges) + 2
        cells = table.mapInPandas(_cells(_Growing(), [_Open(0, 1, 0, 0)], len(columns), width, whole), _SUMS)
        found = cells.groupBy("place").agg(*[F.sum(c).alias(c) for c in ("n", "w", "y")]).toPandas()
        sums = np.zeros((3, len(columns) * width), np.int64)
        sums[:, found["place"].to_numpy()] = found[["n", "w", "y"]].to_numpy().T
        sums = sums.reshape(3, len(columns), width)
        _, w, y = (int(v) for v in sums[:, 0].sum(axis=1))
        for k, name in enumerate(columns):
            split = best_split(sums[:, k:k + 1], np.array([k]), whole)
            if split:
                _, b, (_, lw, ly) = split
                pure = sum((a ** 2 + (n - a) ** 2) / n for a, n in ((int(ly), int(lw)), (y - int(ly), w - int(lw)))) / w
                out.append((name, pure - (y ** 2 + (w - y) ** 2) / w ** 2, float(edges[k][b - 1]) if b else float("nan")))
    return pd.DataFrame(out, columns=["feature", "gain", "threshold"])


def predict(rows: DataFrame, forest: Forest, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` of every row and the probability ``score`` of label 1.

    Rows are stored with a number each, as they are read once for the trees and once for the result. A task holds one part of
    one tree and at most about ``SCORED_ROWS`` of the rows that come to it; a part with more rows goes to several tasks.
    """
    if not forest.n_trees:
        return rows.select(*keep, F.lit(0.0).alias("score"))
    named = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(rows.select(*keep).columns)]
    stored = cut(rows.select(*named, *added_numbers(forest.columns), F.monotonically_increasing_id().alias("row")))
    n_columns, width = len(forest.columns), _width(forest.edges)
    numbers = stored.select("row", *[f"_{k}" for k in range(n_columns)])
    n_rows = stored.count()
    if forest.whole and n_rows * n_columns <= SENT_CELLS:
        return _result(stored, _shares_sent(numbers, forest), rows.select(*keep).columns, forest.n_trees)
    trees = [r["tree"] for r in forest.nodes.select("tree").distinct().orderBy("tree").collect()]
    spark, counts = rows.sparkSession, {}
    if n_rows > SCORED_ROWS:
        coming = numbers.mapInPandas(_led(forest, trees, None), "tree int, top bigint, n bigint")
        counts = {(r["tree"], r["top"]): -(-r["n"] // SCORED_ROWS) for r in coming.groupBy("tree", "top").agg(
            F.sum("n").alias("n")).where(F.col("n") > SCORED_ROWS).collect()}
    led = numbers.mapInPandas(_led(forest, trees, counts), "tree int, top bigint, part int, row bigint, bins binary")
    parts = forest.nodes.where("top != 0").withColumn("parts", F.lit(1))
    if counts:
        shared = spark.createDataFrame([(t, top, int(n)) for (t, top), n in counts.items()], "tree int, top bigint, parts int")
        parts = parts.drop("parts").join(shared, ["tree", "top"], "left").fillna(1, ["parts"])
    parts = parts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "rows", "n")
    met = led.groupBy("tree", "top", "part").cogroup(parts.groupBy("tree", "top", "part"))
    shares = met.applyInPandas(_met(n_columns, width), "row bigint, share bigint")
    return _result(stored, shares.groupBy("row").agg(F.sum("share").alias("share")), rows.select(*keep).columns, forest.n_trees)


def _result(stored: DataFrame, shares: DataFrame, names: Sequence[str], n_trees: int) -> DataFrame:
    """The stored rows, under their names, with the mean of the trees' shares."""
    mean = F.col("share") / F.lit(float(SHARE_UNIT)) / F.lit(n_trees)
    return stored.join(shares.select("row", mean.alias("score")), "row").select(
        *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(names)], "score")


def _steps(share: np.ndarray) -> np.ndarray:
    return np.rint(share * SHARE_UNIT).astype(np.int64)


def _shares_sent(numbers: DataFrame, forest: Forest) -> DataFrame:
    """Every row's sum of shares over all trees; each task has all rows, as bytes, and some trees."""
    edges, n_columns, width = forest.edges, len(forest.columns), _width(forest.edges)

    def pack(batches):
        for batch in batches:
            bins = binned(batch[[f"_{k}" for k in range(n_columns)]].to_numpy(float), edges)
            yield pd.DataFrame({"row": [batch["row"].to_numpy("<i8").tobytes()], "bins": [bins.astype(_kind(width)).tobytes()]})

    sent = numbers.sparkSession.sparkContext.broadcast(_gathered(numbers.mapInPandas(pack, "row binary, bins binary"), ("row", "bins")))

    def lead(batches: Iterator[pd.DataFrame]):
        row = np.frombuffer(sent.value["row"], "<i8")
        bins = np.frombuffer(sent.value["bins"], _kind(width)).reshape(-1, n_columns)
        total, open_tree, pieces = np.zeros(len(row), np.int64), None, []
        for batch in batches:
            for tree, found in batch.groupby("tree"):
                if tree != open_tree and pieces:
                    total += _steps(unfolded(pd.concat(pieces)).shares(bins))
                    pieces = []
                open_tree = tree
                pieces.append(found)
        if pieces:
            total += _steps(unfolded(pd.concat(pieces)).shares(bins))
            for k, lo in enumerate(range(0, len(row), ROWS_TOGETHER >> 4)):
                yield pd.DataFrame({"part": [k], "share": [total[lo: lo + (ROWS_TOGETHER >> 4)].tobytes()]})

    def add(key, parts):
        lo = int(key[0]) * (ROWS_TOGETHER >> 4)
        total = sum(np.frombuffer(v, np.int64) for v in parts["share"])
        return pd.DataFrame({"row": np.frombuffer(sent.value["row"], "<i8")[lo: lo + len(total)], "share": total})

    # All pieces of a tree come to one task, one after the other.
    pieces = forest.nodes.select("tree", "name", "feature", "cut", "share").repartition("tree").sortWithinPartitions("tree")
    return pieces.mapInPandas(lead, "part int, share binary").groupBy("part").applyInPandas(add, "row bigint, share bigint")


def _led(forest: Forest, trees: list[int], parts: dict[tuple[int, int], int] | None):
    """For every row and tree the part of the tree that the row comes to; without ``parts`` only how many come."""
    edges, upper, width = forest.edges, forest.upper, _width(forest.edges)

    def run(batches):
        for batch in batches:
            bins = binned(batch[[f"_{k}" for k in range(len(edges))]].to_numpy(float), edges)
            row, told = batch["row"].to_numpy(), np.array(packed(bins, width) if parts is not None else [], object)
            for tree in trees:
                top = upper.place(tree, bins).astype(np.int64)
                if parts is None:
                    found, n = np.unique(top, return_counts=True)
                    yield pd.DataFrame({"tree": tree, "top": found, "n": n})
                    continue
                part = np.zeros(len(row), np.int64)
                for name in np.unique(top) if parts else ():
                    if (tree, int(name)) in parts:
                        part = np.where(top == name, row % parts[tree, int(name)], part)
                yield pd.DataFrame({"tree": tree, "top": top, "part": part, "row": row, "bins": told})
    return run


def _met(n_columns: int, width: int):
    """The share, in whole steps, of the leaf that each row ends in."""
    def run(key, rows, nodes):
        if not len(rows):
            return pd.DataFrame({"row": [], "share": []}).astype("int64")
        share = unfolded(nodes).shares(unpacked(rows["bins"], n_columns, width), int(np.int64(key[1]).astype(np.uint64)))
        return pd.DataFrame({"row": rows["row"], "share": _steps(share)})
    return run
