"""Second-order gradient boosting of trees over histograms, grown level by level.

Values are replaced by the number of their bin once, and the binned rows are stored. For every level of a tree each
task routes its rows through the tree so far and adds up gradients and Hessians of the logistic loss by node, feature and
bin; Spark sums these over the tasks. The driver sees sums alone, nodes x features x bins of them, and picks the
splits. Gradients are rounded to multiples of 2**-26 and summed as integers, so that the trees do not depend
on how the rows are partitioned, and equal those of a plain loop over the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.operators.quantiles import exact_quantiles
from pulsemark.session import cut

#: Steps of a gradient or Hessian in one unit.
UNIT = 1 << 26
#: Trees after which the margins of all rows are stored again.
REFRESH = 25
_MIX = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Settings:
    """``gamma`` is the least loss reduction of a split, ``min_child_weight`` the least sum of Hessians in a child."""

    n_estimators: int = 500
    max_depth: int = 6
    learning_rate: float = 0.1
    subsample: float = 0.8
    colsample: float = 0.8
    min_child_weight: float = 5.0
    gamma: float = 0.0
    reg_lambda: float = 1.0
    max_bin: int = 64
    seed: int = 42


@dataclass
class Tree:
    """Nodes in order of creation; the root is 0. A leaf has feature -1 and a value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])  # bins up to this go left
    missing_left: list[bool] = field(default_factory=lambda: [True])
    left: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin_: int, missing_left: bool) -> None:
        self.feature[node], self.cut[node], self.missing_left[node] = feature, bin_, missing_left
        self.left[node] = len(self.feature)
        for _ in range(2):
            self.feature.append(-1)
            self.cut.append(0)
            self.missing_left.append(True)
            self.left.append(-1)
            self.value.append(0.0)

    def route(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node that each row of bins reaches after at most ``depth`` splits; bin 0 is a missing value."""
        feature, cut_, left = np.array(self.feature), np.array(self.cut), np.array(self.left)
        missing = np.array(self.missing_left)
        at = np.zeros(len(bins), np.int64)
        for _ in range(depth):
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                break
            node = at[inner]
            b = bins[inner, feature[node]]
            goes_left = np.where(b == 0, missing[node], b <= cut_[node])
            at[inner] = left[node] + ~goes_left
        return at


@dataclass
class Booster:
    columns: list[str]
    edges: list[np.ndarray]  # a value's bin is 1 and the number of edges below it
    trees: list[Tree]
    settings: Settings

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return added(np.zeros(len(bins)), self.trees, bins, self.settings.max_depth)

    def gains(self) -> dict[str, int]:
        """How many splits use each column."""
        used = [f for tree in self.trees for f in tree.feature if f >= 0]
        return {c: used.count(k) for k, c in enumerate(self.columns)}


def added(margin: np.ndarray, trees: Sequence[Tree], bins: np.ndarray, depth: int) -> np.ndarray:
    """The margins with the values of trees added one after the other, so that sums do not depend on where they were stored."""
    for tree in trees:
        margin = margin + np.array(tree.value)[tree.route(bins, depth)]
    return margin


def binned(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of the columns of an array; 0 for NaN."""
    out = np.zeros(values.shape, np.int64)
    for k, e in enumerate(edges):
        column = values[:, k]
        out[:, k] = np.where(np.isnan(column), 0, 1 + np.searchsorted(e, column, "left"))
    return out


def edges_of(rows: DataFrame, columns: Sequence[str], max_bin: int) -> list[np.ndarray]:
    """Exact quantiles of each column as edges between its bins; equal ones once. The last bin has no edge."""
    if not columns:
        return []
    probabilities = [k / max_bin for k in range(1, max_bin)]
    found = exact_quantiles(rows, [], columns, probabilities).select("feature", "value").toPandas()
    return [np.unique(found.value[found.feature == c].to_numpy(float)) for c in columns]


def gradients(margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the logistic loss in whole units."""
    p = 1 / (1 + np.exp(-margin))
    return np.rint((p - label) * UNIT).astype(np.int64), np.rint(p * (1 - p) * UNIT).astype(np.int64)


def draws(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A number from 0 to 1 for each row and tree, from a hash of the row's key and the tree."""
    x = keys.astype(np.uint64) ^ np.uint64(((tree * 2 + 1) * _MIX ^ seed << 32) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).astype(float) / 2.0 ** 64


def chosen(keys: np.ndarray, tree: int, share: float, seed: int) -> np.ndarray:
    """Whether each row takes part in a tree."""
    return draws(keys, tree, seed) < share


def columns_of(tree: int, n: int, share: float, seed: int) -> np.ndarray:
    """The columns that a tree may use: a share of them, one at least."""
    keep = max(1, int(share * n))
    return np.sort(np.random.default_rng([seed, tree]).permutation(n)[:keep])


def histogram(bins: np.ndarray, node: np.ndarray, g: np.ndarray, h: np.ndarray, features: np.ndarray, width: int):
    """Sums (g, h) by node, feature and bin as (cell, g, h) of the cells that rows fall in; exact in 64 bits."""
    cells, parts = [], []
    for f in features:
        cell = (node * (int(features.max()) + 1) + f) * width + bins[:, f]
        found, back = np.unique(cell, return_inverse=True)
        sums = np.zeros((2, len(found)), np.int64)
        np.add.at(sums[0], back, g)
        np.add.at(sums[1], back, h)
        cells.append(found)
        parts.append(sums)
    return np.concatenate(cells), *np.concatenate(parts, axis=1)


def best_split(g: np.ndarray, h: np.ndarray, settings: Settings) -> tuple[float, int, int, bool] | None:
    """(gain, feature, bin, missing_left) of the best split of one node from its sums by feature and bin.

    Ties go to the first feature, the lowest bin, and missing values to the left.
    """
    lam, least = settings.reg_lambda, settings.min_child_weight
    total_g, total_h = g[0].sum() / UNIT, h[0].sum() / UNIT
    parent = total_g ** 2 / (total_h + lam)
    best = None
    for missing_left in (True, False):
        lost = 0 if missing_left else 1
        left_g = (np.cumsum(g[:, 1:], axis=1) + (0 if lost else g[:, :1])) / UNIT
        left_h = (np.cumsum(h[:, 1:], axis=1) + (0 if lost else h[:, :1])) / UNIT
        right_g, right_h = total_g - left_g, total_h - left_h
        gain = 0.5 * (left_g ** 2 / (left_h + lam) + right_g ** 2 / (right_h + lam) - parent) - settings.gamma
        gain = np.where((left_h >= least) & (right_h >= least), np.round(gain, 9), -np.inf)
        f, b = np.unravel_index(int(gain.argmax()), gain.shape)
        if gain[f, b] > 0 and (best is None or (gain[f, b], -f, -b) > (best[0], -best[1], -best[2] + 1)):
            best = (float(gain[f, b]), int(f), int(b) + 1, missing_left)
    return best


def grow(level_sums, n_features: int, width: int, tree_no: int, settings: Settings) -> Tree:
    """One tree. ``level_sums(tree, nodes, features)`` gives sums (cell, g, h) of the rows in these nodes."""
    tree, nodes = Tree(), [0]
    features = columns_of(tree_no, n_features, settings.colsample, settings.seed)
    stride = int(features.max()) + 1
    totals: dict[int, tuple[int, int]] = {}
    for depth in range(settings.max_depth + 1):
        cell, g, h = level_sums(tree, nodes, features)
        following = []
        owner, place = cell // (stride * width), cell % (stride * width)
        order = np.argsort(owner, kind="stable")
        owner, place, g, h = owner[order], place[order], g[order], h[order]
        for node in nodes:
            at = slice(*np.searchsorted(owner, [node, node + 1]))
            sums = np.zeros((2, stride * width), np.int64)
            sums[0, place[at]], sums[1, place[at]] = g[at], h[at]
            sums = sums.reshape(2, stride, width)[:, features]
            totals[node] = int(sums[0, 0].sum()), int(sums[1, 0].sum())
            split = best_split(sums[0], sums[1], settings) if depth < settings.max_depth else None
            if split:
                _, f, b, missing_left = split
                tree.split(node, int(features[f]), b, missing_left)
                following += [tree.left[node], tree.left[node] + 1]
            else:
                weight, mass = totals[node][0] / UNIT, totals[node][1] / UNIT
                tree.value[node] = -settings.learning_rate * weight / (mass + settings.reg_lambda) if mass else 0.0
        nodes = following
        if not nodes:
            break
    return tree


_ROWS = "key bigint, label double, margin double, bins array<int>"
_CELLS = "cell bigint, g bigint, h bigint"


def as_matrix(column) -> np.ndarray:
    return np.stack([np.asarray(x, np.int64) for x in column]) if len(column) else np.zeros((0, 0), np.int64)


def prepared(rows: DataFrame, columns: Sequence[str], label: str, key: str, max_bin: int):
    """The stored rows (key, label, margin, bins) and the edges of the bins; (None, []) if there is nothing to learn from."""
    # Infinite values have no place between edges; they are missing like NaN.
    numbers = [F.when(F.abs(F.col(c).cast("double")) < math.inf, F.col(c).cast("double")).alias(c) for c in columns]
    known = cut(rows.where(F.col(label).isNotNull()).select(
        F.xxhash64(key).alias("_key"), F.col(label).cast("double").alias("_label"), *numbers))
    if not columns or known.isEmpty():
        return None, []
    edges = edges_of(known, columns, max_bin)

    def store(batches):
        for batch in batches:
            bins = binned(batch[columns].to_numpy(float), edges)
            yield pd.DataFrame({"key": batch["_key"], "label": batch["_label"], "margin": 0.0, "bins": list(bins)})

    return cut(known.mapInPandas(store, _ROWS)), edges


def first_splits(rows: DataFrame, columns: Sequence[str], label: str, key: str, settings: Settings = Settings()) -> pd.DataFrame:
    """How much the best first split on each column gains over all rows: (feature, gain, threshold, missing_left).

    A threshold is the largest value that goes left, NaN if all values do and missing ones alone go right. Columns
    without a split of positive gain are left out.
    """
    columns, out = list(columns), []
    table, edges = prepared(rows, columns, label, key, settings.max_bin)
    if table is not None:
        width, whole = max(len(e) for e in edges) + 2, replace(settings, subsample=1.0)
        features = np.arange(len(columns))
        sums = table.mapInPandas(_summed([], Tree(), [0], features, width, 0, whole), _CELLS)
        found = sums.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toPandas()
        full = np.zeros((2, len(columns) * width), np.int64)
        full[:, found.cell.to_numpy()] = found[["g", "h"]].to_numpy(np.int64).T
        full = full.reshape(2, len(columns), width)
        for k, name in enumerate(columns):
            split = best_split(full[0, k: k + 1], full[1, k: k + 1], settings)
            if split:
                gain, _, b, missing_left = split
                out.append((name, gain, float(edges[k][b - 1]) if b <= len(edges[k]) else float("nan"), missing_left))
    return pd.DataFrame(out, columns=["feature", "gain", "threshold", "missing_left"])


def fit(rows: DataFrame, columns: Sequence[str], label: str, key: str, settings: Settings = Settings()) -> Booster:
    """M6: trees fitted one after the other to all rows; ``key`` names the rows for the draw of each tree.

    NULL, NaN and infinite values are missing, and go to the side that gains more. Rows without a label teach nothing.
    An empty table or one without columns gives trees of one leaf with value 0.
    """
    columns = list(columns)
    table, edges = prepared(rows, columns, label, key, settings.max_bin)
    booster = Booster(columns, edges, [], settings)
    if table is None:
        booster.trees = [Tree() for _ in range(settings.n_estimators)]
        return booster
    width, done = max(len(e) for e in edges) + 2, 0
    for number in range(settings.n_estimators):
        if number - done >= REFRESH:
            table, done = cut(table.mapInPandas(_moved(booster.trees[done:], settings), _ROWS)), number

        def level_sums(tree, nodes, features, number=number, done=done, table=table):  # bound now, as the loop goes on
            sums = table.mapInPandas(_summed(
                booster.trees[done:], tree, nodes, features, width, number, settings), _CELLS)
            found = sums.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toPandas()
            return tuple(found[c].to_numpy(np.int64) for c in ("cell", "g", "h"))

        booster.trees.append(grow(level_sums, len(columns), width, number, settings))
    return booster


def _moved(trees: list[Tree], settings: Settings):
    def run(batches):
        for batch in batches:
            bins = as_matrix(batch["bins"])
            yield batch.assign(margin=added(batch["margin"].to_numpy(), trees, bins, settings.max_depth))
    return run


def _summed(trees: list[Tree], tree: Tree, nodes, features, width: int, number: int, settings: Settings):
    """Per task the sums of its rows by node, feature and bin; ``trees`` are those since margins were stored."""
    wanted = np.array(nodes)

    def run(batches):
        found: list = []
        for batch in batches:
            batch = batch[chosen(batch["key"].to_numpy(np.int64), number, settings.subsample, settings.seed)]
            if not len(batch):
                continue
            bins = as_matrix(batch["bins"])
            at = tree.route(bins, settings.max_depth)
            here = np.isin(at, wanted)
            bins, margin = bins[here], batch["margin"].to_numpy()[here]
            g, h = gradients(added(margin, trees, bins, settings.max_depth), batch["label"].to_numpy()[here])
            if len(bins):
                found.append(pd.DataFrame(dict(zip(("cell", "g", "h"), histogram(bins, at[here], g, h, features, width)))))
            if len(found) > 8:
                found = [pd.concat(found).groupby("cell", as_index=False).sum()]
        if found:
            yield pd.concat(found).groupby("cell", as_index=False).sum()
    return run


def added_numbers(columns: Sequence[str]) -> list:
    """The columns as doubles named _0, _1 and so on; infinite values are missing."""
    return [F.when(F.abs(F.col(c).cast("double")) < math.inf, F.col(c).cast("double")).alias(f"_{k}")
            for k, c in enumerate(columns)]


def predict(rows: DataFrame, booster: Booster, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` of every row and the probability ``score`` of label 1."""
    asked = rows.select(*keep, *added_numbers(booster.columns))
    shared = rows.sparkSession.sparkContext.broadcast(booster)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)

    def run(batches):
        model = shared.value
        names = [f"_{k}" for k in range(len(model.columns))]
        for batch in batches:
            margin = model.margins(binned(batch[names].to_numpy(float), model.edges)) if names else np.zeros(len(batch))
            yield batch[list(keep)].assign(score=1 / (1 + np.exp(-margin)))

    return asked.mapInPandas(run, f"{kept}, score double")
