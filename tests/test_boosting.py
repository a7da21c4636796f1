"""Second-order boosting against a plain booster that scans rows instead of histograms."""

import numpy as np
import pytest

from pulsemark.operators import boosting
from pulsemark.operators.boosting import Settings


def plain_booster(bins, label, keys, s):
    """Trees by direct search over rows: nested tuples (feature, bin, missing_left, left, right) or a leaf's value."""
    margin, trees = np.zeros(len(label)), []

    def best(rows, g, h, features):
        found, n_bins = None, bins.max() + 1
        parent = g[rows].sum() / boosting.UNIT, h[rows].sum() / boosting.UNIT
        for missing_left in (True, False):
            for f in features:
                for b in range(1, n_bins + 1):
                    x = bins[rows, f]
                    left = rows[np.where(x == 0, missing_left, x <= b)]
                    gl, hl = g[left].sum() / boosting.UNIT, h[left].sum() / boosting.UNIT
                    gr, hr = parent[0] - gl, parent[1] - hl
                    if hl < s.min_child_weight or hr < s.min_child_weight:
                        continue
                    gain = round(0.5 * (gl ** 2 / (hl + s.reg_lambda) + gr ** 2 / (hr + s.reg_lambda)
                                        - parent[0] ** 2 / (parent[1] + s.reg_lambda)) - s.gamma, 9)
                    if gain > 0 and (found is None or gain > found[0] or (gain == found[0] and (f, b) < found[1:3])):
                        found = (gain, f, b, missing_left)
        return found

    def node(rows, g, h, features, depth):
        split = best(rows, g, h, features) if depth < s.max_depth else None
        if split is None:
            return -s.learning_rate * (g[rows].sum() / boosting.UNIT) / (h[rows].sum() / boosting.UNIT + s.reg_lambda)
        _, f, b, missing_left = split
        x = bins[rows, f]
        left = np.where(x == 0, missing_left, x <= b)
        return (f, b, missing_left, *(node(r, g, h, features, depth + 1) for r in (rows[left], rows[~left])))

    def value(tree, row):
        while isinstance(tree, tuple):
            f, b, missing_left, left, right = tree
            tree = left if (missing_left if row[f] == 0 else row[f] <= b) else right
        return tree

    for t in range(s.n_estimators):
        g, h = boosting.gradients(margin, label)
        rows = np.flatnonzero(boosting.chosen(keys, t, s.subsample, s.seed))
        trees.append(node(rows, g, h, boosting.columns_of(t, bins.shape[1], s.colsample, s.seed), 0))
        margin = margin + np.array([value(trees[-1], r) for r in bins])
    return trees, margin


def nested(tree, k=0):
    if tree.feature[k] < 0:
        return tree.value[k]
    return (tree.feature[k], tree.cut[k], tree.missing_left[k], nested(tree, tree.left[k]), nested(tree, tree.left[k] + 1))


def same(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if not isinstance(a, tuple):
        return abs(a - b) < 1e-12
    return a[:3] == b[:3] and same(a[3], b[3]) and same(a[4], b[4])


def table(spark, n=240, parts=5):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(n, 4)), 1)
    x[:, 3] = rng.integers(0, 3, n)
    label = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(n) < 0.1)).astype(int)
    rows = [(k, int(y), *[float(v) if rng.random() > 0.05 else [None, float("nan"), float("inf")][k % 3] for v in r])
            for k, (y, r) in enumerate(zip(label, x))]
    return spark.createDataFrame(rows, "id long, y int, a double, b double, c double, d double").repartition(parts)


COLUMNS = ["a", "b", "c", "d"]


@pytest.mark.parametrize("settings", [
    Settings(n_estimators=4, max_depth=3, max_bin=8, min_child_weight=2, subsample=1.0, colsample=1.0),
    Settings(n_estimators=3, max_depth=4, max_bin=16, min_child_weight=1, gamma=0.3, subsample=0.7, colsample=0.5),
])
def test_equals_plain_booster(spark, settings):
    df = table(spark)
    booster = boosting.fit(df, COLUMNS, "y", "id", settings)
    rows = df.selectExpr("id", "y", *COLUMNS, "xxhash64(id) as k").toPandas()
    values = rows[COLUMNS].to_numpy(float)
    values[np.isinf(values)] = np.nan
    trees, margin = plain_booster(boosting.binned(values, booster.edges), rows.y.to_numpy(float), rows.k.to_numpy(), settings)
    assert all(same(nested(t), p) for t, p in zip(booster.trees, trees)) and len(booster.trees) == len(trees)
    got = {r.id: r.score for r in boosting.predict(df, booster, ["id"]).collect()}
    assert np.allclose([got[k] for k in rows.id], 1 / (1 + np.exp(-margin)))
    other = boosting.fit(df.repartition(2), COLUMNS, "y", "id", settings)
    assert all(same(nested(a), nested(b)) for a, b in zip(booster.trees, other.trees))


def test_margins_are_stored_again(spark, monkeypatch):
    settings = Settings(n_estimators=5, max_depth=2, max_bin=8, min_child_weight=1)
    first = boosting.fit(table(spark), COLUMNS, "y", "id", settings)
    monkeypatch.setattr(boosting, "REFRESH", 2)
    second = boosting.fit(table(spark), COLUMNS, "y", "id", settings)
    assert all(same(nested(a), nested(b)) for a, b in zip(first.trees, second.trees))


def test_gamma_and_child_weight_stop_splits(spark):
    for stop in ({"gamma": 1e6}, {"min_child_weight": 1e6}):
        booster = boosting.fit(table(spark), COLUMNS, "y", "id", Settings(n_estimators=2, max_bin=8, **stop))
        assert all(len(t.feature) == 1 for t in booster.trees)
    assert sum(booster.gains().values()) == 0


def test_no_rows_or_columns(spark):
    empty = table(spark).limit(0)
    for df, columns in ((empty, COLUMNS), (table(spark), [])):
        booster = boosting.fit(df, columns, "y", "id", Settings(n_estimators=2))
        assert [t.value for t in booster.trees] == [[0.0], [0.0]]
    assert {r.score for r in boosting.predict(table(spark), booster, ["id", "a"]).collect()} == {0.5}
