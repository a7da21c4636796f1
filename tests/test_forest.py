"""Forests without a depth limit against trees grown by direct search over rows."""

import numpy as np
import pytest

from pulsemark.operators import boosting, forest
from pulsemark.operators.forest import Settings
from tests.test_boosting import COLUMNS, table


def plain_tree(bins, w, y, number, s, name=1, depth=0):
    """(rows, share) of a leaf, or (rows, share, feature, cut, left, right)."""
    rows, weight, ones = len(w), w.sum(), (w * y).sum()
    leaf, best = (rows, ones / weight), None
    if rows < s.min_samples_split or ones in (0, weight) or depth == s.max_depth:
        return leaf
    for f in forest.features_of(number, name, bins.shape[1], s):
        for b in range(int(bins[:, f].max())):
            left = bins[:, f] <= b
            if min(left.sum(), (~left).sum()) < max(s.min_samples_leaf, 1):
                continue
            impurity = 0.0
            for side in (left, ~left):
                p = (w * y)[side].sum() / w[side].sum()
                impurity += w[side].sum() / weight * (1 - p ** 2 - (1 - p) ** 2)
            if best is None or impurity < best[0] - 1e-11:
                best = (impurity, int(f), b, left)
    if best is None:
        return leaf
    _, f, b, left = best
    names = [int(forest.children(np.array([name], np.uint64), np.array([side]))[0]) for side in (False, True)]
    return (*leaf, f, b, *(plain_tree(bins[m], w[m], y[m], number, s, k, depth + 1) for m, k in zip((left, ~left), names)))


def nested(tree, name=1):
    k = int(np.searchsorted(tree.name, np.uint64(name)))
    leaf = (int(tree.rows[k]), float(tree.share[k]))
    if tree.feature[k] < 0:
        return leaf
    names = [int(forest.children(np.array([name], np.uint64), np.array([side]))[0]) for side in (False, True)]
    return (*leaf, int(tree.feature[k]), int(tree.cut[k]), *(nested(tree, n) for n in names))


def same(a, b):
    return len(a) == len(b) and a[0] == b[0] and abs(a[1] - b[1]) < 1e-12 and a[2:4] == b[2:4] and all(
        same(x, y) for x, y in zip(a[4:], b[4:]))


def leaves(node):
    return [node] if len(node) == 2 else leaves(node[4]) + leaves(node[5])


@pytest.mark.parametrize("settings", [
    Settings(n_estimators=3, max_bin=16, min_samples_leaf=1),
    Settings(n_estimators=3, max_bin=8, min_samples_leaf=7, min_samples_split=31, max_features=None),
    Settings(n_estimators=2, max_bin=8, max_depth=3, max_features="log2", bootstrap=False),
])
@pytest.mark.parametrize("local", [0, 40, 10_000])
def test_equals_plain_trees(spark, settings, local, monkeypatch):
    monkeypatch.setattr(forest, "LOCAL_ROWS", local)
    monkeypatch.setattr(forest, "QUEUE", 5)
    monkeypatch.setattr(forest, "CARRIED_ROWS", 300)
    if local == 0:
        settings = Settings(**{**settings.__dict__, "max_depth": 3, "n_estimators": 2})
    df = table(spark, 150, 3)
    model = forest.fit(df, COLUMNS, "y", "id", settings)
    rows = df.selectExpr("id", "y", *COLUMNS, "xxhash64(id) as k").toPandas()
    values = rows[COLUMNS].to_numpy(float)
    values[np.isinf(values)] = np.nan
    bins, y = boosting.binned(values, model.edges), rows.y.to_numpy()
    assert len(model.trees) == settings.n_estimators
    for number, tree in enumerate(model.trees):
        w = forest.bag(rows.k.to_numpy(), number, settings)
        got = nested(tree)
        assert same(got, plain_tree(bins[w > 0], w[w > 0], y[w > 0], number, settings))
        assert all(leaf[0] >= settings.min_samples_leaf for leaf in leaves(got)) or len(got) == 2
    scores = {r.id: r.score for r in forest.predict(df, model, ["id"]).collect()}
    assert np.allclose([scores[k] for k in rows.id], model.shares(bins)) and len(scores) == len(rows)


def test_deeper_than_thirty(spark):
    """Alternating labels are peeled off one by one."""
    df = spark.createDataFrame([(i, i % 2, float(i)) for i in range(64)], "id long, y int, a double").repartition(4)
    model = forest.fit(df, ["a"], "y", "id", Settings(n_estimators=1, min_samples_leaf=1, max_bin=256, bootstrap=False))
    assert model.trees[0].depth() > 30
    assert all(abs(r.score - r.y) < 1e-12 for r in forest.predict(df, model, ["id", "y"]).collect())


def test_bags_are_poisson():
    w = forest.bag(np.arange(200_000), 3, Settings())
    assert abs(w.mean() - 1) < 0.01 and abs((w == 0).mean() - np.exp(-1)) < 0.005
    other = forest.bag(np.arange(200_000), 4, Settings())
    assert abs(np.corrcoef(w, other)[0, 1]) < 0.01


def test_no_rows_columns_or_labels(spark):
    df = table(spark, 40, 2)
    for rows, columns in ((df.limit(0), COLUMNS), (df, []), (df.selectExpr("id", "cast(null as int) y", *COLUMNS), COLUMNS)):
        model = forest.fit(rows, columns, "y", "id", Settings(n_estimators=2))
        assert model.trees == [] and {r.score for r in forest.predict(df, model, ["id", "a"]).collect()} == {0.0}
    pure = forest.fit(df.withColumn("y", df.y * 0 + 1), COLUMNS, "y", "id", Settings(n_estimators=2))
    assert [t.share.tolist() for t in pure.trees] == [[1.0], [1.0]]


def test_nodes_do_not_pass_through_the_driver(spark, monkeypatch):
    """Fitting and predicting gather less than one row per node; a part of a tree that many rows come to is dealt to several tasks."""
    df = table(spark, 150, 3)
    frame, gathered = type(df), []
    for name in ("toPandas", "collect"):
        def told(self, *a, call=getattr(frame, name), **b):
            out = call(self, *a, **b)
            gathered.append(len(out))
            return out
        monkeypatch.setattr(frame, name, told)
    monkeypatch.setattr(forest, "LOCAL_ROWS", 60)
    model = forest.fit(df, COLUMNS, "y", "id", Settings(n_estimators=9, min_samples_leaf=1, max_bin=16))
    scores = forest.predict(df, model, ["id"])
    passed = sum(gathered) - len(COLUMNS) * 16  # without the edges of the bins
    whole = {r.id: r.score for r in scores.collect()}
    assert passed < sum(len(t.name) for t in model.trees) / 2
    monkeypatch.setattr(forest, "SCORED_ROWS", 7, raising=False)
    assert {r.id: r.score for r in forest.predict(df, model, ["id"]).collect()} == whole and len(whole) == df.count()


@pytest.mark.parametrize("columns, settings", [
    (3, Settings(min_samples_leaf=1)), (21, Settings()), (21, Settings(max_features=None, max_depth=5)),
    (5, Settings(min_samples_leaf=0, min_samples_split=31, max_features=2)), (1, Settings(bootstrap=False))])
@pytest.mark.parametrize("together", [1 << 18, 64])
def test_all_nodes_of_a_depth_at_once_equal_one_after_the_other(columns, settings, together, monkeypatch):
    monkeypatch.setattr(forest, "ROWS_TOGETHER", together)
    random, width = np.random.default_rng(columns), 20
    bins = np.minimum(random.integers(0, width, (700, columns)), random.integers(2, width, (1, columns)))
    w, y = random.integers(1, 5, 700), (random.random(700) < bins[:, 0] / width).astype(int)
    wanted, open_nodes = [], [(1, 0, np.arange(700))]
    while open_nodes:
        name, depth, at = open_nodes.pop()
        features = forest.features_of(9, name, columns, settings)
        deep = settings.max_depth is not None and depth >= settings.max_depth
        split = None if deep else forest.best_split(forest.counted(bins[at], w[at], y[at], features, width), features, settings)
        f, b = split[:2] if split else (-1, 0)
        wanted.append((name, f, b, len(at), (w[at] * y[at]).sum() / w[at].sum()))
        for side in (False, True) if split else ():
            child = int(forest.children(np.array([name], np.uint64), np.array([side]))[0])
            open_nodes.append((child, depth + 1, at[(bins[at, f] > b) == side]))
    got = forest.grown(9, 1, 0, bins.astype(np.uint8), w.astype(np.int8), y.astype(np.int8), width, settings)
    assert sorted(zip(*[v.tolist() for v in got])) == sorted(wanted) and len(wanted) > 3


def test_features_of_all_nodes():
    names = np.append(np.random.default_rng(5).integers(0, 2 ** 64, 3000, dtype=np.uint64), np.array([1, 2 ** 32], np.uint64))
    for n in (1, 2, 3, 21, 64):
        for tree, s in ((0, Settings()), (499, Settings(max_features="log2", seed=0)), (3, Settings(seed=1 << 40))):
            some = names if s.seed < 1 << 32 else names[:20]
            wanted = [forest.features_of(tree, int(x), n, s).tolist() for x in some]
            assert forest.features_of_all(tree, some, n, s).tolist() == wanted


@pytest.mark.parametrize("local", [0, 40, 60])
def test_sent_and_shuffled_tables_give_the_same_forest(spark, local, monkeypatch):
    """A small table is sent to the tasks, which grow whole trees and shuffle no row; others are shuffled by node."""
    df, s = table(spark, 150, 3), Settings(n_estimators=6, min_samples_leaf=2, max_bin=16, max_depth=4 if local == 0 else None)
    monkeypatch.setattr(forest, "PIECE", 7)
    sent = forest.fit(df, COLUMNS, "y", "id", s)
    whole = {r.id: r.score for r in forest.predict(df, sent, ["id"]).collect()}
    monkeypatch.setattr(forest, "SENT_CELLS", 0)
    by_parts = {r.id: r.score for r in forest.predict(df, sent, ["id"]).collect()}
    monkeypatch.setattr(forest, "LOCAL_ROWS", local)
    monkeypatch.setattr(forest, "CARRIED_ROWS", 300)
    shuffled = forest.fit(df, COLUMNS, "y", "id", s)
    assert sent.whole and not shuffled.whole and sent.n_trees == shuffled.n_trees == 6
    for a, b in zip(sent.trees, shuffled.trees):
        assert all((getattr(a, c) == getattr(b, c)).all() for c in ("name", "feature", "cut", "rows", "share"))
    monkeypatch.setattr(forest, "SCORED_ROWS", 7)
    assert {r.id: r.score for r in forest.predict(df, shuffled, ["id"]).collect()} == whole == by_parts and len(whole) == df.count()
