import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsemark.operators import correlation, distributions, evaluate, profile, quantiles
from pulsemark.operators.ordering import running_total, value_buckets
from pulsemark.operators.quantiles import exact_quantiles


def column(spark, values, name="x"):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], f"{name} double")


SHARES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("n,accuracy", [(1, 100), (2, 100), (7, 100), (999, 100), (5000, 100), (20000, 500)])
def test_exact_quantiles_through_brackets(spark, n, accuracy):
    rng = np.random.default_rng(n)
    values = np.round(rng.pareto(1.2, n) * 100, 2)
    values[: n // 3] = 7.0  # one value holds a third of the rows
    got = {r.p: r.value for r in exact_quantiles(column(spark, values), [], ["x"], SHARES, accuracy).collect()}
    for p in SHARES:
        assert got[p] == pytest.approx(np.quantile(values, p)), p


def test_quantiles_of_groups_ignore_missing(spark):
    rows = [("a", float(i)) for i in range(500)] + [("a", None), ("a", float("nan")), ("b", 3.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {(r.k, r.p): r.value for r in exact_quantiles(df, ["k"], ["x"], [0.5, 0.9], 50).collect()}
    assert got == {("a", 0.5): 249.5, ("a", 0.9): pytest.approx(449.1), ("b", 0.5): 3.0, ("b", 0.9): 3.0}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=60), st.sampled_from([0.1, 0.5, 0.66]))
def test_quantiles_property(spark, values, p):
    got = exact_quantiles(column(spark, values), [], ["x"], [p], 4).first().value
    assert got == pytest.approx(np.quantile(values, p))


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(3).gamma(2.0, 50.0, 2000)
    rows = distributions.histogram(column(spark, values), ["x"]).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=40)
    assert [r.n for r in rows] == list(counts)
    assert [r.bin_low for r in rows] == pytest.approx(list(edges[:-1]))
    assert sum(r.density for r in rows) * (edges[1] - edges[0]) == pytest.approx(1.0)


def test_histogram_of_one_value(spark):
    rows = distributions.histogram(column(spark, [5, 5, 5]), ["x"]).orderBy("bin").collect()
    assert [r.n for r in rows] == list(np.histogram([5.0] * 3, bins=40)[0])


def test_kde_against_the_formula(spark):
    values = np.random.default_rng(4).normal(10, 3, 400).round(1)
    rows = distributions.kde(column(spark, values), ["x"]).orderBy("i").collect()
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 200)
    want = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(1) / (len(values) * h * np.sqrt(2 * np.pi))
    assert [r.density for r in rows] == pytest.approx(list(want))
    assert 0.9 < np.trapezoid([r.density for r in rows], grid) <= 1.0
    snapped = distributions.kde(column(spark, values), ["x"], cells=4096).orderBy("i").collect()
    assert [r.density for r in snapped] == pytest.approx(list(want), rel=1e-2, abs=1e-4)


def test_kde_skips_groups_without_spread(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 2.0), ("c", 1.0), ("c", 2.0)], "k string, x double")
    assert {r.k for r in distributions.kde(df, ["x"], ["k"]).select("k").distinct().collect()} == {"c"}


def test_box_stats(spark):
    values = [1, 2, 3, 4, 5, 6, 7, 8, 9, 100]
    df = spark.createDataFrame([("a", float(v)) for v in values], "k string, x double")
    row = distributions.box_stats(df, "x", ["k"]).first()
    assert (row.q1, row.median, row.q3) == (3.25, 5.5, 7.75)
    assert (row.whisker_low, row.whisker_high, row.n_outliers, row.n) == (1, 9, 1, 10)


def test_winsorize_per_group(spark):
    rows = [("a", float(i)) for i in range(101)] + [("b", float(i)) for i in range(0, 1010, 10)] + [("a", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    out = distributions.winsorize(df, ["x"], ["k"], 0.9)
    top = {r.k: r.m for r in out.groupBy("k").agg(F.max("x").alias("m")).collect()}
    assert top == {"a": 90.0, "b": 900.0} and out.where("x is null").count() == 1
    assert distributions.winsorize(df, ["x"], [], 0.5).agg(F.max("x")).first()[0] == pytest.approx(np.quantile(
        [r[1] for r in rows if r[1] is not None], 0.5))


def test_density_2d_counts_every_row(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i % 2), float(x), float(y)) for i, (x, y) in enumerate(rng.exponential(1, (500, 2)))]
    df = spark.createDataFrame(rows, "k int, x double, y double")
    out = distributions.density_2d(df, "x", "y", "k")
    assert out.agg(F.sum("n")).first()[0] == 500
    assert out.agg(F.max("bin_x"), F.max("bin_y"), F.min("bin_x")).first()[:] == (40, 40, 1)


def test_correlations_pairwise_complete(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(1e6, 10, 300)
    frame = {"x": x, "y": x * 0.5 + rng.normal(0, 5, 300), "z": rng.normal(0, 1, 300), "flat": np.full(300, 2.0)}
    rows = [tuple(None if (name == "z" and i % 5 == 0) else float(frame[name][i]) for name in frame) for i in range(300)]
    df = spark.createDataFrame(rows, "x double, y double, z double, flat double").repartition(5)
    got = {(r.feature_a, r.feature_b): (r.n, r.r) for r in correlation.correlations(df).collect()}
    keep = np.array([i % 5 != 0 for i in range(300)])
    assert set(got) == {("y", "x"), ("z", "x"), ("z", "y")}
    assert got[("y", "x")] == (300, pytest.approx(np.corrcoef(frame["x"], frame["y"])[0, 1]))
    assert got[("z", "y")] == (240, pytest.approx(np.corrcoef(frame["z"][keep], frame["y"][keep])[0, 1]))


def test_null_profile_duplicates_and_outliers(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", float("nan"), None), ("b", 3.0, "x")], "video_id string, x double, s string")
    assert {r.feature: (r.null_count, r.null_pct) for r in profile.null_profile(df).collect()} == {"x": (1, 33.33), "s": (2, 66.67)}
    assert profile.duplicate_keys(df).first()[:] == (3, 2, 1)
    assert profile.type_counts(df) == {"string": 2, "double": 1}
    row = profile.iqr_outliers(column(spark, [*range(1, 10), 100]), ["x"]).first()
    assert (row.q1, row.q3, row.n_outliers, row.pct_outliers) == (3.25, 7.75, 1, 10.0)


def brute_auc(labels, scores):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("levels", [2, 10, 100000])
def test_auc_against_brute_force(spark, levels):
    rng = np.random.default_rng(levels)
    labels = rng.integers(0, 2, 400)
    scores = rng.integers(0, levels, 400) / levels
    df = spark.createDataFrame([(int(y), float(s)) for y, s in zip(labels, scores)], "above_baseline int, score double")
    assert evaluate.roc_auc(df).first()[0] == pytest.approx(brute_auc(labels, scores))
    assert evaluate.roc_auc(df.where("above_baseline = 1")).first()[0] is None


def test_report_of_an_empty_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 1)], "above_baseline int, prediction int")
    row = evaluate.classification_report(df).first()
    assert (row.accuracy, row.precision_above, row.recall_above, row.f1_above) == (0.5, 0.0, 0.0, 0.0)
    assert (row.precision_below, row.recall_below) == (1.0, 0.5)


def test_running_total_equals_a_plain_sum(spark):
    values = np.random.default_rng(8).normal(0, 1, 1000).round(2)
    df = column(spark, sorted(set(values))).withColumn("n", F.lit(1)).repartition(6)
    out = running_total(value_buckets(df, "x", 16), "n", ["x"], "before").orderBy("x").collect()
    assert [r.before for r in out] == list(range(len(out)))


def _adversarial(kind):
    rng = np.random.default_rng(11)
    if kind == "one value":
        return np.where(rng.random(6000) < 0.9, 5.0, rng.normal(5, 1e-9, 6000))
    if kind == "powers":
        return 2.0 ** rng.integers(-300, 300, 6000) * rng.choice([-1.0, 1.0], 6000)
    if kind == "neighbours":
        return np.nextafter(1.0, 2.0) + rng.integers(0, 40, 6000) * np.spacing(1.0)
    return np.concatenate([np.zeros(2999), [1.0], np.full(3000, 2.0)])


@pytest.mark.parametrize("kind", ["one value", "powers", "neighbours", "halves"])
def test_quantiles_narrow_by_rounds(spark, kind):
    values = _adversarial(kind)
    got = {r.p: r.value for r in exact_quantiles(column(spark, values), [], ["x"], SHARES, 40, finish=8).collect()}
    assert len(got) == len(SHARES)
    for p in SHARES:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-12), p


@pytest.mark.parametrize("lo,hi", [(0.0, 3.0), (990.0, 999.0), (500.0, 500.0), (0.0, 999.0), (498.5, 499.2)])
def test_narrowing_from_any_bracket(spark, lo, hi):
    """Brackets that miss the rank on either side, hold it, or are one value."""
    long = spark.range(2000).selectExpr("'g' k", "cast(id div 2 as double) value")
    targets = long.groupBy("k").agg(F.count("*").alias("n"), F.min("value").alias("lowest"), F.max("value").alias("highest")).selectExpr(
        "k", "n", "lowest", "highest", "0 i", "0.5D p", f"{lo}D lo", f"{hi}D hi", "999.5D rank", "999L first", "1000L second")
    row = quantiles._narrowed(long, ["k"], targets, 100, 10).collect()
    assert [(r.a, r.b) for r in row] == [(499.0, 500.0)]


def test_quantiles_of_an_empty_table(spark):
    assert exact_quantiles(column(spark, [None]), [], ["x"], [0.5]).collect() == []


def _kernels(z):
    return np.exp(-0.5 * z * z) / np.sqrt(2 * np.pi)


@pytest.mark.parametrize("share", [1e-2, 1e-4])
def test_binned_kde_stays_within_its_bound(spark, share):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(10, 3, 300), rng.pareto(1.5, 200) * 20])
    rows = distributions.binned_kde(column(spark, values), ["x"], share=share).orderBy("i").collect()
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 200)
    want = _kernels((grid[:, None] - values) / h).sum(1) / (len(values) * h)
    assert [r.x for r in rows] == pytest.approx(list(grid))
    bound = rows[0].error_bound
    assert bound <= share / (np.sqrt(2 * np.pi) * h) * (1 + 1e-9)
    assert np.abs(np.array([r.density for r in rows]) - want).max() <= bound + 1e-12


def test_binned_kde_per_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 2.0), ("c", 1.0), ("c", 2.0), ("c", None)], "k string, x double")
    rows = distributions.binned_kde(df, ["x"], ["k"], 20).collect()
    assert {r.k for r in rows} == {"c"} and len(rows) == 20


def test_kde_2d_against_the_formula(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, 400)
    y = x * 0.5 + rng.exponential(2.0, 400)
    df = spark.createDataFrame([("a", float(u), float(v)) for u, v in zip(x, y)] + [("b", 1.0, 1.0), ("a", None, 2.0)],
                               "k string, x double, y double")
    rows = distributions.kde_2d(df, "x", "y", ["k"], points=30).orderBy("i_x", "i_y").collect()
    x, y = np.minimum(x, np.quantile(x, 0.99)), np.minimum(y, np.quantile(y, 0.99))
    hx, hy = (v.std(ddof=1) * 400 ** (-1 / 6) for v in (x, y))
    gx, gy = (np.linspace(v.min() - 3 * h, v.max() + 3 * h, 30) for v, h in ((x, hx), (y, hy)))
    kx, ky = _kernels((gx[:, None] - x) / hx), _kernels((gy[:, None] - y) / hy)
    want = (kx @ ky.T / (400 * hx * hy)).ravel()
    got = np.array([r.density for r in rows])
    assert {r.k for r in rows} == {"a"} and len(rows) == 900
    assert np.abs(got - want).max() <= rows[0].error_bound + 1e-12
    assert rows[0].error_bound <= 2 * 5e-3 * 1.7 / (2 * np.pi * hx * hy)
    assert 0.98 < got.sum() * (gx[1] - gx[0]) * (gy[1] - gy[0]) <= 1.0 + 1e-6


def test_binned_densities_take_no_python(spark):
    df = spark.range(100).selectExpr("cast(id as double) x", "cast(id * id as double) y", "id % 2 k")
    for frame in (distributions.binned_kde(df, ["x"]), distributions.kde_2d(df, "x", "y", ["k"])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "InPandas" not in plan
