import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsemark.operators import marginals


def brute(values, family):
    """The statistic by sorting all values."""
    v = np.sort(values)
    n, m, s, a = len(v), v.mean(), v.std(ddof=1), v.min()
    if family == "uniform":
        f = np.clip((v - m) / (2 * np.sqrt(3) * s) + 0.5, 0, 1)
    elif family == "exponential":
        f = 1 - np.exp(-(v - a) / (m - a))
    elif family == "logistic":
        f = 1 / (1 + np.exp(-(v - m) * np.pi / np.sqrt(3) / s))
    elif family == "laplace":
        tail = np.exp(-np.abs(v - m) * np.sqrt(2) / s) / 2
        f = np.where(v >= m, 1 - tail, tail)
    elif family == "gumbel":
        scale = s * np.sqrt(6) / np.pi
        f = np.exp(-np.exp(-(v - (m - 0.5772156649015329 * scale)) / scale))
    else:
        logs = np.log(1 + v - a)
        z = (v - m) / s if family == "normal" else (logs - logs.mean()) / logs.std(ddof=1)
        f = np.array([(1 + math.erf(x / np.sqrt(2))) / 2 for x in z])
    upto = np.searchsorted(v, v, "right") / n
    before = np.searchsorted(v, v, "left") / n
    return max((upto - f).max(), (f - before).max())


def columns(rng, n=3000):
    return {
        "u": rng.uniform(-4, 9, n), "e": 3 + rng.exponential(5, n), "g": rng.normal(100, 7, n),
        "l": np.exp(rng.normal(2, 1, n)), "p": rng.laplace(0, 2, n), "t": rng.gumbel(5, 2, n).round(1),
    }


@pytest.fixture(scope="module")
def table(spark):
    made = columns(np.random.default_rng(8))
    rows = list(zip(*[x.tolist() for x in made.values()]))
    rows = [(*r, 4.0, None) for r in rows] + [(None,) * 8, (float("nan"),) * 7 + (None,)]
    return made, spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*made, "k", "none"]))


@pytest.mark.parametrize("bucket_rows", [500_000, 70])
def test_statistic_equals_brute_force(table, monkeypatch, bucket_rows):
    monkeypatch.setattr(marginals, "BUCKET_ROWS", bucket_rows)
    made, df = table
    got = {(r.feature, r.family): r for r in marginals.fitted(df, [*made, "k", "none"]).collect()}
    for c, values in made.items():
        for family in marginals.FAMILIES:
            assert got[c, family].ks == pytest.approx(brute(values, family), abs=3e-7), (c, family)
    chosen = {c: f for (c, f), r in got.items() if r.chosen}
    nearest = {c: min(marginals.FAMILIES, key=lambda f: brute(values, f)) for c, values in made.items()}
    assert chosen == {**nearest, "k": "constant"}
    # The families the values were drawn from; a shifted lognormal comes as near to a Gumbel.
    assert [chosen[c] for c in "uegp"] == ["uniform", "exponential", "normal", "laplace"]


def test_quantiles_are_the_inverse_within_the_range(table, spark):
    made, df = table
    shares = np.linspace(0.05, 0.95, 19)
    rows = [r for r in marginals.fitted(df, list(made)).collect()]
    for r in rows:
        back = spark.createDataFrame([(float(v), r.m, r.s, r.a, r.lm, r.ls) for v in marginals.quantile(
            r.family, r.asDict(), shares)], "v double, m double, s double, a double, lm double, ls double")
        values = [x[0] for x in back.select("v").collect()]
        assert min(values) >= r.a and max(values) <= r.b
        if r.chosen:
            again = [x[0] for x in back.select(marginals.cdf(r.family, F.col("v"))).collect()]
            assert again == pytest.approx(list(shares), abs=1e-5)


def test_grids_of_missing_columns(table):
    _, df = table
    grids = marginals.chosen_grids(df, ["k", "none", "e"], 11)
    assert set(grids["k"]) == {4.0} and set(grids["none"]) == {0.0}
    assert (np.diff(grids["e"]) > 0).all()
