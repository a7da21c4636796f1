"""Range joins and bootstrap intervals against plain Python, and the import without the optional parts."""

import hashlib
import os
import random
import shutil
import subprocess
import sys

import numpy as np
import pytest

from pulsemark.operators import ranges, segments

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def holds(v, lo, hi):
    return v is not None and v == v and (lo is None or v >= lo) and (hi is None or v < hi)


@pytest.mark.parametrize("limits", [{}, {"few_bins": 0}, {"few_bins": 0, "hot_rows": 5}])
def test_range_join_equals_all_pairs(spark, limits):
    rng = random.Random(1)
    values = [rng.choice([rng.uniform(-5, 1000), rng.uniform(0, 1), 7.0, 1e9, 1000.0]) for _ in range(300)]
    values += [None, float("nan"), -5.0, 7.0, 7.0]
    bands = [tuple(sorted(rng.choices(values[:300], k=2))) for _ in range(60)]
    bands += [(None, 7.0), (7.0, None), (None, None), (7.0, 7.0), (9.0, 8.0), (float("nan"), 5.0), (1e10, 2e10), (-9.0, -5.0), (7.0, 7.5)]
    points = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k long, v double").repartition(4)
    table = spark.createDataFrame([(k, *b) for k, b in enumerate(bands)], "band long, lo double, hi double")
    joined = ranges.join_ranges(points, table, "v", "lo", "hi", **limits)
    got = sorted((r.k, r.band) for r in joined.collect())
    want = sorted((k, b) for k, v in enumerate(values) for b, (lo, hi) in enumerate(bands)
                  if holds(v, lo, hi) and lo == lo)
    assert got == want and joined.columns == ["k", "v", "band", "lo", "hi"]
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_range_join_edges(spark):
    table = spark.createDataFrame([(1, 0.0, 2.0)], "band long, lo double, hi double")
    same = spark.createDataFrame([(1, 1.0), (2, 1.0)], "k long, v double")
    assert ranges.join_ranges(same, table, "v", "lo", "hi").count() == 2
    assert ranges.join_ranges(same.limit(0), table, "v", "lo", "hi").count() == 0
    assert ranges.join_ranges(same, table.limit(0), "v", "lo", "hi").count() == 0
    extremes = spark.createDataFrame([(1, float("inf")), (2, -1.7e308), (3, 1.7e308), (4, 1.0)], "k long, v double")
    assert {r.k for r in ranges.join_ranges(extremes, table, "v", "lo", "hi").collect()} == {4}
    with pytest.raises(ValueError, match="lo"):
        ranges.join_ranges(same.withColumnRenamed("k", "lo"), table, "v", "lo", "hi")


def plain_bootstrap(rows, replicates):
    """(n, rate, low, high) of rows (id, label) with the same weights."""
    steps = np.array(segments.poisson_steps())
    b = np.arange(replicates)
    w, wy = np.zeros(replicates), np.zeros(replicates)
    for key, label in rows:
        digest = hashlib.md5(key.encode()).hexdigest()
        s, t, u = (int(digest[8 * k: 8 * k + 8], 16) % segments.PRIME for k in range(3))
        weight = np.searchsorted(steps, (s + t * b + u * b * b) % segments.PRIME, "right")
        w, wy = w + weight, wy + weight * label
    means = wy[w > 0] / w[w > 0]
    low, high = np.percentile(means, [2.5, 97.5]) if len(means) else (None, None)
    return len(rows), sum(y for _, y in rows) / len(rows), low, high


def test_bootstrap_equals_plain_resampling(spark):
    rng = random.Random(3)
    rows = [(f"v{k}", rng.choice(["A", "B", None]), rng.choice(["S", "M", None]), rng.choice([0, 1, 1, None])) for k in range(300)]
    df = spark.createDataFrame(rows, "video_id string, vertical string, tier string, above_baseline int").repartition(3)
    got = segments.bootstrap_rates(df, replicates=200).collect()
    groups: dict = {}
    for key, v, t, y in rows:
        if y is not None:
            for name in ([("vertical", v, None)] * (v is not None) + [("tier", None, t)] * (t is not None)
                         + [("vertical_tier", v, t)] * (v is not None and t is not None)):
                groups.setdefault(name, []).append((key, y))
    assert {(r.level, r.vertical, r.tier) for r in got} == set(groups)
    for r in got:
        n, rate, low, high = plain_bootstrap(groups[(r.level, r.vertical, r.tier)], 200)
        assert r.n == n and np.allclose([r.rate, r.rate_low, r.rate_high], [rate, low, high])
    assert segments.bootstrap_rates(df.limit(0)).count() == 0


def test_weights_are_poisson():
    b = np.arange(1000)
    seeds = np.random.default_rng(0).integers(0, segments.PRIME, (500, 3))
    weight = np.searchsorted(segments.poisson_steps(), (seeds[:, :1] + seeds[:, 1:2] * b + seeds[:, 2:] * b * b) % segments.PRIME, "right")
    assert abs(weight.mean() - 1) < 0.01 and abs(weight.var() - 1) < 0.02


@pytest.mark.parametrize("gone", [["pulsemark/llm", "tests/llm"], ["pulsemark/llm", "tests/llm", "corpus_pipeline.py"]])
def test_entry_without_training_text(folder, gone):
    copy = f"{folder}/copy"
    shutil.copytree(ROOT, copy, ignore=lambda path, names: [
        n for n in names if n in (".git", "__pycache__") or os.path.relpath(os.path.join(path, n), ROOT) in gone])
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(n for n in e.queries() if n[:2] == 'op' or n == 'pipeline'))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split(" ", 1)[1].strip() == "[]"
