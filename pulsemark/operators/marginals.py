"""Distribution families fitted to columns from moments, the nearest one by Kolmogorov-Smirnov.

Two passes of aggregations give the moments; the statistic compares each family with the exact empirical
distribution over all rows. Ranks are running totals over ordered buckets of values, so that no task
sorts a whole column, and a repeated value is one row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemark.operators.quantiles import unpivot
from pulsemark.session import cut

FAMILIES = ["exponential", "gumbel", "laplace", "logistic", "lognormal", "normal", "uniform"]
# A column without spread has this family and a statistic of 0.
CONSTANT = "constant"
BUCKET_ROWS = 500_000
MAX_BUCKETS = 2_000
_EULER = 0.5772156649015329


def _exp(x: Column) -> Column:
    """exp without overflow: beyond 700 either way nothing changes in a probability."""
    return F.exp(F.greatest(F.least(x, F.lit(700.0)), F.lit(-700.0)))


def normal_cdf(z: Column) -> Column:
    """The normal distribution by the five-term formula for erf, whose error is below 1e-7."""
    a = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * a)
    # Fixed values of the formula.
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    tail = poly * _exp(-a * a) / 2
    return F.when(z >= 0, 1 - tail).otherwise(tail)


def cdf(family: str, v: Column) -> Column:
    """A family's distribution function at ``v`` from the moments m, s, a, lm, ls beside it."""
    m, s, a, lm, ls = (F.col(c) for c in ("m", "s", "a", "lm", "ls"))
    if family == "normal":
        return normal_cdf((v - m) / s)
    if family == "lognormal":
        return F.when(ls > 0, normal_cdf((F.log(1 + v - a) - lm) / ls)).otherwise(F.lit(1.0))
    if family == "uniform":
        return F.greatest(F.least((v - m) / (2 * math.sqrt(3) * s) + 0.5, F.lit(1.0)), F.lit(0.0))
    if family == "exponential":
        return 1 - _exp((a - v) / (m - a))
    if family == "logistic":
        return 1 / (1 + _exp((m - v) * (math.pi / math.sqrt(3)) / s))
    if family == "laplace":
        tail = _exp(-F.abs(v - m) * math.sqrt(2) / s) / 2
        return F.when(v >= m, 1 - tail).otherwise(tail)
    if family == "gumbel":
        scale = s * (math.sqrt(6) / math.pi)
        return _exp(-_exp((m - _EULER * scale - v) / scale))
    raise ValueError(f"unknown family {family}")


def quantile(family: str, fit: dict, shares: np.ndarray) -> np.ndarray:
    """The family's quantiles, kept within the seen range."""
    m, s, a, b, lm, ls = (fit[c] for c in ("m", "s", "a", "b", "lm", "ls"))
    p = np.clip(shares, 1e-9, 1 - 1e-9)
    if family == CONSTANT:
        return np.full(len(p), a)
    if family in ("normal", "lognormal"):
        z = np.array([NormalDist().inv_cdf(q) for q in p])
        out = m + s * z if family == "normal" else a - 1 + np.exp(np.minimum(lm + ls * z, 700.0))
    elif family == "uniform":
        out = m + (p - 0.5) * 2 * math.sqrt(3) * s
    elif family == "exponential":
        out = a - (m - a) * np.log1p(-p)
    elif family == "logistic":
        out = m + s * math.sqrt(3) / math.pi * np.log(p / (1 - p))
    elif family == "laplace":
        out = m - np.sign(p - 0.5) * s / math.sqrt(2) * np.log1p(-2 * np.abs(p - 0.5))
    elif family == "gumbel":
        scale = s * math.sqrt(6) / math.pi
        out = m - _EULER * scale - scale * np.log(-np.log(p))
    else:
        raise ValueError(f"unknown family {family}")
    return np.clip(out, a, b)


def _ranked(long: DataFrame, largest: int) -> DataFrame:
    """Distinct values with their rows (c) and the rows of smaller values (before), per feature."""
    buckets = min(MAX_BUCKETS, max(1, -(-largest // BUCKET_ROWS)))
    counted = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c"))
    if buckets == 1:
        order = Window.partitionBy("feature").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
        return counted.withColumn("before", F.coalesce(F.sum("c").over(order), F.lit(0)))
    shares = [i / buckets for i in range(1, buckets)]
    ends = long.groupBy("feature").agg(F.percentile_approx("value", shares, 10 * buckets).alias("ends"))
    placed = cut(counted.join(F.broadcast(ends), "feature").select(
        "feature", "value", "c", F.size(F.filter("ends", lambda e: e < F.col("value"))).alias("bucket")))
    earlier = Window.partitionBy("feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("feature", "bucket").agg(F.sum("c").alias("s")).select(
        "feature", "bucket", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("feature", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(F.broadcast(offsets), ["feature", "bucket"]).select(
        "feature", "value", "c", (F.col("offset") + F.coalesce(F.sum("c").over(inside), F.lit(0))).alias("before"))


def fitted(rows: DataFrame, columns: Sequence[str], families: Sequence[str] = FAMILIES) -> DataFrame:
    """Per column and family: moments, the statistic ``ks`` and whether the family is ``chosen``.

    Families are fitted by moments: mean m and deviation s, the least value a, and mean and deviation
    (lm, ls) of log(1 + value - a) for the lognormal. The statistic is the largest distance to the
    empirical distribution on both sides of every distinct value. The smallest one is chosen,
    the first by name of equal ones. Missing values are left out; a column without spread is one
    row, ``constant``; a column without values has no row.
    """
    long = unpivot(rows, [], columns)
    moments = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("m"), F.stddev_samp("value").alias("s"),
        F.min("value").alias("a"), F.max("value").alias("b"))
    logs = long.join(F.broadcast(moments.select("feature", "a")), "feature").groupBy("feature").agg(
        F.avg(F.log(1 + F.col("value") - F.col("a"))).alias("lm"),
        F.stddev_samp(F.log(1 + F.col("value") - F.col("a"))).alias("ls"))
    # At most one row per listed column from here on.
    stats = cut(moments.join(logs, "feature").na.fill(0.0, ["s", "ls"]))
    largest = stats.agg(F.max("n")).first()[0] or 0
    spread = stats.where("a < b")
    low, high = F.col("before") / F.col("n"), (F.col("before") + F.col("c")) / F.col("n")
    distances = _ranked(long, largest).join(F.broadcast(spread), "feature").groupBy("feature").agg(*[
        F.max(F.greatest(high - cdf(f, F.col("value")), cdf(f, F.col("value")) - low)).alias(f) for f in families])
    told = distances.unpivot("feature", list(families), "family", "ks").join(F.broadcast(stats), "feature")
    flat = stats.where("a = b").select("feature", F.lit(CONSTANT).alias("family"), F.lit(0.0).alias("ks"),
                                       *stats.columns[1:])
    nearest = Window.partitionBy("feature").orderBy("ks", "family")
    return told.unionByName(flat).withColumn("chosen", F.row_number().over(nearest) == 1)


def chosen_grids(rows: DataFrame, columns: Sequence[str], points: int) -> dict[str, np.ndarray]:
    """Quantiles of each column's chosen family at even shares; one row per column reaches the driver."""
    shares = np.linspace(0.0, 1.0, points)
    best = {r.feature: r for r in fitted(rows, columns).where("chosen").collect()}
    return {c: quantile(best[c].family, best[c].asDict(), shares) if c in best else np.zeros(points) for c in columns}
