"""Histograms, densities, box statistics and capped tails."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemark.functions.numbers import cap_at, finite
from pulsemark.operators.quantiles import (
    BROADCAST_GROUPS, exact_quantiles, quantile_columns, unpivot,
)
from pulsemark.session import cut

BINS = 40
GRID = 200
GRID_2D = 50


def beside(stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Statistics to join back: broadcast if there is at most one row per listed feature, or if the
    counted number of groups is small; otherwise an ordinary join."""
    if not keys:
        return F.broadcast(stats)
    kept = cut(stats)
    return F.broadcast(kept) if kept.count() <= BROADCAST_GROUPS else kept


def _histogram(long: DataFrame, keys: Sequence[str], bins: int) -> DataFrame:
    group = [*keys, "feature"]
    ends = long.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    # A single-valued feature gets a unit-wide range around its value.
    flat = F.col("lo") == F.col("hi")
    ends = ends.select(
        *group, "total",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    ).withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    ends = beside(ends, keys)
    slot = F.least(F.floor((F.col("value") - F.col("lo")) / F.col("width")) + 1, F.lit(bins))
    counted = long.join(ends, group).groupBy(*group, slot.alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    frame = ends.withColumn("bin", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(bins).cast("long"))))
    full = frame.join(counted, [*group, "bin"], "left").na.fill(0, ["n"])
    return full.select(
        *group, "bin", (F.col("lo") + (F.col("bin") - 1) * F.col("width")).alias("bin_low"), "n",
        (F.col("n") / (F.col("total") * F.col("width"))).alias("density"),
    )


def histogram(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), bins: int = BINS
) -> DataFrame:
    """Equal-width bins per column, empty ones included, the last closed at the maximum."""
    return _histogram(unpivot(df, keys, columns), keys, bins)


def _capped(df: DataFrame, keys: Sequence[str], columns: Sequence[str], p: float) -> DataFrame:
    long = unpivot(df, keys, columns)
    caps = beside(
        exact_quantiles(df, keys, columns, [p]).select(*keys, "feature", F.col("value").alias("cap")),
        keys,
    )
    return long.join(caps, [*keys, "feature"]).select(
        *keys, "feature", F.least("value", "cap").alias("value")
    )


def capped_histogram(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], p: float = 0.99, bins: int = BINS
) -> DataFrame:
    """Histogram per group of values capped at the group's quantile ``p``."""
    return _histogram(_capped(df, keys, columns, p), keys, bins)


def winsorize(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), p: float = 0.99
) -> DataFrame:
    """Cap columns at their quantile ``p``, per group if keys are given."""
    caps = exact_quantiles(df, keys, columns, [p]).groupBy(*keys).agg(*[
        F.max(F.when(F.col("feature") == c, F.col("value"))).alias(f"_cap_{c}") for c in columns
    ])
    if keys:
        joined = df.join(beside(caps, keys), list(keys), "left")
        high = {c: F.col(f"_cap_{c}") for c in columns}
    else:
        row = caps.first()
        joined, high = df, {c: F.lit(row[f"_cap_{c}"]).cast("double") for c in columns}
    return joined.withColumns({
        c: cap_at(F.col(c).cast("double"), high[c]) for c in columns
    }).select(*df.columns)


def kde(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    points: int = GRID,
    cells: int | None = None,
) -> DataFrame:
    """Gaussian density of each column on an even grid from its minimum to its maximum.

    Bandwidth is n^(-1/5) times the sample deviation; groups of fewer than two rows or without
    spread have none. Each task folds its values into one grid per group, so only ``points`` sums per
    group and task are shuffled, and values never are.
    ``cells`` snaps values to that many steps first, for a fast approximate curve.
    """
    group = [*keys, "feature"]
    long = unpivot(df, keys, columns)
    stats = long.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"),
        (F.stddev_samp("value") * F.pow(F.count(F.lit(1)), F.lit(-0.2))).alias("h"),
    ).where("n >= 2 and h > 0")
    placed = long.join(beside(stats, keys), group)
    if cells:
        step = (F.col("hi") - F.col("lo")) / cells
        placed = placed.withColumn("value", F.col("lo") + F.round((F.col("value") - F.col("lo")) / step) * step)
    facts = [*group, "n", "lo", "hi", "h"]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.select(*facts).schema)
    folded = placed.select(*facts, "value").mapInPandas(_folded(facts, points), f"{kept}, masses array<double>")
    total = folded.select(*facts, F.posexplode("masses").alias("i", "mass")).groupBy(*facts, "i").agg(
        F.sum("mass").alias("mass"))
    return total.select(
        *group, "i", (F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / (points - 1)).alias("x"),
        (F.col("mass") / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"))


def _folded(facts: list[str], points: int):
    """Per task one row per group: the kernel sums of its values at every point of the grid."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for key, part in batch.groupby(facts, dropna=False, sort=False):
                lo, hi, h = key[-3:]
                grid = lo + np.arange(points) * (hi - lo) / (points - 1)
                values, times = np.unique(part["value"].to_numpy(), return_counts=True)
                mass = sums.setdefault(key, np.zeros(points))
                for at in range(0, len(values), 2000):
                    z = (grid[:, None] - values[None, at: at + 2000]) / h
                    mass += np.exp(-0.5 * z * z) @ times[at: at + 2000]
        if sums:
            out = pd.DataFrame(list(sums), columns=facts)
            out["masses"] = [m.tolist() for m in sums.values()]
            yield out
    return run


def box_stats(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 IQR, and outliers, per group."""
    quartiles = quantile_columns(
        exact_quantiles(df, keys, [column], [0.25, 0.5, 0.75]), [*keys, "feature"],
        {0.25: "q1", 0.5: "median", 0.75: "q3"},
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    group = [*keys, "feature"]
    return unpivot(df, keys, [column]).join(beside(quartiles, keys), group).groupBy(
        *group, "n", "q1", "median", "q3"
    ).agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def density_2d(
    df: DataFrame, x: str, y: str, key: str, p: float = 0.99, bins: int = BINS
) -> DataFrame:
    """Rows per cell of a two-dimensional grid per class, both axes capped at quantile ``p``."""
    pair = df.select(key, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna(
        subset=["x", "y"]
    )
    capped = winsorize(pair, ["x", "y"], [key], p)
    ends = beside(capped.groupBy(key).agg(*[
        f(c).alias(f"{c}_{end}") for c in ("x", "y") for end, f in (("lo", F.min), ("hi", F.max))
    ]), [key])

    def slot(c: str):
        lo, hi = F.col(f"{c}_lo"), F.col(f"{c}_hi")
        width = F.when(lo == hi, F.lit(1.0)).otherwise(hi - lo) / bins
        return F.least(F.floor((F.col(c) - lo) / width) + 1, F.lit(bins))

    return capped.join(ends, key).groupBy(
        key, slot("x").alias("bin_x"), slot("y").alias("bin_y")
    ).agg(F.count(F.lit(1)).alias("n"))


# Kernel values beyond this many bandwidths are below 3e-18 of a kernel's height.
REACH = 9.0


def _on_nodes(value: Column, lo: Column, hi: Column, steps: Column) -> tuple[Column, Column]:
    """The node before a value on an even grid of ``steps`` steps, and how far behind it the value is."""
    place = (value - lo) / (hi - lo) * steps
    node = F.least(F.floor(place), steps - 1)
    return node, place - node


def _fine(lo: Column, hi: Column, h: Column, points: int, share: float) -> Column:
    """Nodes per step of the grid, so that linear binning errs by at most ``share`` of a kernel's height."""
    return F.greatest(F.ceil((hi - lo) / (h * ((points - 1) * math.sqrt(8 * share)))), F.lit(1))


def _convolved(nodes: DataFrame, axis: str, points: int, by: Sequence[str]) -> DataFrame:
    """Each node's mass spread over the grid points in reach along one axis, and summed per point.

    Needs columns j (node), w (mass), and lo, hi, h, fine of the axis; gives i and w.
    """
    j, lo, hi, h, fine = (F.col(f"{c}{axis}") for c in ("j", "lo", "hi", "h", "fine"))
    step = (hi - lo) / (points - 1)
    at, reach = j / fine, REACH * h / step
    first, last = F.greatest(F.ceil(at - reach), F.lit(0)), F.least(F.floor(at + reach), F.lit(points - 1))
    spread = nodes.where(first <= last).withColumn(f"i{axis}", F.explode(F.sequence(first, last)))
    z = (F.col(f"i{axis}") - at) * step / h
    return spread.groupBy(*by, f"i{axis}").agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("w"))


def binned_kde(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), points: int = GRID, share: float = 1e-3
) -> DataFrame:
    """A17, A18 at scale: ``kde`` by linear binning, then a convolution of nodes with grid points.

    A value gives its mass to the two nodes around it. A kernel's linear interpolation errs by at most
    step^2 / 8 times its second derivative, so no density is further than ``error_bound`` from the
    exact sum; nodes are as fine as ``share`` asks. After the binning, which combines before its
    shuffle, work depends on the nodes alone. Groups of fewer than two rows or without spread have none.
    """
    group = [*keys, "feature"]
    long = unpivot(df, keys, columns)
    lo, hi, h, fine = (F.col(c) for c in ("lo", "hi", "h", "fine"))
    stats = long.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"),
        (F.stddev_samp("value") * F.pow(F.count(F.lit(1)), F.lit(-0.2))).alias("h"),
    ).where("n >= 2 and h > 0").withColumn("fine", _fine(lo, hi, h, points, share))
    stats = beside(stats, keys)
    node, behind = _on_nodes(F.col("value"), lo, hi, fine * (points - 1))
    facts = [*group, "n", "lo", "hi", "h", "fine"]
    cells = long.join(stats, group).groupBy(*facts, node.alias("node")).agg(
        F.count(F.lit(1)).alias("c"), F.sum(behind).alias("s"))
    nodes = cells.select(*facts, F.explode(F.array(
        F.struct(F.col("node").alias("j"), (F.col("c") - F.col("s")).alias("w")),
        F.struct((F.col("node") + 1).alias("j"), F.col("s").alias("w")))).alias("m")).select(*facts, "m.*")
    found = _convolved(nodes, "", points, group)
    frame = stats.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))))
    step = (hi - lo) / (points - 1)
    root = math.sqrt(2 * math.pi)
    return frame.join(found, [*group, "i"], "left").select(
        *group, "i", (lo + F.col("i") * step).alias("x"),
        (F.coalesce("w", F.lit(0.0)) / (F.col("n") * h * root)).alias("density"),
        (F.pow(step / fine / h, F.lit(2)) / (8 * root) / h).alias("error_bound"))


def kde_2d(
    df: DataFrame, x: str, y: str, keys: Sequence[str], p: float = 0.99, points: int = GRID_2D,
    margin: float = 3.0, share: float = 5e-3,
) -> DataFrame:
    """Gaussian product-kernel density of a pair per group, both axes capped at quantile ``p``.

    Bandwidths are n^(-1/6) times the deviation of each axis; the grid reaches ``margin`` bandwidths
    beyond the values. Values give their mass to the four nodes around them, and the convolution is
    done along one axis after the other. ``error_bound`` limits the distance to the exact sum
    (``share`` of a kernel's height per axis). Rows with a missing value, groups of fewer than two
    rows and groups without spread on an axis have no density.
    """
    keys = list(keys)
    pair = df.select(*keys, finite(F.col(x).cast("double")).alias("x"), finite(F.col(y).cast("double")).alias("y"))
    capped = winsorize(pair.dropna(subset=["x", "y"]), ["x", "y"], keys, p)
    count = F.count(F.lit(1))
    stats = capped.groupBy(*keys).agg(count.alias("n"), *[
        f.alias(f"{name}_{c}") for c in ("x", "y") for name, f in (
            ("lo", F.min(c)), ("hi", F.max(c)), ("h", F.stddev_samp(c) * F.pow(count, F.lit(-1 / 6))))
    ]).where("n >= 2 and h_x > 0 and h_y > 0")
    for c in ("_x", "_y"):
        lo, hi, h = (F.col(f"{e}{c}") for e in ("lo", "hi", "h"))
        stats = stats.withColumns({f"lo{c}": lo - margin * h, f"hi{c}": hi + margin * h}).withColumn(
            f"fine{c}", _fine(lo, hi, h, points, share))
    stats = beside(stats, keys)
    facts = [*keys, "n", *[f"{e}_{c}" for c in ("x", "y") for e in ("lo", "hi", "h", "fine")]]
    (node_x, a), (node_y, b) = (
        _on_nodes(F.col(c), F.col(f"lo_{c}"), F.col(f"hi_{c}"), F.col(f"fine_{c}") * (points - 1)) for c in ("x", "y"))
    cells = capped.join(stats, keys).groupBy(*facts, node_x.alias("cx"), node_y.alias("cy")).agg(
        F.sum((1 - a) * (1 - b)).alias("w00"), F.sum((1 - a) * b).alias("w01"),
        F.sum(a * (1 - b)).alias("w10"), F.sum(a * b).alias("w11"))
    nodes = cells.select(*facts, F.explode(F.array(*[
        F.struct((F.col("cx") + i).alias("j_x"), (F.col("cy") + j).alias("j_y"), F.col(f"w{i}{j}").alias("w"))
        for i in (0, 1) for j in (0, 1)])).alias("m")).select(*facts, "m.*")
    nodes = nodes.groupBy(*facts, "j_x", "j_y").agg(F.sum("w").alias("w"))
    along = _convolved(nodes, "_x", points, [*facts, "j_y"])
    both = _convolved(along, "_y", points, [*facts, "i_x"]).select(*keys, "i_x", "i_y", "w")
    every = F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))
    frame = stats.withColumn("i_x", F.explode(every)).withColumn("i_y", F.explode(every))
    step = {c: (F.col(f"hi_{c}") - F.col(f"lo_{c}")) / (points - 1) for c in ("x", "y")}
    height = 1 / (2 * math.pi * F.col("h_x") * F.col("h_y"))
    curved = sum(F.pow(step[c] / F.col(f"fine_{c}") / F.col(f"h_{c}"), F.lit(2)) / 8 for c in ("x", "y"))
    return frame.join(both, [*keys, "i_x", "i_y"], "left").select(
        *keys, "n", "h_x", "h_y", "i_x", "i_y",
        *[(F.col(f"lo_{c}") + F.col(f"i_{c}") * step[c]).alias(c) for c in ("x", "y")],
        (F.coalesce("w", F.lit(0.0)) * height / F.col("n")).alias("density"), (curved * height).alias("error_bound"))
