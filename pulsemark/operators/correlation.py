"""Pearson correlations of many columns in two scans."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.constants import TARGET
from pulsemark.operators.cleaning import numeric_columns, varying_columns

_MOMENTS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Moment sums of every column pair over rows where both are known.

    Each task folds its rows into one small matrix per moment and emits a row per pair, so the
    shuffle carries pairs per task whatever the row count. Values are centred on the overall means
    first, which keeps sums of large counts exact enough to subtract.
    """
    columns = list(columns)
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).first()
    centre = np.array([means[c] or 0.0 for c in columns])
    lower_a, lower_b = np.tril_indices(len(columns), -1)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            values = batch.to_numpy(dtype="float64") - centre
            known = np.isfinite(values)
            x, m = np.where(known, values, 0.0), known.astype("float64")
            square = x * x
            part = np.stack([m.T @ m, x.T @ m, m.T @ x, square.T @ m, m.T @ square, x.T @ x])
            total = part if total is None else total + part
        if total is not None:
            picked = {name: total[i][lower_a, lower_b] for i, name in enumerate(_MOMENTS)}
            yield pd.DataFrame({"a": lower_a.astype("int32"), "b": lower_b.astype("int32"), **picked})

    typed = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    schema = "a int, b int, " + ", ".join(f"{m} double" for m in _MOMENTS)
    parts = typed.mapInPandas(fold, schema)
    names = F.array(*[F.lit(c) for c in columns])
    summed = parts.groupBy("a", "b").agg(*[F.sum(m).alias(m) for m in _MOMENTS])
    return summed.select(
        F.element_at(names, F.col("a") + 1).alias("feature_a"),
        F.element_at(names, F.col("b") + 1).alias("feature_b"), *_MOMENTS,
    )


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Lower triangle of the Pearson matrix; columns of low variance drop out first.

    A pair without spread on its common rows has NULL.
    """
    wanted = list(columns) if columns is not None else numeric_columns(df)
    moments = pair_moments(df, varying_columns(df, wanted))
    c = F.col
    spread_x = c("sxx") - c("sx") * c("sx") / c("n")
    spread_y = c("syy") - c("sy") * c("sy") / c("n")
    shared = c("sxy") - c("sx") * c("sy") / c("n")
    return moments.where("n > 0").select(
        "feature_a", "feature_b", c("n").cast("long").alias("n"),
        F.try_divide(
            shared, F.sqrt(F.greatest(spread_x, F.lit(0.0)) * F.greatest(spread_y, F.lit(0.0)))
        ).alias("r"),
    )


def target_correlations(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Correlation of every feature with the target; sort by absolute value to check leakage."""
    found = correlations(df).where((F.col("feature_a") == target) | (F.col("feature_b") == target))
    other = F.when(F.col("feature_a") == target, F.col("feature_b")).otherwise(F.col("feature_a"))
    return found.select(other.alias("feature"), "n", "r")


def correlation_shift(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlations of all rows beside those of real rows only."""
    kept = varying_columns(df.where(~F.col("contains_synthetic_data")), columns)
    mixed = correlations(df, kept).select("feature_a", "feature_b", F.col("r").alias("r_mixed"))
    real = correlations(df.where(~F.col("contains_synthetic_data")), kept).select(
        "feature_a", "feature_b", F.col("r").alias("r_real")
    )
    # At most one row per column pair on either side.
    return mixed.join(F.broadcast(real), ["feature_a", "feature_b"]).withColumn(
        "shift", F.col("r_mixed") - F.col("r_real")
    )
