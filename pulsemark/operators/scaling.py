"""Standardisation fitted on train and applied to any frame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Scaler:
    """M3: zero mean and unit population deviation; a constant column only loses its mean."""

    columns: list[str] = field(default_factory=list)
    means: dict[str, float] = field(default_factory=dict)
    deviations: dict[str, float] = field(default_factory=dict)

    def fit(self, df: DataFrame, columns: Sequence[str]) -> Scaler:
        self.columns = list(columns)
        row = df.agg(
            *[F.avg(c).alias(f"m_{c}") for c in self.columns],
            *[F.stddev_pop(c).alias(f"s_{c}") for c in self.columns],
        ).first()
        self.means = {c: row[f"m_{c}"] or 0.0 for c in self.columns}
        self.deviations = {c: row[f"s_{c}"] or 1.0 for c in self.columns}
        return self

    def _fitted(self) -> None:
        if not self.columns:
            raise RuntimeError("the scaler is not fitted yet")

    def transform(self, df: DataFrame) -> DataFrame:
        self._fitted()
        return df.withColumns({
            c: (F.col(c) - F.lit(self.means[c])) / F.lit(self.deviations[c]) for c in self.columns
        })

    def inverse(self, df: DataFrame) -> DataFrame:
        self._fitted()
        return df.withColumns({
            c: F.col(c) * F.lit(self.deviations[c]) + F.lit(self.means[c]) for c in self.columns
        })

    def record(self) -> dict:
        """What a saved model keeps."""
        return {"columns": self.columns, "means": self.means, "deviations": self.deviations}
