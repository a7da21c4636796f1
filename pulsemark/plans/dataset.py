"""Clean table and modelling table, each one lazy plan."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from pulsemark.operators.baselines import attach_baselines
from pulsemark.operators.cleaning import clean, drop_bad_baselines, fill_missing
from pulsemark.operators.features import add_encodings, derive_features
from pulsemark.operators.polls import pivot_parts, with_late


def build_clean(
    snapshots: DataFrame,
    medians: DataFrame,
    static_cols: Sequence[str] | None = None,
    metric_cols: Sequence[str] | None = None,
    texts: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Poll rows and channel medians to one clean row per complete video; medians are joined before texts.

    ``texts`` adds the texts to poll rows that lack them, as in ``pivot_parts``.
    """
    wide, late, columns = pivot_parts(snapshots, static_cols, metric_cols, texts)
    if "channel_id" not in wide.columns:  # it ranks behind the texts
        return clean(attach_baselines(with_late(wide, late, columns), medians))
    joined = attach_baselines(wide, medians)
    return clean(joined if late is None else with_late(joined, late, columns))


def engineer(clean_table: DataFrame) -> DataFrame:
    """Clean rows to model rows: drop bad baselines, derive, encode, fill."""
    kept = drop_bad_baselines(clean_table)
    return fill_missing(add_encodings(derive_features(kept)))
