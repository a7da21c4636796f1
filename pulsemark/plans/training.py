"""The whole run: tables to clean rows, features, split, augmentation, models and validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.operators.features import feature_columns
from pulsemark.operators.learners import Entry, train, tune, validate
from pulsemark.operators.synthetic import append_to_train, generate, read_by_generate, rows_needed
from pulsemark.plans.dataset import build_clean, engineer
from pulsemark.session import cut


def augment(split: DataFrame, target_real_pct: float, seed: int = 42) -> DataFrame:
    """Synthetic rows, engineered like real ones, added to train; nothing if none are needed.

    Of the train rows only the columns that generating reads are stored again, no texts.
    """
    real = split.where("split = 'train'").drop("split")
    read = cut(real.select(*read_by_generate(real)))
    n = rows_needed(read.count(), target_real_pct)
    if n <= 0:
        return split.withColumn("contains_synthetic_data", F.lit(False))
    made = cut(generate(read, n, seed, schema=real.schema))
    return append_to_train(split, engineer(made).withColumn("contains_synthetic_data", F.lit(True)))


def full_run(
    snapshots: DataFrame,
    medians: DataFrame,
    holdout_ids: DataFrame,
    params: Mapping[str, Mapping] | None = None,
    target_real_pct: float | None = None,
    tune_with: Mapping | None = None,
    kinds: Sequence[str] = ("lr_l1", "rf", "gbt", "ensemble"),
    seed: int = 42,
) -> tuple[dict[str, Entry], dict[str, dict], DataFrame]:
    """Fitted entries, their holdout metrics, and the split table they came from."""
    from pulsemark.operators.splits import split as split_rows

    rows = cut(engineer(build_clean(snapshots, medians)))
    divided = split_rows(rows, holdout_ids, seed)
    if target_real_pct is not None:
        divided = augment(divided, target_real_pct, seed)
    else:
        divided = divided.withColumn("contains_synthetic_data", F.lit(False))
    divided = cut(divided)
    columns = feature_columns(rows)
    parts = {name: divided.where(F.col("split") == name) for name in ("train", "test", "val")}
    chosen = dict(params or {})
    if tune_with is not None:
        for kind in ("lr_l1", "rf", "gbt"):
            chosen[kind] = tune(kind, parts["train"], columns, seed=seed, **tune_with)["best_params"]
    entries = train(parts["train"], parts["test"], columns, chosen, seed, kinds)
    return entries, validate(entries, parts["val"]), divided
