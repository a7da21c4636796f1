"""Structural clean-up of the wide table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemark.constants import NON_NEGATIVE_PREFIXES, REQUIRED_MEDIANS, TEXT_COLS
from pulsemark.functions.numbers import finite, floor_at
from pulsemark.functions.text import strip


def clean(df: DataFrame) -> DataFrame:
    """Strip texts, missing tags to an empty list, negative counts to zero.

    NULL texts stay NULL (a deliberate difference: text conversion must not invent the word None).
    """
    changed = {c: strip(F.col(c)) for c in TEXT_COLS if c in df.columns}
    if "tags" in df.columns:
        changed["tags"] = F.coalesce(F.col("tags"), F.array().cast("array<string>"))
    for c in df.columns:
        if c.startswith(tuple(NON_NEGATIVE_PREFIXES)):
            changed[c] = floor_at(F.col(c), 0)
    return df.withColumns(changed)


def drop_bad_baselines(df: DataFrame) -> DataFrame:
    """Keep rows with all four medians known and a non-zero median rate."""
    known = F.lit(True)
    for c in REQUIRED_MEDIANS:
        known = known & F.col(c).isNotNull()
    return df.where(known & (F.col("baseline_median_engagement_rate") != 0.0))


def drop_unassessed(df: DataFrame) -> DataFrame:
    """P10: drop rows whose synthetic-media flag is unknown."""
    return df.dropna(subset=["contains_synthetic_media"])


def only_real(df: DataFrame, real: bool = True) -> DataFrame:
    """Real rows, or synthetic rows with ``real=False``."""
    flag = F.col("contains_synthetic_data")
    return df.where(~flag if real else flag)


def fill_missing(df: DataFrame, value: float = 0, subset: Sequence[str] | None = None) -> DataFrame:
    """NULL, NaN and infinities in numeric and boolean columns become ``value``.

    ``subset`` of None or nothing means every column; booleans become integers first.
    """
    wanted = set(subset) if subset else set(df.columns)
    changed = {}
    for field in df.schema.fields:
        if field.name not in wanted:
            continue
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.BooleanType):
            changed[field.name] = F.coalesce(col.cast("int"), F.lit(int(value)))
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            changed[field.name] = F.coalesce(finite(col), F.lit(float(value)))
        elif isinstance(field.dataType, T.NumericType):
            changed[field.name] = F.coalesce(col, F.lit(value).cast(field.dataType))
    return df.withColumns(changed) if changed else df


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns in table order, without the excluded ones."""
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)
    ]


def varying_columns(df: DataFrame, columns: Sequence[str], minimum: float = 0.01) -> list[str]:
    """Columns whose sample variance exceeds ``minimum``; one pass, one row to the driver."""
    if not columns:
        return []
    row = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] is not None and row[c] > minimum]


def align(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order, missing ones as NULL."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns])
