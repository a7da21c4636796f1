"""Column and table profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemark.operators.quantiles import exact_quantiles, quantile_columns, unpivot


def _stack(row: DataFrame, names: Sequence[str], head: str) -> DataFrame:
    """One wide row to (head, value) rows."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in names)
    return row.selectExpr(f"stack({len(names)}, {pairs}) AS ({head})", "total_rows")


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with missing values (NULL or NaN), their number and percentage."""
    counts = []
    for f in df.schema.fields:
        missing = F.col(f.name).isNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            missing = missing | F.isnan(f.name)
        counts.append(F.count_if(missing).alias(f.name))
    row = df.agg(F.count(F.lit(1)).alias("total_rows"), *counts)
    return _stack(row, df.columns, "feature, null_count").where("null_count > 0").select(
        "feature", "null_count",
        F.round(F.col("null_count") / F.col("total_rows") * 100, 2).alias("null_pct"),
    )


def duplicate_keys(df: DataFrame, key: str = "video_id") -> DataFrame:
    """Rows, distinct keys and the difference; rows are counted per key before the sum."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("unique_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column."""
    basic = unpivot(df, [], columns).groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quartiles = quantile_columns(
        exact_quantiles(df, [], columns, [0.25, 0.5, 0.75]), ["feature"],
        {0.25: "q25", 0.5: "q50", 0.75: "q75"},
    ).drop("n")
    return basic.join(F.broadcast(quartiles), "feature")


def type_counts(df: DataFrame) -> dict[str, int]:
    """Number of columns per type."""
    counts: dict[str, int] = {}
    for f in df.schema.fields:
        name = f.dataType.simpleString()
        counts[name] = counts.get(name, 0) + 1
    return counts


def iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, 1.5 IQR fences and the rows beyond them, per column."""
    fences = quantile_columns(
        exact_quantiles(df, [], columns, [0.25, 0.75]), ["feature"], {0.25: "q1", 0.75: "q3"}
    ).withColumn("iqr", F.col("q3") - F.col("q1")).withColumns({
        "lower_fence": F.col("q1") - 1.5 * F.col("iqr"),
        "upper_fence": F.col("q3") + 1.5 * F.col("iqr"),
    })
    # At most one row per listed column is broadcast.
    beyond = unpivot(df, [], columns).join(F.broadcast(fences), "feature").groupBy(
        "feature", "n", "q1", "q3", "iqr", "lower_fence", "upper_fence"
    ).agg(F.count_if(
        (F.col("value") < F.col("lower_fence")) | (F.col("value") > F.col("upper_fence"))
    ).alias("n_outliers"))
    return beyond.select(
        "feature",
        *[F.round(c, 3).alias(c) for c in ("q1", "q3", "iqr", "lower_fence", "upper_fence")],
        "n_outliers", F.round(F.col("n_outliers") / F.col("n") * 100, 2).alias("pct_outliers"),
    )


def snapshot_profile(df: DataFrame) -> DataFrame:
    """A snapshot's size and composition as (measure, key, n) rows, in one scan.

    Every listed column is one grouping set. The groups of the two id columns are counted again, which
    gives the distinct ids and the rows.
    """
    ids = {"video_id": "unique_videos", "channel_id": "unique_channels"}
    flags = [c for c in ("contains_synthetic_data",) if c in df.columns]
    breakdown = [c for c in ("poll_label", "vertical", "tier") if c in df.columns] + flags
    columns = [c for c in ids if c in df.columns] + breakdown
    sets = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).groupingSets(
        [[c] for c in columns], *columns
    ).agg(F.count(F.lit(1)).alias("n"), *[F.grouping(c).alias(f"g_{c}") for c in columns])

    measure, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for c in columns:
        measure = F.when(F.col(f"g_{c}") == 0, F.lit(c)).otherwise(measure)
        value = F.when(F.col(f"g_{c}") == 0, F.col(c)).otherwise(value)
    named = sets.select(measure.alias("measure"), value.alias("value"), "n")
    is_id = F.col("measure").isin(*ids)
    counted = named.groupBy(
        "measure", F.when(is_id, F.lit("all")).otherwise(F.col("value")).alias("key")
    ).agg(F.sum("n").alias("n"), F.count("value").alias("groups"))

    def entry(name, key, number):
        return F.struct(name.alias("measure"), key.alias("key"), number.alias("n"))

    every = F.lit("all")
    distinct = F.when(F.col("measure") == "video_id", F.lit(ids["video_id"])).otherwise(F.lit(ids["channel_id"]))
    entries = F.when(is_id, F.array(
        entry(distinct, every, F.col("groups")),
        entry(F.when(F.col("measure") == columns[0], F.lit("total_rows")), every, F.col("n")),
    )).when(F.col("measure").isin(*flags, ""), F.array(
        entry(F.when(F.col("key") == "true", F.lit("synthetic_rows")), every, F.col("n")),
    )).otherwise(F.array(entry(F.col("measure"), F.col("key"), F.col("n"))))
    return counted.select(F.inline(entries)).where("measure is not null and key is not null")


def publish_range(df: DataFrame) -> DataFrame:
    """First and last publish time."""
    return df.agg(
        F.min("published_at").alias("earliest_publish"), F.max("published_at").alias("latest_publish")
    )
