"""Rates and counts per vertical and tier."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsemark.constants import TARGET, TIERS, VERTICALS
from pulsemark.functions.polls import by_key

SEGMENT = ["vertical", "tier"]


def label_rates(df: DataFrame) -> DataFrame:
    """Share of videos above their baseline by vertical, by tier and by both, in one pass.

    ``level`` names the grouping; rows without a key are left out of the levels that use it. The interval is the normal approximation of the mean's 95 % interval.
    """
    label = F.col(TARGET).cast("double")
    half = 1.96 * F.stddev_samp(label) / F.sqrt(F.count(label))
    over_vertical, over_tier = F.grouping("vertical") == 1, F.grouping("tier") == 1
    rates = df.groupingSets(
        [["vertical"], ["tier"], SEGMENT], *SEGMENT
    ).agg(
        F.when(over_tier, "vertical").when(over_vertical, "tier").otherwise("vertical_tier").alias("level"),
        F.count(label).alias("n"), F.avg(label).alias("rate"),
        (F.avg(label) - half).alias("rate_low"), (F.avg(label) + half).alias("rate_high"),
    )
    keyed = (F.col("level") == "tier") | F.col("vertical").isNotNull()
    return rates.where(keyed & ((F.col("level") == "vertical") | F.col("tier").isNotNull()))


#: Replicates of a bootstrap, and the modulus of the hashes that draw them.
REPLICATES, PRIME = 1000, (1 << 31) - 1
#: Segments whose sums a task holds at once.
HELD_SEGMENTS = 500


def poisson_steps() -> list[int]:
    """Weight k is drawn by a number below step k and not below step k - 1: the distribution function of Poisson(1)."""
    total, steps = 0.0, []
    for k in range(9):
        total += math.exp(-1) / math.factorial(k)
        steps.append(math.floor(PRIME * total))
    return steps


def bootstrap_rates(df: DataFrame, key: str = "video_id", replicates: int = REPLICATES) -> DataFrame:
    """Label rates by vertical, by tier and by both with a 95 % bootstrap interval, in one pass over the rows.

    In each replicate a row counts as often as a draw from Poisson(1) says, which is what drawing with replacement comes
    to in large segments. The draw of replicate b follows from three numbers s, t, u of the hash of the row's
    key, as (s + t b + u b b) mod PRIME, so that it is the same wherever the row lies. Every task sends two sums per segment
    and replicate. The limits are interpolated percentiles over the replicates that drew a row. Rows without a label are left
    out, and rows without a key of the segment where it is used.
    """
    digest = F.md5(F.col(key).cast("string").cast("binary"))
    seeds = [(F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") % PRIME).alias(f"s{k}") for k in range(3)]
    rows = df.where(F.col(TARGET).isNotNull()).select(*SEGMENT, F.col(TARGET).cast("int").alias("y"), *seeds)
    parts = rows.mapInPandas(_replicated(replicates), "vertical string, tier string, n long, y long, w array<long>, wy array<long>")
    whole = parts.groupingSets([["vertical"], ["tier"], SEGMENT], *SEGMENT).agg(
        F.grouping("vertical").alias("over_vertical"), F.grouping("tier").alias("over_tier"),
        F.sum("n").alias("n"), F.sum("y").alias("y"))
    levels = whole.select("*", F.when(F.col("over_tier") == 1, "vertical").when(
        F.col("over_vertical") == 1, "tier").otherwise("vertical_tier").alias("level"))
    drawn = parts.select(*SEGMENT, F.posexplode(F.arrays_zip("w", "wy")).alias("b", "z")).select(*SEGMENT, "b", "z.w", "z.wy")
    sums = drawn.groupingSets([["vertical", "b"], ["tier", "b"], [*SEGMENT, "b"]], *SEGMENT, "b").agg(
        F.when(F.grouping("tier") == 1, "vertical").when(F.grouping("vertical") == 1, "tier").otherwise(
            "vertical_tier").alias("level"), F.sum("w").alias("w"), F.sum("wy").alias("wy"))
    limits = sums.where("w > 0").groupBy("level", *SEGMENT).agg(
        F.percentile(F.col("wy") / F.col("w"), F.array(F.lit(0.025), F.lit(0.975))).alias("limits"))
    joined = levels.alias("a").join(limits.alias("b"), [
        F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("level", *SEGMENT)], "left")
    used = (F.col("a.level") == "tier") | F.col("a.vertical").isNotNull()
    return joined.where(used & ((F.col("a.level") == "vertical") | F.col("a.tier").isNotNull())).select(
        "a.level", "a.vertical", "a.tier", "n", (F.col("y") / F.col("n")).alias("rate"),
        F.col("limits")[0].alias("rate_low"), F.col("limits")[1].alias("rate_high"))


def _replicated(replicates: int):
    """Per task the rows, positives, and weighted counts of both for each replicate, by segment."""
    steps, b = np.array(poisson_steps()), np.arange(replicates, dtype=np.int64)

    def sent(sums: dict) -> pd.DataFrame:
        rows = [(*(None if k != k else k for k in key), n, y, w.tolist(), wy.tolist()) for key, (n, y, w, wy) in sums.items()]
        return pd.DataFrame(rows, columns=[*SEGMENT, "n", "y", "w", "wy"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.iloc[at: at + 2000]
                s, t, u = (part[f"s{k}"].to_numpy(np.int64)[:, None] for k in range(3))
                weight = np.searchsorted(steps, (s + t * b + u * (b * b)) % PRIME, "right")
                label = part["y"].to_numpy(np.int64)
                codes, keys = pd.MultiIndex.from_frame(part[SEGMENT].astype(object).where(part[SEGMENT].notna(), None)).factorize()
                for k, key in enumerate(keys):
                    here = codes == k
                    old = sums.get(key, (0, 0, np.zeros(replicates, np.int64), np.zeros(replicates, np.int64)))
                    sums[key] = (old[0] + int(here.sum()), old[1] + int(label[here].sum()),
                                 old[2] + weight[here].sum(axis=0), old[3] + label[here] @ weight[here])
            if len(sums) > HELD_SEGMENTS:
                yield sent(sums)
                sums = {}
        if sums:
            yield sent(sums)
    return run


def label_heatmap(df: DataFrame) -> DataFrame:
    """Label rate in percent and rows, verticals down and tiers across."""
    label = F.col(TARGET).cast("double")
    return df.groupBy("vertical").pivot("tier", TIERS).agg(
        (F.avg(label) * 100).alias("pct"), F.count(label).alias("n")
    )


def segment_grid(spark) -> DataFrame:
    """The nine fixed vertical and tier pairs."""
    return spark.createDataFrame([(v, t) for v in VERTICALS for t in TIERS], SEGMENT)


def with_segments(frame: DataFrame | None, base: DataFrame) -> DataFrame:
    """Put vertical and tier back on a frame that lost them, matched by video id.

    A frame that has them, or has no video id to match by, is returned as it is.
    """
    if frame is None:
        raise ValueError("no active frame: run the clean or engineer step first")
    missing = [c for c in SEGMENT if c not in frame.columns and c in base.columns]
    if not missing or "video_id" not in frame.columns:
        return frame
    return frame.join(base.select("video_id", *missing), "video_id", "left")


def split_composition(split: DataFrame) -> DataFrame:
    """Rows and positives of train and test per segment, zero where a segment is empty."""
    def part(name: str, value):
        return F.sum(F.when(F.col("split") == name, value).otherwise(0))

    counts = split.groupBy(*SEGMENT).agg(
        part("train", F.lit(1)).alias("train_total"),
        part("train", F.col(TARGET)).alias("train_above_median"),
        part("test", F.lit(1)).alias("test_total"),
        part("test", F.col(TARGET)).alias("test_above_median"),
    )
    filled = segment_grid(split.sparkSession).join(counts, SEGMENT, "left").na.fill(0)
    return filled.withColumn("total_videos", F.col("train_total") + F.col("test_total"))


def category_distribution(df: DataFrame, column: str, names: dict[int, str]) -> DataFrame:
    """Rows per class code with its name."""
    return df.groupBy(F.col(column).alias("code")).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(column).alias("feature"), by_key(names, F.col("code")).alias("name"), "n"
    )


def target_balance(df: DataFrame) -> DataFrame:
    """Rows per target value and their share."""
    counted = df.groupBy(TARGET).agg(F.count(F.lit(1)).alias("n"))
    # The window runs over the counted rows, one per target value.
    everything = Window.partitionBy(F.lit(0))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(everything))
