"""Filling the channel panel from a buffer of candidates."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsemark.constants import (
    BASELINE_POOL, MIN_UPLOADS_PER_WEEK, TIER_TARGETS, VELOCITY_WEEKS,
)
from pulsemark.functions.polls import by_key, ntz, tier_of
from pulsemark.operators.collection import set_flag
from pulsemark.operators.segments import SEGMENT, segment_grid


def _largest(plan: DataFrame) -> int:
    """The most that any segment of the plan needs; a plan has one row per segment."""
    return plan.agg(F.max("needed")).first()[0] or 0


def channel_counts(channels: DataFrame) -> DataFrame:
    """Tracked channels per vertical and tier."""
    return channels.groupBy(*SEGMENT).agg(F.count(F.lit(1)).alias("current"))


def known_ids(channels: DataFrame, candidates: DataFrame) -> DataFrame:
    """Ids already tracked or buffered."""
    return channels.select("channel_id").union(candidates.select("channel_id")).distinct()


def fill_plan(channels: DataFrame, max_per_combo: int = 0) -> DataFrame:
    """How many channels each vertical and tier still needs; ``max_per_combo`` caps it."""
    counted = segment_grid(channels.sparkSession).join(channel_counts(channels), SEGMENT, "left")
    needed = F.greatest(F.lit(0), by_key(TIER_TARGETS, F.col("tier")) - F.col("current"))
    plan = counted.na.fill(0, ["current"]).withColumn(
        "target", by_key(TIER_TARGETS, F.col("tier"))
    ).withColumn("needed", needed)
    if max_per_combo > 0:
        plan = plan.withColumn("needed", F.least("needed", F.lit(max_per_combo)))
    return plan


def upload_velocity(uploads: DataFrame, now: datetime | str) -> DataFrame:
    """Uploads per week over four weeks, among the newest 50 uploads of each channel."""
    at = now if isinstance(now, datetime) else datetime.fromisoformat(now)
    newest = Window.partitionBy("channel_id").orderBy(F.desc("published_at"), "video_id")
    recent = uploads.select("channel_id", "video_id", "published_at").withColumn(
        "_recency", F.row_number().over(newest)
    ).where(F.col("_recency") <= BASELINE_POOL)
    since = ntz(at - timedelta(weeks=VELOCITY_WEEKS))
    return recent.groupBy("channel_id").agg(
        (F.count_if(F.col("published_at") >= since) / VELOCITY_WEEKS).alias("velocity")
    )


def qualify(
    found: DataFrame,
    known: DataFrame,
    uploads: DataFrame,
    plan: DataFrame,
    now: datetime | str,
) -> DataFrame:
    """Unknown channels in a tier's range that upload often enough, at most ``needed`` each.

    The plan's largest number is a literal limit, which drops nothing that the plan asks for and lets
    Spark trim every segment before the shuffle.
    """
    placed = found.withColumn("tier", tier_of(F.col("subscriber_count"))).where("tier is not null")
    unknown = placed.join(known, "channel_id", "left_anti").drop("upload_velocity_per_week")
    paced = unknown.join(upload_velocity(uploads, now), "channel_id").where(
        F.col("velocity") >= by_key(MIN_UPLOADS_PER_WEEK, F.col("tier"))
    )
    order = Window.partitionBy(*SEGMENT).orderBy("discovered_at", "channel_id")
    ranked = paced.withColumn("_rank", F.row_number().over(order)).where(
        F.col("_rank") <= _largest(plan)
    )
    chosen = ranked.join(plan.select(*SEGMENT, "needed"), SEGMENT).where("_rank <= needed")
    return chosen.select(
        "channel_id", "channel_handle", *SEGMENT, "subscriber_count",
        "total_channel_views", "total_channel_videos",
        F.bround("velocity", 2).alias("upload_velocity_per_week"),
        "discovered_at", F.lit(False).alias("added_to_tracking"),
    )


def drain(candidates: DataFrame, plan: DataFrame) -> DataFrame:
    """The oldest unconsumed candidates of each segment, at most ``needed``."""
    order = Window.partitionBy(*SEGMENT).orderBy("discovered_at", "channel_id")
    waiting = candidates.where(~F.col("added_to_tracking")).withColumn(
        "_rank", F.row_number().over(order)
    ).where(F.col("_rank") <= _largest(plan))
    taken = waiting.join(plan.select(*SEGMENT, "needed"), SEGMENT).where("_rank <= needed")
    return taken.select(
        "channel_id", "channel_handle", *SEGMENT, "subscriber_count",
        "total_channel_views", "total_channel_videos", "upload_velocity_per_week",
    )


def mark_consumed(candidates: DataFrame, drained: DataFrame) -> DataFrame:
    """K7, D3: candidates with the drained ones marked as added."""
    return set_flag(candidates, drained, "channel_id", "added_to_tracking")
