"""Channel history: which uploads form it, its medians, and joining them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsemark.constants import BASELINE_KEEP, BASELINE_POOL
from pulsemark.functions.numbers import finite
from pulsemark.operators.quantiles import exact_quantiles

# A group this large is not gathered by the built-in percentile.
HOT_GROUP_ROWS = 200_000
_COUNTED = ("view_count", "like_count", "comment_count")
_MEDIANS = {
    "median_views": "view_count", "median_likes": "like_count",
    "median_comments": "comment_count", "median_engagement_rate": "engagement_rate",
}


def _plain_medians(rated: DataFrame) -> DataFrame:
    return rated.groupBy("channel_id").agg(
        F.max("channel_handle").alias("channel_handle"),
        F.count(F.lit(1)).alias("video_count"),
        *[F.median(source).alias(name) for name, source in _MEDIANS.items()],
    )


def _hot_medians(rated: DataFrame) -> DataFrame:
    sizes = rated.groupBy("channel_id").agg(
        F.max("channel_handle").alias("channel_handle"), F.count(F.lit(1)).alias("video_count")
    )
    long = exact_quantiles(rated, ["channel_id"], list(_MEDIANS.values()), [0.5])
    wide = long.groupBy("channel_id").agg(*[
        F.max(F.when(F.col("feature") == source, F.col("value"))).alias(name)
        for name, source in _MEDIANS.items()
    ])
    return sizes.join(wide, "channel_id", "left")


def channel_medians(videos: DataFrame, hot_group_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """A2: exact medians of a channel's videos; the rate is (likes + comments) / views per video.

    The built-in median holds a group's distinct values in one buffer. That is right for the usual
    channel with tens of uploads; channels over ``hot_group_rows`` take the bracketed way instead,
    whose per-task state stays small. NaN and infinities count as missing in both.
    """
    rated = videos.select(
        "channel_id", "channel_handle", *[finite(F.col(c)).alias(c) for c in _COUNTED],
    ).withColumn("engagement_rate", finite(F.try_divide(
        (F.col("like_count") + F.col("comment_count")).cast("double"), F.col("view_count"))))
    hot = rated.groupBy("channel_id").count().where(F.col("count") > hot_group_rows).select("channel_id")
    if hot.isEmpty():  # the same medians without the second way's passes
        return _plain_medians(rated)
    # Joins drop null keys, so a null channel, which is a group of its own, has a key without the mark.
    marked = F.coalesce(F.concat(F.lit("+"), "channel_id"), F.lit("-"))
    named, hot = rated.withColumn("channel_id", marked), hot.select(marked.alias("channel_id"))
    cold = _plain_medians(named.join(hot, "channel_id", "left_anti"))
    large = _hot_medians(named.join(hot, "channel_id", "left_semi"))
    key = F.col("channel_id")
    return cold.unionByName(large).withColumn("channel_id", F.when(key != "-", F.substr(key, F.lit(2))))


def attach_baselines(wide: DataFrame, medians: DataFrame) -> DataFrame:
    """Left join of the medians, every column but the key prefixed with ``baseline_``.

    No broadcast hint: Spark measures the medians and broadcasts only under its own threshold;
    beyond it the join shuffles and adaptive execution splits a hot channel.
    """
    prefixed = medians.select(
        "channel_id",
        *[F.col(c).alias(f"baseline_{c}") for c in medians.columns if c != "channel_id"],
    )
    return wide.join(prefixed, "channel_id", "left")


def baseline_match_counts(joined: DataFrame) -> DataFrame:
    """How many rows found a channel median."""
    return joined.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count("baseline_video_count").alias("matched_rows"),
    )


def recent_untracked(uploads: DataFrame, tracked: DataFrame) -> DataFrame:
    """Per channel the newest 50 uploads, minus tracked ones, and of these the newest 30.

    Both row-number filters are literal, so Spark limits each group before the shuffle and a channel
    with a third of all uploads sends at most 50 rows per task.
    """
    newest = Window.partitionBy("channel_id").orderBy(F.desc("published_at"), "video_id")
    pool = uploads.withColumn("_recency", F.row_number().over(newest)).where(
        F.col("_recency") <= BASELINE_POOL
    )
    fresh = pool.join(tracked.select("video_id").distinct(), "video_id", "left_anti")
    return (
        fresh.withColumn("_pick", F.row_number().over(newest))
        .where(F.col("_pick") <= BASELINE_KEEP)
        .select(*uploads.columns)
    )


def channels_without_baseline(
    channels: DataFrame, baseline_videos: DataFrame, force: bool = False
) -> DataFrame:
    """Channels with no collected history; ``force`` returns all of them."""
    if force:
        return channels
    return channels.join(baseline_videos.select("channel_id").distinct(), "channel_id", "left_anti")
