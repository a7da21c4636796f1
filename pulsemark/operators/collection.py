"""Which videos and channels to poll next, and keeping the tracking table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.constants import CHANNEL_BATCH, DUE_LIMIT, POLL_STAGES, POLL_WINDOWS
from pulsemark.functions.polls import aged_between, hours_between, ntz, poll_label


def label_observations(observations: DataFrame) -> DataFrame:
    """Label by age at poll time and drop what falls outside every window.

    Works on batch and streaming frames alike.
    """
    age = hours_between(F.col("published_at"), F.col("poll_timestamp"))
    return observations.withColumns({
        "hours_since_publish": F.bround(age, 2), "poll_label": poll_label(age)
    }).where("poll_label is not null")


def first_observations(labelled: DataFrame) -> DataFrame:
    """T2 on a batch: the earliest observation per (video_id, poll_label), combined before the shuffle."""
    keys = ["video_id", "poll_label"]
    rest = [c for c in labelled.columns if c not in keys and c != "poll_timestamp"]
    first = labelled.groupBy(*keys).agg(F.min(F.struct("poll_timestamp", *rest)).alias("r"))
    return first.select(*[c if c in keys else F.col(f"r.{c}").alias(c) for c in labelled.columns])


def due_videos(
    tracking: DataFrame,
    channels: DataFrame,
    label: str,
    now: datetime | str,
    limit: int | None = DUE_LIMIT,
) -> DataFrame:
    """Videos in the label's window whose flag is unset and whose earlier flag is set.

    The age test is a range on the stored publish time, so scans prune; the limit is ordered.
    """
    flag, _, needs = POLL_STAGES[label]
    due = ~F.col(flag) & aged_between(F.col("published_at"), now, *POLL_WINDOWS[label])
    if needs:
        due = due & F.col(needs)
    waiting = tracking.where(due).select("video_id", "channel_id", "published_at")
    joined = waiting.join(
        channels.select("channel_id", "channel_handle", "vertical", "tier"), "channel_id"
    )
    if limit is None:
        return joined
    return joined.orderBy("published_at", "video_id").limit(limit)


def new_videos(candidates: DataFrame, tracking: DataFrame, now: datetime | str) -> DataFrame:
    """Candidates fresh enough for the first poll and not yet tracked, as tracking rows."""
    low, high = POLL_WINDOWS["upload"]
    at = ntz(now)
    # As a range on the stored time, which reaches the scan; ages are inclusive at both ends.
    moment = now if isinstance(now, datetime) else datetime.fromisoformat(now)
    first, last = (ntz(moment - timedelta(hours=h)) for h in (high, low))
    fresh = candidates.where(F.col("published_at").between(first, last)).select(
        "video_id", "channel_id", "published_at")
    fresh = fresh.groupBy("video_id").agg(
        F.min("channel_id").alias("channel_id"), F.min("published_at").alias("published_at")
    )
    unknown = fresh.join(tracking.select("video_id"), "video_id", "left_anti")
    return unknown.select(
        "video_id", "channel_id", "published_at", at.alias("first_seen_at"),
        *[F.lit(False).alias(flag) for flag, _, _ in POLL_STAGES.values()],
    )


def sample_channels(channels: DataFrame, n: int = CHANNEL_BATCH, seed: int = 42) -> DataFrame:
    """L1: a seeded random batch; hashing the id makes it the same however the rows are partitioned."""
    place = F.md5(F.concat_ws(":", "channel_id", F.lit(str(seed))).cast("binary"))
    return channels.orderBy(place, "channel_id").limit(n)


def mark_done(tracking: DataFrame, done: DataFrame, label: str) -> DataFrame:
    """K7: set a stage's flag for the given video ids, as a new version of the table."""
    flag = POLL_STAGES[label][0]
    return set_flag(tracking, done, "video_id", flag)


def set_flag(table: DataFrame, ids: DataFrame, key: str, flag: str) -> DataFrame:
    """K7: ``UPDATE .. SET flag = TRUE WHERE key IN (ids)`` as a left join."""
    hit = ids.select(key).distinct().withColumn("_hit", F.lit(True))
    joined = table.join(hit, key, "left").withColumn(
        flag, F.when(F.col("_hit"), F.lit(True)).otherwise(F.col(flag))
    )
    return joined.select(*table.columns)


def distinct_channels(batch: DataFrame) -> DataFrame:
    """U4: the channels of a batch."""
    return batch.select("channel_id").distinct()


def run_report(planned: DataFrame, written: DataFrame) -> DataFrame:
    """Of the channels planned for a run, how many were done and skipped, and the rows written for them.

    Rows of a channel are counted before the join, so a channel with a third of them is one row. A
    channel planned twice counts once; rows of channels that were not planned are in ``rows_elsewhere``.
    """
    rows = written.groupBy("channel_id").agg(F.count(F.lit(1)).alias("n"))
    wanted = planned.where("channel_id is not null").select("channel_id", F.lit(1).alias("planned")).distinct()
    both = wanted.join(rows, "channel_id", "full")
    is_planned = F.col("planned").isNotNull()
    return both.agg(
        F.count("planned").alias("channels_planned"),
        F.count_if(is_planned & F.col("n").isNotNull()).alias("channels_done"),
        F.count_if(F.col("n").isNull()).alias("channels_skipped"),
        F.coalesce(F.sum(F.when(is_planned, F.col("n"))), F.lit(0)).alias("rows_written"),
        F.coalesce(F.sum(F.when(~is_planned, F.col("n"))), F.lit(0)).alias("rows_elsewhere"),
    )


def skipped_channels(planned: DataFrame, written: DataFrame) -> DataFrame:
    """The planned channels for which nothing was written, each once."""
    known = planned.where("channel_id is not null").dropDuplicates(["channel_id"])
    return known.join(written.select("channel_id").distinct(), "channel_id", "left_anti")
