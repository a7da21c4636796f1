"""Health of the collected tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsemark.constants import MIN_COMPLETION_PCT, POLL_STAGES
from pulsemark.functions.polls import older_than
from pulsemark.session import cut


def completion(tracking: DataFrame, now: datetime | str) -> DataFrame:
    """Eligible, completed and missing videos of the three stages, in one pass."""
    sums, rows = [], []
    for i, (stage, (flag, hours, needs)) in enumerate(POLL_STAGES.items()):
        eligible = older_than(F.col("published_at"), now, hours)
        if needs:
            eligible = eligible & F.col(needs)
        sums += [
            F.count_if(eligible).alias(f"e{i}"),
            F.count_if(eligible & F.col(flag)).alias(f"c{i}"),
            F.count_if(eligible & ~F.col(flag)).alias(f"m{i}"),
        ]
        rows.append(f"'{stage}', e{i}, c{i}, m{i}")
    counted = tracking.agg(*sums).selectExpr(
        f"stack({len(rows)}, {', '.join(rows)}) AS (stage, total_eligible, completed, missing)"
    )
    pct = F.round(F.try_divide(F.col("completed"), F.col("total_eligible")) * 100, 1)
    return counted.withColumn("completion_pct", F.coalesce(pct, F.lit(0.0)))


def poll_audit(tracking: DataFrame, snapshots: DataFrame, how: str = "full") -> DataFrame:
    """Tracking rows beside their snapshot counts, one join for every per-video check.

    Snapshots are counted per video first, so a video with a third of all rows is one row here.
    """
    counts = snapshots.where("poll_label is not null").groupBy("video_id").agg(*[
        F.count_if(F.col("poll_label") == stage).alias(f"rows_{stage}") for stage in POLL_STAGES
    ])
    flags = [flag for flag, _, _ in POLL_STAGES.values()]
    known = tracking.select("video_id", "channel_id", "published_at", *flags, F.lit(True).alias("tracked"))
    return known.join(counts, "video_id", how)


def mismatches(tracking: DataFrame, snapshots: DataFrame) -> DataFrame:
    """A stage is flagged done but has no snapshot with its label."""
    audit = poll_audit(tracking, snapshots, "left")
    missing = F.array(*[
        F.when(F.col(flag) & (F.coalesce(F.col(f"rows_{stage}"), F.lit(0)) == 0), F.lit(stage))
        for stage, (flag, _, _) in POLL_STAGES.items()
    ])
    return audit.select(
        F.explode(F.filter(missing, lambda s: s.isNotNull())).alias("stage"),
        "video_id", "channel_id", "published_at",
    )


def mismatch_examples(tracking: DataFrame, snapshots: DataFrame, n: int = 5) -> DataFrame:
    """The first few mismatches, in a fixed order."""
    found = mismatches(tracking, snapshots)
    return found.orderBy("stage", "video_id").limit(n)


def orphans(tracking: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Labelled snapshots of videos with no tracking row, per stage."""
    counts = snapshots.groupBy("video_id", "poll_label").agg(F.count(F.lit(1)).alias("n"))
    lost = counts.join(tracking.select("video_id"), "video_id", "left_anti")
    found = lost.agg(*[
        F.coalesce(F.sum(F.when(F.col("poll_label") == stage, F.col("n"))), F.lit(0)).alias(stage)
        for stage in POLL_STAGES
    ])
    pairs = ", ".join(f"'{stage}', `{stage}`" for stage in POLL_STAGES)
    return found.selectExpr(f"stack({len(POLL_STAGES)}, {pairs}) AS (stage, orphaned_snapshots)")


def missing_baselines(tracking: DataFrame, medians: DataFrame) -> DataFrame:
    """Tracked channels without medians."""
    return tracking.select("channel_id").distinct().join(
        medians.select("channel_id"), "channel_id", "left_anti"
    )


def spot_check(tracking: DataFrame, snapshots: DataFrame, n: int = 5) -> DataFrame:
    """For each stage, the snapshots of the newest videos flagged done.

    One scan of either table: ``n`` tracking rows per stage are found first and, being so few, broadcast.
    The literal row number lets Spark limit each stage before the shuffle.
    """
    metrics = ["hours_since_publish", "view_count", "like_count", "comment_count"]
    stages = F.array(*[F.when(F.col(flag), F.lit(stage)) for stage, (flag, _, _) in POLL_STAGES.items()])
    flagged = tracking.select("video_id", "published_at", F.explode(stages).alias("stage")).where("stage is not null")
    by_age = [F.desc("published_at"), F.asc("video_id")]
    newest = cut(flagged.withColumn(
        "_place", F.row_number().over(Window.partitionBy("stage").orderBy(*by_age))
    ).where(F.col("_place") <= n).drop("_place"))
    polls = snapshots.select("video_id", "poll_label", *metrics).join(
        F.broadcast(newest.select("video_id", F.col("stage").alias("poll_label"))), ["video_id", "poll_label"], "left_semi")
    both = newest.join(polls.withColumn("stage", F.col("poll_label")), ["video_id", "stage"], "left")
    order = by_age + [F.desc_nulls_last(c) for c in metrics]
    ranked = both.withColumn("_place", F.row_number().over(Window.partitionBy("stage").orderBy(*order)))
    return ranked.where(F.col("_place") <= n).select("stage", "video_id", "published_at", "poll_label", *metrics)


def tracking_summary(tracking: DataFrame) -> DataFrame:
    """A5: rows, flags set, and first and last time seen."""
    return tracking.agg(
        F.count(F.lit(1)).alias("total_tracked"),
        F.count_if("upload_poll_done").alias("upload_done"),
        F.count_if("day1_poll_done").alias("day1_done"),
        F.count_if("day7_poll_done").alias("day7_done"),
        F.min("first_seen_at").alias("earliest_tracked"),
        F.max("first_seen_at").alias("latest_tracked"),
    )


def snapshot_volume(snapshots: DataFrame) -> DataFrame:
    """Labelled rows per label with their time range."""
    return snapshots.where("poll_label is not null").groupBy("poll_label").agg(
        F.count(F.lit(1)).alias("snapshot_count"),
        F.min("poll_timestamp").alias("earliest"), F.max("poll_timestamp").alias("latest"),
    )


def warnings(
    tracking: DataFrame, snapshots: DataFrame, medians: DataFrame, now: datetime | str
) -> DataFrame:
    """Every failed check as (check, stage, affected); no row means healthy."""
    done = completion(tracking, now)
    low = done.where(
        (F.col("total_eligible") > 0) & (F.col("completion_pct") < MIN_COMPLETION_PCT)
    ).select(F.lit("completion").alias("check"), "stage", F.col("missing").alias("affected"))

    audit = poll_audit(tracking, snapshots)
    sums, rows = [], []
    for i, (stage, (flag, _, _)) in enumerate(POLL_STAGES.items()):
        seen = F.coalesce(F.col(f"rows_{stage}"), F.lit(0))
        sums += [
            F.count_if(F.col(flag) & (seen == 0)).alias(f"m{i}"),
            F.coalesce(F.sum(F.when(F.col("tracked").isNull(), seen)), F.lit(0)).alias(f"o{i}"),
        ]
        rows += [f"'mismatch', '{stage}', m{i}", f"'orphan', '{stage}', o{i}"]
    found = audit.agg(*sums).selectExpr(
        f"stack({len(rows)}, {', '.join(rows)}) AS (check, stage, affected)"
    ).where("affected > 0")

    bare = missing_baselines(tracking, medians).agg(F.count(F.lit(1)).alias("affected")).select(
        F.lit("missing_baseline").alias("check"), F.lit("all").alias("stage"), "affected"
    ).where("affected > 0")
    return low.unionByName(found).unionByName(bare)


def status(found: DataFrame) -> str:
    """``ok`` or ``warnings``."""
    return "ok" if found.isEmpty() else "warnings"


