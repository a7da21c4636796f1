"""Named queries over a folder of the driver's tables.

Every query reads whole tables. Doubles are rounded so that another engine's results can be compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemark import constants as C
from pulsemark.functions import polls as P
from pulsemark.functions.images import read_thumbnails, write_images
from pulsemark.operators import baselines, boosting, cleaning, collection, correlation, discovery, distributions
from pulsemark.operators import evaluate, features, health, learners, polls, profile, segments, splits
from pulsemark.operators import forest, marginals, quantiles, ranges, synthetic
from pulsemark.operators.scaling import Scaler
from pulsemark.plans import fixtures as X
from pulsemark.plans.dataset import build_clean, engineer
from pulsemark.plans.training import augment
from pulsemark.session import cut, shared_dir
from pulsemark.schemas import VIDEOS_TO_TRACK
from pulsemark.sources import holdout_store, model_store, raw_items, snapshots as snapshot_store, tables, tracking_store
from pulsemark.streaming import collector

HEALTH_NOW = "2001-08-15 00:00:00"
DUE_NOW = "1998-11-18 14:00:00"
VELOCITY_NOW = "2024-02-25 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_NO_TEXT = [c for c in C.STATIC_COLS + C.THUMBNAIL_COLS if c not in ("title", "description", "tags")]
COUNTS = [f"{c}_{p}" for p in C.POLL_LABELS for c in C.METRIC_COLS]
HOURS = [f"hours_since_publish_{p}" for p in C.POLL_LABELS]
MEDIANS = ["median_views", "median_likes", "median_comments", "median_engagement_rate"]
VELOCITY = [f"{m}_velocity_24h" for m in C.METRIC_COLS] + [
    "view_velocity_upload", "like_velocity_upload", "view_velocity_per_sub_24h",
    "like_velocity_per_sub_24h", "view_velocity_ratio", "view_velocity_acceleration",
    "like_velocity_acceleration",
]
RATIOS = [
    "view_count_upload_vs_baseline", "like_count_upload_vs_baseline", "like_rate_upload", "like_rate_24h",
]
PER_SUB = [f"{m}s_per_sub_{p}" for p in C.POLL_LABELS for m in ("view", "like", "comment")]
TEXT = ["title_length", "title_word_count", "desc_length", "desc_link_count", "desc_hashtag_count"]
TIME = ["publish_hour", "publish_dayofweek", "publish_is_weekend"]
DURATION = ["is_short", "is_long", "duration_bucket"]
ENCODED = ["tier_encoded"] + [f"vertical_{v}" for v in C.VERTICALS]
# Every numeric column of the model rows, without the excluded ones and with the target for correlations.
PROFILED = [
    c for c in [*COUNTS, *HOURS, *[f"baseline_{c}" for c in ["video_count", *MEDIANS]], "duration_seconds", "face_count",
                "brightness", "colorfulness", "engagement_7d", "baseline_engagement", C.TARGET, *VELOCITY, *RATIOS, *PER_SUB]
    if c not in C.NOT_PROFILED
]
CORRELATED = [*PROFILED, C.TARGET]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tidy(df: DataFrame, *columns: str, places: int = 6, **special: int) -> DataFrame:
    """Select columns; doubles rounded, integers widened."""
    out = []
    for name in columns or df.columns:
        kind = df.schema[name].dataType
        col = F.col(name)
        if isinstance(kind, (T.DoubleType, T.DecimalType)):
            col = F.round(col.cast("double"), special.get(name, places))
        elif isinstance(kind, T.IntegralType):
            col = col.cast("long")
        out.append(col.alias(name))
    return df.select(*out)


def medians(spark: SparkSession, d: str) -> DataFrame:
    return baselines.channel_medians(X.baseline_videos(spark, d))


def numeric_clean(spark: SparkSession, d: str) -> DataFrame:
    """Clean wide rows without texts; nothing textual enters the shuffle."""
    return build_clean(X.labelled(spark, d, with_text=False), medians(spark, d), _NO_TEXT)


def full_clean(spark: SparkSession, d: str) -> DataFrame:
    rows, texts = X.labelled_parts(spark, d)
    return build_clean(rows, medians(spark, d), texts=texts)


def numeric_rows(spark: SparkSession, d: str) -> DataFrame:
    """Model rows with target and numeric features only."""
    rows = cleaning.drop_bad_baselines(numeric_clean(spark, d))
    for step in (features.add_target, features.add_velocity, features.add_ratios, features.add_per_subscriber):
        rows = rows.transform(step)
    return rows


def target_rows(spark: SparkSession, d: str) -> DataFrame:
    return features.add_target(cleaning.drop_bad_baselines(numeric_clean(spark, d)))


def profile_rows(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """A narrow numeric projection, written once because profiles read it more than once."""
    return cut(numeric_rows(spark, d).select(*columns))


# --- flagship -------------------------------------------------------------------------------
@query
def entry_label_rates(spark, d):
    return tidy(segments.label_rates(target_rows(spark, d)))


@query
def label_rates_bootstrap(spark, d):
    """Label rates with bootstrap intervals."""
    return tidy(segments.bootstrap_rates(target_rows(spark, d)), places=9)


@query
def label_heatmap(spark, d):
    return tidy(segments.label_heatmap(target_rows(spark, d)))


# --- polls and clean-up ---------------------------------------------------------------------
@query
def triplet_counts(spark, d):
    return tidy(polls.triplet_counts(X.labelled(spark, d, with_text=False)))


@query
def latest_poll(spark, d):
    return tidy(
        polls.latest_polls(X.labelled(spark, d, with_text=False)), "video_id", "poll_label", *C.METRIC_COLS,
        "hours_since_publish", "brightness", "colorfulness",
    )


@query
def pivot_wide(spark, d):
    wide = polls.pivot_polls(X.labelled(spark, d, with_text=False))
    return tidy(wide, "video_id", "channel_id", "category_name", "duration_seconds", "face_count", *COUNTS,
                *HOURS, "brightness", "colorfulness")


@query
def pivot_multiplicity(spark, d):
    return polls.pivot_multiplicity(X.labelled(spark, d, with_text=False))


@query
def baseline_medians(spark, d):
    return tidy(medians(spark, d))


@query
def baseline_join(spark, d):
    wide = polls.pivot_polls(X.labelled(spark, d, with_text=False), ["channel_id"], ["view_count"])
    joined = baselines.attach_baselines(wide, medians(spark, d))
    return tidy(joined, "video_id", "channel_id", "baseline_video_count", *[f"baseline_{m}" for m in MEDIANS])


@query
def baseline_match(spark, d):
    wide = polls.pivot_polls(X.labelled(spark, d, with_text=False), ["channel_id"], ["view_count"])
    return baselines.baseline_match_counts(baselines.attach_baselines(wide, medians(spark, d)))


@query
def clean_table(spark, d):
    rows = full_clean(spark, d).withColumn("tag_count", F.size("tags"))
    return tidy(rows, "video_id", "channel_handle", "title", "description", "tag_count", *COUNTS)


@query
def drop_bad_baselines(spark, d):
    return cleaning.drop_bad_baselines(numeric_clean(spark, d)).select("video_id", "channel_id")


@query
def assessed_only(spark, d):
    kept = cleaning.drop_unassessed(X.labelled(spark, d, with_text=False))
    return kept.groupBy("poll_label").agg(F.count(F.lit(1)).alias("n"))


@query
def fill_missing(spark, d):
    wanted = ["baseline_median_views", "baseline_video_count", "contains_synthetic_media"]
    filled = cleaning.fill_missing(numeric_clean(spark, d), -999, wanted)
    return tidy(filled, "video_id", *wanted)


# --- features -------------------------------------------------------------------------------
@query
def target(spark, d):
    return tidy(target_rows(spark, d), "video_id", "engagement_7d", "baseline_engagement", "above_baseline")


@query
def velocity(spark, d):
    rows = features.add_velocity(cleaning.drop_bad_baselines(numeric_clean(spark, d)))
    return tidy(rows, "video_id", *VELOCITY)


@query
def ratios(spark, d):
    rows = features.add_ratios(cleaning.drop_bad_baselines(numeric_clean(spark, d)))
    return tidy(rows, "video_id", *RATIOS)


@query
def per_sub(spark, d):
    rows = features.add_per_subscriber(cleaning.drop_bad_baselines(numeric_clean(spark, d)))
    return tidy(rows, "video_id", *PER_SUB)


def _texts(spark, d):
    return cleaning.clean(X.texts(spark, d).withColumn(
        "video_id", F.concat(F.lit("v"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
    ))


@query
def title_category(spark, d):
    return tidy(features.add_text_classes(_texts(spark, d)), "video_id", "title_category")


@query
def desc_category(spark, d):
    return tidy(features.add_text_classes(_texts(spark, d)), "video_id", "desc_category")


@query
def text_features(spark, d):
    return tidy(features.add_text_features(_texts(spark, d)), "video_id", *TEXT, "tag_count", "has_tags")


@query
def temporal(spark, d):
    return tidy(features.add_publish_time(X.videos(spark, d)), "video_id", *TIME)


@query
def duration(spark, d):
    return tidy(features.add_duration(X.timed_videos(spark, d)), "video_id", *DURATION)


@query
def parse_duration(spark, d):
    return tidy(X.timed_videos(spark, d), "video_id", "duration_seconds")


@query
def category_name(spark, d):
    return X.timed_videos(spark, d).groupBy("category_id", "category_name").agg(F.count(F.lit(1)).alias("n"))


@query
def encode(spark, d):
    rows = cleaning.fill_missing(features.add_encodings(X.channels(spark, d)), 0, ENCODED)
    return tidy(rows, "channel_id", *ENCODED)


@query
def thumbnail(spark, d):
    wide = polls.pivot_polls(X.labelled(spark, d, with_text=False), ["face_count"], ["view_count"])
    return tidy(features.add_thumbnail(wide), "video_id", "has_face")


@query
def engineered(spark, d):
    rows = engineer(full_clean(spark, d))
    return tidy(
        rows, "video_id", "duration_seconds", *COUNTS, "brightness", "colorfulness", *VELOCITY, *RATIOS,
        *PER_SUB, "engagement_7d", "baseline_engagement", "above_baseline", *TEXT, "tag_count", "has_tags",
        "title_category", "desc_category", *TIME, *DURATION, "has_face", *ENCODED,
    )


# --- collection -----------------------------------------------------------------------------
@query
def poll_label(spark, d):
    labelled = collection.label_observations(X.observations(spark, d)).withColumn(
        "age_hours", P.hours_between(F.col("published_at"), F.col("poll_timestamp"))
    )
    return tidy(labelled, "event_id", "video_id", "age_hours", "poll_label")


@query
def first_observation(spark, d):
    first = collection.first_observations(collection.label_observations(X.observations(spark, d)))
    return tidy(first, "video_id", "poll_label", "event_id", "view_count")


@query
def whole_hours(spark, d):
    age = P.whole_hours_old(F.col("published_at"), P.ntz(HEALTH_NOW))
    return X.videos(spark, d).select("video_id", age.alias("hours_old"))


def _due(spark, d, label):
    due = collection.due_videos(X.tracking(spark, d), X.tracked_channels(spark, d), label, DUE_NOW)
    return due.select("video_id", "channel_id", "channel_handle", "vertical", "tier")


@query
def due_24h(spark, d):
    return _due(spark, d, "24h")


@query
def due_7d(spark, d):
    return _due(spark, d, "7d")


@query
def new_videos(spark, d):
    return collection.new_videos(X.videos(spark, d), X.tracking(spark, d), DUE_NOW).drop(
        "published_at", "first_seen_at"
    )


@query
def channels_without_baseline(spark, d):
    bare = baselines.channels_without_baseline(X.tracked_channels(spark, d), X.baseline_videos(spark, d))
    return bare.select("channel_id", "channel_handle", "vertical", "tier")


@query
def last_30_baseline(spark, d):
    return baselines.recent_untracked(X.videos(spark, d), X.tracking(spark, d)).select("video_id", "channel_id")


@query
def run_counts(spark, d):
    return polls.run_counts(X.labelled(spark, d, with_text=False))


@query
def run_report(spark, d):
    """Channels planned, done and skipped by a run that wrote the baseline videos, by vertical of the channel."""
    planned, written = X.tracked_channels(spark, d), X.baseline_videos(spark, d)
    parts = [collection.run_report(planned.where(F.col("vertical") == v), written.where(F.col("vertical") == v)).withColumn(
        "vertical", F.lit(v)) for v in C.VERTICALS]
    return tidy(reduce(DataFrame.unionByName, parts))


@query
def skipped_channels(spark, d):
    return collection.skipped_channels(X.tracked_channels(spark, d), X.baseline_videos(spark, d)).select(
        "channel_id", "channel_handle", "vertical", "tier")


@query
def combined_polls(spark, d):
    """The three batches of a run, collected apart and put together."""
    rows = X.labelled(spark, d, with_text=False)
    batches = [rows.where(F.col("poll_label") == label) for label in C.POLL_LABELS]
    return tidy(polls.combine_polls(*batches), "video_id", "poll_label", "view_count", "like_count", "comment_count")


@query
def segments_restored(spark, d):
    """A narrow frame that lost vertical and tier gets them back by video id."""
    base = cut(numeric_rows(spark, d).select("video_id", "vertical", "tier", C.TARGET, "view_count_24h"))
    bare = base.select("video_id", C.TARGET, "view_count_24h")
    return tidy(segments.with_segments(bare, base), "video_id", "vertical", "tier", C.TARGET, "view_count_24h")


@query
def model_inputs(spark, d):
    """The numeric model inputs among the columns of the model rows, with their known values and range."""
    rows = numeric_rows(spark, d)
    chosen = cleaning.numeric_columns(rows, C.NOT_FEATURES)
    chosen = [c for c in features.feature_columns(rows) if c in chosen]
    long = quantiles.unpivot(rows, [], chosen)
    return tidy(long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most")))


@query
def real_and_synthetic(spark, d):
    """Real rows and synthetic rows of the flagged table, each by its own filter."""
    rows = cut(numeric_rows(spark, d).select("video_id", C.TARGET, F.expr(
        "cast(substr(video_id, 2) as bigint) % 7 = 0").alias("contains_synthetic_data")))
    parts = [cleaning.only_real(rows, real).withColumn("part", F.lit(name)) for real, name in ((True, "real"), (False, "synthetic"))]
    return tidy(reduce(DataFrame.unionByName, parts), "video_id", C.TARGET, "part")


@query
def aligned_rows(spark, d):
    """Baseline videos in the columns of poll rows, missing ones as NULL."""
    wanted = ["video_id", "poll_label", "channel_id", "view_count", "like_count", "hours_since_publish", "tier"]
    rows = cleaning.align(X.baseline_videos(spark, d), wanted)
    return rows.withColumns({"poll_label": F.col("poll_label").cast("string"),
                             "hours_since_publish": F.col("hours_since_publish").cast("double")})


@query
def mark_flags(spark, d):
    done = X.labelled(spark, d, with_text=False).where("poll_label = '24h'")
    marked = collection.mark_done(X.tracking(spark, d), done, "24h")
    return marked.select("video_id", "upload_poll_done", "day1_poll_done", "day7_poll_done")


@query
def mark_flags_in_place(spark, d):
    """The same flags set in a table of folders by hash, of which those with a changed row are rewritten."""
    table = tracking_store.BucketedTable(spark, f"{_place(spark)}/tracking", VIDEOS_TO_TRACK, buckets=16)
    table.add(X.tracking(spark, d))
    done = X.labelled(spark, d, with_text=False).where("poll_label = '24h'")
    table.set_flag(done, "day1_poll_done")
    return table.read().select("video_id", "upload_poll_done", "day1_poll_done", "day7_poll_done")


# --- health ---------------------------------------------------------------------------------
def _polls(spark, d):
    return X.snapshots(spark, d, with_text=False)


@query
def completion(spark, d):
    return tidy(health.completion(X.tracking(spark, d), HEALTH_NOW))


@query
def mismatches(spark, d):
    return health.mismatches(X.tracking(spark, d), _polls(spark, d)).drop("published_at")


@query
def mismatch_examples(spark, d):
    return health.mismatch_examples(X.tracking(spark, d), _polls(spark, d)).drop("published_at")


@query
def orphans(spark, d):
    return health.orphans(X.tracking(spark, d), _polls(spark, d))


@query
def missing_baselines(spark, d):
    return health.missing_baselines(X.tracking(spark, d), medians(spark, d))


@query
def spot_check(spark, d):
    return tidy(health.spot_check(X.tracking(spark, d), _polls(spark, d)).drop("published_at"))


def _as_text(df, *columns):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


@query
def tracking_summary(spark, d):
    return _as_text(health.tracking_summary(X.tracking(spark, d)), "earliest_tracked", "latest_tracked")


@query
def snapshot_volume(spark, d):
    return _as_text(health.snapshot_volume(_polls(spark, d)), "earliest", "latest")


@query
def health_warnings(spark, d):
    return health.warnings(X.tracking(spark, d), _polls(spark, d), medians(spark, d), HEALTH_NOW)


# --- discovery ------------------------------------------------------------------------------
@query
def channel_counts(spark, d):
    return discovery.channel_counts(X.tracked_channels(spark, d))


@query
def fill_plan(spark, d):
    return tidy(discovery.fill_plan(X.tracked_channels(spark, d)))


@query
def known_ids(spark, d):
    return discovery.known_ids(X.tracked_channels(spark, d), X.candidates(spark, d))


@query
def upload_velocity(spark, d):
    return tidy(discovery.upload_velocity(X.uploads(spark, d), VELOCITY_NOW))


@query
def range_join(spark, d):
    """Tracked channels with every subscriber band that holds them; bands overlap and have open ends."""
    bands = spark.createDataFrame(
        [(name, low, high) for name, (low, high) in C.TIER_RANGES.items()], "band string, low long, high long")
    open_ends = spark.createDataFrame([("below", None, 1000), ("above", 500_000, None)], bands.schema)
    own = X.channels(spark, d).groupBy(F.col("vertical").alias("band")).agg(
        F.expr("percentile(subscriber_count, 0.25)").cast("long").alias("low"),
        F.expr("percentile(subscriber_count, 0.75)").cast("long").alias("high"))
    found = ranges.join_ranges(X.channels(spark, d), bands.union(open_ends).union(own), "subscriber_count", "low", "high")
    return found.select("channel_id", "band", "low", "high")


@query
def tier_range(spark, d):
    return X.channels(spark, d).select("channel_id", P.tier_of(F.col("subscriber_count")).alias("tier"))


@query
def qualify_candidates(spark, d):
    chosen = discovery.qualify(
        X.candidates(spark, d), X.tracked_channels(spark, d).select("channel_id"), X.uploads(spark, d),
        discovery.fill_plan(X.tracked_channels(spark, d)), VELOCITY_NOW,
    )
    return tidy(chosen, "channel_id", "vertical", "tier", "upload_velocity_per_week", "subscriber_count")


def _taken(spark, d):
    return discovery.drain(X.candidates(spark, d), discovery.fill_plan(X.tracked_channels(spark, d)))


@query
def drain_candidates(spark, d):
    return tidy(_taken(spark, d), "channel_id", "channel_handle", "vertical", "tier", "subscriber_count",
                "total_channel_views", "upload_velocity_per_week")


@query
def drain_large_plan(spark, d):
    """A plan that asks for more of a segment than any target does."""
    plan = discovery.fill_plan(X.tracked_channels(spark, d)).withColumn("needed", F.lit(400))
    candidates = X.candidates(spark, d).withColumns({"vertical": F.lit("Tech"), "tier": F.lit("S")})
    return discovery.drain(candidates, plan).select("channel_id", "vertical", "tier")


@query
def mark_consumed(spark, d):
    return discovery.mark_consumed(X.candidates(spark, d), _taken(spark, d)).select(
        "channel_id", "added_to_tracking"
    )


# --- profiles -------------------------------------------------------------------------------
@query
def snapshot_profile(spark, d):
    return profile.snapshot_profile(X.labelled(spark, d, with_text=False))


@query
def null_profile(spark, d):
    return tidy(profile.null_profile(full_clean(spark, d)))


@query
def duplicates(spark, d):
    return profile.duplicate_keys(X.labelled(spark, d, with_text=False))


@query
def describe(spark, d):
    return tidy(profile.describe(profile_rows(spark, d, *PROFILED), PROFILED), places=4)


@query
def iqr_outliers(spark, d):
    return profile.iqr_outliers(profile_rows(spark, d, *PROFILED), PROFILED)


@query
def histogram(spark, d):
    return tidy(distributions.histogram(profile_rows(spark, d, *PROFILED), PROFILED), density=10)


@query
def class_histogram(spark, d):
    wanted = C.CLASS_HISTOGRAM_FEATURES
    rows = profile_rows(spark, d, C.TARGET, *wanted)
    return tidy(distributions.capped_histogram(rows, wanted, [C.TARGET]), density=10)


@query
def kde(spark, d):
    rows = profile_rows(spark, d, *C.DENSITY_FEATURES)
    return tidy(distributions.kde(rows, C.DENSITY_FEATURES), x=4, density=9)


@query
def kde_by_vertical(spark, d):
    rows = profile_rows(spark, d, "vertical", "view_count_24h")
    return tidy(distributions.kde(rows, ["view_count_24h"], ["vertical"]), x=4, density=9)


@query
def box_stats(spark, d):
    rows = profile_rows(spark, d, "vertical", "view_count_24h")
    return tidy(distributions.box_stats(rows, "view_count_24h", ["vertical"]))


@query
def box_stats_by_tier(spark, d):
    rows = profile_rows(spark, d, "tier", "vertical", "engagement_7d")
    return tidy(distributions.box_stats(rows, "engagement_7d", ["tier", "vertical"]))


@query
def winsorize(spark, d):
    rows = profile_rows(spark, d, "video_id", C.TARGET, "view_velocity_ratio", "like_rate_24h")
    capped = distributions.winsorize(rows, ["view_velocity_ratio", "like_rate_24h"], [C.TARGET])
    return tidy(capped, "video_id", "view_velocity_ratio", "like_rate_24h")


@query
def density_2d(spark, d):
    rows = profile_rows(spark, d, C.TARGET, *{c: None for pair in C.DENSITY_PAIRS for c in pair})
    parts = [
        distributions.density_2d(rows.select(C.TARGET, x, y), x, y, C.TARGET).withColumn("pair", F.lit(f"{x} {y}"))
        for x, y in C.DENSITY_PAIRS
    ]
    return tidy(reduce(DataFrame.unionByName, parts))


@query
def kde_binned(spark, d):
    """The density curves by linear binning, with the bound of their error."""
    rows = profile_rows(spark, d, *C.DENSITY_FEATURES)
    curves = distributions.binned_kde(rows, C.DENSITY_FEATURES)
    return tidy(curves, "feature", "i", "x", "density", "error_bound", x=4, density=9, error_bound=9)


@query
def kde_2d(spark, d):
    """Two-dimensional densities of both pairs per class, as shares of a kernel of one row's height."""
    rows = profile_rows(spark, d, C.TARGET, *{c: None for pair in C.DENSITY_PAIRS for c in pair})
    parts = [
        distributions.kde_2d(rows.select(C.TARGET, x, y), x, y, [C.TARGET]).withColumn("pair", F.lit(f"{x} {y}"))
        for x, y in C.DENSITY_PAIRS
    ]
    scaled = reduce(DataFrame.unionByName, parts).withColumns({
        c: F.col(c) * F.col("h_x") * F.col("h_y") for c in ("density", "error_bound")})
    return tidy(scaled, C.TARGET, "pair", "n", "i_x", "i_y", "x", "y", "density", "error_bound", density=8, error_bound=8)


@query
def correlation_matrix(spark, d):
    return tidy(correlation.correlations(profile_rows(spark, d, *CORRELATED), CORRELATED))


QUERIES["correlation"] = QUERIES.pop("correlation_matrix")


@query
def target_correlation(spark, d):
    return tidy(correlation.target_correlations(profile_rows(spark, d, *CORRELATED)))


@query
def correlation_shift(spark, d):
    rows = profile_rows(spark, d, "video_id", *CORRELATED)
    flagged = rows.withColumn("contains_synthetic_data", F.expr("cast(substr(video_id, 2) as bigint) % 7 = 0"))
    return tidy(correlation.correlation_shift(flagged, CORRELATED))


@query
def category_distribution(spark, d):
    rows = features.add_text_classes(_texts(spark, d))
    return segments.category_distribution(rows, "title_category", C.TITLE_CLASSES).unionByName(
        segments.category_distribution(rows, "desc_category", C.DESCRIPTION_CLASSES)
    )


@query
def target_balance(spark, d):
    return tidy(segments.target_balance(target_rows(spark, d)), "above_baseline", "n", "share")


# --- splits and scaling ---------------------------------------------------------------------
def _with_new_holdout(rows):
    """Rows split against a holdout drawn from them, over one hashed key table."""
    keyed = splits.hashed_keys(rows)
    return splits.split(rows, splits.draw_holdout(rows, keyed=keyed), keyed=keyed)


_SPLIT_KEYS = ["video_id", "vertical", "tier", C.TARGET]


def _split_rows(spark, d, *more):
    rows = cut(numeric_rows(spark, d).select(*_SPLIT_KEYS, *more))
    return _with_new_holdout(rows)


@query
def stratum_counts(spark, d):
    return splits.stratum_counts(target_rows(spark, d))


@query
def holdout(spark, d):
    return splits.draw_holdout(target_rows(spark, d).select(*_SPLIT_KEYS))


@query
def split(spark, d):
    return _split_rows(spark, d).select("video_id", "split")


@query
def split_composition(spark, d):
    return tidy(segments.split_composition(_split_rows(spark, d)))


@query
def training_composition(spark, d):
    rows = _split_rows(spark, d).withColumn("contains_synthetic_data", F.lit(False))
    return tidy(evaluate.training_composition(rows))


@query
def scale(spark, d):
    wanted = ["view_count_upload", "like_rate_24h", "duration_seconds", "view_velocity_ratio"]
    rows = cut(_split_rows(spark, d, *wanted))
    scaler = Scaler().fit(rows.where("split = 'train'"), wanted)
    return tidy(scaler.transform(rows), "video_id", *wanted)


# --- evaluation -----------------------------------------------------------------------------
def _scored(spark, d):
    """A score per labelled document from its text's hash, with ties."""
    docs = X.table(spark, d, "documents").select("doc_id", "text")
    hashed = F.md5(F.col("text").cast("binary"))
    score = (F.ascii(F.substring(hashed, 1, 1)) * 7 + F.ascii(F.substring(hashed, 2, 1)) + 40 * F.col("quality")) % 97
    return X.table(spark, d, "labels").join(docs, "doc_id").select(
        F.col("quality").alias(C.TARGET), (score / 97.0).alias("score")
    ).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


@query
def auc(spark, d):
    return tidy(evaluate.roc_auc(_scored(spark, d)))


@query
def classification_report(spark, d):
    return tidy(evaluate.classification_report(_scored(spark, d)))


@query
def best_per_metric(spark, d):
    rows = numeric_rows(spark, d).groupBy("vertical").agg(
        F.round(F.avg(C.TARGET), 9).alias("label_rate"), F.round(F.avg("like_rate_24h"), 9).alias("like_rate")
    )
    return tidy(evaluate.best_per_metric(rows, "vertical", ["label_rate", "like_rate"]))


# --- synthetic rows -------------------------------------------------------------------------
@query
def synthetic_cleanup(spark, d):
    bent = numeric_rows(spark, d).withColumns({
        "view_count_24h": F.col("view_count_24h") - 200000.5,
        "like_count_24h": F.col("like_count_24h") * 0.37,
        "comment_count_7d": F.col("comment_count_7d") - 90.25,
        "hours_since_publish_24h": F.col("hours_since_publish_24h") - 25,
    })
    return tidy(synthetic.clean_synthetic(bent), "video_id", *COUNTS, *HOURS)


@query
def synthetic_features(spark, d):
    rows = synthetic.add_synthetic_features(numeric_clean(spark, d))
    return tidy(rows, "video_id", "engagement_7d", "above_baseline", *PER_SUB, "title_length", "publish_hour",
                "is_short", "duration_minutes")


@query
def real_plus_synthetic(spark, d):
    rows = numeric_rows(spark, d)
    made = rows.select(F.concat(F.lit("syn-"), "video_id").alias("video_id"), "view_count_7d")
    both = synthetic.combine(rows.select("video_id", C.TARGET), made)
    return tidy(both, "video_id", C.TARGET, "view_count_7d", "contains_synthetic_data")


@query
def channel_lookup(spark, d):
    rows = synthetic.channel_lookup(numeric_clean(spark, d))
    return tidy(rows, "channel_id", "channel_handle", "vertical", "tier", "baseline_video_count")


@query
def channel_draw(spark, d):
    real = cleaning.drop_bad_baselines(numeric_clean(spark, d)).select("channel_id")
    ids = X.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    return synthetic.draw_channels(ids, real)


@query
def fitted_marginals(spark, d):
    """Every family's distance to every synthesised column, and the family chosen."""
    columns = synthetic.NUMERIC
    return tidy(marginals.fitted(profile_rows(spark, d, *columns), columns), "feature", "family", "n", "ks", "chosen")


@query
def synthetic_rows_fitted(spark, d):
    """Synthetic rows from the chosen families: their number and each column's range against the real one."""
    real = profile_rows(spark, d, *synthetic.NUMERIC, *C.SYNTHETIC_CATEGORIES)
    ranges_of = [f(F.col(c).cast("double")).alias(f"{c}_{e}") for c in synthetic.NUMERIC for e, f in (("lo", F.min), ("hi", F.max))]
    total = real.count()
    made = synthetic.sample_copula(spark, synthetic.fit_copula(real, marginals="fitted"), total)
    limits = real.agg(*ranges_of).first()
    outside = [F.count_if(~F.col(c).between(limits[f"{c}_lo"], limits[f"{c}_hi"])).alias(c) for c in synthetic.NUMERIC]
    told = made.agg(F.count(F.lit(1)).alias("n"), *outside)
    return told.unpivot("n", synthetic.NUMERIC, "feature", "n_outside")


@query
def synthetic_rows(spark, d):
    """A quarter as many synthetic rows as real ones, with the real table's columns."""
    real = cut(numeric_rows(spark, d))
    return synthetic.generate(real, synthetic.rows_needed(real.count(), 0.8))


# --- stores ---------------------------------------------------------------------------------
def _place(spark: SparkSession) -> str:
    """A fresh folder in the shared directory."""
    return f"{shared_dir(spark)}/queries/{uuid.uuid4().hex}"


_STAMP = datetime(2026, 1, 1)


@query
def snapshot_roundtrip(spark, d):
    """Save poll rows, baseline videos and medians under a tag, list them, and load them by tag."""
    root = _place(spark)
    snapshot_store.save_raw(
        X.labelled(spark, d, with_text=False), (X.baseline_videos(spark, d), medians(spark, d)), root, "v1.0", _STAMP
    )
    rows, history, middle = snapshot_store.load_inputs(spark, "snapshots", root, "v1.0")
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
        for name, df in (("videos", rows), ("baselines", history), ("medians", middle))
    ]
    listed = snapshot_store.list_snapshots(spark, root).select(
        F.concat(F.lit("listed_"), "kind").alias("part"),
        F.coalesce("total_rows", "baseline_video_rows").alias("n"),
    )
    return counted[0].unionByName(counted[1]).unionByName(counted[2]).unionByName(listed)


POLLED = ["video_id", "poll_label", "channel_id", "channel_handle", "vertical", "tier", "view_count", "like_count",
          "comment_count", "subscriber_count", "duration_seconds", "category_name", "contains_synthetic_media"]
HISTORY = ["video_id", "channel_id", "channel_handle", "vertical", "tier", "view_count", "like_count", "comment_count",
           "subscriber_count"]


def _day_time(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


@query
def snapshot_videos_loaded(spark, d):
    """Every poll row as it is read back from a saved snapshot."""
    root = _place(spark)
    snapshot_store.save_videos(X.labelled(spark, d, with_text=False), root, "v1.0", _STAMP)
    rows, _ = snapshot_store.load_videos(spark, root, "v1.0")
    return tidy(rows.withColumns({c: _day_time(c) for c in ("published_at", "poll_timestamp")}),
                *POLLED, "published_at", "poll_timestamp", "hours_since_publish")


def _loaded_baselines(spark, d):
    root = _place(spark)
    snapshot_store.save_baselines(X.baseline_videos(spark, d), medians(spark, d), root, "v1.0", _STAMP)
    return snapshot_store.load_baselines(spark, root, "v1.0")


@query
def snapshot_baselines_loaded(spark, d):
    """Every baseline video as it is read back."""
    history, _, _ = _loaded_baselines(spark, d)
    return tidy(history.withColumn("published_at", _day_time("published_at")), *HISTORY, "published_at")


@query
def snapshot_medians_loaded(spark, d):
    """Every channel's medians as they are read back beside their videos."""
    _, middle, record = _loaded_baselines(spark, d)
    return tidy(middle.withColumn("listed", F.lit(record["baseline_median_rows"])),
                "channel_id", "channel_handle", "video_count", *MEDIANS, "listed")


@query
def final_snapshot(spark, d):
    """K3: the model table with real and synthetic counts in its record, and the target as read back."""
    root = _place(spark)
    rows = numeric_rows(spark, d).select(
        "video_id", "channel_id", "vertical", "tier", "published_at", C.TARGET,
        F.expr("cast(substr(video_id, 2) as bigint) % 7 = 0").alias("contains_synthetic_data"))
    record = snapshot_store.save_final(rows, root, "v1.0", _STAMP)
    loaded, _ = snapshot_store.load_videos(spark, root, "v1.0")
    told = {c: F.lit(record[c]) for c in ("total_rows", "real_rows", "synthetic_rows", "synthetic_pct")}
    return tidy(loaded.withColumns(told), "video_id", C.TARGET, "contains_synthetic_data", *told)


@query
def tables_appended(spark, d):
    """Poll rows appended in two parts and read back with the table's schema."""
    root = _place(spark)
    rows = X.snapshots(spark, d, with_text=False)
    first = F.expr("cast(substr(video_id, 2) as bigint) % 2 = 0")
    tables.append(rows.where(first), root, "video_snapshots")
    tables.append(rows.where(~first), root, "video_snapshots")
    read = tables.poll_snapshots(spark, root).withColumn("poll_timestamp", _day_time("poll_timestamp"))
    return tidy(read, *POLLED, "poll_timestamp", "hours_since_publish")


@query
def tables_medians(spark, d):
    """Baseline videos and medians appended, and medians read as stored and as computed."""
    root = _place(spark)
    tables.append(X.baseline_videos(spark, d), root, "channel_baseline_videos")
    tables.append(medians(spark, d), root, "channel_baseline_medians")
    parts = [tables.baseline_medians(spark, root, stored).withColumn("stored", F.lit(stored)) for stored in (True, False)]
    return tidy(parts[0].select(*parts[1].columns).unionByName(parts[1]),
                "channel_id", "channel_handle", "video_count", *MEDIANS, "stored")


@query
def thumbnail_scan(spark, d):
    """brightness and colourfulness of image files made from the bytes of each document's digest."""
    root = f"{_place(spark)}/images"
    # A picture of 4 x 4 pixels; blue, green and red of a pixel are three bytes of the digest.
    at = F.sequence(F.lit(0), F.lit(15))
    pixels = F.array_join(F.transform(at, lambda i: F.concat(*[
        F.substr("h", (i + shift) % 16 * 2 + 1, F.lit(2)) for shift in (11, 5, 0)])), "")
    images = X.table(spark, d, "documents").where("text is not null").select(
        F.concat(F.lit("d"), "doc_id").alias("name"), F.md5(F.col("text").cast("binary")).alias("h")).select(
        "name", F.lit(4).alias("width"), F.lit(4).alias("height"), F.unhex(pixels).alias("pixels"))
    written = write_images(images, root)
    told = read_thumbnails(spark, root).select(
        F.regexp_extract("origin", r"(d\d+)\.bmp$", 1).alias("name"), "brightness", "colorfulness", F.lit(written).alias("written"))
    return tidy(told)


@query
def json_appended(spark, d):
    """K5: tracking rows appended twice as lines of JSON and read back."""
    path = f"{_place(spark)}/tracking"
    rows = X.tracking(spark, d)
    for done in (True, False):
        tables.append_json(rows.where(F.col("day1_poll_done") == done), path)
    read = spark.read.schema(VIDEOS_TO_TRACK).json(path)
    return tidy(read.withColumns({c: _day_time(c) for c in ("published_at", "first_seen_at")}))


@query
def csv_sample(spark, d):
    """A sample of poll rows written as CSV: its rows, and how many of them are rows of the table."""
    path = f"{_place(spark)}/sample"
    rows = X.labelled(spark, d, with_text=False).select(
        "video_id", "poll_label", "view_count", "like_count", "comment_count")
    tables.sample_csv(rows, path, 100)
    sample = spark.read.schema(rows.schema).csv(path, header=True)
    # At most 100 rows on either broadcast side.
    found = rows.join(F.broadcast(sample.distinct()), rows.columns, "left_semi").distinct().withColumn("known", F.lit(True))
    return sample.join(F.broadcast(found), rows.columns, "left").agg(
        F.count(F.lit(1)).alias("n"), (F.count_if(F.col("known").isNull()) == 0).alias("all_known"))


@query
def split_loaded(spark, d):
    """Every row's split as read back from a saved split."""
    root = _place(spark)
    rows = cut(numeric_rows(spark, d).select(*_SPLIT_KEYS))
    store = holdout_store.HoldoutStore(spark, root)
    holdout_store.create_holdout(rows, store, _STAMP)
    snapshot_store.save_splits(holdout_store.split_against(rows, store), root, "v1.0", _STAMP)
    loaded = [snapshot_store.load_splits(spark, root, "v1.0", part) for part in ("train", "test", "val")]
    return tidy(reduce(DataFrame.unionByName, loaded).withColumn("split", F.col("split").cast("string")),
                "video_id", "vertical", "tier", C.TARGET, "split")


@query
def split_roundtrip(spark, d):
    """Lock a holdout, split against it, save the splits and load them back."""
    root = _place(spark)
    rows = cut(numeric_rows(spark, d).select(*_SPLIT_KEYS))
    store = holdout_store.HoldoutStore(spark, root)
    holdout_store.create_holdout(rows, store, _STAMP)
    snapshot_store.save_splits(holdout_store.split_against(rows, store), root, "v1.0", _STAMP)
    loaded = snapshot_store.load_splits(spark, root, "v1.0")
    return loaded.groupBy("split", C.TARGET).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("split").cast("string").alias("split"), F.col(C.TARGET).cast("long").alias(C.TARGET), "n"
    )


@query
def raw_items_parsed(spark, d):
    """Videos written as API items in JSON and parsed back to typed poll rows."""
    totals = X.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.expr("l_suppkey % 50")).alias("comments")
    )
    items = X.videos(spark, d).join(totals, "o_orderkey", "left").selectExpr(
        "channel_id",
        """to_json(named_struct('id', video_id,
            'snippet', named_struct('title', concat('t', video_id), 'publishedAt',
                date_format(published_at, "yyyy-MM-dd'T'HH:mm:ss'Z'"), 'categoryId', category_id),
            'statistics', named_struct('viewCount', cast(o_orderkey * 10 as string), 'commentCount', cast(comments as string)),
            'contentDetails', named_struct('duration', duration),
            'status', named_struct('containsSyntheticMedia', contains_synthetic_media))) AS payload""",
    )
    rows = raw_items.snapshot_rows(items, X.channels(spark, d), "7d", HEALTH_NOW)
    return tidy(rows.withColumn("tag_count", F.size("tags")), "video_id", "channel_handle", "vertical", "title",
                "description", "tag_count", "duration_seconds", "category_name", "hours_since_publish",
                "view_count", "like_count", "comment_count", "subscriber_count", "contains_synthetic_media")


@query
def validation_history(spark, d):
    """One scored table evaluated, recorded twice and read back as history."""
    root, result = _place(spark), evaluate.evaluate(_scored(spark, d))
    for day in (1, 2):
        model_store.append_validation(spark, root, "v1.0", "d1", {"rule": result}, datetime(2026, 1, day))
    return tidy(model_store.validation_history(spark, root))


@query
def roc_curve(spark, d):
    return tidy(evaluate.roc_curve(_scored(spark, d)))


def _recorded(spark, d):
    """Records of two models of one rule's scores, saved and read back."""
    root, scored = _place(spark), cut(_scored(spark, d))
    about = learners.about_training(scored.where("score < 0.4"), scored.where("score >= 0.4"))
    for version in ("v1.0_rule", "v1.1_rule"):
        entry = learners.Entry("rule", {}, _INPUTS, result=evaluate.evaluate(scored), training=about)
        model_store.save_model(spark, entry, root, version, "d1", _STAMP, notes="by rule")
    return model_store.model_records(spark, root)


@query
def model_comparison(spark, d):
    """Saved records side by side."""
    return tidy(model_store.compare_models(_recorded(spark, d)))


@query
def model_listing(spark, d):
    return tidy(model_store.list_models(_recorded(spark, d)))


@query
def model_generations(spark, d):
    """The wide record of each model with its generation."""
    rows = model_store.model_table(_recorded(spark, d))
    return tidy(rows, "model_name", "version", "generation", "data_snapshot", "model_type", "train_rows", "test_rows",
                "accuracy", "roc_auc", "features_count")


@query
def sample_channels(spark, d):
    return collection.sample_channels(X.channels(spark, d)).select("channel_id")


# --- models ---------------------------------------------------------------------------------
_SMALL = {
    "lr_l1": {"max_iter": 100},
    "rf": {"n_estimators": 20, "max_depth": 6},
    "gbt": {"n_estimators": 10, "max_depth": 4},
}
#: Trees of the query on second-order boosting; each takes a job per level.
BOOSTED = 20
_INPUTS = VELOCITY + RATIOS + [c for c in PER_SUB if not c.endswith("7d")] + ["duration_seconds"]


def _divided(spark, d):
    rows = cut(cleaning.fill_missing(numeric_rows(spark, d)))
    return cut(_with_new_holdout(rows))


def _by_split(rows):
    return (rows.where(F.col("split") == name) for name in ("train", "test", "val"))


@query
def train_and_compare(spark, d):
    """Train the four models, save them, and compare them by their saved records."""
    root = _place(spark)
    train, test, _ = _by_split(_divided(spark, d))
    for name, entry in learners.train(train, test, _INPUTS, _SMALL).items():
        model_store.save_model(spark, entry, root, f"v1.0_{name}", "d1", _STAMP)
    return model_store.compare_models(model_store.model_records(spark, root))


@query
def boosting_first_splits(spark, d):
    """What the best first split of a booster gains on each column, over all model rows."""
    rows = cut(numeric_rows(spark, d).select("video_id", C.TARGET, *_INPUTS))
    found = boosting.first_splits(rows, _INPUTS, C.TARGET, "video_id", boosting.Settings(gamma=0.0))
    return tidy(spark.createDataFrame(found, "feature string, gain double, threshold double, missing_left boolean").withColumn(
        "threshold", F.when(~F.isnan("threshold"), F.col("threshold"))))


@query
def boosted_trees(spark, d):
    """Scores of the holdout by second-order boosting of the train rows."""
    train, _, val = _by_split(_divided(spark, d))
    booster = boosting.fit(train, _INPUTS, C.TARGET, "video_id", boosting.Settings(n_estimators=BOOSTED))
    return boosting.predict(val, booster, ["video_id", C.TARGET])


@query
def forest_first_splits(spark, d):
    """How much the best first split of a tree on each column lowers impurity, over all model rows."""
    rows = cut(numeric_rows(spark, d).select("video_id", C.TARGET, *_INPUTS))
    found = forest.first_splits(rows, _INPUTS, C.TARGET, "video_id")
    return tidy(spark.createDataFrame(found, "feature string, gain double, threshold double").withColumn(
        "threshold", F.when(~F.isnan("threshold"), F.col("threshold"))))


@query
def forest_trees(spark, d):
    """Scores of the holdout by a forest of the train rows, with the default settings: 500 trees of any depth."""
    train, _, val = _by_split(_divided(spark, d))
    grown = forest.fit(train, _INPUTS, C.TARGET, "video_id")
    return forest.predict(val, grown, ["video_id", C.TARGET])


@query
def retro_validate(spark, d):
    """Two saved versions of a model, loaded and validated on the holdout, beside their test metrics."""
    root = _place(spark)
    train, test, val = _by_split(_divided(spark, d))
    for version, wanted in (("v1.0", _INPUTS), ("v1.1", _INPUTS[:8])):
        entry = learners.train(train, test, wanted, _SMALL, kinds=("lr_l1",))["lr_l1"]
        model_store.save_model(spark, entry, root, f"{version}_lr_l1", "d1", _STAMP)
    family = model_store.load_family(spark, root, ["v1.0", "v1.1"])
    return evaluate.three_way(spark, {
        "hist_test": {name: entry.result for name, entry in family.items()},
        "curr_test": learners.validate(family, test),
        "val": learners.validate(family, val),
    })


@query
def tune_model(spark, d):
    """Every combination of a small grid with its cross-validated area under ROC."""
    train, _, _ = _by_split(_divided(spark, d))
    found = learners.tune("lr_l1", train, _INPUTS, {"C": [0.1, 1.0], "max_iter": [50]}, "grid", cv=3)
    rows = [(t["C"], t["max_iter"], float(auc)) for t, auc in found["trials"]]
    return spark.createDataFrame(rows, "C double, max_iter int, roc_auc double")


@query
def stratified_folds(spark, d):
    """Five folds of all model rows, stratified on the target."""
    rows = cut(engineer(full_clean(spark, d)).select("video_id", C.TARGET))  # folds are edges first, then rows
    return tidy(splits.with_folds(rows, 5), "video_id", C.TARGET, "fold")


@query
def feature_weights(spark, d):
    """Features of a linear model by absolute weight."""
    train, test, _ = _by_split(_divided(spark, d))
    entry = learners.train(train, test, _INPUTS, _SMALL, kinds=("lr_l1",))["lr_l1"]
    rows = [(w["feature"], w["coefficient"]) for w in entry.importances()]
    return spark.createDataFrame(rows, "feature string, coefficient double")


@query
def augmented_train(spark, d):
    """Train rows with synthetic rows added until four in five are real; the other splits unchanged."""
    rows = cut(engineer(full_clean(spark, d)), free=True)
    divided = _with_new_holdout(rows)  # a join with the stored rows, whose texts are not stored again
    return augment(divided, 0.8).groupBy("split", "contains_synthetic_data").agg(F.count(F.lit(1)).alias("n"))


@query
def augmented_real_rows(spark, d):
    """The real rows after synthetic ones joined the train split, with split, target and a count."""
    rows = cut(engineer(full_clean(spark, d)), free=True)
    made = augment(_with_new_holdout(rows), 0.8)
    return tidy(made.where("not contains_synthetic_data"), "video_id", "split", C.TARGET, "view_count_7d")


# --- streams --------------------------------------------------------------------------------
def _stream(spark, d):
    """The events table as a stream of observations."""
    events = spark.readStream.schema(X.schema_of("events")).option("pathGlobFilter", "events.parquet").parquet(d)
    return X.observation_columns(events)


def _drained(stream, root):
    """Write a stream's available rows to Parquet and read them back."""
    stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/state").option(
        "path", f"{root}/rows"
    ).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/rows")


@query
def stream_labels(spark, d):
    rows = _drained(collector.label_stream(_stream(spark, d)), _place(spark))
    return tidy(rows, "event_id", "video_id", "poll_label")


@query
def stream_first(spark, d):
    rows = _drained(collector.first_per_label(collector.label_stream(_stream(spark, d))), _place(spark))
    return rows.select("video_id", "poll_label")


@query
def stream_snapshots(spark, d):
    """The first observation per video and label of two runs over the same events."""
    root = _place(spark)
    for run in ("a", "b"):
        labelled = collector.label_stream(_stream(spark, d))
        collector.record_stream(labelled, f"{root}/tables", f"{root}/state-{run}").awaitTermination()
    rows = collector.Recorder(spark, f"{root}/tables").read_snapshots()
    return tidy(rows.withColumn("polled", F.date_format("poll_timestamp", "yyyy-MM-dd HH:mm:ss")),
                "video_id", "poll_label", "polled", "hours_since_publish")


@query
def stream_tracking(spark, d):
    """Snapshots recorded batch by batch, then the tracking flags they set."""
    root = _place(spark)
    labelled = collector.label_stream(_stream(spark, d))
    collector.record_stream(labelled, f"{root}/tables", f"{root}/state").awaitTermination()
    return collector.Recorder(spark, f"{root}/tables").tracking.read().select(
        "video_id", "channel_id", "upload_poll_done", "day1_poll_done", "day7_poll_done"
    )


@query
def stream_sorted_out(spark, d):
    """First, repeated and late observations of events that come in up to eight days after each other, in four runs."""
    root, events = _place(spark), X.table(spark, d, "events")
    # How many days after the first one an event comes in decides the run that reads it.
    comes = F.dayofmonth("ts") - 1 + F.col("event_id") % 3 * 4
    parted = cut(events.withColumn("part", F.least(F.lit(3), F.floor(comes / 5))))
    for part in range(4):
        parted.where(F.col("part") == part).drop("part").write.mode("append").parquet(f"{root}/in")
        arrived = X.observation_columns(spark.readStream.schema(events.schema).parquet(f"{root}/in"))
        collector.record_with_state(
            collector.label_stream(arrived), f"{root}/tables", f"{root}/state").awaitTermination()
    recorder = collector.StatefulRecorder(spark, f"{root}/tables")
    keys = ["video_id", "poll_label"]
    polled = F.date_format(F.min("poll_timestamp"), "yyyy-MM-dd HH:mm:ss").alias("polled")
    first = recorder.recorder.read_snapshots().groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), polled)
    late = recorder.late().groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), polled)
    repeats = recorder.repeats().withColumn("polled", F.lit(None).cast("string"))
    return first.withColumn("kind", F.lit("first")).unionByName(late.withColumn("kind", F.lit("late"))).unionByName(
        repeats.withColumn("kind", F.lit("repeat"))).select(*keys, "kind", "n", "polled")


@query
def stream_new_videos(spark, d):
    """Videos of the events that the tracking table lacks, inserted by two runs over the same events."""
    root = _place(spark)
    for run in ("a", "b"):
        collector.insert_new_videos(
            _stream(spark, d), f"{root}/log", f"{root}/state-{run}", lambda: X.tracking(spark, d)).awaitTermination()
    schema = collector.VIDEOS_TO_TRACK
    rows = spark.read.schema(schema).parquet(f"{root}/log")  # as inserted: a second insertion would be a second row
    return rows.select("video_id", "channel_id", *[
        F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("published_at", "first_seen_at")], "upload_poll_done")
