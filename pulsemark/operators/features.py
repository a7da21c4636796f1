"""Target and features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.constants import METRIC_COLS, NOT_FEATURES, TIERS, VERTICALS
from pulsemark.functions import text as X
from pulsemark.functions.numbers import floor_at, rate, truth
from pulsemark.functions.polls import by_key


def add_target(df: DataFrame) -> DataFrame:
    """Seven-day engagement, the channel's usual engagement, and whether it was beaten."""
    c = F.col
    seen = rate(c("like_count_7d") + c("comment_count_7d"), c("view_count_7d"))
    if {"baseline_median_likes", "baseline_median_views"} <= set(df.columns):
        comments = (
            c("baseline_median_comments") if "baseline_median_comments" in df.columns else F.lit(0)
        )
        usual = rate(c("baseline_median_likes") + comments, c("baseline_median_views"))
    else:
        usual = F.lit(0.0)
    rated = df.withColumns({"engagement_7d": seen, "baseline_engagement": usual})
    beaten = truth(c("engagement_7d") > c("baseline_engagement"))
    return rated.withColumn("above_baseline", beaten)


def _subscribers():
    return floor_at(F.col("subscriber_count_upload"), 1)


def add_velocity(df: DataFrame) -> DataFrame:
    """Speeds per hour, per subscriber and against the channel, and acceleration."""
    c = F.col
    between = floor_at(c("hours_since_publish_24h") - c("hours_since_publish_upload"), 0.1)
    first = floor_at(c("hours_since_publish_upload"), 0.1)
    speeds = {
        f"{m}_velocity_24h": (c(f"{m}_24h") - c(f"{m}_upload")) / between
        for m in METRIC_COLS
        if f"{m}_upload" in df.columns and f"{m}_24h" in df.columns
    }
    speeds["view_velocity_upload"] = c("view_count_upload") / first
    speeds["like_velocity_upload"] = c("like_count_upload") / first
    derived = {
        f"{m}_velocity_per_sub_24h": c(f"{m}_count_velocity_24h") / _subscribers()
        for m in ("view", "like")
    }
    derived["view_velocity_ratio"] = c("view_count_velocity_24h") / floor_at(
        c("baseline_median_views"), 1
    )
    for m in ("view", "like"):
        derived[f"{m}_velocity_acceleration"] = c(f"{m}_count_velocity_24h") / floor_at(
            c(f"{m}_velocity_upload"), 0.01
        )
    return df.withColumns(speeds).withColumns(derived)


def add_ratios(df: DataFrame) -> DataFrame:
    """Early counts against the channel's medians, and like rates."""
    c = F.col
    ratios = {
        f"{m}_count_upload_vs_baseline": c(f"{m}_count_upload") / floor_at(
            c(f"baseline_median_{m}s"), 1
        )
        for m in ("view", "like")
    }
    for poll in ("upload", "24h"):
        ratios[f"like_rate_{poll}"] = rate(c(f"like_count_{poll}"), c(f"view_count_{poll}"))
    return df.withColumns(ratios)


def add_per_subscriber(df: DataFrame) -> DataFrame:
    """counts per subscriber at each poll."""
    return df.withColumns({
        f"{m}s_per_sub_{poll}": F.col(f"{m}_count_{poll}") / _subscribers()
        for poll in ("upload", "24h", "7d")
        for m in ("view", "like", "comment")
    })


def add_text_classes(df: DataFrame) -> DataFrame:
    """F12-F13."""
    return df.withColumns({
        "title_category": X.title_class(F.col("title")),
        "desc_category": X.description_class(F.col("description")),
    })


def add_text_features(df: DataFrame) -> DataFrame:
    """F14-F18."""
    tags = F.coalesce(F.size("tags"), F.lit(0))
    return df.withColumns({
        "title_length": F.length("title"),
        "title_word_count": X.word_count(F.col("title")),
        "desc_length": F.length("description"),
        "desc_link_count": X.link_count(F.col("description")),
        "desc_hashtag_count": X.hashtag_count(F.col("description")),
        "tag_count": tags,
        "has_tags": (tags > 0).cast("int"),
    })


def add_publish_time(df: DataFrame) -> DataFrame:
    """hour, weekday with Monday as 0, weekend."""
    day = F.weekday("published_at")
    return df.withColumns({
        "publish_hour": F.hour("published_at"),
        "publish_dayofweek": day,
        "publish_is_weekend": truth(day >= 5),
    })


def add_duration(df: DataFrame) -> DataFrame:
    """Short and long flags and four length classes; unknown length is the longest class."""
    seconds = F.col("duration_seconds")
    return df.withColumns({
        "is_short": truth(seconds <= 60),
        "is_long": truth(seconds > 1200),
        "duration_bucket": F.when(seconds <= 60, 0).when(seconds <= 600, 1)
        .when(seconds <= 1200, 2).otherwise(3),
    })


def add_thumbnail(df: DataFrame) -> DataFrame:
    """F20."""
    return df.withColumn("has_face", truth(F.col("face_count") > 0))


def add_encodings(df: DataFrame) -> DataFrame:
    """Ordinal tier (unknown is NULL, later filled with 0) and one-hot vertical."""
    encoded = {"tier_encoded": by_key({t: i for i, t in enumerate(TIERS)}, F.col("tier"))}
    for name in VERTICALS:
        encoded[f"vertical_{name}"] = truth(F.col("vertical") == name)
    return df.withColumns(encoded)


def derive_features(df: DataFrame) -> DataFrame:
    """All feature groups on a clean wide table. Running it again overwrites, so it is idempotent."""
    steps = [
        add_target, add_velocity, add_ratios, add_per_subscriber, add_text_classes,
        add_text_features, add_publish_time, add_duration, add_thumbnail,
    ]
    for step in steps:
        df = df.transform(step)
    return df


def feature_columns(df: DataFrame) -> list[str]:
    """Model inputs; everything but identifiers, raw baselines, the target and 7-day values."""
    return [c for c in df.columns if c not in NOT_FEATURES and not c.endswith("_7d")]
