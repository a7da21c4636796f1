"""Raw JSON items of the video API to typed snapshot rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark import schemas
from pulsemark.functions.polls import category_name, duration_seconds, hours_since_publish, ntz


def snapshot_rows(raw: DataFrame, channels: DataFrame, label: str, now: datetime | str) -> DataFrame:
    """Rows of (channel_id, payload) and the channel table to snapshot rows of one poll.

    Missing counts are 0, missing texts empty, missing tags an empty list, and a missing
    synthetic-media flag false. Thumbnail columns default to 0 and may be joined in.
    """
    item = raw.select("channel_id", F.from_json("payload", schemas.RAW_VIDEO).alias("v"))
    known = channels.select("channel_id", "channel_handle", "vertical", "tier", "subscriber_count")
    joined = item.join(known, "channel_id", "left")
    at = ntz(now)
    published = F.to_timestamp_ntz(F.col("v.snippet.publishedAt"), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))

    def text(path: str, default: str = ""):
        return F.coalesce(F.col(path), F.lit(default))

    def count(path: str):
        return F.coalesce(F.col(path).try_cast("long"), F.lit(0).cast("long"))

    category = text("v.snippet.categoryId")
    columns = {
        "video_id": F.col("v.id"), "poll_timestamp": at, "poll_label": F.lit(label),
        "channel_id": F.col("channel_id"), "channel_handle": text("channel_handle"),
        "vertical": text("vertical"), "tier": text("tier"),
        "title": F.col("v.snippet.title"), "description": text("v.snippet.description"),
        "tags": F.coalesce(F.col("v.snippet.tags"), F.array().cast("array<string>")),
        "duration_seconds": duration_seconds(text("v.contentDetails.duration", "PT0S")),
        "category_id": category, "category_name": category_name(category),
        "published_at": published, "hours_since_publish": hours_since_publish(published, at),
        "view_count": count("v.statistics.viewCount"), "like_count": count("v.statistics.likeCount"),
        "comment_count": count("v.statistics.commentCount"),
        "subscriber_count": F.coalesce(F.col("subscriber_count"), F.lit(0).cast("long")),
        "face_count": F.lit(0), "brightness": F.lit(0.0), "colorfulness": F.lit(0.0),
        "contains_synthetic_media": F.coalesce(F.col("v.status.containsSyntheticMedia"), F.lit(False)),
    }
    return joined.select(*[c.alias(name) for name, c in columns.items()])
