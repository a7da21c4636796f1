"""Small hand-made frames."""

from datetime import datetime

from pyspark.sql import types as T

CLEAN_ROW = {
    "video_id": "v1", "channel_id": "c1", "channel_handle": "@a",
    "title": "Some title", "description": "Some description that is reasonably long.",
    "tags": ["t1", "t2"], "duration_seconds": 300, "category_id": "1", "category_name": "Music",
    "published_at": datetime(2026, 1, 1, 12), "vertical": "Tech", "tier": "M",
    "contains_synthetic_media": False, "face_count": 1, "duration_minutes": 5.0,
    "view_count_upload": 100, "like_count_upload": 10, "comment_count_upload": 5,
    "view_count_24h": 1000, "like_count_24h": 100, "comment_count_24h": 50,
    "view_count_7d": 5000, "like_count_7d": 500, "comment_count_7d": 250,
    "subscriber_count_upload": 10000, "subscriber_count_24h": 10010,
    "hours_since_publish_upload": 1.0, "hours_since_publish_24h": 24.0,
    "baseline_median_views": 2000.0, "baseline_median_likes": 200.0, "baseline_median_comments": 10.0,
    "baseline_median_engagement_rate": 0.1, "baseline_channel_handle": "@a", "baseline_video_count": 50,
    "contains_synthetic_data": False,
}
_TYPES = {str: T.StringType(), int: T.LongType(), float: T.DoubleType(), bool: T.BooleanType(),
          datetime: T.TimestampNTZType(), list: T.ArrayType(T.StringType())}
CLEAN_SCHEMA = T.StructType([T.StructField(k, _TYPES[type(v)]) for k, v in CLEAN_ROW.items()])


def clean_rows(spark, *changes):
    rows = [{**CLEAN_ROW, **change} for change in (changes or ({},))]
    return spark.createDataFrame([tuple(r[k] for k in CLEAN_ROW) for r in rows], CLEAN_SCHEMA)


def strata_frame(spark, per_cell=20):
    """Three verticals by three tiers, labels alternating."""
    rows, i = [], 0
    for vertical in ("Education", "Lifestyle", "Tech"):
        for tier in ("S", "M", "L"):
            for _ in range(per_cell):
                rows.append((f"v{i:05d}", vertical, tier, i % 2, float(i)))
                i += 1
    return spark.createDataFrame(rows, "video_id string, vertical string, tier string, above_baseline int, extra double")
