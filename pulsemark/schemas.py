"""Explicit table schemas; no reader in this package infers one."""

from pyspark.sql import types as T


def _struct(spec: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in spec.items()])


_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_B, _TS = T.BooleanType(), T.TimestampNTZType()

VIDEO_SNAPSHOTS = _struct({
    "video_id": _S, "poll_timestamp": _TS, "poll_label": _S,
    "channel_id": _S, "channel_handle": _S, "vertical": _S, "tier": _S,
    "title": _S, "description": _S, "tags": T.ArrayType(_S),
    "duration_seconds": _I, "category_id": _S, "category_name": _S,
    "published_at": _TS, "hours_since_publish": _D,
    "view_count": _L, "like_count": _L, "comment_count": _L, "subscriber_count": _L,
    "face_count": _I, "brightness": _D, "colorfulness": _D,
    "contains_synthetic_media": _B,
})

VIDEOS_TO_TRACK = _struct({
    "video_id": _S, "channel_id": _S, "published_at": _TS, "first_seen_at": _TS,
    "upload_poll_done": _B, "day1_poll_done": _B, "day7_poll_done": _B,
})

CHANNELS_TO_TRACK = _struct({
    "channel_id": _S, "channel_handle": _S, "vertical": _S, "tier": _S,
    "subscriber_count": _L, "total_channel_views": _L, "total_channel_videos": _L,
    "upload_velocity_per_week": _D,
})

CHANNEL_CANDIDATES = T.StructType(
    CHANNELS_TO_TRACK.fields
    + [T.StructField("discovered_at", _TS, True), T.StructField("added_to_tracking", _B, True)]
)

CHANNEL_BASELINE_VIDEOS = _struct({
    "channel_id": _S, "channel_handle": _S, "vertical": _S, "tier": _S,
    "video_id": _S, "title": _S, "published_at": _TS, "duration_seconds": _I,
    "category_id": _S, "category_name": _S,
    "view_count": _L, "like_count": _L, "comment_count": _L, "subscriber_count": _L,
    "baseline_polled_at": _TS,
})

CHANNEL_BASELINE_MEDIANS = _struct({
    "channel_id": _S, "channel_handle": _S, "video_count": _L,
    "median_views": _D, "median_likes": _D, "median_comments": _D,
    "median_engagement_rate": _D,
})

# One item of the video API's JSON; counts arrive as strings.
RAW_VIDEO = _struct({
    "id": _S,
    "snippet": _struct({
        "title": _S, "description": _S, "publishedAt": _S, "categoryId": _S,
        "tags": T.ArrayType(_S),
    }),
    "statistics": _struct({"viewCount": _S, "likeCount": _S, "commentCount": _S}),
    "contentDetails": _struct({"duration": _S}),
    "status": _struct({"containsSyntheticMedia": _B}),
})

_FEATURE_WEIGHT = _struct({"feature": _S, "coefficient": _D, "importance": _D})

MODEL_RESULT = _struct({
    "roc_auc": _D, "accuracy": _D,
    "precision_above": _D, "recall_above": _D, "f1_above": _D,
    "precision_below": _D, "recall_below": _D, "f1_below": _D,
    "confusion_matrix": T.ArrayType(T.ArrayType(_L)),
    "top_features": T.ArrayType(_FEATURE_WEIGHT),
    "val_rows": _L,
})

VALIDATION_RECORD = _struct({
    "run_timestamp": _S, "model_version": _S, "data_version": _S, "val_rows": _L,
    "results": T.MapType(_S, MODEL_RESULT),
})

MODEL_METADATA = _struct({
    "version": _S, "training_date": _S, "data_snapshot": _S,
    "config": _struct({"model_type": _S}),
    "training_data": _struct({
        "real_train_rows": _L, "synthetic_train_rows": _L, "total_train_rows": _L,
        "test_rows": _L, "synthetic_pct": _D,
        "target_balance_train": T.MapType(_S, _L), "target_balance_test": T.MapType(_S, _L),
    }),
    "result": MODEL_RESULT,
    "feature_count": _L, "features": T.ArrayType(_S), "notes": _S,
})

SNAPSHOT_METADATA = _struct({
    "version_tag": _S, "snapshot_timestamp": _S,
    "total_rows": _L, "real_rows": _L, "synthetic_rows": _L, "synthetic_pct": _D,
    "unique_videos": _L, "unique_channels": _L,
    "poll_label_counts": T.MapType(_S, _L),
    "vertical_counts": T.MapType(_S, _L), "tier_counts": T.MapType(_S, _L),
    "baseline_video_rows": _L, "baseline_median_rows": _L,
    "parquet_file": _S, "baselines_file": _S, "medians_file": _S, "notes": _S,
})

HOLDOUT_META = _struct({
    "created_at": _S, "seed": _L, "total_val_rows": _L, "rows_per_cell": T.MapType(_S, _L),
})
