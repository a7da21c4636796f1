"""Names, codes, windows and thresholds the results depend on."""

# --- fixed values: polls -------------------------------------------------------------------
POLL_LABELS = ["upload", "24h", "7d"]
# Age in hours at which an observation counts for a label, inclusive at both ends.
POLL_WINDOWS = {"upload": (0, 6), "24h": (20, 30), "7d": (156, 180)}
# flag column, minimum whole hours of age (strict), flag that must already be set
POLL_STAGES = {
    "upload": ("upload_poll_done", 6, None),
    "24h": ("day1_poll_done", 30, "upload_poll_done"),
    "7d": ("day7_poll_done", 180, "day1_poll_done"),
}
MIN_COMPLETION_PCT = 90
DUE_LIMIT = 100
CHANNEL_BATCH = 500
BASELINE_POOL = 50
BASELINE_KEEP = 30

# --- fixed values: column groups -----------------------------------------------------------
STATIC_COLS = [
    "video_id", "channel_id", "channel_handle",
    "title", "description", "tags",
    "duration_seconds", "category_id", "category_name",
    "published_at", "vertical", "tier",
    "contains_synthetic_media",
]
METRIC_COLS = ["view_count", "like_count", "comment_count", "subscriber_count"]
THUMBNAIL_COLS = ["face_count", "brightness", "colorfulness"]
TEXT_COLS = ["title", "description", "channel_handle"]
# Columns of any length, which pass as few shuffles as possible.
LONG_COLS = ["title", "description", "tags"]
NON_NEGATIVE_PREFIXES = [
    "view_count_", "like_count_", "comment_count_", "subscriber_count_", "duration_seconds",
]
REQUIRED_MEDIANS = [
    "baseline_median_views", "baseline_median_likes",
    "baseline_median_comments", "baseline_median_engagement_rate",
]

# --- fixed values: segments ----------------------------------------------------------------
TIERS = ["S", "M", "L"]
VERTICALS = ["Education", "Lifestyle", "Tech"]
TIER_RANGES = {"S": (1_000, 100_000), "M": (100_000, 1_000_000), "L": (1_000_000, 10_000_000)}
TIER_TARGETS = {"S": 150, "M": 100, "L": 75}
MIN_UPLOADS_PER_WEEK = {"S": 1.0, "M": 1.0, "L": 0.5}
VELOCITY_WEEKS = 4

# --- fixed values: category ids ------------------------------------------------------------
CATEGORY_NAMES = {
    "1": "Film & Animation", "2": "Autos & Vehicles", "10": "Music",
    "15": "Pets & Animals", "17": "Sports", "19": "Travel & Events",
    "20": "Gaming", "22": "People & Blogs", "23": "Comedy",
    "24": "Entertainment", "25": "News & Politics", "26": "Howto & Style",
    "27": "Education", "28": "Science & Technology", "29": "Nonprofits & Activism",
}

# --- fixed values: text classes ------------------------------------------------------------
TITLE_CLASSES = {
    0: "neutral", 1: "question", 2: "exclamation", 3: "listicle",
    4: "how_to", 5: "emoji_heavy", 6: "all_caps", 7: "clickbait",
}
DESCRIPTION_CLASSES = {
    0: "neutral", 1: "has_timestamps", 2: "has_links", 3: "link_heavy",
    4: "has_hashtags", 5: "minimal", 6: "long_form",
}
LISTICLE_WORDS = ["top ", " best ", " ways ", " things ", " tips "]
# Characters Python's str.split and str.strip treat as whitespace.
WHITESPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
EMOJI_CLASS = r"[\x{1F600}-\x{1F9FF}\x{2702}-\x{27B0}\x{1FA00}-\x{1FA6F}]"

# --- fixed values: model inputs ------------------------------------------------------------
TARGET = "above_baseline"
NOT_FEATURES = [
    "video_id", "channel_id", "channel_handle", "title", "description", "tags",
    "category_id", "category_name",
    "published_at", "poll_timestamp_upload", "poll_timestamp_24h", "poll_timestamp_7d",
    "above_baseline", "engagement_7d", "baseline_engagement",
    "contains_synthetic_data", "contains_synthetic_media",
    "baseline_channel_handle", "baseline_video_count",
    "baseline_median_views", "baseline_median_likes",
    "baseline_median_comments", "baseline_median_engagement_rate",
    "vertical", "tier",
    "duration_minutes",
    "hours_since_publish_upload", "hours_since_publish_24h",
    "face_count",
]
NOT_PROFILED = ["video_id", "above_baseline", "is_short", "is_long"]
DENSITY_FEATURES = [
    "view_count_upload", "view_count_24h", "view_count_7d", "like_count_24h", "comment_count_24h",
]
CLASS_HISTOGRAM_FEATURES = [
    "view_count_velocity_24h", "view_velocity_ratio", "view_velocity_acceleration",
]
DENSITY_PAIRS = [
    ("view_velocity_ratio", "like_rate_24h"),
    ("view_count_upload_vs_baseline", "view_velocity_acceleration"),
]

# --- fixed values: synthetic rows ----------------------------------------------------------
SYNTHETIC_COUNTS = [
    "view_count_upload", "like_count_upload", "comment_count_upload", "subscriber_count_upload",
    "view_count_24h", "like_count_24h", "comment_count_24h", "subscriber_count_24h",
    "view_count_7d", "like_count_7d", "comment_count_7d", "subscriber_count_7d",
    "face_count", "duration_seconds",
]
SYNTHETIC_REALS = [
    "hours_since_publish_upload", "hours_since_publish_24h", "hours_since_publish_7d",
    "brightness", "colorfulness",
]
SYNTHETIC_CATEGORIES = ["vertical", "tier", "category_id"]
SYNTHETIC_TEXT = "[Synthetic]"
BASELINE_COLS = [
    "baseline_video_count",
    "baseline_median_views", "baseline_median_likes",
    "baseline_median_comments", "baseline_median_engagement_rate",
    "baseline_channel_handle",
]

# --- fixed values: evaluation --------------------------------------------------------------
METRIC_NAMES = [
    "roc_auc", "accuracy", "f1_above", "precision_above", "recall_above",
    "f1_below", "precision_below", "recall_below",
]
