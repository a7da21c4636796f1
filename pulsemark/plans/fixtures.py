"""The package's tables derived from the driver's star-schema parquet files.

Each function reads whole tables and returns a lazy frame, so work grows with the input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemark.functions.polls import category_name, duration_seconds

_CHANNEL_ID = "concat('UC', lpad(cast({0} as string), 8, '0'))"
_VIDEO_ID = "concat('v', lpad(cast({0} as string), 9, '0'))"


_SCHEMAS = {
    "customer": "c_custkey bigint, c_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double",
    "part": "p_partkey bigint, p_name string",
    "documents": "doc_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def schema_of(name: str) -> str:
    return _SCHEMAS[name]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The columns used of one table, with a given schema."""
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def channels(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer: handle, vertical, tier and subscribers (some negative)."""
    return table(spark, folder, "customer").selectExpr(
        f"{_CHANNEL_ID.format('c_custkey')} AS channel_id",
        "concat('@c', cast(c_custkey as string)) AS channel_handle",
        "case c_custkey % 3 when 0 then 'Education' when 1 then 'Lifestyle' else 'Tech' end AS vertical",
        "case cast(floor(c_custkey / 3.0) as bigint) % 3 when 0 then 'S' when 1 then 'M' else 'L' end AS tier",
        "cast(round(c_acctbal * 100) as bigint) AS subscriber_count",
        "c_custkey",
    )


def _published(df: DataFrame) -> DataFrame:
    return df.withColumn("published_at", F.expr(
        "cast(concat(substring(cast(o_orderdate as string), 1, 10), ' ', "
        "lpad(cast(o_orderkey % 24 as string), 2, '0'), ':00:00') as timestamp_ntz)"
    ))


def videos(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order: identifiers, publish time and duration, tracked or baseline."""
    orders = _published(table(spark, folder, "orders"))
    h = "case when o_orderkey % 4 in (0, 1) then concat(cast(o_orderkey % 3 as string), 'H') else '' end"
    m = "case when o_orderkey % 4 in (0, 2) then concat(cast(o_orderkey % 60 as string), 'M') else '' end"
    s = "case when o_orderkey % 4 in (0, 3) then concat(cast(o_orderkey % 59 as string), 'S') else '' end"
    return orders.selectExpr(
        "o_orderkey", "published_at",
        f"{_VIDEO_ID.format('o_orderkey')} AS video_id",
        f"{_CHANNEL_ID.format('o_custkey')} AS channel_id",
        "o_orderkey % 5 <> 0 AS is_tracked",
        f"case when o_orderkey % 101 = 0 then 'P1DT2H' else concat('PT', {h}, {m}, {s}) end AS duration",
        "cast(o_orderkey % 31 as string) AS category_id",
        "case when o_orderkey % 13 <> 0 then o_orderkey % 17 = 0 end AS contains_synthetic_media",
    )


def timed_videos(spark: SparkSession, folder: str) -> DataFrame:
    """Videos with parsed duration and category name."""
    return videos(spark, folder).withColumns({
        "duration_seconds": duration_seconds(F.col("duration")),
        "category_name": category_name(F.col("category_id")),
    })


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Title, description and tags per order; documents and parts are matched by equi-joins."""
    joined = _text_keys(spark, folder).join(_documents(spark, folder), "doc_id", "left")
    return joined.selectExpr("o_orderkey", *_text_columns())


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def _text_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The document's key and the part's name per order."""
    docs = _documents(spark, folder)
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    n_docs, n_parts = docs.count(), parts.count()
    keyed = table(spark, folder, "orders").select(
        "o_orderkey",
        (F.col("o_orderkey") % n_docs).alias("doc_id"),
        (F.col("o_orderkey") % n_parts).alias("p_partkey"),
    )
    return keyed.join(parts, "p_partkey", "left").drop("p_partkey")


def _text_columns() -> list[str]:
    start = "substring(text, 1, 60)"
    links = "' http://a.example/1 https://a.example/2 http://a.example/3 https://a.example/4 https://a.example/5'"
    return [
        f"""case o_orderkey % 9
              when 0 then {start} when 1 then concat('How to ', {start})
              when 2 then concat('TOP 10 ', {start}) when 3 then concat({start}, '?')
              when 4 then concat({start}, '!') when 5 then concat({start}, '\U0001F600\U0001F600✂')
              when 6 then upper(replace({start}, 'ß', 'ss'))
              when 7 then upper(replace(concat('! \U0001F600 ', {start}), 'ß', 'ss'))
            end AS title""",
        f"""case o_orderkey % 7
              when 0 then text when 1 then concat(text, {links})
              when 2 then concat(text, ' https://a.example/1') when 3 then concat(text, ' 0:30')
              when 4 then concat(text, ' #tag_é') when 5 then substring(text, 1, 20)
            end AS description""",
        "case when o_orderkey % 11 <> 0 then split(p_name, ' ') end AS tags",
    ]


_POLLS = [
    "l_orderkey AS o_orderkey",
    "case l_linenumber when 1 then 'upload' when 2 then '24h' when 3 then '7d' end AS poll_label",
    """case l_linenumber when 1 then round(l_tax * 50, 2) when 2 then round(20 + l_discount * 100, 2)
         when 3 then round(156 + l_quantity * 0.48, 2) else round(l_quantity, 2) end AS hours_since_publish""",
    "cast(round(l_extendedprice) * (l_linenumber * l_linenumber) as bigint) AS view_count",
    "cast(round(l_quantity * 40) * l_linenumber as bigint) AS like_count",
    "cast(l_suppkey % 50 as bigint) * l_linenumber AS comment_count",
    "cast(l_orderkey % 3 as int) AS face_count",
    "l_tax * 1000 AS brightness",
    "l_discount * 500 AS colorfulness",
]


_SNAPSHOT = [
    "video_id", "poll_timestamp", "poll_label", "channel_id", "channel_handle", "vertical", "tier",
    "title", "description", "tags", "duration_seconds", "category_id", "category_name",
    "published_at", "hours_since_publish", "view_count", "like_count", "comment_count",
    "subscriber_count", "face_count", "brightness", "colorfulness", "contains_synthetic_media",
]


def _polled(spark: SparkSession, folder: str, with_keys: bool) -> DataFrame:
    """Poll rows of tracked videos without texts, with the keys of these if wanted."""
    lines = table(spark, folder, "lineitem").selectExpr(*_POLLS)
    tracked = timed_videos(spark, folder).where("is_tracked").drop("is_tracked")
    if with_keys:
        tracked = tracked.join(_text_keys(spark, folder), "o_orderkey")
    rows = lines.join(tracked, "o_orderkey").join(channels(spark, folder).drop("c_custkey"), "channel_id")
    return rows.withColumn("poll_timestamp", F.expr(
        "published_at + make_dt_interval(0, 0, 0, cast(round(hours_since_publish * 3600, 6) as decimal(18,6)))"
    ))


def snapshots(spark: SparkSession, folder: str, with_text: bool = True) -> DataFrame:
    """Poll rows of tracked videos, with natural duplicates and unlabelled rows.

    Documents are joined last, so that no other join moves their texts.
    """
    if not with_text:
        return _polled(spark, folder, False).select(*[c for c in _SNAPSHOT if c not in _TEXTS])
    rows, add_texts = labelled_parts(spark, folder, "true")
    return add_texts(rows).select(*_SNAPSHOT)


_TEXTS = ("title", "description", "tags")


def labelled_parts(
    spark: SparkSession, folder: str, where: str = "poll_label is not null"
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Labelled poll rows with the keys of their texts, and the function that adds the texts to any such rows."""
    def add_texts(rows: DataFrame) -> DataFrame:
        return rows.join(_documents(spark, folder), "doc_id", "left").withColumns({
            c: F.expr(e.removesuffix(f" AS {c}")) for c, e in zip(_TEXTS, _text_columns())})

    return _polled(spark, folder, True).where(where), add_texts


def labelled(spark: SparkSession, folder: str, with_text: bool = True) -> DataFrame:
    return snapshots(spark, folder, with_text).where("poll_label is not null")


def baseline_videos(spark: SparkSession, folder: str) -> DataFrame:
    """Lifetime counts of the untracked orders; rows without any line drop out."""
    totals = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        (F.sum(F.expr("round(l_extendedprice)")).cast("bigint") * 3).alias("view_count"),
        F.sum(F.expr("round(l_quantity * 40)")).cast("bigint").alias("like_count"),
        F.sum(F.expr("l_suppkey % 50")).cast("bigint").alias("comment_count"),
    )
    base = timed_videos(spark, folder).where("not is_tracked").join(totals, "o_orderkey")
    return base.join(channels(spark, folder), "channel_id").select(
        "channel_id", "channel_handle", "vertical", "tier", "video_id", "published_at",
        "duration_seconds", "category_id", "category_name", "view_count", "like_count", "comment_count", "subscriber_count",
    )


def tracking(spark: SparkSession, folder: str) -> DataFrame:
    """Tracked videos with flags; some rows left out so that orphan snapshots exist."""
    return videos(spark, folder).where("is_tracked and o_orderkey % 97 <> 0").selectExpr(
        "video_id", "channel_id", "published_at",
        "published_at + interval 1 hour AS first_seen_at",
        "o_orderkey % 10 <> 9 AS upload_poll_done",
        "o_orderkey % 10 < 8 AS day1_poll_done",
        "o_orderkey % 10 < 6 AS day7_poll_done",
    )


def tracked_channels(spark: SparkSession, folder: str) -> DataFrame:
    return channels(spark, folder).where("c_custkey % 4 <> 0")


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Buffered candidate channels; subscribers spread over all tiers."""
    return channels(spark, folder).where("c_custkey % 4 = 0").selectExpr(
        "channel_id", "channel_handle", "vertical", "tier",
        "abs(subscriber_count) * (1 + c_custkey % 7) AS subscriber_count",
        "cast(c_custkey * 1000 as bigint) AS total_channel_views",
        "cast(c_custkey % 300 as bigint) AS total_channel_videos",
        "cast(c_custkey % 8 as double) / 4 AS upload_velocity_per_week",
        "timestamp_ntz'2001-01-01 00:00:00' + make_dt_interval(0, cast(c_custkey % 500 as int)) AS discovered_at",
        "c_custkey % 20 = 0 AS added_to_tracking",
    )


def uploads(spark: SparkSession, folder: str) -> DataFrame:
    """Recent uploads of channels: one per event, the user being the channel."""
    return table(spark, folder, "events").selectExpr(
        f"{_CHANNEL_ID.format('user_id')} AS channel_id", f"{_VIDEO_ID.format('event_id')} AS video_id",
        "ts AS published_at",
    )


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """Raw observations: one per event, the user being the video."""
    return observation_columns(table(spark, folder, "events"))


def observation_columns(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id", f"{_VIDEO_ID.format('user_id')} AS video_id",
        f"{_CHANNEL_ID.format('user_id % 40')} AS channel_id",
        "ts AS poll_timestamp",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(user_id as int)) AS published_at",
        "cast(round(value * 100) as bigint) AS view_count",
    )
