"""The collected tables with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from pulsemark import schemas
from pulsemark.operators.baselines import channel_medians

TABLE_SCHEMAS: dict[str, StructType] = {
    "video_snapshots": schemas.VIDEO_SNAPSHOTS,
    "videos_to_track": schemas.VIDEOS_TO_TRACK,
    "channels_to_track": schemas.CHANNELS_TO_TRACK,
    "channel_candidates": schemas.CHANNEL_CANDIDATES,
    "channel_baseline_videos": schemas.CHANNEL_BASELINE_VIDEOS,
    "channel_baseline_medians": schemas.CHANNEL_BASELINE_MEDIANS,
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the warehouse folder; the schema is given, never inferred."""
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{root}/{name}")


def read_jdbc(spark: SparkSession, name: str, options: dict[str, str]) -> DataFrame:
    """A table through JDBC. Give partitionColumn, lowerBound, upperBound and numPartitions in
    ``options`` for anything large: without them one task reads it all."""
    return spark.read.format("jdbc").options(dbtable=name, **options).load()


def poll_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Labelled poll rows; the label test reaches the Parquet scan."""
    return read_table(spark, root, "video_snapshots").where("poll_label is not null")


def baseline_videos(spark: SparkSession, root: str) -> DataFrame:
    """S2."""
    return read_table(spark, root, "channel_baseline_videos")


def baseline_medians(spark: SparkSession, root: str, stored: bool = False) -> DataFrame:
    """S3: stored medians, or medians computed from the baseline videos."""
    if stored:
        return read_table(spark, root, "channel_baseline_medians")
    return channel_medians(baseline_videos(spark, root))


def append(df: DataFrame, root: str, name: str) -> None:
    """K6: append rows, in the table's column order and types."""
    wanted = [f for f in TABLE_SCHEMAS[name].fields if f.name in df.columns]
    df.select(*[df[f.name].cast(f.dataType) for f in wanted]).write.mode("append").parquet(f"{root}/{name}")


def append_json(df: DataFrame, path: str) -> None:
    """K5: append rows as newline-delimited JSON."""
    df.write.mode("append").json(path)


def sample_csv(df: DataFrame, path: str, n: int = 100, seed: int = 42) -> None:
    """A seeded random sample of ``n`` rows as CSV; arrays and structs as JSON text."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    flat = df.select(*[
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
        else F.col(f.name) for f in df.schema.fields
    ])
    flat.orderBy(F.rand(seed)).limit(n).coalesce(1).write.mode("errorifexists").csv(path, header=True)
