"""Versioned snapshots of the data: write under a tag, find and read by tag, list.

Layout under a root: ``snapshots/<name>`` is a Parquet dataset and ``snapshots/<name>_meta`` its JSON
record. The tag is followed by an underscore in every name, so v3.1 never matches v3.10.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemark import schemas
from pulsemark.operators.profile import publish_range, snapshot_profile
from pulsemark.sources import tables
from pulsemark.sources.files import complete, exists, read_record, write_record

_PREFIX = {"videos": "snapshots", "baselines": "baselines", "medians": "medians", "splits": "splits"}


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/snapshots"


def _name(kind: str, tag: str, now: datetime) -> str:
    return f"{_PREFIX[kind]}_{tag}_{now:%Y%m%d_%H%M%S}"


def _refuse_existing(spark: SparkSession, root: str, kind: str, tag: str, overwrite: bool) -> None:
    if not overwrite and exists(spark, f"{_folder(root)}/{_PREFIX[kind]}_{tag}_*"):
        raise ValueError(f"{kind} snapshot {tag!r} already exists; use another tag or overwrite=True")


def describe_snapshot(df: DataFrame) -> dict:
    """A7 as a record: sizes, breakdowns, publish range and columns."""
    found: dict[str, dict[str, int]] = {}
    for r in snapshot_profile(df).collect():
        found.setdefault(r["measure"], {})[r["key"]] = r["n"]

    def single(measure: str) -> int:
        return found.get(measure, {}).get("all", 0)

    span = publish_range(df).first() if "published_at" in df.columns else None
    return {
        "total_rows": single("total_rows"),
        "unique_videos": single("unique_videos"), "unique_channels": single("unique_channels"),
        "poll_label_counts": found.get("poll_label", {}),
        "vertical_counts": found.get("vertical", {}), "tier_counts": found.get("tier", {}),
        "date_range": {
            "earliest_publish": str(span[0]) if span and span[0] else "",
            "latest_publish": str(span[1]) if span and span[1] else "",
        },
        "columns": df.columns,
        "synthetic_rows": single("synthetic_rows"),
    }


def save_videos(
    df: DataFrame, root: str, tag: str, now: datetime, notes: str = "", overwrite: bool = False
) -> dict:
    """K1: write poll rows, then their record, read back from the written files."""
    spark = df.sparkSession
    _refuse_existing(spark, root, "videos", tag, overwrite)
    name = _name("videos", tag, now)
    path = f"{_folder(root)}/{name}"
    df.write.mode("overwrite").parquet(path)
    about = describe_snapshot(spark.read.parquet(path))
    about.pop("synthetic_rows")
    record = {"version_tag": tag, "snapshot_timestamp": now.isoformat(), **about,
              "parquet_file": path, "notes": notes}
    write_record(spark, record, f"{path}_meta", "overwrite")
    return record


def save_final(
    df: DataFrame, root: str, tag: str, now: datetime, notes: str = "", overwrite: bool = False
) -> dict:
    """K3: write the model table with its real and synthetic counts."""
    spark = df.sparkSession
    _refuse_existing(spark, root, "videos", tag, overwrite)
    path = f"{_folder(root)}/{_name('videos', tag, now)}"
    df.write.mode("overwrite").parquet(path)
    about = describe_snapshot(spark.read.parquet(path))
    total, fake = about["total_rows"], about["synthetic_rows"]
    record = {
        "version_tag": tag, "snapshot_timestamp": now.isoformat(), **about,
        "real_rows": total - fake, "synthetic_rows": fake,
        "synthetic_pct": round(fake / total * 100, 1) if total else 0.0,
        "parquet_file": path, "notes": notes,
    }
    write_record(spark, record, f"{path}_meta", "overwrite")
    return record


def save_baselines(
    videos: DataFrame, medians: DataFrame, root: str, tag: str, now: datetime, notes: str = "",
    overwrite: bool = False,
) -> dict:
    """K2: baseline videos and medians under one tag."""
    spark = videos.sparkSession
    _refuse_existing(spark, root, "baselines", tag, overwrite)
    paths = {kind: f"{_folder(root)}/{_name(kind, tag, now)}" for kind in ("baselines", "medians")}
    videos.write.mode("overwrite").parquet(paths["baselines"])
    medians.write.mode("overwrite").parquet(paths["medians"])
    record = {
        "version_tag": tag, "snapshot_timestamp": now.isoformat(),
        "baseline_video_rows": spark.read.parquet(paths["baselines"]).count(),
        "baseline_median_rows": spark.read.parquet(paths["medians"]).count(),
        "baselines_file": paths["baselines"], "medians_file": paths["medians"], "notes": notes,
    }
    write_record(spark, record, f"{paths['baselines']}_meta", "overwrite")
    return record


def save_splits(
    split: DataFrame, root: str, tag: str, now: datetime, notes: str = "", overwrite: bool = False
) -> dict:
    """K4: train, test and validation rows as one dataset partitioned by split; features and target
    stay in the same rows, so they cannot come apart."""
    spark = split.sparkSession
    _refuse_existing(spark, root, "splits", tag, overwrite)
    path = f"{_folder(root)}/{_name('splits', tag, now)}"
    split.write.mode("overwrite").partitionBy("split").parquet(path)
    counted = spark.read.parquet(path).groupBy("split").count().collect()
    record = {
        "version_tag": tag, "snapshot_timestamp": now.isoformat(),
        "splits": {r["split"]: {"rows": r["count"], "cols": len(split.columns) - 1} for r in counted},
        "parquet_file": path, "notes": notes,
    }
    write_record(spark, record, f"{path}_meta", "overwrite")
    return record


def save_raw(
    videos: DataFrame | None, history: tuple[DataFrame, DataFrame] | None, root: str, tag: str,
    now: datetime, notes: str = "", overwrite: bool = False,
) -> dict[str, dict | str]:
    """K1, K2 as one step: either part is saved or its refusal reported, whatever the other does."""
    done: dict[str, dict | str] = {}
    jobs = {
        "videos": (lambda: save_videos(videos, root, tag, now, notes, overwrite)) if videos is not None else None,
        "baselines": (lambda: save_baselines(*history, root, tag, now, notes, overwrite)) if history else None,
    }
    for name, job in jobs.items():
        if job is None:
            continue
        try:
            done[name] = job()
        except ValueError as refusal:
            done[name] = str(refusal)
    return done


def _newest(spark: SparkSession, root: str, kind: str, tag: str) -> str:
    stamp = "[0-9]" * 8 + "_" + "[0-9]" * 6
    found = complete(spark, f"{_folder(root)}/{_PREFIX[kind]}_{tag}_{stamp}")
    if not found:
        raise FileNotFoundError(f"no {kind} snapshot for tag {tag!r} under {root}")
    return sorted(found)[-1]


def load_videos(spark: SparkSession, root: str, tag: str) -> tuple[DataFrame, dict]:
    """The newest snapshot of a tag and its record."""
    path = _newest(spark, root, "videos", tag)
    return spark.read.parquet(path), read_record(spark, f"{path}_meta")


def _newest_pair(spark: SparkSession, root: str, tag: str) -> tuple[str, str]:
    """Baseline videos and medians of the newest save that wrote both; they carry one time stamp."""
    stamp = "[0-9]" * 8 + "_" + "[0-9]" * 6
    found = [
        {path[-15:]: path for path in complete(spark, f"{_folder(root)}/{_PREFIX[kind]}_{tag}_{stamp}")}
        for kind in ("baselines", "medians")
    ]
    both = sorted(found[0].keys() & found[1].keys())
    if not both:
        raise FileNotFoundError(f"no complete baselines snapshot for tag {tag!r} under {root}")
    return found[0][both[-1]], found[1][both[-1]]


def load_baselines(spark: SparkSession, root: str, tag: str) -> tuple[DataFrame, DataFrame, dict | None]:
    """Baseline videos, the medians of the same save, and the record if there is one.

    A save that was lost between its two parts is passed over, so videos never meet older medians.
    """
    path, medians = _newest_pair(spark, root, tag)
    record = read_record(spark, f"{path}_meta") if exists(spark, f"{path}_meta") else None
    return spark.read.parquet(path), spark.read.parquet(medians), record


def load_splits(spark: SparkSession, root: str, tag: str, split: str | None = None) -> DataFrame:
    """The rows of a split snapshot; naming a split reads its partition only."""
    rows = spark.read.parquet(_newest(spark, root, "splits", tag))
    return rows.where(F.col("split") == split) if split else rows


def load_inputs(
    spark: SparkSession, source: str, root: str, raw_tag: str | None = None,
    baselines_tag: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Poll rows, baseline videos and medians, from the live tables (``tables``, ``bq``) or from
    snapshots (``snapshots``, ``gcs``). The baselines tag defaults to the raw tag."""
    if source in ("tables", "bq"):
        return (tables.poll_snapshots(spark, root), tables.baseline_videos(spark, root),
                tables.baseline_medians(spark, root))
    if source in ("snapshots", "gcs"):
        if not raw_tag:
            raise ValueError("a snapshot source needs a raw tag")
        videos, _ = load_videos(spark, root, raw_tag)
        history, medians, _ = load_baselines(spark, root, baselines_tag or raw_tag)
        return videos, history, medians
    raise ValueError(f"unknown source {source!r}; choose tables or snapshots")


def list_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Every snapshot record, classified by the fields it has."""
    pattern = f"{_folder(root)}/*_meta"
    if not exists(spark, pattern):
        records = spark.createDataFrame([], schemas.SNAPSHOT_METADATA)
    else:
        records = spark.read.schema(schemas.SNAPSHOT_METADATA).json(pattern)
    kind = F.when(F.col("total_rows").isNotNull(), "videos").when(
        F.col("baseline_video_rows").isNotNull(), "baselines"
    ).otherwise("unknown")
    return records.select(
        kind.alias("kind"), "version_tag", "snapshot_timestamp", "total_rows", "baseline_video_rows",
        "baseline_median_rows", "poll_label_counts", "notes",
    )
