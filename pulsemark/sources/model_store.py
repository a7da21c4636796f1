"""Saved models and their records: write, load, list, compare, and the validation history."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.ml.classification import (
    GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemark import schemas
from pulsemark.operators.learners import Entry
from pulsemark.operators.scaling import Scaler
from pulsemark.sources.files import exists, matches, read_record, write_record

_READERS = {
    "lr_l1": LogisticRegressionModel, "rf": RandomForestClassificationModel, "gbt": GBTClassificationModel,
}
_RESULT = ["accuracy", "roc_auc", "precision_above", "recall_above", "f1_above",
           "precision_below", "recall_below", "f1_below"]


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/models"


def save_model(
    spark: SparkSession, entry: Entry, root: str, version: str, data_snapshot: str, now: datetime,
    notes: str = "", overwrite: bool = False,
) -> dict:
    """Fitted members, scaler, feature list and record under ``models/<version>``."""
    base = f"{_folder(root)}/{version}"
    if exists(spark, base) and not overwrite:
        raise ValueError(f"model {version!r} already exists; use another version or overwrite=True")
    for name, model in entry.members.items():
        model.write().overwrite().save(f"{base}/{name}")
    record = {
        "version": version, "training_date": now.isoformat(), "data_snapshot": data_snapshot,
        "config": {"model_type": entry.kind, "params": entry.params, "members": list(entry.members)},
        "training_data": entry.training, "result": entry.result,
        "scaler": entry.scaler.record() if entry.scaler else None,
        "feature_count": len(entry.columns), "features": entry.columns, "notes": notes,
    }
    write_record(spark, record, f"{base}/metadata", "overwrite")
    return record


def load_model(spark: SparkSession, root: str, version: str) -> tuple[Entry, dict]:
    """A saved model ready to score, and its record."""
    base = f"{_folder(root)}/{version}"
    if not exists(spark, f"{base}/metadata/_SUCCESS"):
        raise FileNotFoundError(f"no model {version!r} under {root}")
    record = read_record(spark, f"{base}/metadata")
    members = {m: _READERS[m].load(f"{base}/{m}") for m in record["config"]["members"]}
    kept = record["scaler"]
    scaler = Scaler(kept["columns"], kept["means"], kept["deviations"]) if kept else None
    entry = Entry(record["config"]["model_type"], members, record["features"], scaler,
                  record["result"], record["training_data"], record["config"]["params"])
    return entry, record


def load_family(spark: SparkSession, root: str, versions: list[str]) -> dict[str, Entry]:
    """All models of the given base versions, keyed by name, or by version/name if there are
    several versions. The underscore keeps v3.1 from matching v3.10."""
    if not versions or any(not v for v in versions):
        raise ValueError("give at least one base version")
    loaded = {}
    for version in versions:
        found = matches(spark, f"{_folder(root)}/{version}_*/metadata/_SUCCESS")
        tags = sorted(p.split("/")[-3] for p in found)
        if not tags:
            raise FileNotFoundError(f"no models of version {version!r} under {root}")
        for tag in tags:
            name = tag[len(version) + 1:]
            loaded[f"{version}/{name}" if len(versions) > 1 else name] = load_model(spark, root, tag)[0]
    return loaded


def model_records(spark: SparkSession, root: str) -> DataFrame:
    """All model records with their directory as ``model_name``; empty if none is saved."""
    pattern = f"{_folder(root)}/*/metadata"
    if not exists(spark, pattern):
        return spark.createDataFrame([], schemas.MODEL_METADATA).withColumn("model_name", F.lit(""))
    records = spark.read.schema(schemas.MODEL_METADATA).json(pattern)
    return records.withColumn("model_name", F.regexp_extract(F.input_file_name(), r"/models/([^/]+)/metadata/", 1))


def list_models(records: DataFrame) -> DataFrame:
    """One row per model."""
    return records.select(
        "version", F.col("config.model_type").alias("model_type"), F.col("result.roc_auc").alias("roc_auc"),
        F.col("training_data.real_train_rows").alias("real_rows"),
        F.col("training_data.synthetic_train_rows").alias("synth_rows"), "data_snapshot",
        F.substring("training_date", 1, 10).alias("training_date"), "notes",
    ).orderBy("version")


def compare_models(records: DataFrame) -> DataFrame:
    """The 14-column comparison."""
    return records.select(
        "version", F.col("config.model_type").alias("model_type"), "data_snapshot",
        F.substring("training_date", 1, 10).alias("training_date"),
        F.col("training_data.real_train_rows").alias("real_rows"),
        F.col("training_data.synthetic_train_rows").alias("synth_rows"),
        *[F.col(f"result.{m}").alias(m) for m in _RESULT],
    ).orderBy("version")


def model_table(records: DataFrame) -> DataFrame:
    """The wide flat record with the version's generation."""
    data = "training_data"
    return records.select(
        "model_name", "version", F.regexp_extract("version", r"(v\d+\.\d+)", 1).alias("generation"),
        "data_snapshot", F.col("config.model_type").alias("model_type"),
        F.col(f"{data}.total_train_rows").alias("train_rows"), F.col(f"{data}.test_rows").alias("test_rows"),
        F.col(f"{data}.target_balance_test").alias("classes_test"),
        F.col(f"{data}.target_balance_train").alias("classes_train"),
        *[F.col(f"result.{m}").alias(m) for m in _RESULT],
        F.col("result.confusion_matrix").alias("confusion_matrix"),
        F.col("feature_count").alias("features_count"), "features",
        F.col("result.top_features").alias("top_features"),
    ).orderBy("model_name")


def append_validation(
    spark: SparkSession, root: str, model_version: str, data_version: str,
    results: Mapping[str, Mapping], now: datetime,
) -> str:
    """K8: one validation run as one more JSON line; nothing written before is touched."""
    path = f"{_folder(root)}/{model_version}/validation_results"
    first = next(iter(results.values()), {})
    record = {
        "run_timestamp": f"{now.isoformat()}Z", "model_version": model_version,
        "data_version": data_version, "val_rows": first.get("val_rows", 0),
        "results": {k: dict(v) for k, v in results.items()},
    }
    write_record(spark, record, path, "append")
    return path


def validation_history(spark: SparkSession, root: str, model_version: str | None = None) -> DataFrame:
    """One row per run and model, without the wide fields; empty if there was no run."""
    pattern = f"{_folder(root)}/{model_version or '*'}/validation_results"
    if exists(spark, pattern):
        records = spark.read.schema(schemas.VALIDATION_RECORD).json(pattern)
    else:
        records = spark.createDataFrame([], schemas.VALIDATION_RECORD)
    exploded = records.select(
        "model_version", "run_timestamp", "data_version", F.explode("results").alias("model_name", "r")
    )
    return exploded.select(
        "model_version", "run_timestamp", "model_name", "data_version",
        *[F.col(f"r.{m}").alias(m) for m in _RESULT], F.col("r.val_rows").alias("val_rows"),
    ).orderBy("model_version", "run_timestamp", "model_name")
