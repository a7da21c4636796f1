"""The locked holdout, written once and never changed."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from pulsemark.operators.splits import HOLDOUT_FRACTION, draw_holdout, split
from pulsemark.session import cut
from pulsemark.sources.files import exists, read_record, write_record


class HoldoutStore:
    """Ids as a Parquet dataset beside a small JSON record; ids never pass through the driver."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/splits/holdout"

    def exists(self) -> bool:
        return exists(self.spark, f"{self.path}/record/_SUCCESS")

    def save(self, ids: DataFrame, record: dict) -> None:
        if self.exists():
            raise ValueError(f"a holdout is already locked at {self.path}")
        # Ids without a record are the remains of a lost job: the record is what locks them.
        ids.write.mode("overwrite").parquet(f"{self.path}/ids")
        write_record(self.spark, record, f"{self.path}/record")

    def _required(self) -> None:
        if not self.exists():
            raise RuntimeError(f"no holdout at {self.path}; create it once before splitting")

    def ids(self) -> DataFrame:
        self._required()
        return self.spark.read.schema("video_id string, stratum string").parquet(f"{self.path}/ids")

    def record(self) -> dict:
        self._required()
        return read_record(self.spark, f"{self.path}/record")


def create_holdout(
    df: DataFrame, store: HoldoutStore, now: datetime, fraction: float = HOLDOUT_FRACTION,
    seed: int = 42, confirm: Callable[[dict], bool] | None = None, write: bool = True,
) -> dict:
    """M1: draw and lock a holdout. A declined or dry run (``write=False``) writes nothing."""
    if store.exists():
        raise ValueError(f"a holdout is already locked at {store.path}")
    ids = cut(draw_holdout(df, fraction, seed))
    cells = {r["stratum"]: r["count"] for r in ids.groupBy("stratum").count().collect()}
    record = {
        "created_at": now.isoformat(), "seed": seed,
        "total_val_rows": sum(cells.values()), "rows_per_cell": dict(sorted(cells.items())),
    }
    if confirm is not None and not confirm(record):
        raise RuntimeError("holdout creation declined")
    if write:
        store.save(ids, record)
    return record


def split_against(df: DataFrame, store: HoldoutStore, seed: int = 42) -> DataFrame:
    """M2: split against the locked holdout; the record stays as it is."""
    return split(df, store.ids(), seed)
