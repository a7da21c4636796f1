"""Tables that are updated: every update is a new complete version, readers take the newest.

Plain Parquet has no UPDATE. A version counts only once its write has finished, so a job lost half-way
leaves the table as it was. Where a whole version is too much for a few flags, ``BucketedTable`` rewrites folders by hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemark.operators.collection import mark_done, set_flag
from pulsemark.session import cut
from pulsemark.sources.files import complete, exists


class VersionedTable:
    """K7: read the newest version, or write the next one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[str]:
        return complete(self.spark, f"{self.path}/v=*")

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self) -> DataFrame:
        found = self.versions()
        if not found:
            raise FileNotFoundError(f"no finished version under {self.path}")
        return self.spark.read.parquet(found[-1])

    def write(self, df: DataFrame) -> str:
        found = self.versions()
        number = int(found[-1].rsplit("v=", 1)[1]) + 1 if found else 1
        target = f"{self.path}/v={number:08d}"
        df.write.mode("overwrite").parquet(target)
        return target

    def add(self, rows: DataFrame) -> str:
        """Rows whose video is not in the table yet."""
        if not self.exists():
            return self.write(rows)
        current = self.read()
        fresh = rows.join(current.select("video_id"), "video_id", "left_anti")
        return self.write(current.unionByName(fresh))

    def mark(self, done: DataFrame, label: str) -> str:
        return self.write(mark_done(self.read(), done, label))


class BucketedTable:
    """K7 on large tables: folders by hash of the key, of which an update rewrites those alone in which a row changes.

    Rows are replaced by Spark's dynamic partition overwrite. Lost executors change nothing, as folders are exchanged once
    all of them are written; only a driver that is lost while it exchanges them can leave a folder out. A repeated update
    finds nothing to change and writes nothing. Writers follow each other. A null key is a key like any other in
    ``add``, and no update finds it.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "video_id", buckets: int = 256):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path.rstrip("/"), schema, key, buckets

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def _stored(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def _write(self, rows: DataFrame, mode: str) -> list[int]:
        """Write stored rows into their folders and name these, of which there are ``buckets`` at most."""
        touched = sorted(r.bucket for r in rows.select("bucket").distinct().collect())
        if touched:
            rows.hint("rebalance", "bucket").write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(
                "bucket").parquet(self.path)
        return touched

    def read(self) -> DataFrame:
        return self._stored().drop("bucket")

    def add(self, rows: DataFrame) -> list[int]:
        """Append one row for each key that the table does not have; the folders that got rows. Which of several rows of a key is
        taken is decided by the order of their columns."""
        rest = [f.name for f in self.schema.fields if f.name != self.key]
        one = rows.groupBy(self.key).agg(F.min(F.struct(*rest)).alias("r")).select(self.key, "r.*").select(*self.schema.names)
        new, old = self._placed(one), self._stored().select(F.col(self.key).alias("_key"), F.col("bucket").alias("_bucket"))
        # The folder is part of the key, so that the join's two sides agree on it.
        fresh = new.join(old, (new.bucket == F.col("_bucket")) & new[self.key].eqNullSafe(F.col("_key")), "left_anti")
        return self._write(cut(fresh), "append")

    def set_flag(self, ids: DataFrame, flag: str) -> list[int]:
        """``UPDATE .. SET flag = TRUE WHERE key IN (ids)``; the folders that were rewritten."""
        wanted = cut(ids.select(self.key).where(F.col(self.key).isNotNull()).distinct())
        stored = self._stored()
        unset = stored.where(~F.coalesce(flag, F.lit(False))).select(self.key, "bucket")
        found = sorted(r.bucket for r in unset.join(wanted, self.key, "left_semi").select("bucket").distinct().collect())
        if not found:
            return []
        return self._write(cut(set_flag(stored.where(F.col("bucket").isin(found)), wanted, self.key, flag)), "overwrite")
