"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "pulsemark") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    A temporary folder is made only where the setting is absent, that is in local runs.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    made = tempfile.mkdtemp(prefix="pulsemark-")
    context.setCheckpointDir(made)
    return context.getCheckpointDir().rstrip("/")


def cut(df: DataFrame, free: bool = False) -> DataFrame:
    """Write a frame to the shared folder and go on from the files.

    Later passes do not recompute it, also when executors are lost. Parquet keeps column pruning,
    filter pushdown and a known size, which a checkpoint of rows would not. With ``free`` the driver then collects its
    garbage, upon which Spark deletes the shuffle files of plans that are gone; they would stay until it does so by itself.
    """
    spark = df.sparkSession
    path = f"{_cuts(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if free:
        spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def cut_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Write frames of one schema, one at least, one after the other to one folder, and go on from the files."""
    path = None
    for df in frames:
        path = path or f"{_cuts(df.sparkSession)}/{uuid.uuid4().hex}"
        df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _cuts(spark: SparkSession) -> str:
    """The folder of this application's cuts, which no other application writes to."""
    return f"{shared_dir(spark)}/cut/{spark.sparkContext.applicationId}"


def discard_cuts(spark: SparkSession) -> None:
    """Delete what ``cut`` has written in this application, once its results are stored.

    Frames that still read it cannot be used afterwards.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_cuts(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
