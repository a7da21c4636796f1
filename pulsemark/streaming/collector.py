"""Label, deduplicate and record a stream of observations."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pulsemark.constants import POLL_STAGES
from pulsemark.operators.collection import first_observations, label_observations
from pulsemark.schemas import VIDEOS_TO_TRACK
from pulsemark.sources.tracking_store import VersionedTable

# The widest window is open for 24 hours, so a repeat can follow its first row by that long.
REPEAT_DELAY = "25 hours"


def label_stream(observations: DataFrame) -> DataFrame:
    """T1 on a stream."""
    return label_observations(observations)


def first_per_label(labelled: DataFrame, delay: str = REPEAT_DELAY) -> DataFrame:
    """T2 on a stream: one row per (video_id, poll_label). State is dropped once the watermark passes.

    A watermark needs a zoned time, so a zoned copy of the poll time carries it.
    """
    timed = labelled.withColumn("_event_time", F.col("poll_timestamp").cast("timestamp"))
    return timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(
        ["video_id", "poll_label"]
    ).drop("_event_time")


KINDS = ("first", "repeat", "late")


def sorted_out(labelled: DataFrame, delay: str = REPEAT_DELAY) -> DataFrame:
    """T2 with state of its own: every row of a stream, with ``kind`` first, repeat or late.

    ``first`` is the earliest row per (video_id, poll_label) of the first micro-batch that has one, ``late`` a row whose poll time is
    below the watermark, which ``dropDuplicatesWithinWatermark`` would drop without a word. Rows without a poll time are
    late too. Of rows at the same time the one that comes first in order of all columns is taken. A pair's state is its first
    poll time; a timer removes it once the watermark is beyond that time by ``delay``: rows of its window are late by then, and
    a row after it would be first again. State and rows of a pair are read batch by batch, so that a pair of any size fits into one task.
    """
    keys, columns = ["video_id", "poll_label"], labelled.columns
    # Spark takes late rows from an operator with timers by the column that carries the watermark. So each row is doubled before
    # the shuffle: one that moves the watermark and ends there, and one without a time in that column, which no filter takes.
    at = F.col("poll_timestamp").cast("timestamp")
    doubled = labelled.select("*", F.unix_millis(at).alias("_ms"), F.xxhash64(*columns).alias("_order"), F.explode(
        F.when(at.isNotNull(), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))).alias("_clock"))
    stated = doubled.withColumn("_at", F.when(F.col("_clock"), at)).withWatermark("_at", delay).where("_at is null")
    schema = T.StructType([*labelled.schema.fields, T.StructField("kind", T.StringType())])
    span = int(pd.Timedelta(delay).total_seconds() * 1000)

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        if state.hasTimedOut:
            state.remove()
            return
        known, held = state.exists and state.get[0] + span >= watermark, None
        for batch in batches:
            # 0 and below: there is no watermark yet
            late = batch["_ms"].isna() | ((batch["_ms"] < watermark) if watermark > 0 else False)
            kind = late.map({True: "late", False: "repeat"})
            on_time = batch[~late]
            if not known and len(on_time):
                best = on_time.sort_values(["_ms", "_order"]).iloc[[0]]
                if held is None or tuple(best[["_ms", "_order"]].iloc[0]) < tuple(held[["_ms", "_order"]].iloc[0]):
                    held, best = best, held
                    kind = kind.drop(held.index)
                    batch = batch.drop(held.index)
                    if best is not None:  # an earlier Arrow batch's candidate is a repeat after all
                        yield best[columns].assign(kind="repeat")
            if len(batch):
                yield batch[columns].assign(kind=kind)
        if held is not None:
            state.update((int(held["_ms"].iloc[0]),))
            yield held[columns].assign(kind="first")
        elif not known and state.exists:
            state.remove()
        if state.exists:
            state.setTimeoutTimestamp(max(state.get[0] + span, watermark + 1))

    return stated.groupBy(*keys).applyInPandasWithState(
        run, schema, "first_ms bigint", "append", GroupStateTimeout.EventTimeTimeout)


class StatefulRecorder:
    """T3 over ``sorted_out``: first rows into the snapshot table and the tracking log, late rows into a table of their own.

    Repeats are counted beside them, per video and label. A repeated batch replaces its own folders.
    """

    def __init__(self, spark: SparkSession, root: str, run: str = "0"):
        self.spark, self.root, self.run = spark, root.rstrip("/"), run
        self.recorder = Recorder(spark, root, run)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        name = batch_name(self.run, batch_id)
        # One run of the state function feeds all three tables.
        batch.write.mode("overwrite").parquet(f"{self.root}/sorted/{name}")
        rows = self.spark.read.schema(batch.schema).parquet(f"{self.root}/sorted/{name}")
        rows.where("kind = 'late'").drop("kind").write.mode("overwrite").parquet(f"{self.root}/late_observations/{name}")
        rows.where("kind = 'repeat'").groupBy("video_id", "poll_label").agg(F.count(F.lit(1)).alias("n")).write.mode(
            "overwrite").parquet(f"{self.root}/repeats/{name}")
        self.recorder(rows.where("kind = 'first'").drop("kind"), batch_id)

    def late(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/late_observations").drop("batch")

    def repeats(self) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.root}/repeats")
        return rows.groupBy("video_id", "poll_label").agg(F.sum("n").alias("n"))


def record_with_state(labelled: DataFrame, root: str, checkpoint: str, delay: str = REPEAT_DELAY) -> StreamingQuery:
    """Run the stateful recorder over what is available now, then stop. A restart goes on from the checkpoint's state."""
    recorder = StatefulRecorder(labelled.sparkSession, root, run_of(checkpoint))
    return (
        sorted_out(labelled, delay).writeStream.foreachBatch(recorder).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def batch_name(run: str, batch_id: int) -> str:
    """A batch's folder. The run keeps batches of another checkpoint, which count from 0 too, apart."""
    return f"batch={run}-{batch_id:010d}"


def run_of(checkpoint: str) -> str:
    """The name of the run that a checkpoint belongs to; the same after a restart."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]


class TrackingLog:
    """Tracking rows as one small folder per micro-batch, merged per video when read.

    A batch writes what it saw and nothing else, so its cost does not grow with the table. The merge
    combines before the shuffle. ``publish`` writes the merged rows as the next version of a table.
    """

    def __init__(self, spark: SparkSession, path: str, run: str = "0"):
        self.spark, self.path, self.run = spark, path.rstrip("/"), run

    def add(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{batch_name(self.run, batch_id)}")

    def read(self) -> DataFrame:
        return merge_tracking(self.spark.read.schema(VIDEOS_TO_TRACK).parquet(self.path))

    def publish(self, table: VersionedTable) -> str:
        return table.write(self.read())


def merge_tracking(rows: DataFrame) -> DataFrame:
    """One row per video: first seen time, and every flag that any row has set."""
    flags = [flag for flag, _, _ in POLL_STAGES.values()]
    return rows.groupBy("video_id").agg(
        *[F.min(c).alias(c) for c in ("channel_id", "published_at", "first_seen_at")],
        *[F.bool_or(f).alias(f) for f in flags],
    )


class Recorder:
    """One micro-batch into the snapshot table and the tracking log.

    Snapshots are written first, flags after, so a flag never stands without its snapshot. A batch
    replaces its own folders, so repeating it after a failure changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str, run: str = "0"):
        self.spark, self.run = spark, run
        self.snapshots = f"{root.rstrip('/')}/video_snapshots"
        self.tracking = TrackingLog(spark, f"{root.rstrip('/')}/tracking_log", run)

    def read_snapshots(self) -> DataFrame:
        """T2 across batches and runs: the first row per video and label."""
        rows = self.spark.read.parquet(self.snapshots)
        return first_observations(rows.drop("batch"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        target = f"{self.snapshots}/{batch_name(self.run, batch_id)}"
        first_observations(batch).write.mode("overwrite").parquet(target)
        written = batch.sparkSession.read.schema(batch.schema).parquet(target)
        self.tracking.add(merge_tracking(written.select(
            "video_id", "channel_id", "published_at", F.col("poll_timestamp").alias("first_seen_at"),
            *[(F.col("poll_label") == label).alias(flag) for label, (flag, _, _) in POLL_STAGES.items()],
        )), batch_id)


def record_stream(labelled: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Run the recorder over what is available now, then stop."""
    recorder = Recorder(labelled.sparkSession, root, run_of(checkpoint))
    return (
        labelled.writeStream.foreachBatch(recorder).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


class NewVideos:
    """T4: put the videos of a stream that no one tracks yet into the tracking log, one folder per micro-batch.

    ``tracked`` gives the tracking table as it is now. It is read anew in every batch, as a static side that is read
    once would not see what other runs or writers add meanwhile. Videos that other batches or runs have put into
    the log are left out too. A batch that is repeated after a failure replaces its own folder, and is not kept from
    it by what it wrote before. Runs follow each other; two at the same time could both insert a video, which the
    log's merge makes one row again.
    """

    def __init__(self, spark: SparkSession, path: str, tracked: Callable[[], DataFrame], run: str = "0"):
        self.log, self.tracked = TrackingLog(spark, path, run), tracked

    def _logged(self, batch_id: int) -> DataFrame | None:
        """Video ids in the folders of all other batches; None before the first folder."""
        spark, own = self.log.spark, batch_name(self.log.run, batch_id).removeprefix("batch=")
        path = spark._jvm.org.apache.hadoop.fs.Path(self.log.path)
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return None
        schema = T.StructType([*VIDEOS_TO_TRACK.fields, T.StructField("batch", T.StringType())])
        return spark.read.schema(schema).parquet(self.log.path).where(F.col("batch") != own).select("video_id")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        flags = [F.lit(False).alias(flag) for flag, _, _ in POLL_STAGES.values()]
        seen = batch.where("video_id is not null").groupBy("video_id").agg(
            F.min("channel_id").alias("channel_id"), F.min("published_at").alias("published_at"),
            F.min("poll_timestamp").alias("first_seen_at")).select("*", *flags)
        for known in (self.tracked().select("video_id"), self._logged(batch_id)):
            if known is not None:
                seen = seen.join(known, "video_id", "left_anti")
        self.log.add(seen, batch_id)


def insert_new_videos(observations: DataFrame, path: str, checkpoint: str, tracked: Callable[[], DataFrame]) -> StreamingQuery:
    """Insert what is available now, then stop; ``NewVideos`` says which videos are new."""
    sink = NewVideos(observations.sparkSession, path, tracked, run_of(checkpoint))
    return (
        observations.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
