"""Long poll rows to one wide row per video."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemark.constants import LONG_COLS, METRIC_COLS, POLL_LABELS, STATIC_COLS, THUMBNAIL_COLS
from pulsemark.session import cut

# Rows of one poll are ordered by time; equal times fall back on the measured values, so the
# latest row is the same whichever task sees it first.
_ORDER = ["poll_timestamp", *METRIC_COLS, "hours_since_publish", *THUMBNAIL_COLS]


def _latest(label: str, payload: Sequence[str], order: Sequence[str]) -> Column:
    """Latest row of a label as one struct.

    ``max`` over a struct is combined before the shuffle, so a video that owns a third of all rows
    sends one row per task; a window would sort all of its rows in one place.
    """
    extra = [c for c in payload if c not in order]
    return F.max(F.when(F.col("poll_label") == label, F.struct(*order, *extra)))


def latest_polls(snapshots: DataFrame) -> DataFrame:
    """One row per (video_id, poll_label), the latest by poll time."""
    order = [c for c in _ORDER if c in snapshots.columns]
    keys = ["video_id", "poll_label"]
    rest = [c for c in snapshots.columns if c not in order and c not in keys]
    picked = snapshots.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("r"))
    return picked.select(*[c if c in keys else F.col(f"r.{c}").alias(c) for c in snapshots.columns])


def triplet_counts(snapshots: DataFrame) -> DataFrame:
    """A1: how many of the three named labels each video has, and whether it has them all."""
    seen = [F.max((F.col("poll_label") == name).cast("int")) for name in POLL_LABELS]
    total = seen[0] + seen[1] + seen[2]
    return snapshots.where(F.col("poll_label").isNotNull()).groupBy("video_id").agg(
        total.alias("n_labels"), (total == len(POLL_LABELS)).alias("complete")
    )


def pivot_polls(
    snapshots: DataFrame,
    static_cols: Sequence[str] | None = None,
    metric_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Deduplicate, keep complete triplets and pivot.

    Static and thumbnail columns come from the upload row. Pass only the columns needed: without texts
    this is one aggregation, with them it is ``pivot_parts`` and ``with_late``.
    """
    return with_late(*pivot_parts(snapshots, static_cols, metric_cols))


def _wanted(snapshots: DataFrame, static_cols, metric_cols) -> tuple[list[str], list[str], list[str]]:
    """The static, metric and ordering columns of a pivot."""
    static = list(static_cols) if static_cols is not None else STATIC_COLS + THUMBNAIL_COLS
    static = [c for c in static if c != "video_id" and c in snapshots.columns]
    metrics = list(metric_cols) if metric_cols is not None else list(METRIC_COLS)
    metrics += ["hours_since_publish", "poll_timestamp"]
    return static, metrics, [c for c in _ORDER if c in snapshots.columns]


def pivot_parts(
    snapshots: DataFrame,
    static_cols: Sequence[str] | None = None,
    metric_cols: Sequence[str] | None = None,
    texts: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame | None, list[str]]:
    """A pivot in two parts, to be put together by ``with_late``, and its columns.

    The first part, which is stored, has no texts, so that they do not pass its aggregation and joins. The second has the
    texts, and what ranks behind them among equal polls, of the upload rows of complete videos alone. Both
    pick by the same order, of which the first part knows the beginning, so they pick the same row.

    Where ``snapshots`` lacks the texts, ``texts`` adds them to such rows, each of which it keeps at least once. It is given
    the upload rows of complete videos: Spark does not move that semi join below a join that adds texts.
    """
    whole = texts(snapshots) if texts else snapshots
    static, metrics, order = _wanted(whole, static_cols, metric_cols)
    ranked = order + [c for c in dict.fromkeys(static + metrics) if c not in order]
    columns = ["video_id", *static, *[f"{c}_{label}" for label in POLL_LABELS for c in metrics]]
    long = [i for i, c in enumerate(ranked) if c in LONG_COLS]
    if not long:
        return _pivoted(whole, static, metrics, metrics, order), None, columns
    late = ranked[long[0]:]
    # Joins drop null keys, so a null video, which is a group of its own, has a key without the mark.
    key = F.coalesce(F.concat(F.lit("+"), F.col("video_id").cast("string")), F.lit("-"))
    early = [[c for c in part if c not in late] for part in (static, metrics)]
    wide = cut(_pivoted(snapshots, early[0], early[1], metrics, order).withColumn("_key", key), free=True)
    uploads = snapshots.where(F.col("poll_label") == POLL_LABELS[0]).withColumn("_key", key)
    known = uploads.join(wide.select("_key"), "_key", "left_semi")
    if texts:  # stored, so that what the narrow rows have shuffled is gone before the texts are
        known = texts(cut(known, free=True))
    picked = known.groupBy("_key").agg(F.max(F.struct(*ranked)).alias("r"))
    return wide, picked.select("_key", *[
        F.col(f"r.{c}").alias(c if c in static else f"{c}_{POLL_LABELS[0]}") for c in late]), columns


def with_late(wide: DataFrame, late: DataFrame | None, columns: Sequence[str]) -> DataFrame:
    """The parts of a pivot together; columns that were added to the first part follow."""
    if late is None:
        return wide
    added = [c for c in wide.columns if c not in columns and c != "_key"]
    return wide.join(late, "_key").select(*columns, *added)


def _pivoted(snapshots: DataFrame, static: Sequence[str], upload_metrics: Sequence[str], metrics: Sequence[str],
             order: Sequence[str]) -> DataFrame:
    """Complete triplets with their latest polls, in one aggregation."""
    own = [upload_metrics, *[metrics] * (len(POLL_LABELS) - 1)]
    slots = [
        _latest(label, [*static, *own[i]] if i == 0 else own[i], order).alias(f"p{i}")
        for i, label in enumerate(POLL_LABELS)
    ]
    triplets = (
        snapshots.where(F.col("poll_label").isin(POLL_LABELS)).groupBy("video_id").agg(*slots)
        .where("p0 is not null and p1 is not null and p2 is not null")
    )
    wide = ["video_id"] + [F.col(f"p0.{c}").alias(c) for c in static]
    for i, label in enumerate(POLL_LABELS):
        wide += [F.col(f"p{i}.{c}").alias(f"{c}_{label}") for c in own[i]]
    return triplets.select(*wide)


def pivot_multiplicity(snapshots: DataFrame) -> DataFrame:
    """Rows per video that plain joins of the three poll tables would give.

    Upload rows join twice, so u upload, d day-one and w week rows make u*u*d*w. The number is
    computed from counts; the repeated rows themselves are never built.
    """
    n = [F.count_if(F.col("poll_label") == name) for name in POLL_LABELS]
    counted = snapshots.groupBy("video_id").agg(
        *[c.alias(f"n{i}") for i, c in enumerate(n)]
    ).where("n0 > 0 and n1 > 0 and n2 > 0")
    return counted.select("video_id", (F.expr("n0 * n0 * n1 * n2")).alias("joined_rows"))


def combine_polls(*batches: DataFrame) -> DataFrame:
    """The snapshots of one run as one frame."""
    combined = batches[0]
    for batch in batches[1:]:
        combined = combined.unionByName(batch)
    return combined


def run_counts(snapshots: DataFrame) -> DataFrame:
    """Rows, videos and channels per label of one run."""
    return snapshots.groupBy("poll_label").agg(
        F.count(F.lit(1)).alias("rows_written"),
        F.count_distinct("video_id").alias("videos"),
        F.count_distinct("channel_id").alias("channels_done"),
    )
