"""Synthetic rows: a Gaussian copula over the measured columns, placed on real channels."""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulsemark.constants import (
    BASELINE_COLS, POLL_LABELS, SYNTHETIC_CATEGORIES, SYNTHETIC_COUNTS, SYNTHETIC_REALS, SYNTHETIC_TEXT,
)
from pulsemark.functions.numbers import floor_at
from pulsemark.operators.correlation import pair_moments
from pulsemark.operators.features import (
    add_duration, add_per_subscriber, add_target, add_velocity,
)
from pulsemark.operators.marginals import chosen_grids
from pulsemark.operators.ordering import parts_for, running_total
from pulsemark.session import cut

NUMERIC = SYNTHETIC_COUNTS + SYNTHETIC_REALS
GRID_POINTS = 201
MAX_CATEGORIES = 10_000

# Standard normal values and probabilities, read in both directions by interpolation.
_Z = np.linspace(-6.0, 6.0, 4001)
_P = np.array([NormalDist().cdf(z) for z in _Z])


def fit_copula(rows: DataFrame, max_categories: int = MAX_CATEGORIES, marginals: str = "grid") -> dict:
    """Marginals as quantile grids and category shares, and the correlation of normal scores.

    ``marginals`` is "grid" for the quantiles of the rows or "fitted" for those of the nearest
    distribution family (``operators.marginals``). What reaches the driver is bounded: a fixed grid per column, the categories of three columns and
    one number per column pair. A column with more than ``max_categories`` values is refused, not cut.
    """
    if marginals not in ("grid", "fitted"):
        raise ValueError(f"unknown marginals {marginals!r}")
    if marginals == "fitted":
        grids = chosen_grids(rows, NUMERIC, GRID_POINTS)
    else:
        shares = [i / (GRID_POINTS - 1) for i in range(GRID_POINTS)]
        row = rows.agg(*[
            F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(c) for c in NUMERIC
        ]).first()
        grids = {c: np.asarray(row[c] or [0.0] * GRID_POINTS, dtype="float64") for c in NUMERIC}
    categories = {}
    for c in SYNTHETIC_CATEGORIES:
        counted = rows.groupBy(c).count().orderBy(F.desc("count"), c).limit(max_categories + 1).collect()
        if len(counted) > max_categories:
            raise ValueError(f"{c} has more than {max_categories} values; it is not a category")
        n = np.array([r["count"] for r in counted], dtype="float64")
        categories[c] = ([r[c] for r in counted], np.cumsum(n) / n.sum())

    names = NUMERIC + SYNTHETIC_CATEGORIES

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps = np.linspace(0.0, 1.0, GRID_POINTS)
        for batch in batches:
            out = {}
            for c in NUMERIC:
                v = batch[c].to_numpy(dtype="float64", na_value=np.nan)
                low = np.searchsorted(grids[c], v, "left").clip(0, GRID_POINTS - 1)
                high = (np.searchsorted(grids[c], v, "right") - 1).clip(0, GRID_POINTS - 1)
                tied = (steps[low] + steps[high]) / 2
                share = np.where(high > low, tied, np.interp(v, grids[c], steps))
                out[c] = np.interp(share.clip(1e-6, 1 - 1e-6), _P, _Z)
            for c in SYNTHETIC_CATEGORIES:
                values, upto = categories[c]
                middle = dict(zip(values, (upto + np.concatenate([[0.0], upto[:-1]])) / 2))
                share = batch[c].map(middle).to_numpy(dtype="float64", na_value=0.5)
                out[c] = np.interp(share, _P, _Z)
            yield pd.DataFrame(out)

    typed = rows.select(*[F.col(c).cast("double").alias(c) for c in NUMERIC], *SYNTHETIC_CATEGORIES)
    scored = typed.mapInPandas(scores, ", ".join(f"`{c}` double" for c in names))
    matrix = np.eye(len(names))
    place = {c: i for i, c in enumerate(names)}
    for m in pair_moments(scored, names).collect():
        spread = (m["sxx"] - m["sx"] ** 2 / m["n"]) * (m["syy"] - m["sy"] ** 2 / m["n"]) if m["n"] else 0
        r = (m["sxy"] - m["sx"] * m["sy"] / m["n"]) / math.sqrt(spread) if spread > 1e-12 else 0.0
        i, j = place[m["feature_a"]], place[m["feature_b"]]
        matrix[i, j] = matrix[j, i] = r
    values, vectors = np.linalg.eigh(matrix)
    fixed = vectors @ np.diag(np.clip(values, 1e-6, None)) @ vectors.T
    scale = np.sqrt(np.diag(fixed))
    return {"grids": grids, "categories": categories,
            "factor": np.linalg.cholesky(fixed / np.outer(scale, scale))}


def _uniform(seed: int, stream: int) -> Column:
    """A uniform number from the row id alone, so a retried task draws the same row."""
    return (F.pmod(F.xxhash64("id", F.lit(seed), F.lit(stream)), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def sample_copula(spark: SparkSession, copula: dict, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows (id and the fitted columns); values stay within the seen range."""
    names = NUMERIC + SYNTHETIC_CATEGORIES
    draws = spark.range(n).select("id", *[_uniform(seed, i).alias(c) for i, c in enumerate(names)])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps = np.linspace(0.0, 1.0, GRID_POINTS)
        for batch in batches:
            normal = np.interp(batch[names].to_numpy(), _P, _Z) @ copula["factor"].T
            share = np.interp(normal, _Z, _P)
            out = {"id": batch["id"].to_numpy()}
            for i, c in enumerate(NUMERIC):
                out[c] = np.interp(share[:, i], steps, copula["grids"][c])
            for i, c in enumerate(SYNTHETIC_CATEGORIES, len(NUMERIC)):
                values, upto = copula["categories"][c]
                index = np.searchsorted(upto, share[:, i]).clip(0, len(values) - 1)
                out[c] = np.array(values, dtype=object)[index]
            yield pd.DataFrame(out)

    schema = "id long, " + ", ".join(f"`{c}` double" for c in NUMERIC)
    schema += ", " + ", ".join(f"`{c}` string" for c in SYNTHETIC_CATEGORIES)
    return draws.mapInPandas(place, schema)


def draw_channels(ids: DataFrame, real: DataFrame, seed: int = 42, slices: int | None = None) -> DataFrame:
    """A real channel for every id, drawn in proportion to the channel's rows.

    Channels get consecutive spans of positions, ids a hashed position, and the last span start at or
    before a position is its channel. Positions are cut into even slices that are sorted apart, as many
    as the counted ids and channels ask for; a channel with a third of all rows spans a third of them.
    """
    bucket = F.conv(F.substring(F.md5(F.col("channel_id").cast("binary")), 1, 3), 16, 10).cast("int")
    weights = cut(
        real.groupBy("channel_id").agg(F.count(F.lit(1)).alias("n")).withColumn("_bucket", bucket)
    )
    total, channels = weights.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    if total == 0:
        raise ValueError("no real rows to draw channels from")
    slices = slices or parts_for(ids.count() + channels)
    spans = running_total(weights, "n", ["channel_id"], "position")
    first = F.expr(f"position * {slices} div {total}")
    last = F.expr(f"(position + n - 1) * {slices} div {total}")
    starts = spans.select(
        F.lit(None).cast("long").alias("id"), "channel_id", "position",
        F.explode(F.sequence(first, last)).alias("slice"),
    )
    digest = F.md5(F.concat_ws(":", F.col("id").cast("string"), F.lit(str(seed))).cast("binary"))
    drawn = F.pmod(F.conv(F.substring(digest, 1, 13), 16, 10).cast("long"), F.lit(total))
    hits = ids.select("id").withColumn("position", drawn).select(
        "id", F.lit(None).cast("string").alias("channel_id"), "position",
        F.expr(f"position * {slices} div {total}").alias("slice"),
    )
    order = Window.partitionBy("slice").orderBy("position", F.col("id").asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = starts.unionByName(hits).withColumn(
        "channel_id", F.last("channel_id", ignorenulls=True).over(before)
    )
    return found.where("id is not null").select("id", "channel_id")


def channel_lookup(real: DataFrame) -> DataFrame:
    """Handle, segment and baselines of each channel, from its first row by video id."""
    wanted = ["channel_handle", "vertical", "tier"] + [c for c in BASELINE_COLS if c in real.columns]
    first = real.groupBy("channel_id").agg(F.min(F.struct("video_id", *wanted)).alias("r"))
    return first.select("channel_id", *[F.col(f"r.{c}").alias(c) for c in wanted])


def clean_synthetic(rows: DataFrame) -> DataFrame:
    """no negatives, whole counts, and counts and ages that never fall from poll to poll."""
    floored = {c: floor_at(F.col(c), 0) for c in NUMERIC if c in rows.columns}
    rows = rows.withColumns(floored)
    rows = rows.withColumns({
        c: F.bround(F.col(c).cast("double")).cast("long") for c in SYNTHETIC_COUNTS if c in rows.columns
    })
    for later, earlier in zip(POLL_LABELS[1:], POLL_LABELS):
        rows = rows.withColumns({
            f"{m}_{later}": F.greatest(f"{m}_{earlier}", f"{m}_{later}")
            for m in ("view_count", "like_count", "comment_count", "hours_since_publish")
        })
    return rows


def add_placeholders(rows: DataFrame) -> DataFrame:
    """Ids, the flag, and text and times a synthetic row does not have."""
    nothing = F.lit(None)
    return rows.withColumns({
        "video_id": F.format_string("syn-%06d", F.col("id")),
        "contains_synthetic_data": F.lit(True),
        "title": F.lit(SYNTHETIC_TEXT), "description": F.lit(SYNTHETIC_TEXT),
        "tags": F.array().cast("array<string>"), "category_name": F.lit("Synthetic"),
        "published_at": nothing.cast("timestamp_ntz"),
        "contains_synthetic_media": nothing.cast("boolean"),
        **{f"poll_timestamp_{p}": nothing.cast("timestamp_ntz") for p in POLL_LABELS},
    }).drop("id")


def add_synthetic_features(rows: DataFrame) -> DataFrame:
    """target, speeds and per-subscriber values; text and time features are zero."""
    rows = add_duration(add_per_subscriber(add_velocity(add_target(rows))))
    # What a row without text and time has nothing of.
    zero = [
        "title_length", "title_word_count", "title_category", "desc_length", "desc_link_count",
        "desc_hashtag_count", "desc_category", "tag_count", "has_tags",
        "publish_hour", "publish_dayofweek", "publish_is_weekend",
    ]
    return rows.withColumns({
        **{c: F.lit(0) for c in zero}, "duration_minutes": F.col("duration_seconds") / 60
    })


def read_by_generate(real: DataFrame) -> list[str]:
    """The columns of the real rows that ``generate`` reads, in their order."""
    wanted = {*NUMERIC, *SYNTHETIC_CATEGORIES, *BASELINE_COLS, "video_id", "channel_id", "channel_handle", "vertical", "tier"}
    return [c for c in real.columns if c in wanted]


def generate(
    real: DataFrame, n: int, seed: int = 42, max_categories: int = MAX_CATEGORIES, marginals: str = "grid",
    schema: StructType | None = None,
) -> DataFrame:
    """``n`` synthetic rows with the real frame's columns, or those of ``schema``, and the flag."""
    spark = real.sparkSession
    measured = sample_copula(spark, fit_copula(real, max_categories, marginals), n, seed).drop("vertical", "tier")
    placed = measured.join(draw_channels(spark.range(n), real, seed), "id")
    known = placed.join(channel_lookup(real), "channel_id")
    rows = add_synthetic_features(add_placeholders(clean_synthetic(known)))
    kept = [f for f in (schema or real.schema).fields if f.name != "contains_synthetic_data"]
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in kept
    ], "contains_synthetic_data")


def combine(real: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Real and synthetic rows with a flag that is never NULL."""
    return real.withColumn("contains_synthetic_data", F.lit(False)).unionByName(
        synthetic.withColumn("contains_synthetic_data", F.lit(True)), allowMissingColumns=True
    )


def rows_needed(real_rows: int, target_real_pct: float) -> int:
    """How many synthetic rows make real rows the given share."""
    return math.floor(real_rows / target_real_pct) - real_rows


def append_to_train(split: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Synthetic rows join the train split and no other."""
    return combine(split, synthetic.withColumn("split", F.lit("train")))
