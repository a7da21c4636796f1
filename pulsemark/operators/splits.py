"""Reproducible stratified splits against a locked holdout.

Rows are picked by the smallest hash of (id, seed) in each stratum, an exact number per stratum. The
18 strata each hold a large share of the table, so rows are never ranked stratum by stratum: a
histogram of hash prefixes finds the prefix each quota ends in, only rows with that prefix are ranked,
and membership is a comparison with one threshold per stratum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemark.constants import TARGET
from pulsemark.session import cut

HOLDOUT_FRACTION = 0.30
TEST_FRACTION = 0.20
_PREFIX = 4
# Strata are counted; up to so many, their quotas and thresholds go to every task.
BROADCAST_STRATA = 10_000


def stratum() -> Column:
    """vertical, tier and target as one key."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in ("vertical", "tier", TARGET)]
    return F.concat_ws("_", *parts)


def stratum_counts(df: DataFrame) -> DataFrame:
    """Rows per stratum."""
    return df.groupBy(stratum().alias("stratum")).agg(F.count(F.lit(1)).alias("n"))


def quotas(counts: DataFrame, drawn: int, total: int) -> DataFrame:
    """Largest-remainder share of ``drawn`` rows for each stratum; ties go to the first name.

    ``counts`` has one row per stratum, so the window over all of it is small.
    """
    exact = F.col("n") * F.lit(drawn) / F.lit(max(total, 1))
    shared = counts.withColumn("base", F.floor(exact)).withColumn("rest", exact - F.col("base"))
    everything = Window.partitionBy(F.lit(0))
    order = everything.orderBy(F.desc("rest"), "stratum")
    spare = F.lit(drawn) - F.sum("base").over(everything)
    given = F.col("base") + F.when(F.row_number().over(order) <= spare, 1).otherwise(0)
    return shared.withColumn("quota", given.cast("long")).select("stratum", "n", "quota")


def thresholds(keyed: DataFrame, quota: DataFrame, few: bool = False) -> DataFrame:
    """The last (hash, id) inside each stratum's quota. ``keyed`` has stratum, hash and video_id, one
    row per id. ``few``: there are so few strata that they may be broadcast."""
    beside = F.broadcast if few else lambda df: df
    prefix = F.substring("hash", 1, _PREFIX)
    histogram = keyed.groupBy("stratum", prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("stratum").orderBy("prefix"))
    edge = histogram.withColumn("upto", upto).join(beside(quota.select("stratum", "quota")), "stratum").where(
        (F.col("quota") > F.col("upto") - F.col("n")) & (F.col("quota") <= F.col("upto"))
    ).select("stratum", "prefix", (F.col("quota") - (F.col("upto") - F.col("n"))).alias("inside"))
    order = Window.partitionBy("stratum", "prefix").orderBy("hash", "video_id")
    return (
        keyed.withColumn("prefix", prefix).join(beside(edge), ["stratum", "prefix"])
        .withColumn("rank", F.row_number().over(order)).where("rank = inside")
        .select("stratum", F.col("hash").alias("last_hash"), F.col("video_id").alias("last_id"))
    )


def hashed_keys(df: DataFrame, seed: int = 42) -> DataFrame:
    """The narrow key table, cut once because several passes read it; a holdout and a split may share it."""
    hashed = F.md5(F.concat_ws(":", F.col("video_id"), F.lit(str(seed))).cast("binary"))
    return cut(df.select("video_id", stratum().alias("stratum"), hashed.alias("hash")))


def _within(keyed: DataFrame, quota: DataFrame, strata: int) -> DataFrame:
    """``keyed`` with a flag for rows inside the quota; with few strata no row is shuffled for it."""
    few = strata <= BROADCAST_STRATA
    last = thresholds(keyed, quota, few)
    marked = keyed.join(F.broadcast(last) if few else last, "stratum", "left")
    before = (F.col("hash") < F.col("last_hash")) | (
        (F.col("hash") == F.col("last_hash")) & (F.col("video_id") <= F.col("last_id"))
    )
    return marked.select("video_id", "stratum", F.coalesce(before, F.lit(False)).alias("inside"))


def _counted(keyed: DataFrame) -> tuple[DataFrame, int, int]:
    """Rows per stratum, all rows and the number of strata."""
    counts = cut(keyed.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")))
    row = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    return counts, row[0] or 0, row[1]


def draw_holdout(
    df: DataFrame, fraction: float = HOLDOUT_FRACTION, seed: int = 42, keyed: DataFrame | None = None
) -> DataFrame:
    """M1: ids and strata of a new holdout. Raises on an empty table or a stratum of one row.

    ``keyed`` is the table's ``hashed_keys`` with the seed, where the caller has it already.
    """
    keyed = hashed_keys(df, seed) if keyed is None else keyed
    counts, total, strata = _counted(keyed)
    if total == 0:
        raise ValueError(
            "no rows to draw a holdout from: check for videos with all three polls and for channels "
            "with usable medians"
        )
    small = [r["stratum"] for r in counts.where("n < 2").limit(50).collect()]
    if small:
        raise ValueError(f"cannot stratify, strata with fewer than 2 rows: {sorted(small)}")
    drawn = total - math.ceil(total * (1 - fraction))
    return _within(keyed, quotas(counts, drawn, total), strata).where("inside").select("video_id", "stratum")


def split(
    df: DataFrame, holdout_ids: DataFrame, seed: int = 42, test_fraction: float = TEST_FRACTION,
    keyed: DataFrame | None = None,
) -> DataFrame:
    """The table with a ``split`` column of val, train or test.

    Every recorded id is kept out of train and test, also ids not present now. A stratum of one row
    among the rest cannot be split and raises. ``keyed`` as in ``draw_holdout``.
    """
    recorded = holdout_ids.select("video_id").distinct()
    keyed = hashed_keys(df, seed) if keyed is None else keyed
    rest = cut(keyed.join(recorded, "video_id", "left_anti"))
    counts, total, strata = _counted(rest)
    lone = [r["stratum"] for r in counts.where("n < 2").limit(50).collect()]
    if lone:
        raise ValueError(f"cannot split, strata with fewer than 2 rows: {sorted(lone)}")
    train = total - math.ceil(total * test_fraction)
    marked = _within(rest, quotas(counts, train, total), strata).select(
        "video_id", F.when(F.col("inside"), "train").otherwise("test").alias("split")
    )
    return df.join(marked, "video_id", "left").withColumn(
        "split", F.coalesce("split", F.lit("val"))
    )


def with_folds(df: DataFrame, folds: int, seed: int = 42, label: str = TARGET, key: str = "video_id") -> DataFrame:
    """M8: the table with an int column ``fold`` from 0, stratified on the label.

    The folds of a class differ by one row at most. A class with fewer rows than folds leaves some of them out; a NULL
    label is a class of its own. Rows with one key have one fold, which can make a class with repeated keys less even. All
    edges of all classes come from one histogram of hash prefixes; no class is ranked as a whole. An older column ``fold`` is replaced.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    named = df.select(
        F.struct(*[df[c] for c in df.columns if c != "fold"]).alias("_row"),
        F.coalesce(F.col(label).cast("string"), F.lit("None")).alias("_class"), name.alias("_key"),
        F.md5(F.concat_ws(":", name, F.lit(str(seed))).cast("binary")).alias("_hash"))
    keyed = cut(named.select("_class", "_key", "_hash"))
    prefix = F.substring("_hash", 1, _PREFIX)
    histogram = cut(keyed.groupBy("_class", prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("n")))
    classes = cut(histogram.groupBy("_class").agg(F.sum("n").alias("rows")))
    beside = F.broadcast if classes.count() <= BROADCAST_STRATA else lambda rows: rows
    # The first j folds hold this many rows.
    wanted = classes.select("_class", F.explode(F.sequence(F.lit(1), F.lit(max(folds - 1, 1)))).alias("j"), "rows").withColumn(
        "quota", F.floor(F.col("rows") * F.col("j") / F.lit(folds)))
    upto = F.sum("n").over(Window.partitionBy("_class").orderBy("_prefix"))
    edges = histogram.withColumn("upto", upto).join(beside(wanted), "_class").where(
        (F.col("quota") > F.col("upto") - F.col("n")) & (F.col("quota") <= F.col("upto"))
    ).groupBy("_class", "_prefix").agg(F.collect_set(F.col("quota") - (F.col("upto") - F.col("n"))).alias("inside"))
    order = Window.partitionBy("_class", "_prefix").orderBy("_hash", "_key")
    last = (
        keyed.withColumn("_prefix", prefix).join(beside(edges), ["_class", "_prefix"])
        .withColumn("rank", F.row_number().over(order)).where(F.array_contains("inside", F.col("rank").cast("long")))
        .groupBy("_class").agg(F.collect_list(F.struct("_hash", "_key")).alias("_last"))
    )
    empty = wanted.where("quota = 0").groupBy("_class").agg(F.count(F.lit(1)).cast("int").alias("_empty"))
    limits = cut(classes.select("_class").join(last, "_class", "left").join(empty, "_class", "left"))
    passed = F.size(F.filter(F.coalesce("_last", F.array()), lambda x: x < F.struct("_hash", "_key")))
    if folds < 2:
        passed = F.lit(0)
    return named.join(beside(limits), "_class").select(
        "_row.*", (F.coalesce("_empty", F.lit(0)) * F.lit(int(folds > 1)) + passed).cast("int").alias("fold"))


def vanished_ids(df: DataFrame, holdout_ids: DataFrame) -> DataFrame:
    """M2: recorded ids that the table no longer has."""
    return holdout_ids.select("video_id").distinct().join(
        df.select("video_id"), "video_id", "left_anti"
    )


