"""Running totals over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows that one task sorts at once, and the least and most parts a table is cut into.
PART_ROWS = 100_000
PARTS = (8, 20_000)


def parts_for(rows: int, each: int = PART_ROWS) -> int:
    """Into how many parts to cut a table of so many rows."""
    return min(PARTS[1], max(PARTS[0], -(-rows // each)))


def value_buckets(df: DataFrame, column: str, buckets: int | None = None) -> DataFrame:
    """Add ``_bucket``, an ordered bucket of near-equal size by value. The cuts are approximate; the
    order of the buckets is exact. Their number follows the counted rows unless it is given."""
    buckets = buckets or parts_for(df.count())
    shares = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(df.approxQuantile(column, shares, 0.25 / buckets))) or [0.0]
    edges = [-float("inf"), *cuts, float("inf")]
    return Bucketizer(splits=edges, inputCol=column, outputCol="_bucket").transform(df)


def running_total(df: DataFrame, value: str, order: list[str], name: str) -> DataFrame:
    """Add ``name``, the sum of ``value`` over all rows before this one by (_bucket, order).

    Bucket sums are a table of at most one row per bucket; rows are sorted inside their bucket only.
    """
    sums = df.groupBy("_bucket").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_offset")
    )
