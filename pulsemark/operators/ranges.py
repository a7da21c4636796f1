"""Join values with the ranges that hold them, as an equi-join over bins of several widths."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.session import cut

#: A range lies in so many bins at most: widths double until it does.
MOST_BINS = 4
#: Bins of the least width between the smallest and the largest value.
CELLS = 1 << 16
#: Bins of ranges that may be sent to every task, and values of a bin that one task may hold otherwise.
FEW_BINS, HOT_ROWS = 500_000, 2_000_000


def join_ranges(points: DataFrame, ranges: DataFrame, value: str, low: str, high: str,
                few_bins: int = FEW_BINS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each row of ``points`` with each row of ``ranges`` that holds its value: low <= value < high.

    A NULL end is open; ranges may overlap, be empty, or have NULL at both ends. A NULL or NaN value is in no range, nor
    has a range with a NaN end any values. The frames may share no column name.

    Each range is laid over bins of the width at which it covers ``MOST_BINS`` or less, so a range is few rows however
    wide it is; a value has one bin for each width that some range uses. The bins of the ranges are sent to all
    tasks if there are at most ``few_bins``; else both sides are shuffled by bin, and the values of a bin of more
    than ``hot_rows`` are dealt over several tasks, which all get the bin's ranges.
    """
    shared = sorted(set(points.columns) & set(ranges.columns))
    if shared:
        raise ValueError(f"both frames have columns {', '.join(shared)}")
    x, lo, hi = (F.col(c).cast("double") for c in (value, low, high))
    ends = points.agg(F.min(F.when(~F.isnan(x), x)).alias("lo"), F.max(F.when(~F.isnan(x), x)).alias("hi")).first()
    out = [*points.columns, *ranges.columns]
    if ends.lo is None:
        return points.crossJoin(ranges).limit(0)
    first, last = max(ends.lo, -1.7e308), min(ends.hi, 1.7e308)
    width = (last / CELLS - first / CELLS) or 1.0

    def cell(v):
        """The bin of the least width; values beyond the ends lie in the outer bins."""
        inside = F.least(F.greatest(v, F.lit(first)), F.lit(last))
        return F.least(F.floor(inside / width - first / width), F.lit(CELLS)).cast("long")

    mark = uuid.uuid4().hex  # names of this function's own columns
    a, b, level, bin_, piece = (f"{n}_{mark}" for n in ("a", "b", "level", "bin", "piece"))
    kept = ranges.where((lo.isNull() | hi.isNull() | (lo < hi)) & (lo.isNull() | ~F.isnan(lo)) & (hi.isNull() | ~F.isnan(hi)))
    kept = kept.where((lo.isNull() | (lo <= last)) & (hi.isNull() | (hi > first)))
    placed = kept.withColumns({a: F.when(lo.isNull(), F.lit(0)).otherwise(cell(lo)),
                               b: F.when(hi.isNull(), F.lit(CELLS)).otherwise(cell(hi))})
    wide = F.ceil(F.log2((F.col(b) - F.col(a) + 1) / F.lit(MOST_BINS - 1.0)))
    placed = placed.withColumn(level, F.greatest(wide, F.lit(0)).cast("int"))
    bins = cut(placed.withColumn(bin_, F.explode(F.expr(
        f"sequence(shiftright({a}, {level}), shiftright({b}, {level}))"))).drop(a, b))
    levels = [r[0] for r in bins.select(level).distinct().collect()]  # one for each doubling at most
    at = points.where(x.isNotNull() & ~F.isnan(x)).withColumn(a, cell(x)).withColumn(
        level, F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn(bin_, F.expr(f"shiftright({a}, {level})"))
    holds = (lo.isNull() | (x >= lo)) & (hi.isNull() | (x < hi))
    if bins.count() <= few_bins:
        return at.join(F.broadcast(bins), [level, bin_]).where(holds).select(*out)
    # Hot bins are no more than levels * rows / hot_rows.
    hot = cut(at.groupBy(level, bin_).agg(F.count("*").alias(piece)).where(F.col(piece) > hot_rows).withColumn(
        piece, F.ceil(F.col(piece) / hot_rows).cast("int")))
    some = F.coalesce(F.col(piece), F.lit(1))
    dealt = at.join(F.broadcast(hot), [level, bin_], "left").withColumn(
        piece, F.pmod(F.xxhash64(*points.columns), some).cast("int"))
    spread = bins.join(F.broadcast(hot), [level, bin_], "left").withColumn(
        piece, F.explode(F.sequence(F.lit(0), some - 1)))
    return dealt.join(spread, [level, bin_, piece]).where(holds).select(*out)
