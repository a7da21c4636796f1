"""Exact interpolated quantiles of groups of any size.

The built-in ``percentile`` keeps every distinct value of a group in one buffer; with three verticals
or two classes that buffer is a third of the table. Here a bounded sketch gives each quantile a
bracket of values, and one combined count per distinct value inside the bracket finds the exact
order statistics. Rows outside the brackets collapse to one row per task. Ranks that a bracket misses
and brackets too large to sort are narrowed by counts, round by round, until they are found.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsemark.functions.numbers import finite
from pulsemark.session import cut

SKETCH_ACCURACY = 10_000
# Brackets of at most this many groups are broadcast; the number is counted, not assumed.
BROADCAST_GROUPS = 20_000
# Values of one bracket that one task may sort.
FINISH_ROWS = 1_000_000
# Parts into which a round cuts a bracket.
SLOTS = 256


def unpivot(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Numeric columns as (keys, feature, value) rows without NULL, NaN or infinities."""
    typed = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    long = typed.unpivot(list(keys), list(columns), "feature", "value")
    return long.withColumn("value", finite(F.col("value"))).where(F.col("value").isNotNull())


def quantiles_of(
    long: DataFrame,
    keys: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int = SKETCH_ACCURACY,
    finish: int = FINISH_ROWS,
) -> DataFrame:
    """Exact quantiles of ``value`` per ``keys``: rows of (keys, p, value, n).

    A sketch's rank error is at most n / accuracy; brackets reach four times as far on each side.
    Groups smaller than ``accuracy`` rows use their whole range. A rank outside its bracket, and a
    bracket expected to hold more than ``finish`` rows, go on in rounds that narrow by counts
    (``_narrowed``), so that every quantile is found and no task sorts more than ``finish`` values
    of one bracket (the expectation's error apart).
    """
    keys = list(keys)
    margin = 4.0 / accuracy
    lows = [max(0.0, p - margin) for p in probabilities]
    highs = [min(1.0, p + margin) for p in probabilities]

    sketches = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("value", lows + highs, accuracy).alias("cut"),
        F.min("value").alias("lowest"), F.max("value").alias("highest"),
    )
    small = F.col("n") < accuracy
    targets = F.array(*[
        F.struct(
            F.lit(i).alias("i"), F.lit(float(p)).alias("p"),
            F.when(small | F.lit(p - margin <= 0), F.col("lowest"))
            .otherwise(F.element_at("cut", i + 1)).alias("lo"),
            F.when(small | F.lit(p + margin >= 1), F.col("highest"))
            .otherwise(F.element_at("cut", len(probabilities) + i + 1)).alias("hi"),
            ((F.col("n") - 1) * F.lit(float(p))).alias("rank"),
        )
        for i, p in enumerate(probabilities)
    ])
    brackets = cut(sketches.select(*keys, "n", "lowest", "highest", targets.alias("targets")))
    groups, largest = brackets.agg(F.count(F.lit(1)), F.max("n")).first()
    wanted = brackets.select(*keys, "n", "lowest", "highest", F.explode("targets").alias("t")).select(
        *keys, "n", "lowest", "highest", "t.*")
    wanted = wanted.withColumns({"first": F.floor("rank"), "second": F.ceil("rank")})
    # A bracket holds about 2 * margin of its group; a group below ``accuracy`` rows is one.
    direct = (F.col("n") < max(accuracy, 1)) | (F.col("n") * (2 * margin) <= finish)
    few = (groups or 0) * len(probabilities) <= BROADCAST_GROUPS
    if (largest or 0) < accuracy:  # whole ranges, which hold every rank
        found = _counted_off(long, keys, wanted, few)
    else:
        found = cut(_counted_off(long, keys, wanted.where(direct), few))
        missed = F.col("a").isNull() | F.col("b").isNull()
        late = found.where(missed).select(*keys, "i")
        far = wanted.where(~direct).select(*keys, "i")
        open_ = wanted.join(late.unionByName(far), [*keys, "i"], "left_semi")
        if largest * (2 * margin) > finish or found.where(missed).limit(1).count():
            rest = _narrowed(long, keys, open_, accuracy, finish)
            found = found.where(~missed).unionByName(rest)
    between = F.col("a") + (F.col("b") - F.col("a")) * (F.col("rank") - F.floor("rank"))
    return found.select(*keys, "p", between.alias("value"), "n")


def _counted_off(long: DataFrame, keys: list[str], targets: DataFrame, few: bool) -> DataFrame:
    """The values at the positions ``first`` and ``second`` of each target, as a and b.

    One combined count per distinct value inside [lo, hi]; smaller values are one row. A position
    outside the bracket gives NULL.
    """
    small = F.broadcast(targets) if few else targets
    placed = (
        long.join(small.select(*keys, "i", "lo", "hi"), keys)
        .where(F.col("value") <= F.col("hi"))
        .groupBy(*keys, "i", F.when(F.col("value") >= F.col("lo"), F.col("value")).alias("inside"))
        .agg(F.count(F.lit(1)).alias("times"))
    )
    ordered = Window.partitionBy(*keys, "i").orderBy(F.col("inside").asc_nulls_first())
    ranked = placed.withColumn("upto", F.sum("times").over(ordered))

    def at(position: str):
        hit = (F.col("upto") - F.col("times") <= F.col(position)) & (F.col(position) < F.col("upto"))
        return F.max(F.when(hit, F.col("inside")))

    about = [*keys, "i", "p", "n", "rank"]
    return (
        ranked.join(small.select(*about, "first", "second"), [*keys, "i"])
        .groupBy(*about).agg(at("first").alias("a"), at("second").alias("b"))
    )


def _narrowed(long: DataFrame, keys: list[str], targets: DataFrame, accuracy: int, finish: int) -> DataFrame:
    """Exact order statistics whatever the first brackets were: rounds of counts.

    Each position is a target of its own with limits [least, most] that hold it for certain and a
    bracket [lo, hi] inside them. A round counts the rows below, at and inside the ends: a position
    at an end is found; otherwise the limits become the part that holds it, whose ends are values of
    that part, and a sketch of that part gives the next bracket. Every round takes at least the ends
    out, so the rounds end whatever the sketch says; with its usual error a round keeps about a
    hundredth of the rows. Parts of at most ``finish`` rows are counted off by value.
    """
    about = [*keys, "i", "p", "n", "rank"]
    one = targets.select(*about, "lowest", "highest", "lo", "hi", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("first").alias("at")),
        F.struct(F.lit(1).alias("side"), F.col("second").alias("at")))).alias("s"))
    state = cut(one.select(
        *about, F.col("s.side").alias("side"), F.col("s.at").alias("at"),
        F.col("lowest").alias("least"), F.col("highest").alias("most"), "lo", "hi"))
    steps = [j / SLOTS for j in range(SLOTS + 1)]
    v, lo, hi, at = (F.col(c) for c in ("value", "lo", "hi", "at"))
    name = [*about, "side"]
    hits, last = [], []
    while True:
        count = state.count()
        if not count:
            break
        few = count <= BROADCAST_GROUPS
        held = F.broadcast(state) if few else state
        inner = F.when((v > lo) & (v < hi), v)
        lower, upper = F.when(v < lo, v), F.when(v > hi, v)
        seen = cut(long.join(held, keys).groupBy(*name, "at", "least", "most", "lo", "hi").agg(
            F.count(lower).alias("below"), F.count_if(v == lo).alias("at_lo"), F.count(inner).alias("mid"),
            F.count_if((v == hi) & (hi > lo)).alias("at_hi"),
            F.max(lower).alias("before"), F.min(upper).alias("after"),
            F.min(inner).alias("mid_lo"), F.max(inner).alias("mid_hi"),
            F.percentile_approx(inner, steps, accuracy).alias("grid")))
        from_mid = F.col("below") + F.col("at_lo")
        from_hi = from_mid + F.col("mid")
        beyond = from_hi + F.col("at_hi")
        part = (F.when(at < F.col("below"), "low").when(at < from_mid, "lo").when(at < from_hi, "mid")
                .when(at < beyond, "hi").otherwise("high"))
        told = seen.withColumn("part", part)
        hits.append(told.where("part in ('lo', 'hi')").select(
            *name, F.when(F.col("part") == "lo", lo).otherwise(hi).alias("found")))
        mid = F.col("part") == "mid"
        least = F.when(mid, F.col("mid_lo")).when(F.col("part") == "low", F.col("least")).otherwise(F.col("after"))
        most = F.when(mid, F.col("mid_hi")).when(F.col("part") == "low", F.col("before")).otherwise(F.col("most"))
        slot = F.floor((at - from_mid) * SLOTS / F.col("mid")).cast("int")
        near = [F.get("grid", F.greatest(slot - 1, F.lit(0))), F.get("grid", F.least(slot + 2, F.lit(SLOTS)))]
        rest = told.where("part not in ('lo', 'hi')").withColumns({"_least": least, "_most": most})
        last.append(rest.where(mid & (F.col("mid") <= finish)).select(
            *name, "at", F.col("_least").alias("lo"), F.col("_most").alias("hi")))
        state = cut(rest.where(~(mid & (F.col("mid") <= finish))).select(
            *name, "at", F.col("_least").alias("least"), F.col("_most").alias("most"),
            F.when(mid, F.greatest(near[0], F.col("_least"))).otherwise(F.col("_least")).alias("lo"),
            F.when(mid, F.least(near[1], F.col("_most"))).otherwise(F.col("_most")).alias("hi")))
    if last:
        ready = cut(reduce(DataFrame.unionByName, last))
        # Both sides of a quantile keep a bracket of their own under i * 2 + side.
        ready = ready.withColumns({"i": F.col("i") * 2 + F.col("side"), "first": F.col("at"), "second": F.col("at")})
        ended = _counted_off(long, keys, ready, ready.count() <= BROADCAST_GROUPS)
        hits.append(ended.select(
            *keys, F.expr("i div 2").cast("int").alias("i"), "p", "n", "rank",
            F.expr("i % 2").cast("int").alias("side"), F.col("a").alias("found")))
    if not hits:
        return targets.select(*about, F.lit(None).cast("double").alias("a"), F.lit(None).cast("double").alias("b"))
    return reduce(DataFrame.unionByName, hits).groupBy(*about).agg(*[
        F.max(F.when(F.col("side") == side, F.col("found"))).alias(c) for side, c in ((0, "a"), (1, "b"))])


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int = SKETCH_ACCURACY,
    finish: int = FINISH_ROWS,
) -> DataFrame:
    """Exact quantiles of several columns per group: rows of (keys, feature, p, value, n)."""
    long = unpivot(df, keys, columns)
    return quantiles_of(long, [*keys, "feature"], probabilities, accuracy, finish)


def quantile_columns(quantiles: DataFrame, keys: Sequence[str], names: dict[float, str]) -> DataFrame:
    """Turn (keys, p, value, n) rows into one row per group with a named column per probability."""
    return quantiles.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name) for p, name in names.items()],
    )
