from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulsemark.operators import splits
from pulsemark.sources.holdout_store import HoldoutStore, create_holdout, split_against

from frames import strata_frame

NOW = datetime(2026, 1, 1)


def ids(df):
    return {r.video_id for r in df.select("video_id").collect()}


def test_split_needs_a_holdout(spark, folder):
    with pytest.raises(RuntimeError):
        split_against(strata_frame(spark), HoldoutStore(spark, folder))


def test_holdout_size_and_record(spark, folder):
    df, store = strata_frame(spark, 30), HoldoutStore(spark, folder)
    record = create_holdout(df, store, NOW)
    assert abs(record["total_val_rows"] / df.count() - 0.3) < 0.05
    assert store.record() == record and len(record["rows_per_cell"]) == 18
    assert len(ids(store.ids())) == record["total_val_rows"]
    with pytest.raises(ValueError):
        create_holdout(df, store, NOW)


def test_declined_or_dry_run_writes_nothing(spark, folder):
    df, store = strata_frame(spark), HoldoutStore(spark, folder)
    with pytest.raises(RuntimeError):
        create_holdout(df, store, NOW, confirm=lambda record: False)
    assert create_holdout(df, store, NOW, write=False)["total_val_rows"] > 0
    assert not store.exists()


def test_splits_are_disjoint_complete_and_stratified(spark, folder):
    df, store = strata_frame(spark, 30), HoldoutStore(spark, folder)
    create_holdout(df, store, NOW)
    out = split_against(df, store)
    counted = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert out.count() == df.count() == sum(counted.values()) and set(counted) == {"train", "test", "val"}
    assert counted["test"] == -(-(df.count() - counted["val"]) // 5)
    cells = out.groupBy(splits.stratum().alias("s")).pivot("split").count().collect()
    assert all(None not in tuple(r) for r in cells)


def test_recorded_ids_never_reach_train_or_test(spark, folder):
    df, store = strata_frame(spark, 30), HoldoutStore(spark, folder)
    record = create_holdout(df, store, NOW)
    held = ids(store.ids())
    gone = sorted(held)[::2]
    left = df.where(~F.col("video_id").isin(gone))
    out = split_against(left, store)
    assert not held & ids(out.where("split <> 'val'"))
    assert ids(out.where("split = 'val'")) == held - set(gone)
    assert ids(splits.vanished_ids(left, store.ids())) == set(gone)
    assert store.record() == record and ids(store.ids()) == held


def test_same_seed_same_split_however_partitioned(spark):
    df = strata_frame(spark, 20)
    held = splits.draw_holdout(df, seed=7)
    assert ids(held) == ids(splits.draw_holdout(df.repartition(9), seed=7))
    assert ids(held) != ids(splits.draw_holdout(df, seed=8))
    first = {r.video_id: r.split for r in splits.split(df, held).collect()}
    again = {r.video_id: r.split for r in splits.split(df.repartition(3), held).collect()}
    assert first == again


def test_empty_and_small_strata(spark):
    df = strata_frame(spark)
    with pytest.raises(ValueError, match="no rows"):
        splits.draw_holdout(df.limit(0))
    lone = df.limit(1).withColumn("tier", F.lit("XL")).withColumn("video_id", F.lit("lone"))
    with pytest.raises(ValueError, match="XL"):
        splits.draw_holdout(df.unionByName(lone))


def test_thresholds_equal_plain_ranking(spark):
    """One stratum holds most rows; the picked rows are those a full ranking would pick."""
    import hashlib

    df = strata_frame(spark, 200).withColumn("tier", F.when(F.col("extra") < 1500, "S").otherwise(F.col("tier")))
    got = ids(splits.draw_holdout(df, 0.3, 42))
    rows = [(r.video_id, f"{r.vertical}_{r.tier}_{r.above_baseline}") for r in df.collect()]
    by_stratum = {}
    for video, stratum in rows:
        by_stratum.setdefault(stratum, []).append(video)
    total = len(rows)
    drawn = total - -(-total * 7 // 10)
    exact = {s: len(v) * drawn / total for s, v in by_stratum.items()}
    quota = {s: int(e) for s, e in exact.items()}
    for s in sorted(exact, key=lambda s: (-(exact[s] - int(exact[s])), s))[: drawn - sum(quota.values())]:
        quota[s] += 1
    want = set()
    for s, videos in by_stratum.items():
        ranked = sorted(videos, key=lambda v: (hashlib.md5(f"{v}:42".encode()).hexdigest(), v))
        want |= set(ranked[: quota[s]])
    assert got == want


@pytest.mark.parametrize("folds", [1, 2, 3, 7])
def test_folds_differ_by_one_row(spark, folds):
    """Classes of any size, NULL labels and keys, classes smaller than the number of folds, and any partitioning."""
    rows = [(f"k{i}", 0, i) for i in range(101)] + [(f"l{i}", 1, i) for i in range(20)] + [("m", 2, 0), (None, 2, 1)] + [
        (f"n{i}", None, i) for i in range(9)]
    df = spark.createDataFrame(rows, "video_id string, above_baseline int, _last int").repartition(3)
    found = splits.with_folds(df, folds).collect()
    assert len(found) == len(rows) and {r.fold for r in found} <= set(range(folds))
    for label in (0, 1, 2, None):
        sizes = [sum(r.fold == k and r.above_baseline == label for r in found) for k in range(folds)]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == sum(r[1] == label for r in rows)
    again = splits.with_folds(df.repartition(5), folds).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert splits.with_folds(df.limit(0), folds).count() == 0
