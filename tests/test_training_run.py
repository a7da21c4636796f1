"""The training flow end to end, and rules that hold between its parts."""

import math

import pytest
from pyspark.sql import functions as F

from pulsemark.operators import baselines, discovery, learners, segments, splits
from pulsemark.operators.features import feature_columns
from pulsemark.plans import catalog
from pulsemark.plans import fixtures as X
from pulsemark.plans.dataset import build_clean, engineer
from pulsemark.plans.training import full_run
from pulsemark.session import cut
from pulsemark.streaming import collector
from tests.frames import strata_frame
from tests.test_models import SMALL, rows  # noqa: F401

FOLDER = "/root/testdata/sf0.01"


def test_full_run(spark):
    snapshots, medians = cut(X.labelled(spark, FOLDER)), cut(catalog.medians(spark, FOLDER))
    ready = cut(engineer(build_clean(snapshots, medians)))
    held = cut(splits.draw_holdout(ready))
    entries, held_out, divided = full_run(
        snapshots, medians, held, params=SMALL, target_real_pct=0.8)
    assert set(entries) == set(held_out) == {"lr_l1", "rf", "gbt", "ensemble"}
    parts = {r.split: r["count"] for r in divided.where("not contains_synthetic_data").groupBy("split").count().collect()}
    assert parts["val"] == held.count() and set(parts) == {"train", "test", "val"}
    for name, entry in entries.items():
        assert entry.columns == feature_columns(ready)
        about = entry.training
        assert about["real_train_rows"] == parts["train"] and about["test_rows"] == parts["test"]
        assert about["synthetic_train_rows"] == math.floor(parts["train"] / 0.8) - parts["train"]
        assert held_out[name]["val_rows"] == parts["val"]
    first = entries["rf"].columns[0]
    real = divided.where("split = 'train' and not contains_synthetic_data").agg(F.avg(first)).first()[0]
    assert entries["rf"].scaler.means[first] == pytest.approx(real)


@pytest.mark.parametrize("strategy", learners.STRATEGIES)
def test_tuning_does_not_depend_on_units(rows, strategy):  # noqa: F811
    grid = {"C": [0.05, 1.0], "max_iter": [50]}
    found = [learners.tune("lr_l1", rows.withColumn("a", F.col("a") * unit), ["a", "b"], grid, strategy, cv=2, n_iter=2)
             for unit in (1.0, 1e6)]
    assert [t for t, _ in found[0]["trials"]] == [t for t, _ in found[1]["trials"]]
    for (_, x), (_, y) in zip(*(f["trials"] for f in found)):
        assert x == pytest.approx(y, abs=1e-6)


def test_unknown_parameters_are_refused():
    with pytest.raises(ValueError):
        learners.make("rf", {"n_estimator": 3}, 10)
    assert learners.make("gbt", {"max_bin": 64}, 10).getMaxBins() == 64
    assert learners.make("lr_l1", {"penalty": "elastic", "l1_ratio": 0.3}, 10).getElasticNetParam() == 0.3


def test_medians_are_the_same_by_either_way(spark):
    rows = [("a", "@a", float(k * k % 17), float(k), 1.0) for k in range(9)]
    rows += [("b", "@b", v, 2.0, 3.0) for v in (1.0, float("nan"), float("inf"), 5.0, 2.0, 8.0)]
    rows += [("c", "@c", 0.0, 1.0, 1.0), (None, "@n", 4.0, 1.0, 1.0)]
    videos = spark.createDataFrame(
        rows, "channel_id string, channel_handle string, view_count double, like_count double, comment_count double")
    ways = [sorted(map(tuple, baselines.channel_medians(videos, n).select(
        "channel_id", "channel_handle", "video_count", "median_views", "median_likes", "median_comments",
        "median_engagement_rate").collect()), key=repr) for n in (0, 5, 10**9)]
    assert ways[0] == ways[1] == ways[2]
    assert dict((w[0], w[3]) for w in ways[0])["b"] == 3.5


def test_drain_takes_what_the_plan_asks(spark):
    candidates = spark.range(3000).select(
        F.format_string("c%05d", "id").alias("channel_id"), F.lit("@x").alias("channel_handle"),
        F.lit("Tech").alias("vertical"), F.lit("S").alias("tier"), F.lit(5).alias("subscriber_count"),
        F.lit(1).alias("total_channel_views"), F.lit(1).alias("total_channel_videos"),
        F.lit(1.0).alias("upload_velocity_per_week"), F.col("id").alias("discovered_at"),
        F.lit(False).alias("added_to_tracking"))
    plan = spark.createDataFrame([("Tech", "S", 400), ("Tech", "M", 0)], "vertical string, tier string, needed int")
    assert discovery.drain(candidates, plan).count() == 400
    assert discovery.drain(candidates, plan.where("false")).count() == 0


def test_label_rates_leave_out_missing_keys(spark):
    df = strata_frame(spark, 4).unionByName(spark.createDataFrame(
        [("x1", None, "S", 1, 0.0), ("x2", "Tech", None, 1, 0.0)],
        "video_id string, vertical string, tier string, above_baseline int, extra double"))
    got = segments.label_rates(df).collect()
    assert len(got) == 15 and len({(r.level, r.vertical, r.tier) for r in got}) == 15
    n = {(r.level, r.vertical, r.tier): r.n for r in got}
    assert n["vertical", "Tech", None] == 13 and n["tier", None, "S"] == 13 and n["vertical_tier", "Tech", "S"] == 4


def test_split_shuffles_no_row_by_stratum(spark):
    df = strata_frame(spark, 30)
    keyed = splits.hashed_keys(df)
    plan = splits.draw_holdout(df, keyed=keyed)._jdf.queryExecution().executedPlan().toString()
    marking = plan[: plan.index("BroadcastExchange")] if "BroadcastExchange" in plan else plan
    assert "BroadcastHashJoin" in plan and "hashpartitioning(stratum" not in marking


def test_two_runs_of_the_recorder(spark, folder):
    schema = "video_id string, channel_id string, published_at timestamp_ntz, poll_timestamp timestamp_ntz, poll_label string, n int"
    from datetime import datetime

    def batch(n, hour):
        return spark.createDataFrame([("v1", "c1", datetime(2026, 1, 1), datetime(2026, 1, 1, hour), "upload", n)], schema)
    one, two = (collector.Recorder(spark, f"{folder}/t", run) for run in ("a", "b"))
    one(batch(1, 3), 0)
    one(batch(2, 5), 1)
    two(batch(3, 4), 0)
    assert spark.read.parquet(one.snapshots).count() == 3
    kept = two.read_snapshots().collect()
    assert [(r.video_id, r.n) for r in kept] == [("v1", 1)]
    assert two.tracking.read().count() == 1
    assert collector.run_of("/x/state/") == collector.run_of("/x/state") != collector.run_of("/x/other")


def test_cuts_of_the_application_can_be_discarded(spark):
    from pulsemark.session import discard_cuts
    from pulsemark.sources.files import matches

    kept = cut(spark.range(3))
    assert kept.count() == 3
    folder = kept.inputFiles()[0].rsplit("/", 2)[0]
    assert spark.sparkContext.applicationId in folder and matches(spark, folder)
    discard_cuts(spark)
    assert not matches(spark, folder)
    assert cut(spark.range(2)).count() == 2
