from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulsemark import schemas
from pulsemark.operators import baselines, cleaning, collection, discovery, health, polls, segments
from pulsemark.plans import catalog, fixtures as X
from pulsemark.plans.catalog import QUERIES
from pulsemark.plans.dataset import build_clean
from tests.conftest import SMALL

T0 = datetime(2026, 1, 1)
COLUMNS = [f.name for f in schemas.VIDEO_SNAPSHOTS.fields]


def poll(video, label, hours, views=10, **more):
    row = dict.fromkeys(COLUMNS)
    row.update(video_id=video, poll_label=label, poll_timestamp=T0 + timedelta(hours=hours), channel_id="c1",
               hours_since_publish=float(hours), view_count=views, like_count=1, comment_count=0,
               subscriber_count=5, face_count=0, brightness=0.0, colorfulness=0.0, title=f"{video}-{label}", **more)
    return tuple(row[c] for c in COLUMNS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.VIDEO_SNAPSHOTS)


def test_pivot_keeps_complete_triplets_and_latest_rows(spark):
    df = frame(
        spark, poll("a", "upload", 1), poll("a", "upload", 2, 20), poll("a", "24h", 24, 30), poll("a", "7d", 160, 40),
        poll("b", "upload", 1), poll("b", "24h", 24), poll("c", "upload", 1), poll("c", "other", 5), poll("c", "7d", 160),
        poll("d", None, 1),
    )
    rows = polls.pivot_polls(df).collect()
    assert [(r.video_id, r.view_count_upload, r.view_count_24h, r.view_count_7d, r.title) for r in rows] == [
        ("a", 20, 30, 40, "a-upload")
    ]
    assert {r.video_id: r.complete for r in polls.triplet_counts(df).collect()} == {"a": True, "b": False, "c": False}
    assert {(r.video_id, r.joined_rows) for r in polls.pivot_multiplicity(df).collect()} == {("a", 4)}
    assert polls.latest_polls(df.where("video_id = 'a'")).count() == 3


def test_equal_times_pick_the_same_row_in_any_order(spark):
    rows = [poll("a", "upload", 1, v) for v in (5, 9, 7)] + [poll("a", "24h", 24), poll("a", "7d", 160)]
    for order in (rows, rows[::-1]):
        assert polls.pivot_polls(frame(spark, *order)).first().view_count_upload == 9


def test_clean(spark):
    df = spark.createDataFrame(
        [("  t ", None, None, -5, None, -3)],
        "title string, description string, tags array<string>, view_count_upload int, like_count_7d int, duration_seconds int",
    )
    row = cleaning.clean(df).first()
    assert (row.title, row.description, row.tags) == ("t", None, [])
    assert (row.view_count_upload, row.like_count_7d, row.duration_seconds) == (0, None, 0)


def medians_input(spark):
    rows = [(f"c{i % 7}", f"@{i % 7}", (i * 37) % 101 + 1, (i * 13) % 29, (i * 5) % 11) for i in range(400)]
    rows += [("hot", "@hot", (i * 7919) % 5003 + 1, (i * 31) % 997, i % 13) for i in range(3000)]
    return spark.createDataFrame(rows, "channel_id string, channel_handle string, view_count long, like_count long, comment_count long")


def test_hot_channels_have_the_same_medians(spark):
    df = medians_input(spark)
    plain = {r.channel_id: r for r in baselines.channel_medians(df).collect()}
    routed = {r.channel_id: r for r in baselines.channel_medians(df, hot_group_rows=50).collect()}
    assert plain.keys() == routed.keys()
    for key, row in plain.items():
        assert tuple(row)[:3] == tuple(routed[key])[:3]
        assert tuple(routed[key])[3:] == pytest.approx(tuple(row)[3:])


def test_medians_with_views_of_zero(spark):
    df = spark.createDataFrame([("c", "@", 0, 1, 1), ("c", "@", 10, 1, 1)],
                               "channel_id string, channel_handle string, view_count long, like_count long, comment_count long")
    row = baselines.channel_medians(df).first()
    assert row.median_views == 5 and row.median_engagement_rate == pytest.approx(0.2)


def test_recent_untracked_takes_30_of_the_newest_50(spark):
    rows = [("c", f"v{i:03d}", T0 + timedelta(hours=i)) for i in range(120)]
    uploads = spark.createDataFrame(rows, "channel_id string, video_id string, published_at timestamp_ntz")
    tracked = spark.createDataFrame([(f"v{i:03d}",) for i in range(80, 120)], "video_id string")
    got = sorted(r.video_id for r in baselines.recent_untracked(uploads, tracked).collect())
    assert got == [f"v{i:03d}" for i in range(70, 80)]
    none = tracked.limit(0)
    got = sorted(r.video_id for r in baselines.recent_untracked(uploads, none).collect())
    assert got == [f"v{i:03d}" for i in range(90, 120)]


def test_group_limit_is_applied_before_the_shuffle(spark):
    rows = [("c", f"v{i}", T0) for i in range(10)]
    uploads = spark.createDataFrame(rows, "channel_id string, video_id string, published_at timestamp_ntz")
    plan = baselines.recent_untracked(uploads, uploads.select("video_id").limit(0))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_channels_without_baseline(spark):
    channels = spark.createDataFrame([("a",), ("b",)], "channel_id string")
    videos = spark.createDataFrame([("a",), ("a",)], "channel_id string")
    assert [r.channel_id for r in baselines.channels_without_baseline(channels, videos).collect()] == ["b"]
    assert baselines.channels_without_baseline(channels, videos, force=True).count() == 2


TRACK = "video_id string, channel_id string, published_at timestamp_ntz, first_seen_at timestamp_ntz, " \
        "upload_poll_done boolean, day1_poll_done boolean, day7_poll_done boolean"


def tracking(spark, *rows):
    return spark.createDataFrame([(v, "c1", T0, T0, u, d, w) for v, u, d, w in rows], TRACK)


def test_health(spark):
    track = tracking(spark, ("a", True, True, True), ("b", True, False, False), ("c", False, False, False))
    snaps = frame(spark, poll("a", "upload", 1), poll("a", "24h", 24), poll("x", "upload", 1), poll("x", "upload", 2))
    medians = spark.createDataFrame([], "channel_id string")
    now = T0 + timedelta(days=10)
    done = {r.stage: tuple(r)[1:] for r in health.completion(track, now).collect()}
    assert done == {"upload": (3, 2, 1, 66.7), "24h": (2, 1, 1, 50.0), "7d": (1, 1, 0, 100.0)}
    assert {(r.stage, r.video_id) for r in health.mismatches(track, snaps).collect()} == {("7d", "a"), ("upload", "b")}
    assert {r.stage: r.orphaned_snapshots for r in health.orphans(track, snaps).collect()} == {"upload": 2, "24h": 0, "7d": 0}
    found = {(r.check, r.stage): r.affected for r in health.warnings(track, snaps, medians, now).collect()}
    assert found == {
        ("completion", "upload"): 1, ("completion", "24h"): 1, ("mismatch", "7d"): 1, ("mismatch", "upload"): 1,
        ("orphan", "upload"): 2, ("missing_baseline", "all"): 1,
    }
    assert health.status(health.warnings(track, snaps, medians, now)) == "warnings"
    spot = health.spot_check(track, snaps).where("stage = 'upload'").collect()
    assert sorted((r.video_id, r.view_count) for r in spot) == [("a", 10), ("b", None)]
    empty = health.completion(track, T0).collect()
    assert all(r.total_eligible == 0 and r.completion_pct == 0.0 for r in empty)


def test_spot_check_of_a_repeated_video(spark):
    track = tracking(spark, *[(f"v{i}", True, False, False) for i in range(8)])
    snaps = frame(spark, *[poll("v1", "upload", h, h) for h in range(20)], poll("v7", "upload", 1))
    rows = health.spot_check(track, snaps).where("stage = 'upload'").collect()
    assert sorted((r.video_id, r.view_count or 0) for r in rows) == [("v0", 0)] + [("v1", n) for n in (16, 17, 18, 19)]


def test_due_new_and_marked(spark):
    track = tracking(spark, ("a", True, False, False), ("b", True, True, False), ("c", False, False, False))
    channels = spark.createDataFrame([("c1", "@", "Tech", "S")], "channel_id string, channel_handle string, vertical string, tier string")
    for hours, label, wanted in ((19.9, "24h", []), (20, "24h", ["a"]), (30.9, "24h", ["a"]), (31, "24h", []), (160, "7d", ["b"])):
        due = collection.due_videos(track, channels, label, T0 + timedelta(hours=hours))
        assert [r.video_id for r in due.collect()] == wanted, hours
    fresh = spark.createDataFrame([("a", "c1", T0), ("n", "c1", T0), ("n", "c1", T0), ("o", "c1", T0 - timedelta(hours=9))],
                                  "video_id string, channel_id string, published_at timestamp_ntz")
    new = collection.new_videos(fresh, track, T0 + timedelta(hours=3)).collect()
    assert [(r.video_id, r.upload_poll_done) for r in new] == [("n", False)]
    done = spark.createDataFrame([("a",), ("a",), ("zzz",)], "video_id string")
    marked = {r.video_id: r.day1_poll_done for r in collection.mark_done(track, done, "24h").collect()}
    assert marked == {"a": True, "b": True, "c": False}


def test_discovery(spark):
    channels = spark.createDataFrame([(f"t{i}", "Tech", "L") for i in range(70)], "channel_id string, vertical string, tier string")
    plan = {(r.vertical, r.tier): r.needed for r in discovery.fill_plan(channels).collect()}
    assert plan[("Tech", "L")] == 5 and plan[("Education", "S")] == 150 and len(plan) == 9
    assert discovery.fill_plan(channels, 2).agg(F.max("needed")).first()[0] == 2
    rows = [(f"x{i}", "@", "Tech", "L", 2_000_000, 1, 1, 1.0, T0 + timedelta(hours=i), i == 0) for i in range(9)]
    pool = spark.createDataFrame(rows, schemas.CHANNEL_CANDIDATES)
    drained = discovery.drain(pool, discovery.fill_plan(channels))
    assert sorted(r.channel_id for r in drained.collect()) == [f"x{i}" for i in range(1, 6)]
    marked = discovery.mark_consumed(pool, drained).where("added_to_tracking").count()
    assert marked == 6
    uploads = spark.createDataFrame(
        [(f"x{i}", f"{i}-{k}", T0 - timedelta(days=k)) for i in range(9) for k in range(2 if i < 7 else 1)],
        "channel_id string, video_id string, published_at timestamp_ntz",
    )
    chosen = discovery.qualify(pool, channels.select("channel_id"), uploads, discovery.fill_plan(channels), T0)
    assert sorted(r.channel_id for r in chosen.collect()) == [f"x{i}" for i in range(5)]


def test_segments_put_back_only_when_missing(spark):
    base = spark.createDataFrame([("v", "Tech", "S")], "video_id string, vertical string, tier string")
    frame_ = spark.createDataFrame([("v", 1), ("w", 2)], "video_id string, x int")
    got = {r.video_id: r.tier for r in segments.with_segments(frame_, base).collect()}
    assert got == {"v": "S", "w": None}
    assert segments.with_segments(base, base) is base
    bare = frame_.select("x")
    assert segments.with_segments(bare, base) is bare
    with pytest.raises(ValueError):
        segments.with_segments(None, base)


def test_small_set_operations(spark):
    df = spark.createDataFrame([("a", "c1", True, 1), ("b", "c1", False, 2)],
                               "video_id string, channel_id string, contains_synthetic_data boolean, x int")
    assert [r.video_id for r in cleaning.only_real(df).collect()] == ["b"]
    assert [r.video_id for r in cleaning.only_real(df, real=False).collect()] == ["a"]
    assert polls.combine_polls(df, df.select(*reversed(df.columns)), df).count() == 6
    assert collection.distinct_channels(df).count() == 1
    assert cleaning.align(df, ["x", "new", "video_id"]).first()[:] == (1, None, "a")
    assert cleaning.numeric_columns(df, ["x"]) == []
    assert cleaning.varying_columns(df.withColumn("flat", F.lit(1)), ["x", "flat"]) == ["x"]


def test_one_video_with_a_third_of_all_rows(spark):
    hot = [poll("hot", label, hours + i / 1000, i) for i in range(300) for label, hours in (("upload", 1), ("24h", 24), ("7d", 160))]
    rest = [poll(f"v{i}", label, hours, i) for i in range(600) for label, hours in (("upload", 1), ("24h", 24), ("7d", 160))]
    df = frame(spark, *hot, *rest).repartition(8)
    wide = polls.pivot_polls(df)
    assert wide.count() == 601
    row = wide.where("video_id = 'hot'").first()
    assert (row.view_count_upload, row.view_count_24h, row.view_count_7d) == (299, 299, 299)
    assert polls.pivot_multiplicity(df).where("video_id = 'hot'").first().joined_rows == 300 ** 4
    track = tracking(spark, ("hot", True, True, True))
    lost = {r.stage: r.orphaned_snapshots for r in health.orphans(track, df).collect()}
    assert lost == {"upload": 600, "24h": 600, "7d": 600}


@pytest.mark.parametrize("limit", [1, 10, 1000])
def test_medians_of_a_large_null_channel(spark, limit):
    """A null channel and a channel named like its placeholder are groups of their own on either way."""
    rows = [(None, "n", i, 2 * i, 1) for i in range(50)] + [("-", "m", i, i, i) for i in range(1, 21)] + [("a", "a", 7, 1, None)]
    df = spark.createDataFrame(rows, "channel_id string, channel_handle string, view_count long, like_count long, comment_count long")
    got = {r.channel_id: r for r in baselines.channel_medians(df, limit).collect()}
    assert len(got) == 3 and got[None].video_count == 50
    assert got[None].median_views == 24.5 and got[None].median_likes == 49.0
    assert (got["-"].median_views, got["-"].median_engagement_rate) == (10.5, 2.0)
    assert got["a"].median_views == 7.0 and got["a"].median_comments is None


def test_run_report_counts_skipped_channels(spark):
    planned = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4), (None, 5)], "channel_id string, x int")
    written = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "channel_id string")
    row = collection.run_report(planned, written).first()
    assert row.asDict() == {"channels_planned": 3, "channels_done": 1, "channels_skipped": 2, "rows_written": 2, "rows_elsewhere": 2}
    assert sorted(r.channel_id for r in collection.skipped_channels(planned, written).collect()) == ["b", "c"]
    nothing = collection.run_report(planned.limit(0), written.limit(0)).first()
    assert set(nothing.asDict().values()) == {0}


def test_texts_join_after_the_pivot_and_pick_the_same_row(spark):
    """Equal polls rank by channel, then texts, then the rest; a null video is a group of its own; repeats change nothing."""
    def tied(video, title, tags, seconds):
        row = dict(zip(COLUMNS, poll(video, "upload", 1)))
        row.update(title=title, description=None, tags=tags, duration_seconds=seconds, tier="S")
        return tuple(row[c] for c in COLUMNS)

    rows = [tied("a", "x", ["t"], 9), tied("a", "y", None, 5), tied("a", "y", ["b"], 4), tied("a", "y", ["b"], 4)]
    rows += [tied(None, None, None, 7), tied("lone", "z", ["z"], 1)]
    rows += [poll(v, label, h) for v in ("a", None) for label, h in (("24h", 24), ("7d", 160))]
    df = frame(spark, *rows, *rows)
    wide, late, columns = polls.pivot_parts(df)
    assert not {"title", "description", "tags"} & set(wide.columns)
    assert {r["_key"] for r in late.collect()} == {"+a", "-"}  # complete videos alone
    got = {r.video_id: (r.title, r.tags, r.duration_seconds, r.tier, r.view_count_upload) for r in polls.pivot_polls(df).collect()}
    assert got == {"a": ("y", ["b"], 4, "S", 10), None: (None, None, 7, "S", 10)}
    assert polls.pivot_polls(df).columns == columns
    plain = polls.pivot_polls(df, ["channel_id", "tier"])
    assert plain.columns[:3] == ["video_id", "channel_id", "tier"] and plain.count() == 2
    late_key = baselines.channel_medians(spark.createDataFrame(
        [("c1", "@1", 10, 1, 1)], "channel_id string, channel_handle string, view_count long, like_count long, comment_count long"))
    built = build_clean(df, late_key, ["title", "channel_id"]).collect()
    assert {(r.video_id, r.title, r.baseline_median_views) for r in built} == {("a", "y", 10.0), (None, None, 10.0)}


def test_texts_are_added_to_complete_videos_alone(spark):
    """Texts that come by a join are not shuffled for other videos; repeated texts change nothing."""
    rows = [poll(v, label, h) for v in ("a", None) for label, h in (("upload", 1), ("24h", 24), ("7d", 160))]
    rows += [poll(v, "upload", 1) for v in ("lone", "b", "c", "a")] + [poll("b", "24h", 24)]
    bare, given = frame(spark, *rows).drop("title", "description", "tags"), []
    texts = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), ("lone", "z")], "vid string, title string")

    def add(df):
        given.append(df)
        found = df.join(texts, df.video_id == texts.vid, "left").drop("vid")
        return found.withColumns({"description": F.lit(None).cast("string"), "tags": F.array(F.col("title"))})

    wide, late, columns = polls.pivot_parts(bare, texts=add)
    assert {r.video_id for r in given[-1].collect()} == {"a", None} and not {"title", "_key"} & set(given[0].columns)
    got = sorted(tuple(r) for r in polls.with_late(wide, late, columns).select("title", "tags", "view_count_7d").collect() if r.title)
    whole = sorted(tuple(r) for r in polls.pivot_polls(add(bare)).select("title", "tags", "view_count_7d").collect() if r.title)
    assert got == whole == [("y", ["y"], 10)]
    full, plain = catalog.full_clean(spark, SMALL), build_clean(X.labelled(spark, SMALL), catalog.medians(spark, SMALL))
    assert full.columns == plain.columns and full.exceptAll(plain).isEmpty() and plain.exceptAll(full).isEmpty()


def test_folds_compute_the_model_rows_once(spark):
    plan = QUERIES["stratified_folds"](spark, SMALL)._jdf.queryExecution().toString()
    assert "lineitem" not in plan and "l_orderkey" not in plan


def test_documents_are_joined_last(spark):
    """Nothing but the pivot of the texts lies above the join that brings them in."""
    plan = X.snapshots(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line.strip(" :+-") for line in plan.split("\n") if "Join" in line]
    assert joins[0].startswith("Join LeftOuter") and "doc_id" in joins[0]
