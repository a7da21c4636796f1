from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pulsemark.operators.collection import first_observations, label_observations
from pulsemark.plans import catalog
from pulsemark.plans import fixtures as X
from pulsemark.sources import raw_items, snapshots, tables
from pulsemark.schemas import VIDEOS_TO_TRACK
from pulsemark.sources.tracking_store import BucketedTable, VersionedTable
from pulsemark.streaming import collector

SMALL = "/root/testdata/sf0.001"
NOW = datetime(2026, 1, 1)


def test_snapshot_tags(spark, folder):
    rows = X.labelled(spark, SMALL)
    record = snapshots.save_videos(rows, folder, "v3.1", NOW, "first")
    assert record["total_rows"] == rows.count() == sum(record["poll_label_counts"].values())
    assert record["unique_videos"] == rows.select("video_id").distinct().count()
    with pytest.raises(ValueError):
        snapshots.save_videos(rows, folder, "v3.1", NOW)
    snapshots.save_videos(rows.limit(5), folder, "v3.1", datetime(2026, 1, 2), overwrite=True)
    loaded, about = snapshots.load_videos(spark, folder, "v3.1")
    assert loaded.count() == 5 and about["total_rows"] == 5
    snapshots.save_videos(rows.limit(3), folder, "v3.1_extra", NOW)
    snapshots.save_videos(rows.limit(2), folder, "v3.10", NOW)
    assert snapshots.load_videos(spark, folder, "v3.1")[0].count() == 5
    with pytest.raises(FileNotFoundError):
        snapshots.load_videos(spark, folder, "v3")


def test_sources(spark, folder):
    medians = catalog.medians(spark, SMALL)
    done = snapshots.save_raw(X.labelled(spark, SMALL), (X.baseline_videos(spark, SMALL), medians), folder, "v1", NOW)
    again = snapshots.save_raw(X.labelled(spark, SMALL), None, folder, "v1", NOW)
    assert isinstance(done["baselines"], dict) and "already exists" in again["videos"]
    rows, history, middle = snapshots.load_inputs(spark, "gcs", folder, "v1")
    assert middle.count() == medians.count() and rows.count() == X.labelled(spark, SMALL).count()
    with pytest.raises(ValueError):
        snapshots.load_inputs(spark, "ftp", folder, "v1")
    with pytest.raises(FileNotFoundError):
        snapshots.load_inputs(spark, "snapshots", folder, "v1", "v2")
    kinds = {r.kind: r.version_tag for r in snapshots.list_snapshots(spark, folder).collect()}
    assert kinds == {"videos": "v1", "baselines": "v1"}
    assert snapshots.list_snapshots(spark, folder + "/none").count() == 0


def test_final_snapshot_counts_synthetic_rows(spark, folder):
    rows = X.labelled(spark, SMALL, False).withColumn("contains_synthetic_data", F.col("poll_label") == "7d")
    record = snapshots.save_final(rows, folder, "f1", NOW)
    assert record["real_rows"] + record["synthetic_rows"] == record["total_rows"]
    assert record["synthetic_pct"] == round(record["synthetic_rows"] / record["total_rows"] * 100, 1)
    assert snapshots.save_final(rows.limit(0), folder, "f2", NOW)["synthetic_pct"] == 0.0


def test_live_tables(spark, folder):
    tables.append(X.snapshots(spark, SMALL), folder, "video_snapshots")
    tables.append(X.baseline_videos(spark, SMALL), folder, "channel_baseline_videos")
    rows, history, medians = snapshots.load_inputs(spark, "bq", folder)
    assert rows.count() == X.labelled(spark, SMALL, False).count()
    assert medians.count() == catalog.medians(spark, SMALL).count()
    plan = rows.select("video_id").where("view_count > 5")._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(poll_label)" in plan and "GreaterThan(view_count,5)" in plan and "description" not in plan
    tables.append(X.tracking(spark, SMALL), folder, "videos_to_track")
    tables.append(X.tracking(spark, SMALL), folder, "videos_to_track")
    assert tables.read_table(spark, folder, "videos_to_track").count() == 2 * X.tracking(spark, SMALL).count()
    tables.append_json(X.candidates(spark, SMALL).select("channel_id"), f"{folder}/nd")
    assert spark.read.schema("channel_id string").json(f"{folder}/nd").count() == X.candidates(spark, SMALL).count()
    tables.sample_csv(X.labelled(spark, SMALL), f"{folder}/csv", 20)
    csv = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{folder}/csv")
    assert len(csv.columns) == 23


def test_versioned_table(spark, folder):
    table = VersionedTable(spark, f"{folder}/t")
    with pytest.raises(FileNotFoundError):
        table.read()
    track = X.tracking(spark, SMALL)
    table.write(track.limit(10))
    table.add(track)
    assert table.read().count() == track.count()
    ids = track.where("not day7_poll_done").select("video_id").limit(3)
    before = table.read().where("day7_poll_done").count()
    table.mark(ids, "7d")
    assert table.read().where("day7_poll_done").count() == before + 3 and len(table.versions()) == 3


def test_raw_items_defaults(spark):
    raw = spark.createDataFrame(
        [("c1", '{"id":"v","snippet":{"title":"t","publishedAt":"2026-01-01T00:00:00Z","categoryId":"27"},"statistics":{"viewCount":"7"}}'),
         ("zz", '{"id":"w","snippet":{"title":"u","publishedAt":"2026-01-01T10:00:00Z","tags":["a"]},"contentDetails":{"duration":"PT1M"},"status":{"containsSyntheticMedia":true}}')],
        "channel_id string, payload string",
    )
    channels = spark.createDataFrame([("c1", "@c", "Tech", "S", 9)], "channel_id string, channel_handle string, vertical string, tier string, subscriber_count long")
    a, b = raw_items.snapshot_rows(raw, channels, "upload", datetime(2026, 1, 1, 12)).orderBy("video_id").collect()
    assert (a.view_count, a.like_count, a.tags, a.description, a.category_name, a.duration_seconds) == (7, 0, [], "", "Education", 0)
    assert (a.subscriber_count, a.hours_since_publish, a.contains_synthetic_media) == (9, 12.0, False)
    assert (b.channel_handle, b.subscriber_count, b.tags, b.duration_seconds, b.contains_synthetic_media) == ("", 0, ["a"], 60, True)
    assert b.category_name == "Unknown"


def in_parts(spark, folder):
    """Events in time order, one file per step, read one file per micro-batch."""
    events = X.table(spark, SMALL, "events").toPandas().sort_values("ts")
    for i in range(4):
        part = events.iloc[i * len(events) // 4:(i + 1) * len(events) // 4]
        spark.createDataFrame(part, X.schema_of("events")).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(X.schema_of("events")).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    return X.observation_columns(stream)


def test_streams_equal_their_batch_twins(spark, folder):
    batch = label_observations(X.observations(spark, SMALL))
    first = first_observations(batch)
    out = collector.first_per_label(collector.label_stream(in_parts(spark, folder)))
    out.writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(out.schema).parquet(f"{folder}/out")
    keys = ["video_id", "poll_label"]
    assert sorted(map(tuple, got.select(*keys).collect())) == sorted(map(tuple, first.select(*keys).collect()))


def test_recorder_keeps_flags_behind_snapshots(spark, folder):
    query = collector.record_stream(collector.label_stream(in_parts(spark, folder)), f"{folder}/tables", f"{folder}/state")
    query.awaitTermination()
    recorder = collector.Recorder(spark, f"{folder}/tables", collector.run_of(f"{folder}/state"))
    track = recorder.tracking.read()
    stored = spark.read.parquet(recorder.snapshots)
    flags = {"upload": "upload_poll_done", "24h": "day1_poll_done", "7d": "day7_poll_done"}
    for label, flag in flags.items():
        flagged = {r.video_id for r in track.where(flag).collect()}
        written = {r.video_id for r in stored.where(F.col("poll_label") == label).collect()}
        assert flagged == written
    table = VersionedTable(spark, f"{folder}/published")
    recorder.tracking.publish(table)
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, track.select(*table.read().columns).collect()))
    before = (track.count(), stored.count())
    last = stored.where("batch like '%-0000000000'").drop("batch")
    recorder(last, 0)
    assert (recorder.tracking.read().count(), spark.read.parquet(recorder.snapshots).count()) == before


def test_new_videos_are_inserted_once(spark, folder):
    observed = X.observation_columns(X.table(spark, SMALL, "events"))
    ids = sorted(r[0] for r in observed.select("video_id").distinct().collect())
    tracked, asked = set(ids[:5]), []

    def table():
        asked.append(set(tracked))
        return spark.createDataFrame([(v,) for v in sorted(tracked)], "video_id string")

    def rows():
        return spark.read.parquet(f"{folder}/log")

    def run(state):
        collector.insert_new_videos(stream, f"{folder}/log", f"{folder}/{state}", table).awaitTermination()

    stream = in_parts(spark, folder)
    run("one")
    assert len(asked) == 4  # the table is read in every batch
    assert sorted(r.video_id for r in rows().select("video_id").collect()) == ids[5:]
    first = {r.video_id: r.first_seen_at for r in rows().collect()}
    want = {r.video_id: r.t for r in observed.groupBy("video_id").agg(F.min("poll_timestamp").alias("t")).collect()}
    assert all(first[v] == want[v] for v in first)
    tracked |= set(ids[5:8])
    run("two")  # another run sees the first one's videos, and the table's new ones
    run("one")  # nothing is left for a run that goes on from its checkpoint
    assert rows().count() == len(ids) - 5 and len(asked) == 8
    sink = collector.NewVideos(spark, f"{folder}/log", table, collector.run_of(f"{folder}/one"))
    before = sorted(map(tuple, rows().drop("batch").collect()), key=str)
    sink(observed, 99)
    assert sorted(map(tuple, rows().drop("batch").collect()), key=str) == before
    batch = rows().where("batch like '%-0000000000'")
    kept = sorted(r.video_id for r in batch.collect())
    tracked -= set(ids[5:8])  # as the table was when the batch ran first
    again = observed.where(F.col("video_id").isin(kept + ids[:5]))
    sink(again, 0)  # the repeated batch writes its own videos again
    assert sorted(r.video_id for r in rows().where("batch like '%-0000000000'").collect()) == kept


def simulated(parts, delay_ms):
    """Kinds of rows (time, video, label, row) batch by batch, by the rules: (kind, row id) pairs."""
    out, seen, watermark = [], {}, 0
    for part in parts:
        best = {}
        for at, key, rid in part:
            if watermark > 0 and at < watermark:
                out.append(("late", rid))
            elif key in seen and seen[key] + delay_ms >= watermark:
                out.append(("repeat", rid))
            else:
                best.setdefault(key, []).append((at, rid))
        for key, rows in best.items():
            at, rid = min(rows)
            seen[key] = at
            out += [("first" if r == rid else "repeat", r) for _, r in rows]
        watermark = max([watermark] + [at - delay_ms for at, _, _ in part])
    return sorted(out)


def test_stateful_recorder_sorts_rows_out(spark, folder):
    """First, repeated and late rows, over batches and a restart from the checkpoint."""
    rng = __import__("random").Random(5)
    base, hour, parts, rid = 1_700_000_000_000, 3_600_000, [], 0
    for step in range(5):
        part = []
        for _ in range(60):
            at = base + step * 20 * hour + rng.randrange(-60 * hour, 20 * hour) // 1000 * 1000 + rid
            part.append((at, (f"v{rng.randrange(8)}", rng.choice(["upload", "24h"])), rid))
            rid += 1
        parts.append(part)
    schema = "rid long, video_id string, channel_id string, published_at timestamp_ntz, poll_timestamp timestamp_ntz, poll_label string"

    def put(part):
        rows = [(rid, v, "c", at, at, label) for at, (v, label), rid in part]
        ms = spark.createDataFrame(rows, "rid long, video_id string, channel_id string, published_at long, poll_timestamp long, poll_label string")
        ms.selectExpr("rid", "video_id", "channel_id", *[f"cast(timestamp_millis({c}) as timestamp_ntz) {c}" for c in (
            "published_at", "poll_timestamp")], "poll_label").coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def drain():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        collector.record_with_state(stream, f"{folder}/tables", f"{folder}/state").awaitTermination()

    for part in parts[:3]:
        put(part)
    drain()
    for part in parts[3:]:  # a new query goes on with the state of the first
        put(part)
    drain()
    want = simulated(parts, 25 * hour)
    got = sorted((r.kind, r.rid) for r in spark.read.parquet(f"{folder}/tables/sorted").collect())
    assert got == want and {k for k, _ in want} == set(collector.KINDS)
    recorder = collector.StatefulRecorder(spark, f"{folder}/tables", collector.run_of(f"{folder}/state"))
    assert sorted(r.rid for r in recorder.late().collect()) == [i for k, i in want if k == "late"]
    assert sum(r.n for r in recorder.repeats().collect()) == sum(k == "repeat" for k, _ in want)
    first = spark.read.parquet(recorder.recorder.snapshots)
    assert sorted(r.rid for r in first.collect()) == [i for k, i in want if k == "first"]
    flags = {r.video_id: r.day1_poll_done for r in recorder.recorder.tracking.read().collect()}
    assert flags == {v: any(r.video_id == v and r.poll_label == "24h" for r in first.collect()) for v in flags}


def test_timers_remove_state(spark, folder):
    """State goes once its timer finds the watermark beyond it, and stays as long as a repeat can come."""
    schema = "video_id string, poll_timestamp timestamp_ntz, poll_label string"
    counts = []
    for day, video in ((1, "a"), (2, "b"), (9, "c"), (10, "d")):
        spark.createDataFrame([(video, datetime(2026, 1, day), "upload")], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        query = collector.sorted_out(stream).writeStream.format("parquet").option("path", f"{folder}/out").option(
            "checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        query.awaitTermination()
        counts.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert counts[1] == 2 and counts[-1] == 2  # a and b are gone, c and d may still be repeated


def test_update_rewrites_touched_folders_only(spark, folder):
    table = BucketedTable(spark, f"{folder}/t", VIDEOS_TO_TRACK, buckets=16)
    assert table.read().count() == 0 and table.set_flag(spark.createDataFrame([("x",)], "video_id string"), "day7_poll_done") == []
    track = X.tracking(spark, SMALL).select(*VIDEOS_TO_TRACK.names)
    nameless = track.limit(1).withColumn("video_id", F.lit(None).cast("string"))
    table.add(track.limit(40))
    table.add(track.unionByName(track).unionByName(nameless))
    assert table.add(track.unionByName(nameless)) == []
    assert table.read().count() == track.count() + 1
    before = {r.video_id: r for r in table.read().collect()}

    def files():
        return {str(p): p.stat().st_mtime_ns for p in Path(f"{folder}/t").rglob("*.parquet")}

    ids = track.where("not day7_poll_done").select("video_id").limit(3)
    chosen, old = {r.video_id for r in ids.collect()}, files()
    touched = table.set_flag(ids.unionByName(ids).unionByName(spark.createDataFrame([(None,), ("absent",)], "video_id string")), "day7_poll_done")
    after, new = {r.video_id: r for r in table.read().collect()}, files()
    assert after.keys() == before.keys()
    for video, row in after.items():
        want = before[video].asDict() | ({"day7_poll_done": True} if video in chosen else {})
        assert row.asDict() == want
    assert 1 <= len(touched) <= 3
    kept = {p: t for p, t in old.items() if not any(f"/bucket={b}/" in p for b in touched)}
    assert kept and all(new.get(p) == t for p, t in kept.items())
    assert not any(p in new for p in old if p not in kept)
    assert table.set_flag(ids, "day7_poll_done") == [] and files() == new


def test_medians_come_from_the_save_of_their_videos(spark, folder):
    def save(day, views, both=True):
        videos = spark.createDataFrame([("c", f"v{day}", views)], "channel_id string, video_id string, view_count long")
        middle = spark.createDataFrame([("c", float(views))], "channel_id string, median_views double")
        snapshots.save_baselines(videos, middle, folder, "v1", datetime(2026, 1, day), overwrite=True)
        if not both:  # lost between its two parts: no marker of a finished write
            (Path(folder) / "snapshots" / f"medians_v1_2026010{day}_000000" / "_SUCCESS").unlink()

    save(1, 10)
    save(2, 20, both=False)
    videos, middle, record = snapshots.load_baselines(spark, folder, "v1")
    assert videos.first().video_id == "v1" and middle.first().median_views == 10.0
    assert record["snapshot_timestamp"].startswith("2026-01-01")
    save(3, 30)
    videos, middle, _ = snapshots.load_baselines(spark, folder, "v1")
    assert videos.first().video_id == "v3" and middle.first().median_views == 30.0
    with pytest.raises(FileNotFoundError):
        snapshots.load_baselines(spark, folder, "v9")
