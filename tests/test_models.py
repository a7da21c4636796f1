from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsemark.operators import evaluate, learners, synthetic
from pulsemark.operators.scaling import Scaler
from pulsemark.plans import catalog
from pulsemark.plans.dataset import engineer
from pulsemark.plans.training import augment
from pulsemark.session import cut
from pulsemark.sources import model_store

NOW = datetime(2026, 1, 1)
SMALL = {"lr_l1": {"max_iter": 50}, "rf": {"n_estimators": 5, "max_depth": 3}, "gbt": {"n_estimators": 3, "max_depth": 2}}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    data = []
    for i in range(600):
        a, b = rng.normal(size=2)
        data.append((f"v{i}", float(a * 10), float(b), 1.5, int(a + 0.3 * rng.normal() > 0)))
    return cut(spark.createDataFrame(data, "video_id string, a double, b double, flat double, above_baseline int"))


@pytest.fixture(scope="module")
def entries(rows):
    return learners.train(rows.where("video_id < 'v4'"), rows.where("video_id >= 'v4'"), ["a", "b", "flat"], SMALL)


def test_scaler(rows):
    scaler = Scaler().fit(rows, ["a", "flat"])
    out = scaler.transform(rows)
    row = out.agg(F.avg("a"), F.stddev_pop("a"), F.max("flat")).first()
    assert row[:] == pytest.approx((0.0, 1.0, 0.0), abs=1e-9)
    back = scaler.inverse(out).agg(F.sum("a")).first()[0]
    assert back == pytest.approx(rows.agg(F.sum("a")).first()[0])
    with pytest.raises(RuntimeError):
        Scaler().transform(rows)


def test_four_models_learn(entries):
    assert set(entries) == {"lr_l1", "rf", "gbt", "ensemble"}
    for entry in entries.values():
        assert entry.result["roc_auc"] > 0.8
        assert sum(map(sum, entry.result["confusion_matrix"])) == entry.result["val_rows"]
    assert entries["ensemble"].importances() == []
    assert entries["lr_l1"].importances()[0]["feature"] == "a"
    assert "flat" in entries["lr_l1"].zeroed()


def test_ensemble_is_the_weighted_mean(entries, rows):
    vectors = learners.prepare(entries["ensemble"], rows)
    both = entries["ensemble"].predict(vectors).agg(F.sum("score")).first()[0]
    rf = entries["rf"].predict(vectors).agg(F.sum("score")).first()[0]
    gbt = entries["gbt"].predict(vectors).agg(F.sum("score")).first()[0]
    assert both == pytest.approx((rf + 2 * gbt) / 3)


def test_missing_feature_takes_the_training_mean(entries, rows):
    entry = entries["lr_l1"]
    mean = entry.scaler.means["b"]
    filled = entry.predict(learners.prepare(entry, rows.withColumn("b", F.lit(mean)))).agg(F.sum("score")).first()[0]
    absent = entry.predict(learners.prepare(entry, rows.drop("b"))).agg(F.sum("score")).first()[0]
    assert absent == pytest.approx(filled)
    with pytest.raises(RuntimeError):
        learners.validate({}, rows)


def test_save_load_compare_and_history(spark, folder, entries, rows):
    for name, entry in entries.items():
        model_store.save_model(spark, entry, folder, f"v3.1_{name}", "d1", NOW)
    model_store.save_model(spark, entries["rf"], folder, "v3.10_rf", "d1", NOW)
    with pytest.raises(ValueError):
        model_store.save_model(spark, entries["rf"], folder, "v3.1_rf", "d1", NOW)
    family = model_store.load_family(spark, folder, ["v3.1"])
    assert set(family) == set(entries)
    assert set(model_store.load_family(spark, folder, ["v3.1", "v3.10"])) == {f"v3.1/{n}" for n in entries} | {"v3.10/rf"}
    with pytest.raises(FileNotFoundError):
        model_store.load_family(spark, folder, ["v9.9"])
    again = learners.validate(family, rows)
    assert again == learners.validate(entries, rows)
    records = model_store.model_records(spark, folder)
    table = model_store.compare_models(records)
    assert len(table.columns) == 14 and table.count() == 5
    wide = model_store.model_table(records)
    assert {r.generation for r in wide.collect()} == {"v3.1", "v3.10"}
    assert {r.model_type for r in model_store.list_models(records).collect()} == {"lr_l1", "rf", "gbt", "ensemble"}
    for day in (1, 2):
        model_store.append_validation(spark, folder, "v3.1", "d1", again, datetime(2026, 1, day))
    history = model_store.validation_history(spark, folder)
    assert history.count() == 8 and "confusion_matrix" not in history.columns
    assert model_store.validation_history(spark, folder, "v0").count() == 0
    best = evaluate.best_per_metric(table, "version", ["roc_auc"]).first()
    assert best.best_value == max(e.result["roc_auc"] for e in entries.values())


def test_tuning(rows):
    grid = {"n_estimators": [2, 3], "max_depth": [1, 3], "min_samples_leaf": [1]}
    for strategy in learners.STRATEGIES:
        found = learners.tune("rf", rows, ["a", "b"], grid, strategy, cv=2, n_iter=3)
        assert found["best_score"] > 0.8 and found["best_params"]["max_depth"] in (1, 3)
    with pytest.raises(ValueError):
        learners.tune("rf", rows, ["a"], grid, "magic")
    with pytest.raises(ValueError):
        learners.grid_for("svm")
    with pytest.raises(ValueError):
        learners.make("svm", {}, 10)


def test_copula_keeps_marginals_and_correlations(spark):
    real = cut(catalog.numeric_rows(spark, "/root/testdata/sf0.01"))
    made = cut(synthetic.generate(real, 2000, seed=3))
    assert made.count() == 2000 and made.columns == [c for c in real.columns] + ["contains_synthetic_data"]
    assert made.select("video_id").distinct().count() == 2000
    def facts(df):
        return df.agg(F.median("view_count_upload"), F.median("like_count_24h"),
                      F.corr("view_count_upload", "like_count_24h")).first()
    a, b = facts(real), facts(made)
    assert b[0] == pytest.approx(a[0], rel=0.1) and b[1] == pytest.approx(a[1], rel=0.1)
    assert b[2] == pytest.approx(a[2], abs=0.12)
    wrong = made.where("view_count_24h < view_count_upload or view_count_7d < view_count_24h or view_count_upload < 0")
    assert wrong.count() == 0
    known = {r.channel_id: (r.vertical, r.tier) for r in real.select("channel_id", "vertical", "tier").distinct().collect()}
    assert all(known[r.channel_id] == (r.vertical, r.tier) for r in made.select("channel_id", "vertical", "tier").collect())
    again = synthetic.generate(real.repartition(3), 2000, seed=3)
    assert again.agg(F.sum("view_count_7d")).first() == made.agg(F.sum("view_count_7d")).first()


def test_channels_are_drawn_by_weight(spark):
    rows = [("hot",)] * 600 + [(f"c{i}",) for i in range(400)]
    real = spark.createDataFrame(rows, "channel_id string")
    drawn = synthetic.draw_channels(spark.range(5000), real, slices=16)
    counts = {r.channel_id: r["count"] for r in drawn.groupBy("channel_id").count().collect()}
    assert sum(counts.values()) == 5000 and counts["hot"] == pytest.approx(3000, rel=0.06)
    assert len(counts) > 380


def test_augment_adds_to_train_only(spark):
    rows = cut(engineer(catalog.full_clean(spark, "/root/testdata/sf0.01")))
    from pulsemark.operators import splits

    divided = cut(splits.split(rows, splits.draw_holdout(rows)))
    n = divided.where("split = 'train'").count()
    out = cut(augment(divided, 0.8))
    extra = out.where("contains_synthetic_data")
    assert {r.split for r in extra.select("split").distinct().collect()} == {"train"}
    assert extra.count() == synthetic.rows_needed(n, 0.8)
    assert out.where("contains_synthetic_data is null").count() == 0
    row = extra.first()
    assert (row.title_length, row.desc_category) == (11, 5)
    assert augment(divided, 1.0).count() == divided.count()


def test_augmenting_stores_texts_once(spark, monkeypatch):
    """Of the train rows only what generating reads is written again; what is made does not depend on it."""
    from pulsemark.plans import training

    stored, real = [], catalog.engineer(catalog.full_clean(spark, "/root/testdata/sf0.01"))
    divided = cut(real.withColumn("split", F.when(F.xxhash64("video_id") % 2 == 0, "train").otherwise("val")))
    train = divided.where("split = 'train'").drop("split")
    wanted = synthetic.generate(train, synthetic.rows_needed(train.count(), 0.8))
    monkeypatch.setattr(training, "cut", lambda df: stored.append(df) or cut(df))
    out = augment(divided, 0.8)
    assert not {"title", "description", "tags"} & set(stored[0].columns) and stored[0].count() == train.count()
    made = stored[1]
    assert made.schema == wanted.schema and made.exceptAll(wanted).isEmpty() and wanted.exceptAll(made).isEmpty()
    assert set(out.columns) == {*divided.columns, "contains_synthetic_data"}
