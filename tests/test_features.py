import re

import pytest
from pyspark.sql import functions as F

from pulsemark.functions import polls as P
from pulsemark.functions import text as X
from pulsemark.operators import cleaning, features
from pulsemark.plans.dataset import engineer

from frames import clean_rows


def test_worked_row(spark):
    row = engineer(clean_rows(spark)).first()
    wanted = {
        "engagement_7d": 0.15, "baseline_engagement": 0.105, "above_baseline": 1,
        "view_count_velocity_24h": 900 / 23, "view_velocity_upload": 100.0,
        "view_velocity_acceleration": 900 / 23 / 100, "view_velocity_ratio": 900 / 23 / 2000,
        "view_count_upload_vs_baseline": 0.05, "like_rate_upload": 0.1, "views_per_sub_7d": 0.5,
        "title_category": 0, "title_length": 10, "title_word_count": 2, "tag_count": 2, "has_tags": 1,
        "publish_hour": 12, "publish_dayofweek": 3, "publish_is_weekend": 0, "duration_bucket": 1,
        "is_short": 0, "is_long": 0, "has_face": 1, "tier_encoded": 1, "desc_category": 5,
        "vertical_Tech": 1, "vertical_Education": 0,
    }
    for name, value in wanted.items():
        assert row[name] == pytest.approx(value), name


@pytest.mark.parametrize("median", ["views", "likes", "comments", "engagement_rate"])
def test_unknown_median_drops_the_row(spark, median):
    rows = clean_rows(spark, {}, {"video_id": "bad", f"baseline_median_{median}": None})
    assert [r.video_id for r in cleaning.drop_bad_baselines(rows).collect()] == ["v1"]


def test_zero_rate_drops_and_zero_comments_stays(spark):
    rows = clean_rows(spark, {"video_id": "bad", "baseline_median_engagement_rate": 0.0},
                      {"video_id": "ok", "baseline_median_comments": 0.0})
    assert [r.video_id for r in cleaning.drop_bad_baselines(rows).collect()] == ["ok"]


def test_encodings(spark):
    rows = engineer(clean_rows(
        spark, {"tier": "S", "vertical": "Education"}, {"tier": "M", "vertical": "Lifestyle"},
        {"tier": "L", "vertical": "Tech"}, {"tier": "XL", "vertical": "Unknown"},
    )).select("tier_encoded", "vertical_Education", "vertical_Lifestyle", "vertical_Tech").collect()
    assert [tuple(r) for r in rows] == [(0, 1, 0, 0), (1, 0, 1, 0), (2, 0, 0, 1), (0, 0, 0, 0)]


def test_fill_missing(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0, inf, True), (None, -inf, None), (float("nan"), 2.0, False)],
                               "a double, b double, c boolean")
    assert [tuple(r) for r in cleaning.fill_missing(df).collect()] == [(1, 0, 1), (0, 0, 0), (0, 2, 0)]
    assert [tuple(r) for r in cleaning.fill_missing(df, 0, []).collect()] == [(1, 0, 1), (0, 0, 0), (0, 2, 0)]
    only = cleaning.fill_missing(df, -999, ["a"]).collect()
    assert [r.a for r in only] == [1, -999, -999] and only[0].b == inf and only[1].c is None


def test_feature_list(spark):
    names = features.feature_columns(engineer(clean_rows(spark)))
    for out in ("above_baseline", "engagement_7d", "view_count_7d", "views_per_sub_7d", "vertical", "tier",
                "baseline_median_views", "face_count", "duration_minutes", "title", "contains_synthetic_data"):
        assert out not in names
    for kept in ("tier_encoded", "vertical_Tech", "view_count_24h", "has_face", "views_per_sub_24h"):
        assert kept in names


def test_feature_list_has_52_columns_on_the_full_table(spark):
    from pulsemark.plans.catalog import full_clean

    assert len(features.feature_columns(engineer(full_clean(spark, "/root/testdata/sf0.001")))) == 52


def test_engineering_twice_changes_nothing(spark):
    once = engineer(clean_rows(spark))
    twice = engineer(once)
    assert once.first().asDict() == twice.select(*once.columns).first().asDict()


def test_velocity_clips_short_gaps_and_keeps_unknown(spark):
    rows = clean_rows(
        spark, {"hours_since_publish_24h": 1.0, "hours_since_publish_upload": 1.0},
        {"subscriber_count_upload": 0}, {"view_count_24h": None}, {"baseline_median_views": 0.5},
    )
    a, b, c, d = features.add_velocity(rows).collect()
    assert a.view_count_velocity_24h == pytest.approx(900 / 0.1)
    assert b.view_velocity_per_sub_24h == pytest.approx(900 / 23)
    assert c.view_count_velocity_24h is None and c.view_velocity_ratio is None
    assert d.view_velocity_ratio == pytest.approx(900 / 23)


def test_target_without_views_or_baseline_columns(spark):
    row = features.add_target(clean_rows(spark, {"view_count_7d": 0})).first()
    assert row.engagement_7d == 0.0 and row.above_baseline == 0
    bare = clean_rows(spark).drop("baseline_median_views")
    assert features.add_target(bare).first().baseline_engagement == 0.0
    no_comments = clean_rows(spark).drop("baseline_median_comments")
    assert features.add_target(no_comments).first().baseline_engagement == pytest.approx(0.1)
    unknown = features.add_target(clean_rows(spark, {"view_count_7d": None})).first()
    assert unknown.engagement_7d == 0.0


GRIN = "\U0001F600"
TITLES = {
    None: 0, "": 0, "plain words here": 0, "WOW " + GRIN + "! YES": 7, "ALL CAPS HERE": 6, "ABC": 0,
    GRIN * 3 + " hi": 5, "How To bake": 4, "how to": 4, "my top picks": 3, "stop it": 3, "the best way": 3,
    "5 ways out": 3, "is it?": 1, "no way!": 2, "what?!": 1, "tip top ": 3, "a" + "✂" * 3: 5,
    "\U0001FA00" * 2: 0, "ÄÖÜ ÄÖÜ ÄÖ": 6,
}


@pytest.mark.parametrize("title", list(TITLES))
def test_title_class(spark, title):
    df = spark.createDataFrame([(title,)], "t string")
    assert df.select(X.title_class(F.col("t"))).first()[0] == TITLES[title]


LONG = "word " * 500
DESCRIPTIONS = {
    None: 0, "": 5, "short": 5, "x" * 50: 0, "y" * 2001: 6, LONG: 6, "at 0:30 we start " + "z" * 60: 1,
    "see https://a.b " + "z" * 60: 2, "http://a https://b http://c https://d https://e 1:00": 3,
    "#tag " + "z" * 60: 4, "see https://a.b at 12:45": 1, "٣:٤٥ " + "z" * 60: 1,
}


@pytest.mark.parametrize("description", list(DESCRIPTIONS))
def test_description_class(spark, description):
    if description == "٣:٤٥ " + "z" * 60:
        assert re.search(r"\d{1,2}:\d{2}", description)
    df = spark.createDataFrame([(description,)], "d string")
    assert df.select(X.description_class(F.col("d"))).first()[0] == DESCRIPTIONS[description]


def test_text_counts_match_python(spark):
    texts = ["", "  a b ", "a b　c\td", GRIN + " x", "#a #é_1 # #", "http://a https://b", "\n x y\x1f"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", X.strip(F.col("t")).alias("s"), X.word_count(F.col("t")).alias("w"),
        F.length("t").alias("n"), X.hashtag_count(F.col("t")).alias("h"), X.link_count(F.col("t")).alias("l"),
    )
    for r in df.collect():
        assert (r.s, r.w, r.n) == (r.t.strip(), len(r.t.split()), len(r.t))
        assert (r.h, r.l) == (len(re.findall(r"#\w+", r.t)), len(re.findall("https?://", r.t)))


def test_durations_categories_tiers_and_labels(spark):
    durations = {"PT15M33S": 933, "PT1H": 3600, "PT1H2M3S": 3723, "P1DT2H": 0, "": 0, "PT": 0, "PT59S": 59, "nonsense": 0}
    df = spark.createDataFrame([(k,) for k in durations], "t string")
    for r in df.select("t", P.duration_seconds(F.col("t")).alias("s")).collect():
        assert r.s == durations[r.t], r.t
    ages = {-0.5: None, 0.0: "upload", 6.0: "upload", 6.01: None, 20.0: "24h", 30.0: "24h", 31.0: None,
            156.0: "7d", 180.0: "7d", 180.01: None}
    df = spark.createDataFrame([(k,) for k in ages], "a double")
    assert {r.a: r.l for r in df.select("a", P.poll_label(F.col("a")).alias("l")).collect()} == ages
    tiers = {999: None, 1000: "S", 99_999: "S", 100_000: "M", 1_000_000: "L", 10_000_000: None}
    df = spark.createDataFrame([(k,) for k in tiers], "n long")
    assert {r.n: r.t for r in df.select("n", P.tier_of(F.col("n")).alias("t")).collect()} == tiers
    df = spark.createDataFrame([("27",), ("999",), (None,)], "c string")
    names = [r[0] for r in df.select(P.category_name(F.col("c"))).collect()]
    assert names == ["Education", "Unknown", "Unknown"]


def test_age_bounds_equal_whole_hours(spark):
    from datetime import datetime, timedelta

    now = datetime(2026, 1, 10)
    times = [now - timedelta(minutes=m) for m in range(0, 60 * 40, 7)]
    df = spark.createDataFrame([(t,) for t in times], "p timestamp_ntz").select(
        P.aged_between(F.col("p"), now, 20, 30).alias("pushed"),
        P.whole_hours_old(F.col("p"), P.ntz(now)).between(20, 30).alias("plain"),
        P.older_than(F.col("p"), now, 30).alias("old"),
        (P.whole_hours_old(F.col("p"), P.ntz(now)) > 30).alias("plain_old"),
    )
    assert all(r.pushed == r.plain and r.old == r.plain_old for r in df.collect())


def test_ages_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        hours = spark.sql("select timestamp_ntz'2026-03-08 00:00:00' a, timestamp_ntz'2026-03-08 12:00:00' b").select(
            P.hours_between(F.col("a"), F.col("b"))
        ).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert hours == 12.0


def test_image_stats(spark):
    import numpy as np

    from pulsemark.functions.images import thumbnail_stats

    rng = np.random.default_rng(1)
    pixels = rng.integers(0, 256, (4, 5, 3), dtype="uint8")
    schema = "image struct<origin: string, height: int, width: int, nChannels: int, mode: int, data: binary>"
    df = spark.createDataFrame([(("a", 4, 5, 3, 16, pixels.tobytes()),), (("b", 4, 5, 3, 16, b"xx"),)], schema)
    rows = {r.origin: r for r in thumbnail_stats(df).collect()}
    b, g, r = (pixels[..., i].astype(float) for i in range(3))
    rg, yb = abs(r - g), abs(0.5 * (r + g) - b)
    assert rows["a"].brightness == pytest.approx(np.rint(0.299 * r + 0.587 * g + 0.114 * b).mean())
    assert rows["a"].colorfulness == pytest.approx(
        np.sqrt(rg.std() ** 2 + yb.std() ** 2) + 0.3 * np.sqrt(rg.mean() ** 2 + yb.mean() ** 2)
    )
    assert (rows["b"].brightness, rows["b"].colorfulness) == (0.0, 0.0)
