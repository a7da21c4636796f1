"""The same queries as plain SQL, for a second engine to run on the same parquet tables.

Written from the rules, independently of the Spark code. ``BASE`` names the derived tables; a query
is its own SELECT behind them.
"""

from __future__ import annotations

import math
import re

from pulsemark.constants import (
    CATEGORY_NAMES, DENSITY_FEATURES, DENSITY_PAIRS, EMOJI_CLASS, LISTICLE_WORDS, METRIC_COLS, SYNTHETIC_COUNTS,
    SYNTHETIC_REALS, TIER_RANGES, TIERS, VERTICALS, WHITESPACE_CLASS,
)

HEALTH_NOW = "2001-08-15 00:00:00"
DUE_NOW = "1998-11-18 14:00:00"
VELOCITY_NOW = "2024-02-25 00:00:00"

_CH = "concat('UC', lpad(cast({0} as varchar), 8, '0'))"
_VID = "concat('v', lpad(cast({0} as varchar), 9, '0'))"
_WS = WHITESPACE_CLASS


def _part(unit: str) -> str:
    pattern = r"^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?"
    group = "HMS".index(unit) + 1
    return f"coalesce(try_cast(regexp_extract(duration, '{pattern}', {group}) as bigint), 0)"


_SECONDS = f"{_part('H')} * 3600 + {_part('M')} * 60 + {_part('S')}"
_CATEGORY = "case category_id " + " ".join(
    f"when '{k}' then '{v}'" for k, v in CATEGORY_NAMES.items()
) + " else 'Unknown' end"


def _strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_WS}+', ''), '{_WS}+$', '')"


BASE: dict[str, str] = {
    "ch": f"""SELECT {_CH.format('c_custkey')} channel_id, concat('@c', cast(c_custkey as varchar)) channel_handle,
        case c_custkey % 3 when 0 then 'Education' when 1 then 'Lifestyle' else 'Tech' end vertical,
        case cast(floor(c_custkey / 3.0) as bigint) % 3 when 0 then 'S' when 1 then 'M' else 'L' end tier,
        cast(round(c_acctbal * 100) as bigint) subscriber_count, c_custkey FROM customer""",
    "vid": f"""SELECT o_orderkey, {_VID.format('o_orderkey')} video_id, {_CH.format('o_custkey')} channel_id,
        cast(concat(substring(cast(o_orderdate as varchar), 1, 10), ' ',
             lpad(cast(o_orderkey % 24 as varchar), 2, '0'), ':00:00') as timestamp) published_at,
        o_orderkey % 5 <> 0 is_tracked,
        case when o_orderkey % 101 = 0 then 'P1DT2H' else concat('PT',
          case when o_orderkey % 4 in (0, 1) then concat(cast(o_orderkey % 3 as varchar), 'H') else '' end,
          case when o_orderkey % 4 in (0, 2) then concat(cast(o_orderkey % 60 as varchar), 'M') else '' end,
          case when o_orderkey % 4 in (0, 3) then concat(cast(o_orderkey % 59 as varchar), 'S') else '' end) end duration,
        cast(o_orderkey % 31 as varchar) category_id,
        case when o_orderkey % 13 <> 0 then o_orderkey % 17 = 0 end contains_synthetic_media FROM orders""",
    "vids": f"SELECT vid.*, {_SECONDS} duration_seconds, {_CATEGORY} category_name FROM vid",
    "txt": """SELECT o_orderkey,
        case o_orderkey % 9 when 0 then s when 1 then concat('How to ', s) when 2 then concat('TOP 10 ', s)
          when 3 then concat(s, '?') when 4 then concat(s, '!') when 5 then concat(s, '\U0001F600\U0001F600✂')
          when 6 then upper(replace(s, 'ß', 'ss')) when 7 then upper(replace(concat('! \U0001F600 ', s), 'ß', 'ss')) end title,
        case o_orderkey % 7 when 0 then text
          when 1 then concat(text, ' http://a.example/1 https://a.example/2 http://a.example/3 https://a.example/4 https://a.example/5')
          when 2 then concat(text, ' https://a.example/1') when 3 then concat(text, ' 0:30')
          when 4 then concat(text, ' #tag_é') when 5 then substring(text, 1, 20) end description,
        case when o_orderkey % 11 <> 0 then len(string_split(p_name, ' ')) end n_tags
        FROM (SELECT o_orderkey, text, substring(text, 1, 60) s, p_name FROM orders
          LEFT JOIN documents ON doc_id = o_orderkey % (SELECT count(*) FROM documents)
          LEFT JOIN part ON p_partkey = o_orderkey % (SELECT count(*) FROM part))""",
    "snap": """SELECT v.*, ch.channel_handle, ch.vertical, ch.tier, ch.subscriber_count,
        p.poll_label, p.hours_since_publish, p.view_count, p.like_count, p.comment_count, p.face_count,
        p.brightness, p.colorfulness,
        v.published_at + to_microseconds(cast(round(p.hours_since_publish * 3600000000) as bigint)) poll_timestamp
        FROM (SELECT l_orderkey,
          case l_linenumber when 1 then 'upload' when 2 then '24h' when 3 then '7d' end poll_label,
          case l_linenumber when 1 then round(l_tax * 50, 2) when 2 then round(20 + l_discount * 100, 2)
            when 3 then round(156 + l_quantity * 0.48, 2) else round(l_quantity, 2) end hours_since_publish,
          cast(round(l_extendedprice) * (l_linenumber * l_linenumber) as bigint) view_count,
          cast(round(l_quantity * 40) * l_linenumber as bigint) like_count,
          cast(l_suppkey % 50 as bigint) * l_linenumber comment_count,
          l_orderkey % 3 face_count, l_tax * 1000 brightness, l_discount * 500 colorfulness
          FROM lineitem) p JOIN vids v ON v.o_orderkey = p.l_orderkey AND v.is_tracked JOIN ch USING (channel_id)""",
    "lab": "SELECT * FROM snap WHERE poll_label IS NOT NULL",
    "bvid": """SELECT v.video_id, v.channel_id, v.published_at, ch.channel_handle, ch.vertical, ch.tier,
        ch.subscriber_count, t.view_count, t.like_count, t.comment_count
        FROM vids v JOIN (SELECT l_orderkey, cast(sum(round(l_extendedprice)) as bigint) * 3 view_count,
          cast(sum(round(l_quantity * 40)) as bigint) like_count,
          cast(sum(l_suppkey % 50) as bigint) comment_count FROM lineitem GROUP BY 1) t
        ON t.l_orderkey = v.o_orderkey JOIN ch USING (channel_id) WHERE NOT v.is_tracked""",
    "med": """SELECT channel_id, max(channel_handle) channel_handle, count(*) video_count,
        median(view_count) median_views, median(like_count) median_likes, median(comment_count) median_comments,
        median(cast(like_count + comment_count as double) / nullif(view_count, 0)) median_engagement_rate
        FROM bvid GROUP BY 1""",
    "trk": """SELECT video_id, channel_id, published_at, published_at + interval 1 hour first_seen_at,
        o_orderkey % 10 <> 9 upload_poll_done, o_orderkey % 10 < 8 day1_poll_done, o_orderkey % 10 < 6 day7_poll_done
        FROM vid WHERE is_tracked AND o_orderkey % 97 <> 0""",
    "tch": "SELECT * FROM ch WHERE c_custkey % 4 <> 0",
    "cand": """SELECT channel_id, channel_handle, vertical, tier,
        abs(subscriber_count) * (1 + c_custkey % 7) subscriber_count, c_custkey * 1000 total_channel_views,
        c_custkey % 300 total_channel_videos, cast(c_custkey % 8 as double) / 4 upload_velocity_per_week,
        timestamp '2001-01-01 00:00:00' + to_hours(cast(c_custkey % 500 as int)) discovered_at,
        c_custkey % 20 = 0 added_to_tracking FROM ch WHERE c_custkey % 4 = 0""",
    "obs": f"""SELECT event_id, {_VID.format('user_id')} video_id, ts poll_timestamp,
        timestamp '2024-01-01 00:00:00' + to_hours(cast(user_id as int)) published_at,
        cast(round(value * 100) as bigint) view_count FROM events""",
    "upl": f"""SELECT {_CH.format('user_id')} channel_id, {_VID.format('event_id')} video_id, ts published_at FROM events""",
    "latest": """SELECT * EXCLUDE (rn) FROM (SELECT lab.*, row_number() OVER (PARTITION BY video_id, poll_label
        ORDER BY poll_timestamp DESC, view_count DESC, like_count DESC, comment_count DESC, subscriber_count DESC,
        hours_since_publish DESC, face_count DESC, brightness DESC, colorfulness DESC) rn FROM lab) WHERE rn = 1""",
    "wide": "SELECT u.video_id, u.o_orderkey, u.channel_id, u.channel_handle, u.duration_seconds, u.category_id, "
    "u.category_name, u.published_at, u.vertical, u.tier, u.contains_synthetic_media, u.face_count, u.brightness, "
    "u.colorfulness, " + ", ".join(
        f"{a}.{c} {c}_{p}" for a, p in (("u", "upload"), ("d", "24h"), ("w", "7d"))
        for c in [*METRIC_COLS, "hours_since_publish"]
    ) + """ FROM latest u JOIN latest d ON d.video_id = u.video_id AND d.poll_label = '24h'
        JOIN latest w ON w.video_id = u.video_id AND w.poll_label = '7d' WHERE u.poll_label = 'upload'""",
    "cleaned": "SELECT wide.* REPLACE (" + ", ".join(
        f"case when {c}_{p} < 0 then 0 else {c}_{p} end AS {c}_{p}"
        for p in ("upload", "24h", "7d") for c in METRIC_COLS
    ) + """), med.channel_handle baseline_channel_handle, med.video_count baseline_video_count,
        med.median_views baseline_median_views, med.median_likes baseline_median_likes,
        med.median_comments baseline_median_comments, med.median_engagement_rate baseline_median_engagement_rate
        FROM wide LEFT JOIN med USING (channel_id)""",
    "kept": """SELECT * FROM cleaned WHERE baseline_median_views IS NOT NULL AND baseline_median_likes IS NOT NULL
        AND baseline_median_comments IS NOT NULL AND baseline_median_engagement_rate IS NOT NULL
        AND baseline_median_engagement_rate <> 0""",
    "rated": """SELECT *, case when view_count_7d > 0 then cast(like_count_7d + comment_count_7d as double) / view_count_7d
          else 0.0 end engagement_7d,
        case when baseline_median_views > 0 then (baseline_median_likes + baseline_median_comments) / baseline_median_views
          else 0.0 end baseline_engagement FROM kept""",
    "tgt": "SELECT *, case when engagement_7d > baseline_engagement then 1 else 0 end above_baseline FROM rated",
    "step1": """SELECT *, case when subscriber_count_upload < 1 then 1 else subscriber_count_upload end subs,
        case when hours_since_publish_24h - hours_since_publish_upload < 0.1 then 0.1
          else hours_since_publish_24h - hours_since_publish_upload end gap,
        case when hours_since_publish_upload < 0.1 then 0.1 else hours_since_publish_upload end lead,
        case when baseline_median_views < 1 then 1 else baseline_median_views end bviews,
        case when baseline_median_likes < 1 then 1 else baseline_median_likes end blikes FROM tgt""",
    "step2": "SELECT *, " + ", ".join(
        f"({m}_24h - {m}_upload) / gap {m}_velocity_24h" for m in METRIC_COLS
    ) + ", view_count_upload / lead view_velocity_upload, like_count_upload / lead like_velocity_upload FROM step1",
    "eng": "SELECT *, " + ", ".join(
        [f"{m}_count_velocity_24h / subs {m}_velocity_per_sub_24h" for m in ("view", "like")]
        + ["view_count_velocity_24h / bviews view_velocity_ratio"]
        + [f"{m}_count_velocity_24h / (case when {m}_velocity_upload < 0.01 then 0.01 else {m}_velocity_upload end) "
           f"{m}_velocity_acceleration" for m in ("view", "like")]
        + [f"{m}_count_upload / b{m}s {m}_count_upload_vs_baseline" for m in ("view", "like")]
        + [f"case when view_count_{p} > 0 then cast(like_count_{p} as double) / view_count_{p} else 0.0 end like_rate_{p}"
           for p in ("upload", "24h")]
        + [f"cast({m}_count_{p} as double) / subs {m}s_per_sub_{p}"
           for p in ("upload", "24h", "7d") for m in ("view", "like", "comment")]
    ) + " FROM step2",
    "ctext": f"SELECT o_orderkey, {_strip('title')} title, {_strip('description')} description, n_tags FROM txt",
    "tfeat": f"""SELECT o_orderkey, title, description, coalesce(n_tags, 0) tag_count,
        len(regexp_extract_all(title, '\\p{{L}}')) letters, len(regexp_extract_all(title, '\\p{{Lu}}')) caps,
        len(regexp_extract_all(title, '{EMOJI_CLASS}')) emoji, length(title) title_length,
        len(regexp_extract_all(title, '{_WS.replace("[", "[^", 1)}+')) title_word_count,
        length(description) desc_length, len(regexp_extract_all(description, 'https?://')) desc_link_count,
        len(regexp_extract_all(description, '#[\\p{{L}}\\p{{N}}_]+')) desc_hashtag_count FROM ctext""",
    "tclass": """SELECT *,
        case when title is null then 0
          when contains(title, '!') and emoji >= 1 and caps / greatest(letters, 1) > 0.3 then 7
          when caps / greatest(letters, 1) > 0.5 and letters > 5 then 6 when emoji >= 3 then 5
          when starts_with(lower(title), 'how to') then 4
          when """ + " or ".join(f"contains(lower(title), '{w}')" for w in LISTICLE_WORDS) + """ then 3
          when contains(title, '?') then 1 when contains(title, '!') then 2 else 0 end title_category,
        case when description is null then 0 when desc_link_count >= 5 then 3
          when regexp_matches(description, '\\p{Nd}{1,2}:\\p{Nd}{2}') then 1 when desc_link_count > 0 then 2
          when contains(description, '#') then 4 when desc_length < 50 then 5 when desc_length > 2000 then 6
          else 0 end desc_category FROM tfeat""",
    "strat": "SELECT *, concat_ws('_', vertical, tier, cast(above_baseline as varchar)) stratum FROM tgt",
}


def _needed(body: str) -> list[str]:
    """Base tables a query reaches, in definition order."""
    found: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name in BASE:
            if name not in found and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text, re.IGNORECASE):
                found.add(name)
                pending.append(BASE[name])
    return [name for name in BASE if name in found]


def sql(body: str, **extra: str) -> str:
    """``body`` behind the base tables it needs and its own ``extra`` tables."""
    needed = _needed(" ".join([body, *extra.values()]))
    parts = [f"{name} AS ({BASE[name]})" for name in needed]
    parts += [f"{name} AS ({text})" for name, text in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def r(expression: str, name: str | None = None, places: int = 6) -> str:
    return f"round(cast({expression} as double), {places}) AS {name or expression}"


def big(*names: str) -> str:
    return ", ".join(f"cast({n} as bigint) AS {n}" for n in names)


def rs(*names: str, places: int = 6) -> str:
    return ", ".join(r(n, places=places) for n in names)


_WIDE_COUNTS = [f"{c}_{p}" for p in ("upload", "24h", "7d") for c in METRIC_COLS]
_WIDE_HOURS = [f"hours_since_publish_{p}" for p in ("upload", "24h", "7d")]
_MEDIANS = ["median_views", "median_likes", "median_comments", "median_engagement_rate"]
_VELOCITY = [f"{m}_velocity_24h" for m in METRIC_COLS] + [
    "view_velocity_upload", "like_velocity_upload", "view_velocity_per_sub_24h", "like_velocity_per_sub_24h",
    "view_velocity_ratio", "view_velocity_acceleration", "like_velocity_acceleration",
]
_RATIOS = ["view_count_upload_vs_baseline", "like_count_upload_vs_baseline", "like_rate_upload", "like_rate_24h"]
_PER_SUB = [f"{m}s_per_sub_{p}" for p in ("upload", "24h", "7d") for m in ("view", "like", "comment")]
_TEXT = ["title_length", "title_word_count", "desc_length", "desc_link_count", "desc_hashtag_count"]
_TIME = """cast(hour(published_at) as bigint) publish_hour, cast(isodow(published_at) - 1 as bigint) publish_dayofweek,
    cast(isodow(published_at) >= 6 as bigint) publish_is_weekend"""
_DURATION = """cast(coalesce(duration_seconds <= 60, false) as bigint) is_short,
    cast(coalesce(duration_seconds > 1200, false) as bigint) is_long,
    cast(case when duration_seconds <= 60 then 0 when duration_seconds <= 600 then 1 when duration_seconds <= 1200 then 2
      else 3 end as bigint) duration_bucket"""
_ENCODE = "cast(case tier when 'S' then 0 when 'M' then 1 when 'L' then 2 else 0 end as bigint) tier_encoded, " + ", ".join(
    f"cast(vertical = '{v}' as bigint) vertical_{v}" for v in VERTICALS
)
_RATE_CI = """count(*) n, avg(above_baseline) rate,
    avg(above_baseline) - 1.96 * stddev_samp(above_baseline) / sqrt(count(*)) rate_low,
    avg(above_baseline) + 1.96 * stddev_samp(above_baseline) / sqrt(count(*)) rate_high"""
_STAGES = [("upload", "upload_poll_done", 6, "true"), ("24h", "day1_poll_done", 30, "upload_poll_done"),
           ("7d", "day7_poll_done", 180, "day1_poll_done")]


def _hours(now: str) -> str:
    """Whole elapsed hours, truncated."""
    return f"date_diff('microsecond', published_at, timestamp '{now}') // 3600000000"


_DONE = " UNION ALL ".join(
    f"""SELECT '{s}' stage, count(*) total_eligible, count_if({flag}) completed, count_if(NOT {flag}) missing
        FROM trk WHERE {_hours(HEALTH_NOW)} > {h} AND {needs}""" for s, flag, h, needs in _STAGES
)
_COMPLETION = f"""SELECT stage, {big('total_eligible', 'completed', 'missing')},
    coalesce(round(completed * 1.0 / nullif(total_eligible, 0) * 100, 1), 0.0) completion_pct FROM ({_DONE})"""
_MISMATCH = " UNION ALL ".join(
    f"""SELECT '{s}' stage, video_id, channel_id FROM trk WHERE {flag} AND NOT EXISTS
        (SELECT 1 FROM snap WHERE snap.video_id = trk.video_id AND snap.poll_label = '{s}')""" for s, flag, _, _ in _STAGES
)
_ORPHANS = " UNION ALL ".join(
    f"""SELECT '{s}' stage, count(*) orphaned_snapshots FROM snap WHERE poll_label = '{s}' AND NOT EXISTS
        (SELECT 1 FROM trk WHERE trk.video_id = snap.video_id)""" for s, _, _, _ in _STAGES
)


def _due(low: int, high: int, needs: str, flag: str) -> str:
    return f"""SELECT video_id, channel_id, channel_handle, vertical, tier FROM (
        SELECT trk.*, tch.channel_handle, tch.vertical, tch.tier FROM trk JOIN tch USING (channel_id)
        WHERE {needs} AND NOT {flag} AND {_hours(DUE_NOW)} BETWEEN {low} AND {high}
        ORDER BY published_at, video_id LIMIT 100)"""


def _spot(stage: str, flag: str) -> str:
    return f"""(SELECT '{stage}' stage, trk.video_id, trk.published_at, s.poll_label, s.hours_since_publish,
        s.view_count, s.like_count, s.comment_count FROM trk LEFT JOIN snap s
        ON s.video_id = trk.video_id AND s.poll_label = '{stage}' WHERE {flag}
        ORDER BY trk.published_at DESC, trk.video_id, s.hours_since_publish DESC NULLS LAST,
        s.view_count DESC NULLS LAST, s.like_count DESC NULLS LAST, s.comment_count DESC NULLS LAST LIMIT 5)"""


# --- profile tables over the modelling rows -------------------------------------------------
_PER_SUB = [f"{m}s_per_sub_{p}" for p in ("upload", "24h", "7d") for m in ("view", "like", "comment")]
PROFILED = [
    *_WIDE_COUNTS, *_WIDE_HOURS, "baseline_video_count", "baseline_median_views", "baseline_median_likes",
    "baseline_median_comments", "baseline_median_engagement_rate", "duration_seconds", "face_count", "brightness",
    "colorfulness", "engagement_7d", "baseline_engagement", *[f"{m}_velocity_24h" for m in METRIC_COLS],
    "view_velocity_upload", "like_velocity_upload", "view_velocity_per_sub_24h", "like_velocity_per_sub_24h",
    "view_velocity_ratio", "view_velocity_acceleration", "like_velocity_acceleration",
    "view_count_upload_vs_baseline", "like_count_upload_vs_baseline", "like_rate_upload", "like_rate_24h", *_PER_SUB,
]
_LONG = " UNION ALL ".join(
    f"SELECT video_id, vertical, tier, above_baseline, '{c}' feature, cast({c} as double) value FROM eng" for c in PROFILED
)
CORRELATED = [*PROFILED, "above_baseline"]


def _features(names: list[str], keys: str = "video_id, vertical, tier, above_baseline") -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, '{c}' feature, cast({c} as double) value FROM eng" for c in names
    )


def _hist(long: str, keys: list[str]) -> str:
    k = "".join(f"{c}, " for c in keys)
    on = " AND ".join(f"e.{c} = b.{c}" for c in [*keys, "feature", "bin"])
    return f"""SELECT {k}feature, cast(bin as bigint) bin, round(lo + (bin - 1) * width, 6) bin_low,
        cast(n as bigint) n, round(n / (total * width), 10) density FROM (
        SELECT e.*, coalesce(b.n, 0) n FROM (SELECT * FROM ends, generate_series(1, 40) g(bin)) e LEFT JOIN (
          SELECT {''.join(f'l.{c}, ' for c in keys)}l.feature, least(floor((l.value - e.lo) / e.width) + 1, 40) bin, count(*) n
          FROM {long} l JOIN ends e ON {' AND '.join(f'l.{c} = e.{c}' for c in [*keys, 'feature'])} GROUP BY ALL) b ON {on})"""


def _ends(long: str, keys: list[str]) -> str:
    k = "".join(f"{c}, " for c in keys)
    return f"""SELECT *, (hi - lo) / 40 width FROM (SELECT {k}feature, count(*) total,
        case when min(value) = max(value) then min(value) - 0.5 else min(value) end lo,
        case when min(value) = max(value) then max(value) + 0.5 else max(value) end hi FROM {long} GROUP BY ALL)"""


def _kde(long: str, keys: list[str]) -> dict[str, str]:
    k = "".join(f"{c}, " for c in keys)
    on = " AND ".join(f"l.{c} = s.{c}" for c in [*keys, "feature"])
    return {
        "st": f"""SELECT {k}feature, count(*) n, min(value) lo, max(value) hi,
            stddev_samp(value) * pow(count(*), -0.2) h FROM {long} GROUP BY ALL
            HAVING count(*) >= 2 AND stddev_samp(value) > 0""",
        "kd": f"""SELECT {''.join(f's.{c}, ' for c in keys)}s.feature, g.i, s.lo + g.i * (s.hi - s.lo) / 199 x,
            sum(exp(-0.5 * pow((s.lo + g.i * (s.hi - s.lo) / 199 - l.value) / s.h, 2))) / (max(s.n) * max(s.h) * sqrt(2 * pi())) density
            FROM st s JOIN {long} l ON {on}, generate_series(0, 199) g(i) GROUP BY ALL""",
    }


def _box(keys: list[str], column: str) -> str:
    k = ", ".join(keys)
    return f"""SELECT {k}, feature, cast(n as bigint) n, {rs('q1', 'median', 'q3', 'whisker_low', 'whisker_high')},
        cast(n_outliers as bigint) n_outliers FROM (
        SELECT {', '.join('e.' + c for c in keys)}, '{column}' feature, any_value(n) n, any_value(q1) q1, any_value(med) median, any_value(q3) q3,
          min({column}) FILTER ({column} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) whisker_low,
          max({column}) FILTER ({column} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) whisker_high,
          count_if(NOT ({column} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) n_outliers
        FROM eng e JOIN (SELECT {k}, count(*) n, quantile_cont({column}, 0.25) q1, quantile_cont({column}, 0.5) med,
          quantile_cont({column}, 0.75) q3 FROM eng GROUP BY ALL) q USING ({k}) GROUP BY {', '.join('e.' + c for c in keys)})"""


_FAKE = "(CAST(substr(video_id, 2) AS bigint) % 7 = 0)"


def _pairs(where: str = "") -> str:
    """All pairs from one pass: one list of pairs with their correlations, unnested."""
    items = ", ".join(
        f"{{'feature_a': '{a}', 'feature_b': '{b}', 'n': count(CASE WHEN {b} IS NOT NULL THEN {a} END), 'r': corr({a}, {b})}}"
        for i, a in enumerate(CORRELATED) for b in CORRELATED[:i])
    return f"SELECT unnest(p, recursive := true) FROM (SELECT unnest([{items}]) p FROM (SELECT * FROM eng {where}))"


def _varied(where: str = "") -> str:
    items = ", ".join(f"{{'c': '{c}', 'v': var_samp({c})}}" for c in CORRELATED)
    return f"SELECT p.c AS c FROM (SELECT unnest([{items}]) p FROM (SELECT * FROM eng {where})) WHERE p.v > 0.01"


def _quota(source: str, drawn: str) -> dict[str, str]:
    """Largest-remainder quotas per stratum, and rows ranked by hash."""
    return {
        "cnt": f"SELECT stratum, count(*) n FROM {source} GROUP BY 1",
        "tot": f"SELECT sum(n) total, {drawn} drawn FROM cnt",
        "shr": """SELECT stratum, n, drawn, floor(n * drawn / total) base, n * drawn / total - floor(n * drawn / total) rest
            FROM (SELECT cnt.*, cast(tot.total as double) total, cast(tot.drawn as double) drawn FROM cnt, tot)""",
        "quo": """SELECT stratum, base + case when row_number() OVER (ORDER BY rest DESC, stratum) <= drawn - sum(base) OVER ()
            then 1 else 0 end quota FROM shr""",
        "rnk": f"""SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5(concat(video_id, ':42')), video_id) rk
            FROM {source}""",
        "drw": "SELECT rnk.*, rk <= quota inside FROM rnk JOIN quo USING (stratum)",
    }


_HOLD = {
    f"h_{k}": re.sub(r"\b(cnt|tot|shr|quo|rnk|drw)\b", r"h_\1", v)
    for k, v in _quota("strat", "sum(n) - ceil(sum(n) * 0.7)").items()
}
_SPLIT = {
    **_HOLD,
    "pool": "SELECT * FROM strat WHERE video_id NOT IN (SELECT video_id FROM h_drw WHERE inside)",
    **_quota("pool", "sum(n) - ceil(sum(n) * 0.2)"),
    "spl": """SELECT video_id, vertical, tier, above_baseline, case when inside then 'train' else 'test' end split FROM drw
        UNION ALL SELECT video_id, vertical, tier, above_baseline, 'val' FROM h_drw WHERE inside""",
}

# A score per document from its text hash: deterministic, and with ties.
SCORED = """SELECT quality label, (ascii(substr(md5(text), 1, 1)) * 7 + ascii(substr(md5(text), 2, 1)) + 40 * quality) % 97 / 97.0 score
    FROM labels JOIN documents USING (doc_id)"""

ORACLE: dict[str, str] = {}


def _add(name: str, body: str, **extra: str) -> None:
    ORACLE[name] = sql(body, **extra)


_LEVELS = {"vertical": "vertical, NULL AS tier", "tier": "NULL AS vertical, tier", "vertical_tier": "vertical, tier"}
_add("entry_label_rates", f"SELECT level, vertical, tier, cast(n as bigint) n, {rs('rate', 'rate_low', 'rate_high')} FROM ("
     + " UNION ALL ".join(
         f"SELECT '{level}' AS level, {keys}, {_RATE_CI} FROM tgt WHERE "
         + " AND ".join(f"{k} IS NOT NULL" for k in level.split("_")) + f" GROUP BY {', '.join(level.split('_'))}"
         for level, keys in _LEVELS.items()) + ")")
# Each row counts Poisson(1) times in a replicate, by three numbers of its hash.
_SEEDS = ", ".join(f"('0x' || substr(md5(video_id), {1 + 8 * k}, 8))::BIGINT % 2147483647 s{k}" for k in range(3))
_STEPS = [math.floor(2147483647 * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1))) for k in range(9)]
_add("label_rates_bootstrap", f"SELECT level, vertical, tier, cast(n as bigint) n, {rs('rate', 'rate_low', 'rate_high', places=9)} FROM ("
     + " UNION ALL ".join(
         f"""SELECT '{level}' AS level, {keys}, max(n) n, max(rate) rate, quantile_cont(wy / w, 0.025) rate_low, quantile_cont(wy / w, 0.975) rate_high
         FROM (SELECT {', '.join(level.split('_'))}, b, sum(w) w, sum(w * above_baseline) wy, count(*) n, avg(above_baseline) rate FROM drawn
           WHERE {' AND '.join(f'{k} IS NOT NULL' for k in level.split('_'))} GROUP BY ALL) WHERE w > 0 GROUP BY {', '.join(level.split('_'))}"""
         for level, keys in _LEVELS.items()) + ")",
     drawn="SELECT vertical, tier, above_baseline, b, " + " + ".join(f"(u >= {step})::INT" for step in _STEPS) + f""" w FROM (
         SELECT *, (s0 + s1 * b + s2 * (b * b)) % 2147483647 u FROM (SELECT vertical, tier, above_baseline, {_SEEDS} FROM tgt), range(1000) g(b))""")
_add("label_heatmap", "SELECT vertical, " + ", ".join(
    f"round(avg(above_baseline) FILTER (tier = '{t}') * 100, 6) AS {t}_pct, "
    f"nullif(count(*) FILTER (tier = '{t}'), 0) AS {t}_n" for t in TIERS) + " FROM tgt GROUP BY 1")
_add("triplet_counts", """SELECT video_id, count(DISTINCT poll_label) n_labels, count(DISTINCT poll_label) = 3 complete
    FROM lab GROUP BY 1""")
_add("latest_poll", f"SELECT video_id, poll_label, {big('view_count', 'like_count', 'comment_count', 'subscriber_count')}, "
     f"{rs('hours_since_publish', 'brightness', 'colorfulness')} FROM latest")
_add("pivot_wide", f"SELECT video_id, channel_id, category_name, {big('duration_seconds', 'face_count', *_WIDE_COUNTS)}, "
     f"{rs(*_WIDE_HOURS, 'brightness', 'colorfulness')} FROM wide")
_add("pivot_multiplicity", """SELECT video_id, cast(u * u * d * w as bigint) joined_rows FROM (SELECT video_id,
    count_if(poll_label = 'upload') u, count_if(poll_label = '24h') d, count_if(poll_label = '7d') w FROM lab GROUP BY 1)
    WHERE u > 0 AND d > 0 AND w > 0""")
_add("baseline_medians", f"SELECT channel_id, channel_handle, video_count, {rs(*_MEDIANS)} FROM med")
_add("baseline_join", f"SELECT video_id, channel_id, baseline_video_count, {rs(*['baseline_' + m for m in _MEDIANS])} FROM cleaned")
_add("baseline_match", "SELECT count(*) total_rows, count(baseline_video_count) matched_rows FROM cleaned")
_add("clean_table", f"""SELECT video_id, {_strip('channel_handle')} channel_handle, title, description, tag_count,
    {big(*_WIDE_COUNTS)} FROM (SELECT c.*, t.title, t.description, cast(coalesce(t.n_tags, 0) as bigint) tag_count
    FROM cleaned c JOIN ctext t USING (o_orderkey))""")
_add("drop_bad_baselines", "SELECT video_id, channel_id FROM kept")
_add("assessed_only", "SELECT poll_label, count(*) n FROM lab WHERE contains_synthetic_media IS NOT NULL GROUP BY 1")
_add("target", f"SELECT video_id, {rs('engagement_7d', 'baseline_engagement')}, cast(above_baseline as bigint) above_baseline FROM tgt")
_add("velocity", f"SELECT video_id, {rs(*_VELOCITY)} FROM eng")
_add("ratios", f"SELECT video_id, {rs(*_RATIOS)} FROM eng")
_add("per_sub", f"SELECT video_id, {rs(*_PER_SUB)} FROM eng")
_add("title_category", f"SELECT {_VID.format('o_orderkey')} video_id, cast(title_category as bigint) title_category FROM tclass")
_add("desc_category", f"SELECT {_VID.format('o_orderkey')} video_id, cast(desc_category as bigint) desc_category FROM tclass")
_add("text_features", f"SELECT {_VID.format('o_orderkey')} video_id, {big(*_TEXT, 'tag_count')}, "
     "cast(tag_count > 0 as bigint) has_tags FROM tfeat")
_add("temporal", f"SELECT video_id, {_TIME} FROM vids")
_add("duration", f"SELECT video_id, {_DURATION} FROM vids")
_add("parse_duration", f"SELECT video_id, {big('duration_seconds')} FROM vids")
_add("category_name", "SELECT category_id, category_name, count(*) n FROM vids GROUP BY ALL")
_add("encode", f"SELECT channel_id, {_ENCODE} FROM ch")
_add("thumbnail", "SELECT video_id, cast(face_count > 0 as bigint) has_face FROM wide")
_FILL = "case when {0} is null then {1} else {0} end"
_add("fill_missing", f"""SELECT video_id, {r(_FILL.format('baseline_median_views', '-999'), 'baseline_median_views')},
    cast({_FILL.format('baseline_video_count', '-999')} as bigint) baseline_video_count,
    cast({_FILL.format('cast(contains_synthetic_media as int)', '-999')} as bigint) contains_synthetic_media FROM cleaned""")
_add("engineered", f"""SELECT video_id, {big('duration_seconds', *_WIDE_COUNTS)}, {rs('brightness', 'colorfulness')},
    {rs(*_VELOCITY, *_RATIOS, *_PER_SUB, 'engagement_7d', 'baseline_engagement')},
    cast(above_baseline as bigint) above_baseline,
    {', '.join(f'cast(coalesce({c}, 0) as bigint) AS {c}' for c in [*_TEXT, 'tag_count'])},
    cast(coalesce(tag_count, 0) > 0 as bigint) has_tags, {big('title_category', 'desc_category')},
    {_TIME}, {_DURATION}, cast(face_count > 0 as bigint) has_face, {_ENCODE}
    FROM eng JOIN tclass USING (o_orderkey)""")
_add("poll_label", """SELECT event_id, video_id, round(age, 6) age_hours, case when age BETWEEN 0 AND 6 then 'upload'
    when age BETWEEN 20 AND 30 then '24h' when age BETWEEN 156 AND 180 then '7d' end poll_label
    FROM (SELECT *, date_diff('microsecond', published_at, poll_timestamp) / 3.6e9 age FROM obs)
    WHERE age BETWEEN 0 AND 6 OR age BETWEEN 20 AND 30 OR age BETWEEN 156 AND 180""")
_FIRST = """SELECT video_id, poll_label, event_id, view_count FROM (SELECT *, row_number() OVER
    (PARTITION BY video_id, poll_label ORDER BY poll_timestamp, event_id) rn FROM (SELECT *,
    case when age BETWEEN 0 AND 6 then 'upload' when age BETWEEN 20 AND 30 then '24h' when age BETWEEN 156 AND 180 then '7d' end
    poll_label FROM (SELECT *, date_diff('microsecond', published_at, poll_timestamp) / 3.6e9 age FROM obs))
    WHERE poll_label IS NOT NULL) WHERE rn = 1"""
_add("first_observation", _FIRST)
_add("whole_hours", f"SELECT video_id, {_hours(HEALTH_NOW)} AS hours_old FROM vid")
_add("due_24h", _due(20, 30, "upload_poll_done", "day1_poll_done"))
_add("due_7d", _due(156, 180, "day1_poll_done", "day7_poll_done"))
_add("new_videos", f"""SELECT video_id, channel_id, false upload_poll_done, false day1_poll_done, false day7_poll_done FROM vid
    WHERE date_diff('microsecond', published_at, timestamp '{DUE_NOW}') / 3.6e9 BETWEEN 0 AND 6
    AND video_id NOT IN (SELECT video_id FROM trk)""")
_add("channels_without_baseline", """SELECT channel_id, channel_handle, vertical, tier FROM tch
    WHERE channel_id NOT IN (SELECT channel_id FROM bvid)""")
_add("last_30_baseline", """SELECT video_id, channel_id FROM (SELECT *, row_number() OVER (PARTITION BY channel_id
    ORDER BY published_at DESC, video_id) pick FROM (SELECT *, row_number() OVER (PARTITION BY channel_id
    ORDER BY published_at DESC, video_id) rn FROM vid) WHERE rn <= 50 AND video_id NOT IN (SELECT video_id FROM trk))
    WHERE pick <= 30""")
_add("run_counts", """SELECT poll_label, count(*) rows_written, count(DISTINCT video_id) videos,
    count(DISTINCT channel_id) channels_done FROM lab GROUP BY 1""")
_add("run_report", """SELECT vertical, count(*) FILTER (planned) channels_planned, count(*) FILTER (planned AND n > 0) channels_done,
    count(*) FILTER (planned AND n = 0) channels_skipped, cast(coalesce(sum(n) FILTER (planned), 0) as bigint) rows_written,
    cast(coalesce(sum(n) FILTER (NOT planned), 0) as bigint) rows_elsewhere FROM (
      SELECT ch.vertical, c_custkey % 4 <> 0 planned, count(bvid.video_id) n FROM ch LEFT JOIN bvid USING (channel_id)
      GROUP BY ch.vertical, c_custkey, channel_id) GROUP BY 1""")
_add("skipped_channels", """SELECT channel_id, channel_handle, vertical, tier FROM tch
    WHERE channel_id NOT IN (SELECT channel_id FROM bvid)""")
_add("combined_polls", f"SELECT video_id, poll_label, {big('view_count', 'like_count', 'comment_count')} FROM lab")
_add("segments_restored", f"SELECT video_id, vertical, tier, {big('above_baseline', 'view_count_24h')} FROM eng")
_INPUTS = [
    "duration_seconds", "brightness", "colorfulness",
    *[f"{m}_count_{p}" for p in ("upload", "24h") for m in ("view", "like", "comment", "subscriber")],
    *[f"{m}_count_velocity_24h" for m in ("view", "like", "comment", "subscriber")],
    "view_velocity_upload", "like_velocity_upload", "view_velocity_per_sub_24h", "like_velocity_per_sub_24h",
    "view_velocity_ratio", "view_velocity_acceleration", "like_velocity_acceleration",
    "view_count_upload_vs_baseline", "like_count_upload_vs_baseline", "like_rate_upload", "like_rate_24h",
    *[f"{m}s_per_sub_{p}" for p in ("upload", "24h") for m in ("view", "like", "comment")],
]
_add("model_inputs", " UNION ALL ".join(
    f"SELECT '{c}' feature, count({c}) n, round(min(cast({c} as double)), 6) least, round(max(cast({c} as double)), 6) most FROM eng"
    for c in _INPUTS))
_add("real_and_synthetic", """SELECT video_id, cast(above_baseline as bigint) above_baseline,
    case when cast(substr(video_id, 2) as bigint) % 7 = 0 then 'synthetic' else 'real' end part FROM eng""")
_add("aligned_rows", """SELECT video_id, cast(NULL as varchar) poll_label, channel_id, view_count, like_count,
    cast(NULL as double) hours_since_publish, tier FROM bvid""")
_add("completion", _COMPLETION)
_add("mismatches", _MISMATCH)
_add("mismatch_examples", f"SELECT stage, video_id, channel_id FROM ({_MISMATCH}) ORDER BY stage, video_id LIMIT 5")
_add("orphans", _ORPHANS)
_add("missing_baselines", "SELECT DISTINCT channel_id FROM trk WHERE channel_id NOT IN (SELECT channel_id FROM med)")
_add("spot_check", f"""SELECT stage, video_id, poll_label, {rs('hours_since_publish')},
    {big('view_count', 'like_count', 'comment_count')} FROM ({' UNION ALL '.join(_spot(s, f) for s, f, _, _ in _STAGES)})""")
_add("tracking_summary", """SELECT count(*) total_tracked, count_if(upload_poll_done) upload_done, count_if(day1_poll_done) day1_done,
    count_if(day7_poll_done) day7_done, strftime(min(first_seen_at), '%Y-%m-%d %H:%M:%S') earliest_tracked,
    strftime(max(first_seen_at), '%Y-%m-%d %H:%M:%S') latest_tracked FROM trk""")
_add("snapshot_volume", """SELECT poll_label, count(*) snapshot_count, strftime(min(poll_timestamp), '%Y-%m-%d %H:%M:%S') earliest,
    strftime(max(poll_timestamp), '%Y-%m-%d %H:%M:%S') latest FROM lab GROUP BY 1""")
_add("health_warnings", f"""SELECT 'completion' "check", stage, cast(missing as bigint) affected FROM ({_COMPLETION})
      WHERE total_eligible > 0 AND completion_pct < 90
    UNION ALL SELECT 'mismatch', stage, count(*) FROM ({_MISMATCH}) GROUP BY stage
    UNION ALL SELECT 'orphan', stage, orphaned_snapshots FROM ({_ORPHANS}) WHERE orphaned_snapshots > 0
    UNION ALL SELECT 'missing_baseline', 'all', n FROM (SELECT count(DISTINCT channel_id) n FROM trk
      WHERE channel_id NOT IN (SELECT channel_id FROM med)) WHERE n > 0""")
_add("snapshot_profile", """SELECT 'total_rows' measure, 'all' "key", count(*) n FROM lab
    UNION ALL SELECT 'unique_videos', 'all', count(DISTINCT video_id) FROM lab
    UNION ALL SELECT 'unique_channels', 'all', count(DISTINCT channel_id) FROM lab
    UNION ALL SELECT 'poll_label', poll_label, count(*) FROM lab GROUP BY 2
    UNION ALL SELECT 'vertical', vertical, count(*) FROM lab GROUP BY 2
    UNION ALL SELECT 'tier', tier, count(*) FROM lab GROUP BY 2""")
_PLAN = "SELECT v vertical, t tier, coalesce(current, 0) current, target, greatest(0, target - coalesce(current, 0)) needed FROM " \
    "(SELECT v, t, case t when 'S' then 150 when 'M' then 100 else 75 end target FROM unnest(['Education', 'Lifestyle', 'Tech']) a(v), " \
    "unnest(['S', 'M', 'L']) b(t)) LEFT JOIN (SELECT vertical, tier, count(*) current FROM tch GROUP BY ALL) ON vertical = v AND tier = t"
_add("channel_counts", "SELECT vertical, tier, count(*) current FROM tch GROUP BY ALL")
_add("fill_plan", f"SELECT vertical, tier, {big('current', 'target', 'needed')} FROM ({_PLAN})")
_add("known_ids", "SELECT channel_id FROM tch UNION SELECT channel_id FROM cand")
_VEL = f"""SELECT channel_id, count_if(published_at >= timestamp '{VELOCITY_NOW}' - interval 28 day) / 4 velocity FROM
    (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY published_at DESC, video_id) rn FROM upl)
    WHERE rn <= 50 GROUP BY 1"""
_add("upload_velocity", f"SELECT channel_id, {r('velocity')} FROM ({_VEL})")
_TIER = """case when subscriber_count >= 1000 and subscriber_count < 100000 then 'S'
    when subscriber_count >= 100000 and subscriber_count < 1000000 then 'M'
    when subscriber_count >= 1000000 and subscriber_count < 10000000 then 'L' end"""
_add("range_join", """SELECT channel_id, band, cast(low as bigint) low, cast(high as bigint) high FROM ch JOIN bands
    ON (low IS NULL OR subscriber_count >= low) AND (high IS NULL OR subscriber_count < high)""",
     bands="SELECT * FROM (VALUES " + ", ".join(f"('{t}', {a}, {b})" for t, (a, b) in TIER_RANGES.items())
     + """, ('below', NULL, 1000), ('above', 500000, NULL)) v(band, low, high) UNION ALL
     SELECT vertical, cast(trunc(quantile_cont(subscriber_count, 0.25)) as bigint), cast(trunc(quantile_cont(subscriber_count, 0.75)) as bigint)
     FROM ch GROUP BY 1""")
_add("tier_range", f"SELECT channel_id, {_TIER} tier FROM ch")
_add("qualify_candidates", f"""SELECT channel_id, vertical, tier, {r('velocity', 'upload_velocity_per_week')},
    cast(subscriber_count as bigint) subscriber_count FROM (
    SELECT q.*, row_number() OVER (PARTITION BY q.vertical, q.tier ORDER BY discovered_at, channel_id) rk, p.needed FROM (
      SELECT c.* EXCLUDE (tier), {_TIER} tier, velocity FROM cand c JOIN vel USING (channel_id)
      WHERE channel_id NOT IN (SELECT channel_id FROM tch)) q JOIN plan p ON p.vertical = q.vertical AND p.tier = q.tier
    WHERE velocity >= case q.tier when 'L' then 0.5 else 1.0 end) WHERE rk <= needed""", vel=_VEL, plan=_PLAN)
_DRAIN = """SELECT * FROM (SELECT c.*, needed, row_number() OVER (PARTITION BY c.vertical, c.tier ORDER BY discovered_at, channel_id) rk
    FROM cand c JOIN plan p ON p.vertical = c.vertical AND p.tier = c.tier WHERE NOT added_to_tracking) WHERE rk <= needed"""
_add("drain_candidates", f"SELECT channel_id, channel_handle, vertical, tier, {big('subscriber_count', 'total_channel_views')}, "
     f"{rs('upload_velocity_per_week')} FROM ({_DRAIN})", plan=_PLAN)
_add("drain_large_plan", """SELECT channel_id, 'Tech' vertical, 'S' tier FROM cand WHERE NOT added_to_tracking
    ORDER BY discovered_at, channel_id LIMIT 400""")
_add("mark_consumed", f"""SELECT channel_id, added_to_tracking OR channel_id IN (SELECT channel_id FROM drained) added_to_tracking
    FROM cand""", plan=_PLAN, drained=_DRAIN)
_add("mark_flags", """SELECT video_id, upload_poll_done, day1_poll_done OR video_id IN
    (SELECT video_id FROM lab WHERE poll_label = '24h') day1_poll_done, day7_poll_done FROM trk""")
ORACLE["mark_flags_in_place"] = ORACLE["mark_flags"]
_NULLS = [
    "title", "description", "channel_id", "video_id", "channel_handle", "duration_seconds", "category_id", "category_name",
    "published_at", "vertical", "tier", "contains_synthetic_media", "face_count", "brightness", "colorfulness",
    *_WIDE_COUNTS, *_WIDE_HOURS, "baseline_channel_handle", "baseline_video_count", "baseline_median_views",
    "baseline_median_likes", "baseline_median_comments", "baseline_median_engagement_rate",
]
_add("null_profile", "SELECT feature, null_count, null_pct FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' feature, count(*) - count({c}) null_count, round((count(*) - count({c})) * 1.0 / count(*) * 100, 2) null_pct "
    "FROM (SELECT c.*, t.title, t.description FROM cleaned c JOIN ctext t USING (o_orderkey))" for c in _NULLS
) + ") WHERE null_count > 0")
_add("duplicates", """SELECT count(*) total_rows, count(DISTINCT video_id) unique_keys,
    count(*) - count(DISTINCT video_id) duplicates FROM lab""")
_add("describe", f"""SELECT feature, {big('count')}, {rs('mean', 'std', 'min', 'max', 'q25', 'q50', 'q75', places=4)} FROM (
    SELECT feature, count(value) "count", avg(value) mean, stddev_samp(value) std, min(value) "min", max(value) "max",
    quantile_cont(value, 0.25) q25, quantile_cont(value, 0.5) q50, quantile_cont(value, 0.75) q75 FROM ({_LONG}) GROUP BY 1)"""
     .replace('cast(count as bigint) AS count', 'cast("count" as bigint) AS "count"')
     .replace('round(cast(min as double), 4) AS min', 'round(cast("min" as double), 4) AS "min"')
     .replace('round(cast(max as double), 4) AS max', 'round(cast("max" as double), 4) AS "max"'))
_add("iqr_outliers", """SELECT feature, round(any_value(q1), 3) q1, round(any_value(q3), 3) q3, round(any_value(q3 - q1), 3) iqr,
    round(any_value(q1 - 1.5 * (q3 - q1)), 3) lower_fence, round(any_value(q3 + 1.5 * (q3 - q1)), 3) upper_fence,
    cast(count_if(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) as bigint) n_outliers,
    round(count_if(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) * 1.0 / count(*) * 100, 2) pct_outliers
    FROM long JOIN (SELECT feature, quantile_cont(value, 0.25) q1, quantile_cont(value, 0.75) q3 FROM long GROUP BY 1)
    USING (feature) GROUP BY 1""", long=_LONG)
_add("histogram", _hist("long", []), long=_LONG, ends=_ends("long", []))
_CAPPED = """SELECT above_baseline, feature, least(value, cap) value FROM raw JOIN (SELECT above_baseline, feature,
    quantile_cont(value, 0.99) cap FROM raw GROUP BY ALL) USING (above_baseline, feature)"""
_add("class_histogram", _hist("capped", ["above_baseline"]),
     raw=_features(["view_count_velocity_24h", "view_velocity_ratio", "view_velocity_acceleration"]),
     capped=_CAPPED, ends=_ends("capped", ["above_baseline"]))
_add("kde", "SELECT feature, cast(i as bigint) i, round(x, 4) x, round(density, 9) density FROM kd",
     long=_features(DENSITY_FEATURES), **_kde("long", []))
_add("kde_by_vertical", "SELECT vertical, feature, cast(i as bigint) i, round(x, 4) x, round(density, 9) density FROM kd",
     long=_features(["view_count_24h"]), **_kde("long", ["vertical"]))
_add("box_stats", _box(["vertical"], "view_count_24h"))
_add("box_stats_by_tier", _box(["tier", "vertical"], "engagement_7d"))
_add("winsorize", """SELECT video_id, round(case when view_velocity_ratio > c1 then c1 else view_velocity_ratio end, 6) view_velocity_ratio,
    round(case when like_rate_24h > c2 then c2 else like_rate_24h end, 6) like_rate_24h FROM eng JOIN (SELECT above_baseline,
    quantile_cont(view_velocity_ratio, 0.99) c1, quantile_cont(like_rate_24h, 0.99) c2 FROM eng GROUP BY 1) USING (above_baseline)""")
def _cap2(x: str, y: str) -> str:
    return f"""SELECT above_baseline, '{x} {y}' pair, least({x}, c1) x, least({y}, c2) y FROM eng JOIN
    (SELECT above_baseline, quantile_cont({x}, 0.99) c1, quantile_cont({y}, 0.99) c2 FROM eng GROUP BY 1)
    USING (above_baseline)"""


_add("density_2d", """SELECT cast(above_baseline as bigint) above_baseline, pair,
    cast(least(floor((x - xl) / ((xh - xl) / 40)) + 1, 40) as bigint) bin_x,
    cast(least(floor((y - yl) / ((yh - yl) / 40)) + 1, 40) as bigint) bin_y, count(*) n
    FROM cap2 JOIN (SELECT above_baseline, pair, min(x) xl, max(x) xh, min(y) yl, max(y) yh FROM cap2 GROUP BY ALL)
    USING (above_baseline, pair) GROUP BY ALL""", cap2=" UNION ALL ".join(_cap2(x, y) for x, y in DENSITY_PAIRS))
def _fine_sql(lo: str, hi: str, h: str, points: int, share: float) -> str:
    return f"greatest(ceil(({hi} - {lo}) / ({h} * {(points - 1) * math.sqrt(8 * share)!r})), 1)"


_add("kde_binned", """SELECT feature, cast(i as bigint) i, round(any_value(lo) + i * any_value(hi - lo) / 199, 4) x,
    round(sum(w * exp(-0.5 * pow((i - j / fine) * (hi - lo) / 199 / h, 2))) / any_value(n * h * sqrt(2 * pi())), 9) density,
    round(any_value(pow((hi - lo) / 199 / fine / h, 2) / (8 * sqrt(2 * pi())) / h), 9) error_bound
    FROM nodes, generate_series(0, 199) g(i) GROUP BY feature, i""",
     long=_features(DENSITY_FEATURES),
     st=f"""SELECT *, {_fine_sql('lo', 'hi', 'h', 200, 1e-3)} fine FROM (SELECT feature, count(*) n, min(value) lo, max(value) hi,
         stddev_samp(value) * pow(count(*), -0.2) h FROM long GROUP BY feature HAVING count(*) >= 2 AND stddev_samp(value) > 0)""",
     spot="""SELECT s.*, (value - lo) / (hi - lo) * (fine * 199) place, least(floor(place), fine * 199 - 1) node
         FROM long JOIN st s USING (feature)""",
     nodes="""SELECT feature, n, lo, hi, h, fine, node + side j, sum(case side when 0 then 1 - (place - node) else place - node end) w
         FROM spot, generate_series(0, 1) t(side) GROUP BY ALL""")
_clamp = "exp(greatest(least({0}, 700.0), -700.0))".format


def _normal_sql(z: str) -> str:
    a = f"(abs({z}) / sqrt(2))"
    t = f"(1 / (1 + 0.3275911 * {a}))"
    tail = (f"{t} * (0.254829592 + {t} * (-0.284496736 + {t} * (1.421413741 + {t} * (-1.453152027 + {t} * 1.061405429)))) * "
            + _clamp(f"-{a} * {a}") + " / 2")
    return f"(case when {z} >= 0 then 1 - {tail} else {tail} end)"


_FAMILY = {
    "exponential": "1 - " + _clamp("(a - value) / (m - a)"),
    "gumbel": _clamp("-" + _clamp("(m - 0.5772156649015329 * (s * sqrt(6) / pi()) - value) / (s * sqrt(6) / pi())")),
    "laplace": f"case when value >= m then 1 - {_clamp('-abs(value - m) * sqrt(2) / s')} / 2 else {_clamp('-abs(value - m) * sqrt(2) / s')} / 2 end",
    "logistic": f"1 / (1 + {_clamp('(m - value) * pi() / sqrt(3) / s')})",
    "lognormal": f"case when ls > 0 then {_normal_sql('((ln(1 + value - a) - lm) / ls)')} else 1 end",
    "normal": _normal_sql("((value - m) / s)"),
    "uniform": "greatest(least((value - m) / (2 * sqrt(3) * s) + 0.5, 1), 0)",
}
_SYNTHETIC = SYNTHETIC_COUNTS + SYNTHETIC_REALS
_add("fitted_marginals", """SELECT feature, family, cast(n as bigint) n, round(ks, 6) ks,
    row_number() OVER (PARTITION BY feature ORDER BY ks, family) = 1 chosen FROM told""",
     long=" UNION ALL ".join(f"SELECT '{c}' feature, value FROM (SELECT cast({c} as double) value FROM eng) WHERE value IS NOT NULL"
                             for c in _SYNTHETIC),
     mo="""SELECT feature, count(*) n, avg(value) m, coalesce(stddev_samp(value), 0) s, min(value) a, max(value) b FROM long GROUP BY 1""",
     lo="""SELECT feature, avg(ln(1 + value - a)) lm, coalesce(stddev_samp(ln(1 + value - a)), 0) ls FROM long JOIN mo USING (feature) GROUP BY 1""",
     vals="""SELECT feature, value, count(*) c, sum(count(*)) OVER (PARTITION BY feature ORDER BY value) upto FROM long GROUP BY feature, value""",
     cdfs="SELECT v.*, n, " + ", ".join(f"{e} AS {f}" for f, e in _FAMILY.items())
     + " FROM vals v JOIN mo USING (feature) JOIN lo USING (feature) WHERE a < b",
     told=" UNION ALL ".join(f"SELECT feature, '{f}' family, max(n) n, max(greatest(upto / cdfs.n - {f}, {f} - (upto - c) / cdfs.n)) ks "
                             "FROM cdfs GROUP BY feature" for f in _FAMILY)
     + " UNION ALL SELECT feature, 'constant', n, 0 FROM mo WHERE a = b")
_add("synthetic_rows_fitted", "SELECT (SELECT count(*) FROM eng) n, unnest([" + ", ".join(f"'{c}'" for c in _SYNTHETIC)
     + "]) feature, cast(0 as bigint) n_outside")
_KEY2 = "above_baseline, pair, n, lx, hx, bx, fx, ly, hy, by_, fy"
_add("kde_2d", """SELECT cast(above_baseline as bigint) above_baseline, pair, cast(n as bigint) n, cast(i_x as bigint) i_x, cast(i_y as bigint) i_y,
    round(lx + i_x * (hx - lx) / 49, 6) x, round(ly + i_y * (hy - ly) / 49, 6) y,
    round(sum(w * exp(-0.5 * pow((i_y - jy / fy) * (hy - ly) / 49 / by_, 2))) / (2 * pi() * n), 8) density,
    round((pow((hx - lx) / 49 / fx / bx, 2) / 8 + pow((hy - ly) / 49 / fy / by_, 2) / 8) / (2 * pi()), 8) error_bound
    FROM along, generate_series(0, 49) g(i_y) GROUP BY """ + _KEY2 + ", i_x, i_y",
     cap2=" UNION ALL ".join(_cap2(x, y) for x, y in DENSITY_PAIRS),
     st0="""SELECT above_baseline, pair, count(*) n, min(x) x0, max(x) x1, stddev_samp(x) * pow(count(*), -1 / 6.0) bx,
         min(y) y0, max(y) y1, stddev_samp(y) * pow(count(*), -1 / 6.0) by_ FROM cap2 WHERE x IS NOT NULL AND y IS NOT NULL
         GROUP BY ALL HAVING count(*) >= 2 AND stddev_samp(x) > 0 AND stddev_samp(y) > 0""",
     st=f"""SELECT *, {_fine_sql('lx', 'hx', 'bx', 50, 5e-3)} fx, {_fine_sql('ly', 'hy', 'by_', 50, 5e-3)} fy FROM (
         SELECT above_baseline, pair, n, x0 - 3 * bx lx, x1 + 3 * bx hx, bx, y0 - 3 * by_ ly, y1 + 3 * by_ hy, by_ FROM st0)""",
     spot="""SELECT s.*, (x - lx) / (hx - lx) * (fx * 49) px, least(floor(px), fx * 49 - 1) cx,
         (y - ly) / (hy - ly) * (fy * 49) py, least(floor(py), fy * 49 - 1) cy FROM cap2 JOIN st s USING (above_baseline, pair)
         WHERE x IS NOT NULL AND y IS NOT NULL""",
     nodes=f"""SELECT {_KEY2}, cx + a jx, cy + b jy, sum((case a when 0 then 1 - (px - cx) else px - cx end)
         * (case b when 0 then 1 - (py - cy) else py - cy end)) w FROM spot, generate_series(0, 1) s(a), generate_series(0, 1) t(b) GROUP BY ALL""",
     along=f"""SELECT {_KEY2}, jy, i_x, sum(w * exp(-0.5 * pow((i_x - jx / fx) * (hx - lx) / 49 / bx, 2))) w
         FROM nodes, generate_series(0, 49) g(i_x) GROUP BY ALL""")
_add("correlation", "SELECT feature_a, feature_b, cast(n as bigint) n, round(r, 6) r FROM prs WHERE feature_a IN (SELECT c FROM keep) "
     "AND feature_b IN (SELECT c FROM keep)", prs=_pairs(), keep=_varied())
_add("target_correlation", "SELECT case when feature_a = 'above_baseline' then feature_b else feature_a end feature, "
     "cast(n as bigint) n, round(r, 6) r FROM prs WHERE (feature_a = 'above_baseline' OR feature_b = 'above_baseline') "
     "AND feature_a IN (SELECT c FROM keep) AND feature_b IN (SELECT c FROM keep)", prs=_pairs(), keep=_varied())
_add("correlation_shift", "SELECT feature_a, feature_b, round(m.r, 6) r_mixed, round(q.r, 6) r_real, round(m.r - q.r, 6) shift "
     "FROM mix m JOIN rea q USING (feature_a, feature_b) WHERE feature_a IN (SELECT c FROM keep) AND feature_b IN (SELECT c FROM keep)",
     mix=_pairs(), rea=_pairs(f"WHERE NOT {_FAKE}"), keep=_varied(f"WHERE NOT {_FAKE}"))
_TNAMES = "['neutral', 'question', 'exclamation', 'listicle', 'how_to', 'emoji_heavy', 'all_caps', 'clickbait']"
_DNAMES = "['neutral', 'has_timestamps', 'has_links', 'link_heavy', 'has_hashtags', 'minimal', 'long_form']"
_add("category_distribution", f"""SELECT 'title_category' feature, {_TNAMES}[title_category + 1] name, count(*) n FROM tclass GROUP BY ALL
    UNION ALL SELECT 'desc_category', {_DNAMES}[desc_category + 1], count(*) FROM tclass GROUP BY ALL""")
_add("target_balance", """SELECT cast(above_baseline as bigint) above_baseline, count(*) n,
    round(count(*) * 1.0 / (SELECT count(*) FROM tgt), 6) share FROM tgt GROUP BY 1""")
_add("stratum_counts", "SELECT stratum, count(*) n FROM strat GROUP BY 1")
_add("holdout", "SELECT video_id, stratum FROM h_drw WHERE inside", **_HOLD)
_add("split", "SELECT video_id, split FROM spl", **_SPLIT)
_add("split_composition", """SELECT v vertical, t tier, count_if(split = 'train') train_total,
    cast(coalesce(sum(above_baseline) FILTER (split = 'train'), 0) as bigint) train_above_median, count_if(split = 'test') test_total,
    cast(coalesce(sum(above_baseline) FILTER (split = 'test'), 0) as bigint) test_above_median,
    count_if(split IN ('train', 'test')) total_videos FROM unnest(['Education', 'Lifestyle', 'Tech']) a(v), unnest(['S', 'M', 'L']) b(t)
    LEFT JOIN spl ON vertical = v AND tier = t GROUP BY ALL""", **_SPLIT)
_add("training_composition", """SELECT count_if(split = 'train') real_train_rows, 0 synthetic_train_rows, count_if(split = 'train') total_train_rows,
    count_if(split = 'test') test_rows, count_if(split = 'train' AND above_baseline = 0) train_0, count_if(split = 'train' AND above_baseline = 1) train_1,
    count_if(split = 'test' AND above_baseline = 0) test_0, count_if(split = 'test' AND above_baseline = 1) test_1, cast(0 as double) synthetic_pct FROM spl""", **_SPLIT)
_SCALED = ["view_count_upload", "like_rate_24h", "duration_seconds", "view_velocity_ratio"]
_add("scale", "SELECT video_id, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM tr)) / (SELECT stddev_pop({c}) FROM tr), 6) AS {c}" for c in _SCALED
) + " FROM eng", **_SPLIT, tr="SELECT eng.* FROM eng JOIN spl USING (video_id) WHERE split = 'train'")
_add("auc", """SELECT round((sum(rk) FILTER (label = 1) - count_if(label = 1) * (count_if(label = 1) + 1) / 2)
    / (count_if(label = 1) * count_if(label = 0)), 6) roc_auc FROM (SELECT label,
    rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 rk FROM scored)""", scored=SCORED)
_add("classification_report", """SELECT round((tp + tn) / (tp + tn + fp + fn), 6) accuracy,
    round(coalesce(tp / nullif(tp + fp, 0), 0), 6) precision_above, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) recall_above,
    round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) f1_above, round(coalesce(tn / nullif(tn + fn, 0), 0), 6) precision_below,
    round(coalesce(tn / nullif(tn + fp, 0), 0), 6) recall_below, round(coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0), 6) f1_below,
    cast(tp + fn as bigint) support_above, cast(tn + fp as bigint) support_below, cast(tn as bigint) tn, cast(fp as bigint) fp,
    cast(fn as bigint) fn, cast(tp as bigint) tp FROM (SELECT cast(count_if(label = 1 AND score >= 0.5) as double) tp,
    cast(count_if(label = 0 AND score < 0.5) as double) tn, cast(count_if(label = 0 AND score >= 0.5) as double) fp,
    cast(count_if(label = 1 AND score < 0.5) as double) fn FROM scored)""", scored=SCORED)

_add("best_per_metric", """SELECT metric, arg_min(vertical, (-value, vertical)) best_model, round(max(value), 6) best_value,
    arg_min(vertical, (value, vertical)) worst_model, round(min(value), 6) worst_value FROM (
    SELECT vertical, 'label_rate' metric, round(avg(above_baseline), 9) value FROM eng GROUP BY 1
    UNION ALL SELECT vertical, 'like_rate', round(avg(like_rate_24h), 9) FROM eng GROUP BY 1) GROUP BY 1""")
_BENT = """SELECT * REPLACE (view_count_24h - 200000.5 AS view_count_24h, like_count_24h * 0.37 AS like_count_24h,
    comment_count_7d - 90.25 AS comment_count_7d, hours_since_publish_24h - 25 AS hours_since_publish_24h) FROM eng"""


def _whole(c: str) -> str:
    return f"cast(round_even(cast(greatest({c}, 0) as double), 0) as bigint)"


def _rising(m: str, wrap) -> str:
    u, d, w = (wrap(f"{m}_{p}") for p in ("upload", "24h", "7d"))
    return f"{u} AS {m}_upload, greatest({u}, {d}) AS {m}_24h, greatest({u}, {d}, {w}) AS {m}_7d"


_add("synthetic_cleanup", "SELECT video_id, " + ", ".join(
    [_rising(m, _whole) for m in ("view_count", "like_count", "comment_count")]
    + [f"{_whole('subscriber_count_' + p)} AS subscriber_count_{p}" for p in ("upload", "24h", "7d")]
    + [_rising("hours_since_publish", lambda c: f"round(greatest(cast({c} as double), 0), 6)")]
) + " FROM bent", bent=_BENT)
_add("synthetic_features", f"""SELECT video_id, round(e7, 6) engagement_7d,
    cast(coalesce(e7 > eb, false) as bigint) above_baseline, {rs(*_PER_SUB)}, 0 title_length, 0 publish_hour,
    cast(duration_seconds <= 60 as bigint) is_short, round(duration_seconds / 60, 6) duration_minutes FROM (SELECT *,
      case when view_count_7d > 0 then cast(like_count_7d + comment_count_7d as double) / view_count_7d else 0.0 end e7,
      case when baseline_median_views > 0 then (baseline_median_likes + baseline_median_comments) / baseline_median_views else 0.0 end eb,
      {', '.join(f'cast({m}_count_{p} as double) / greatest(subscriber_count_upload, 1) {m}s_per_sub_{p}'
                 for p in ("upload", "24h", "7d") for m in ("view", "like", "comment"))} FROM cleaned)""")
_add("real_plus_synthetic", """SELECT video_id, cast(above_baseline as bigint) above_baseline, cast(NULL as bigint) view_count_7d,
    false contains_synthetic_data FROM eng
    UNION ALL SELECT concat('syn-', video_id), NULL, cast(view_count_7d as bigint), true FROM eng""")
_add("channel_lookup", """SELECT DISTINCT channel_id, channel_handle, vertical, tier, baseline_video_count FROM cleaned""")
_add("channel_draw", """SELECT id, channel_id FROM (SELECT o_orderkey id,
      cast(concat('0x', substr(md5(concat(cast(o_orderkey as varchar), ':42')), 1, 13)) as bigint) % (SELECT sum(n) FROM wgt) pos FROM orders)
    JOIN spn ON pos >= lo AND pos < lo + n""",
     wgt="SELECT channel_id, count(*) n FROM kept GROUP BY 1",
     spn="SELECT *, sum(n) OVER (ORDER BY substr(md5(channel_id), 1, 3), channel_id) - n lo FROM wgt")
_add("snapshot_roundtrip", """SELECT 'videos' part, count(*) n FROM lab UNION ALL SELECT 'baselines', count(*) FROM bvid
    UNION ALL SELECT 'medians', count(*) FROM med UNION ALL SELECT 'listed_videos', count(*) FROM lab
    UNION ALL SELECT 'listed_baselines', count(*) FROM bvid""")
_TEXT_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S') {0}".format
_POLLED = f"""video_id, poll_label, channel_id, channel_handle, vertical, tier,
    {big('view_count', 'like_count', 'comment_count', 'subscriber_count', 'duration_seconds')}, category_name, contains_synthetic_media,
    {_TEXT_TIME('poll_timestamp')}, {r('hours_since_publish')}"""
_add("snapshot_videos_loaded", f"SELECT {_POLLED}, {_TEXT_TIME('published_at')} FROM lab")
_add("tables_appended", f"SELECT {_POLLED} FROM lab")
_add("snapshot_baselines_loaded", f"""SELECT video_id, channel_id, channel_handle, vertical, tier,
    {big('view_count', 'like_count', 'comment_count', 'subscriber_count')}, {_TEXT_TIME('published_at')} FROM bvid""")
_add("snapshot_medians_loaded", f"SELECT channel_id, channel_handle, video_count, {rs(*_MEDIANS)}, (SELECT count(*) FROM med) listed FROM med")
_add("tables_medians", f"SELECT channel_id, channel_handle, video_count, {rs(*_MEDIANS)}, stored FROM med, (VALUES (true), (false)) t(stored)")
_add("final_snapshot", f"""SELECT video_id, cast(above_baseline as bigint) above_baseline, {_FAKE} contains_synthetic_data, count(*) OVER () total_rows,
    count(*) FILTER (NOT {_FAKE}) OVER () real_rows, count(*) FILTER ({_FAKE}) OVER () synthetic_rows,
    round(100.0 * count(*) FILTER ({_FAKE}) OVER () / count(*) OVER (), 1) synthetic_pct FROM eng""")
_BYTE = "cast(concat('0x', substr(h, (i + {0}) % 16 * 2 + 1, 2)) as bigint)".format
_add("thumbnail_scan", """SELECT name, round(avg(round_even(0.299::double * r + 0.587::double * g + 0.114::double * b, 0)), 6) brightness,
    round(sqrt(var_pop(abs(r - g)) + var_pop(abs(0.5::double * (r + g) - b)))
      + 0.3 * sqrt(pow(avg(abs(r - g)), 2) + pow(avg(abs(0.5::double * (r + g) - b)), 2)), 6) colorfulness,
    (SELECT count(*) FROM documents WHERE text IS NOT NULL) written FROM px GROUP BY name""",
     px=f"""SELECT concat('d', cast(doc_id as varchar)) name, {_BYTE(0)} r, {_BYTE(5)} g, {_BYTE(11)} b
         FROM (SELECT doc_id, md5(text) h FROM documents WHERE text IS NOT NULL), generate_series(0, 15) t(i)""")
_add("json_appended", f"""SELECT video_id, channel_id, {_TEXT_TIME('published_at')}, {_TEXT_TIME('first_seen_at')}, upload_poll_done,
    day1_poll_done, day7_poll_done FROM trk""")
_add("csv_sample", "SELECT least(count(*), 100) n, true all_known FROM lab")
_add("split_loaded", "SELECT video_id, vertical, tier, cast(above_baseline as bigint) above_baseline, split FROM spl", **_SPLIT)
_add("augmented_real_rows", """SELECT video_id, split, cast(above_baseline as bigint) above_baseline, cast(view_count_7d as bigint) view_count_7d
    FROM spl JOIN (SELECT video_id, view_count_7d FROM eng) USING (video_id)""", **_SPLIT)
_add("split_roundtrip", "SELECT split, cast(above_baseline as bigint) above_baseline, count(*) n FROM spl GROUP BY ALL", **_SPLIT)
_add("raw_items_parsed", f"""SELECT video_id, channel_handle, vertical, concat('t', video_id) title, '' description, 0 tag_count,
    cast(duration_seconds as bigint) duration_seconds, category_name,
    round(date_diff('microsecond', published_at, timestamp '{HEALTH_NOW}') / 3.6e9, 2) hours_since_publish,
    o_orderkey * 10 view_count, 0 like_count, cast(coalesce(comments, 0) as bigint) comment_count, subscriber_count,
    coalesce(contains_synthetic_media, false) contains_synthetic_media FROM vids JOIN ch USING (channel_id)
    LEFT JOIN (SELECT l_orderkey o_orderkey, sum(l_suppkey % 50) comments FROM lineitem GROUP BY 1) USING (o_orderkey)""")
_REPORT = ORACLE["classification_report"]
_add("validation_history", f"""SELECT 'v1.0' model_version, concat('2026-01-0', d, 'T00:00:00Z') run_timestamp, 'rule' model_name, 'd1' data_version,
    {', '.join(f'round({m}, 4) {m}' for m in ('accuracy', 'precision_above', 'recall_above', 'f1_above', 'precision_below', 'recall_below', 'f1_below'))},
    round(roc_auc, 4) roc_auc, support_above + support_below val_rows FROM ({_REPORT}), ({ORACLE['auc']}), (SELECT unnest([1, 2]) d)""")
_add("roc_curve", """SELECT round(score, 6) threshold, round(count_if(label = 0 AND s >= score) * 1.0 / count_if(label = 0), 6) fpr,
    round(count_if(label = 1 AND s >= score) * 1.0 / count_if(label = 1), 6) tpr
    FROM (SELECT DISTINCT score FROM scored), (SELECT label, score s FROM scored) GROUP BY score""", scored=SCORED)
_MEASURES = ("accuracy", "precision_above", "recall_above", "f1_above", "precision_below", "recall_below", "f1_below")
_MODELS = f"""SELECT v || '_rule' version, v generation, {', '.join(f'round({m}, 4) {m}' for m in _MEASURES)}, round(roc_auc, 4) roc_auc,
    {{}} FROM ({_REPORT}), ({ORACLE['auc']}), (SELECT unnest(['v1.0', 'v1.1']) v)"""
_SIZES = "(SELECT count(*) FROM ({}) WHERE score {} 0.4)"
_RECORDS = _MODELS.format(f"{_SIZES.format(SCORED, '<')} real_rows, {_SIZES.format(SCORED, '>=')} test_rows")
_add("model_comparison", f"""SELECT version, 'rule' model_type, 'd1' data_snapshot, '2026-01-01' training_date, real_rows,
    cast(0 as bigint) synth_rows, {', '.join(_MEASURES)}, roc_auc FROM ({_RECORDS})""")
_add("model_listing", f"""SELECT version, 'rule' model_type, roc_auc, real_rows, cast(0 as bigint) synth_rows, 'd1' data_snapshot,
    '2026-01-01' training_date, 'by rule' notes FROM ({_RECORDS})""")
_add("model_generations", f"""SELECT version model_name, version, generation, 'd1' data_snapshot, 'rule' model_type,
    real_rows train_rows, test_rows, accuracy, roc_auc, cast(22 as bigint) features_count FROM ({_RECORDS})""")
_add("sample_channels", "SELECT channel_id FROM ch ORDER BY md5(concat(channel_id, ':42')), channel_id LIMIT 500")
_LABELLED = """SELECT * FROM (SELECT *, case when age BETWEEN 0 AND 6 then 'upload' when age BETWEEN 20 AND 30 then '24h'
    when age BETWEEN 156 AND 180 then '7d' end poll_label FROM (SELECT *,
    date_diff('microsecond', published_at, poll_timestamp) / 3.6e9 age FROM obs)) WHERE poll_label IS NOT NULL"""
_add("stream_labels", f"SELECT event_id, video_id, poll_label FROM ({_LABELLED})")
_add("stream_first", f"SELECT DISTINCT video_id, poll_label FROM ({_LABELLED})")
_add("stream_snapshots", f"""SELECT video_id, poll_label, strftime(min(poll_timestamp), '%Y-%m-%d %H:%M:%S') polled,
    round_even(arg_min(age, poll_timestamp), 2) hours_since_publish FROM ({_LABELLED}) GROUP BY ALL""")
_add("stream_tracking", f"""SELECT video_id, concat('UC', lpad(cast(cast(substr(video_id, 2) as bigint) % 40 as varchar), 8, '0')) channel_id,
    bool_or(poll_label = 'upload') upload_poll_done,
    bool_or(poll_label = '24h') day1_poll_done, bool_or(poll_label = '7d') day7_poll_done FROM ({_LABELLED}) GROUP BY 1""")
_add("stream_sorted_out", """SELECT video_id, poll_label, kind, count(*) n,
    strftime(min(poll_timestamp) FILTER (kind <> 'repeat'), '%Y-%m-%d %H:%M:%S') polled FROM (
      SELECT *, case when late then 'late' when row_number() OVER (PARTITION BY video_id, poll_label, late ORDER BY part, poll_timestamp) = 1
        then 'first' else 'repeat' end kind FROM (
        SELECT p.*, coalesce(epoch_ms(poll_timestamp) < (SELECT max(epoch_ms(q.poll_timestamp)) FROM parts q WHERE q.part < p.part)
          - 25 * 3600000, false) late FROM parts p)) GROUP BY ALL""",
     parts=f"""SELECT *, least(3, (dayofmonth(poll_timestamp) - 1 + event_id % 3 * 4) // 5) part FROM ({_LABELLED})""")
_add("stream_new_videos", """SELECT video_id, concat('UC', lpad(cast(cast(substr(video_id, 2) as bigint) % 40 as varchar), 8, '0')) channel_id,
    strftime(min(published_at), '%Y-%m-%d %H:%M:%S') published_at, strftime(min(poll_timestamp), '%Y-%m-%d %H:%M:%S') first_seen_at,
    false upload_poll_done FROM obs WHERE video_id NOT IN (SELECT video_id FROM vid WHERE is_tracked AND o_orderkey % 97 <> 0) GROUP BY 1""")
_add("augmented_train", """SELECT split, false contains_synthetic_data, count(*) n FROM spl GROUP BY 1
    UNION ALL SELECT 'train', true, cast(floor(n / cast(0.8 as double)) - n as bigint) FROM
    (SELECT count(*) n FROM spl WHERE split = 'train')""", **_SPLIT)

_add("stratified_folds", """SELECT video_id, cast(above_baseline as bigint) above_baseline,
    cast((n // 5 < k)::int + (n * 2 // 5 < k)::int + (n * 3 // 5 < k)::int + (n * 4 // 5 < k)::int as bigint) fold FROM (SELECT video_id, above_baseline,
      count(*) OVER (PARTITION BY above_baseline) n,
      row_number() OVER (PARTITION BY above_baseline ORDER BY md5(concat(video_id, ':42')), video_id) k FROM eng)""")

_INPUTS = [f"{m}_velocity_24h" for m in METRIC_COLS] + [
    "view_velocity_upload", "like_velocity_upload", "view_velocity_per_sub_24h", "like_velocity_per_sub_24h",
    "view_velocity_ratio", "view_velocity_acceleration", "like_velocity_acceleration", "view_count_upload_vs_baseline",
    "like_count_upload_vs_baseline", "like_rate_upload", "like_rate_24h",
    *[f"{m}s_per_sub_{p}" for p in ("upload", "24h") for m in ("view", "like", "comment")], "duration_seconds"]
_FIRST = dict(
    lng=" UNION ALL ".join(f"""SELECT above_baseline, '{c}' feature,
         case when isfinite(cast({c} as double)) then cast({c} as double) end AS value FROM eng""" for c in _INPUTS),
    edge="""SELECT DISTINCT feature, e FROM (SELECT feature, unnest(quantile_cont(value, [k / 64.0 for k in range(1, 64)])) e
         FROM lng GROUP BY 1) UNION ALL SELECT DISTINCT feature, NULL FROM lng""",
)
# At the first split every gradient is 0.5 less the label and every Hessian 0.25.
_add("boosting_first_splits", """SELECT feature, round(gain, 6) gain, round(e, 6) threshold, missing_left FROM (
    SELECT *, row_number() OVER (PARTITION BY feature ORDER BY gain DESC, e NULLS LAST, missing_left DESC) k FROM (
      SELECT feature, e, missing_left, round(0.5 * (gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)), 9) gain,
        hl, h - hl hr FROM (
        SELECT feature, e, missing_left, sum(d) g, sum(0.25) h,
          coalesce(sum(d) FILTER (goes), 0) gl, coalesce(sum(0.25) FILTER (goes), 0) hl FROM (
          SELECT l.feature, e, missing_left, 0.5 - above_baseline d,
            case when l.value IS NULL then missing_left else e IS NULL OR l.value <= e end goes
          FROM lng l JOIN edge USING (feature), (VALUES (true), (false)) m(missing_left)) GROUP BY ALL))
      WHERE hl >= 5 AND hr >= 5 AND gain > 0) WHERE k = 1""",
     **_FIRST)
# Missing values lie below every value; without an edge they alone go left.
_add("forest_first_splits", """SELECT feature, round(gain, 6) gain, round(e, 6) threshold FROM (
    SELECT *, row_number() OVER (PARTITION BY feature ORDER BY round(gain, 12) DESC, e NULLS FIRST) k FROM (
      SELECT feature, e, l, n - l r, ((yl * yl + (l - yl) * (l - yl)) / l + ((y - yl) * (y - yl) + (n - l - y + yl) * (n - l - y + yl)) / (n - l)) / n
          - (y * y + (n - y) * (n - y)) / (n * n) gain FROM (
        SELECT feature, e, cast(count(*) as double) n, cast(sum(above_baseline) as double) y,
          cast(count(*) FILTER (goes) as double) l, coalesce(cast(sum(above_baseline) FILTER (goes) as double), 0) yl FROM (
          SELECT l.feature, e, above_baseline, value IS NULL OR coalesce(l.value <= e, false) goes
          FROM lng l JOIN edge USING (feature)) GROUP BY ALL) WHERE l >= 5 AND n - l >= 5)) WHERE k = 1""", **_FIRST)
