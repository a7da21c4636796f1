"""Ages, poll labels, durations, categories and tiers."""

from __future__ import annotations

from datetime import datetime, timedelta
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsemark.constants import CATEGORY_NAMES, POLL_WINDOWS, TIER_RANGES


def ntz(moment: datetime | str) -> Column:
    """A timestamp literal without zone."""
    return F.lit(str(moment)).cast("timestamp_ntz")


def _moment(now: datetime | str) -> datetime:
    return now if isinstance(now, datetime) else datetime.fromisoformat(now)


def _seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds to the microsecond. Subtracting zoneless times needs no session time zone."""
    return (end - start).cast("interval second").cast("decimal(20,6)")


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours as a double, unrounded."""
    return _seconds_between(start, end).cast("double") / F.lit(3600.0)


def hours_since_publish(published_at: Column, now: Column) -> Column:
    """Elapsed hours with two decimals, half to even."""
    return F.bround(hours_between(published_at, now), 2)


def whole_hours_old(published_at: Column, now: Column) -> Column:
    """Elapsed whole hours, cut towards zero."""
    return (_seconds_between(published_at, now).cast("long") / 3600).cast("long")


def poll_label(age_hours: Column) -> Column:
    """Label of the window an age falls in, NULL outside every window."""
    label = F.lit(None).cast("string")
    for name, (low, high) in reversed(POLL_WINDOWS.items()):
        label = F.when(age_hours.between(low, high), F.lit(name)).otherwise(label)
    return label


def aged_between(published_at: Column, now: datetime | str, low: int, high: int) -> Column:
    """Whole hours old in ``[low, high]``, written as bounds on the stored column so that the scan
    can skip row groups: whole hours in [low, high] is the same as age in [low, high + 1)."""
    at = _moment(now)
    return (published_at > ntz(at - timedelta(hours=high + 1))) & (
        published_at <= ntz(at - timedelta(hours=low))
    )


def older_than(published_at: Column, now: datetime | str, hours: int) -> Column:
    """Whole hours old strictly above ``hours``."""
    return published_at <= ntz(_moment(now) - timedelta(hours=hours + 1))


def duration_seconds(text: Column) -> Column:
    """Seconds of an ISO duration of hours, minutes and seconds; missing parts and other forms are 0."""
    pattern = r"^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?"

    def part(group: int) -> Column:
        digits = F.regexp_extract(text, pattern, group)
        # Casting an empty text fails inside try_cast, which is slow row after row.
        return F.coalesce(F.when(digits != "", digits).try_cast("int"), F.lit(0))

    return part(1) * 3600 + part(2) * 60 + part(3)


def category_name(category_id: Column) -> Column:
    names = F.create_map(*[F.lit(x) for x in chain.from_iterable(CATEGORY_NAMES.items())])
    return F.coalesce(F.try_element_at(names, category_id), F.lit("Unknown"))


def tier_of(subscribers: Column) -> Column:
    """Tier whose range ``low <= subscribers < high`` holds, NULL outside all of them."""
    tier = F.lit(None).cast("string")
    for name, (low, high) in reversed(TIER_RANGES.items()):
        tier = F.when((subscribers >= low) & (subscribers < high), F.lit(name)).otherwise(tier)
    return tier


def by_key(mapping: dict, key: Column) -> Column:
    """Look a key up in a small fixed mapping; unknown keys give NULL."""
    items = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(items, key)
