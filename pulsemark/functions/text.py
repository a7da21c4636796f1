"""Text features of titles and descriptions, over whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsemark.constants import EMOJI_CLASS, LISTICLE_WORDS, WHITESPACE, WHITESPACE_CLASS


def strip(text: Column) -> Column:
    """Drop leading and trailing Unicode whitespace; plain ``trim`` knows only the space character."""
    return F.btrim(text, F.lit(WHITESPACE))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def title_class(title: Column) -> Column:
    """Class 0-7 of a title; the first matching rule wins and NULL is neutral."""
    letters = _count(title, r"\p{L}")
    upper_share = _count(title, r"\p{Lu}") / F.greatest(letters, F.lit(1))
    emoji = _count(title, EMOJI_CLASS)
    lower = F.lower(title)
    excited = title.contains("!")
    listicle = F.lit(False)
    for word in LISTICLE_WORDS:
        listicle = listicle | lower.contains(word)
    return (
        F.when(title.isNull(), 0)
        .when(excited & (emoji >= 1) & (upper_share > 0.3), 7)
        .when((upper_share > 0.5) & (letters > 5), 6)
        .when(emoji >= 3, 5)
        .when(lower.startswith("how to"), 4)
        .when(listicle, 3)
        .when(title.contains("?"), 1)
        .when(excited, 2)
        .otherwise(0)
    )


def link_count(text: Column) -> Column:
    return _count(text, "https?://")


def hashtag_count(text: Column) -> Column:
    """``#`` followed by letters, numbers or underscore in any script."""
    return _count(text, r"#[\p{L}\p{N}_]+")


def description_class(description: Column) -> Column:
    """Class 0-6 of a description; the first matching rule wins and NULL is neutral."""
    links = link_count(description)
    return (
        F.when(description.isNull(), 0)
        .when(links >= 5, 3)
        .when(description.rlike(r"\p{Nd}{1,2}:\p{Nd}{2}"), 1)
        .when(links > 0, 2)
        .when(description.contains("#"), 4)
        .when(F.length(description) < 50, 5)
        .when(F.length(description) > 2000, 6)
        .otherwise(0)
    )


def word_count(text: Column) -> Column:
    """Whitespace-separated words; empty text has none and NULL stays NULL."""
    return _count(text, WHITESPACE_CLASS.replace("[", "[^", 1) + "+")
