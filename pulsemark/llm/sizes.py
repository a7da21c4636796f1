"""Frames of a counted size: which join sides may be sent to all tasks, and in how many files to store them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.session import cut

#: Rows of a few numbers that may be sent to every task.
FEW = 500_000


def few(df: DataFrame, rows: int = FEW) -> DataFrame:
    """The stored frame with a broadcast hint if it has at most so many rows; else joins shuffle it."""
    return F.broadcast(df) if df.count() <= rows else df


def store(df: DataFrame, rows: int, each: int = 200_000) -> DataFrame:
    """Write a frame of at most about ``rows`` narrow rows and go on from the files, ``each`` rows a file."""
    return cut(df.coalesce(max(1, -(-rows // each))))
