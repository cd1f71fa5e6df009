"""Rows that arrive after their windows closed: allowed lateness and the late output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.slices import as_column, running
from tidemark.operators.windows import seconds


def _closed_at(window: str, delay: str, lateness: str) -> Column:
    """A window takes no more rows once the newest event time seen has reached this."""
    wait = seconds(delay) + seconds(lateness)
    return F.col(f"{window}.end") + F.expr(f"interval {wait} seconds")


def windows_with_state(
    rows: DataFrame, ts: str, size: str, slide: str, delay: str, lateness: str, newest: str
) -> DataFrame:
    """One row per window of each row, with `_open` saying whether the window still takes it."""
    placed = rows.withColumn("_w", F.window(ts, size, slide))
    still = F.col(newest).isNull() | (_closed_at("_w", delay, lateness) > F.col(newest))
    return placed.withColumn("_open", still)


def with_newest(
    df: DataFrame, arrival: Sequence[str], ts: str, **options
) -> DataFrame:
    """Add `_newest`, the latest event time among all rows that arrived up to this one.

    A row never closes its own window, so counting the row itself changes no verdict.
    """
    return running(df, [], arrival, {"_newest": ("max", F.col(ts))}, **options)


def late_rows(
    df: DataFrame, arrival: Sequence[str], ts: str, size: str, slide: str,
    delay: str, lateness: str, **options,
) -> DataFrame:
    """The late output: rows all of whose windows were closed when they arrived."""
    marked = with_newest(df, arrival, ts, **options)
    # The newest window of a row is the one starting at its slide boundary.
    last = F.window(ts, slide)
    end = last.start + F.expr(f"interval {seconds(size)} seconds")
    wait = F.expr(f"interval {seconds(delay) + seconds(lateness)} seconds")
    return (
        marked.withColumn("_end", end)
        .filter(F.col("_end") + wait <= F.col("_newest"))
        .drop("_end", "_newest")
    )


def on_time_windows(
    df: DataFrame, keys: Sequence[str], arrival: Sequence[str], ts: str, size: str, slide: str,
    delay: str, lateness: str, aggs: Sequence[Column | str], **options,
) -> DataFrame:
    """Final window results from the rows each window still accepted."""
    marked = with_newest(df, arrival, ts, **options)
    placed = windows_with_state(marked, ts, size, slide, delay, lateness, "_newest")
    totals = placed.filter("_open").groupBy(*keys, "_w").agg(*map(as_column, aggs))
    rest = [c for c in totals.columns if c not in (*keys, "_w")]
    return totals.select(
        *keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *rest)
