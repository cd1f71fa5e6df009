"""Ranking within a key or a window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import hop


def top_n(
    df: DataFrame, within: Sequence[str], by: Sequence[Column], n: int, rank: str = "rk"
) -> DataFrame:
    """The first n rows of each group. The limit also applies before the shuffle, so a large
    group reaches its task as at most n rows per map task."""
    window = Window.partitionBy(*within).orderBy(*by)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def hot_items(
    df: DataFrame, item: str, ts: str, size: str, slide: str, n: int
) -> DataFrame:
    """The n most frequent items of every sliding window, ties broken by item."""
    counts = hop(df, [item], ts, size, slide, {"n": ("count", "1")})
    return top_n(counts, ["window_end"], [F.col("n").desc(), F.col(item)], n)
