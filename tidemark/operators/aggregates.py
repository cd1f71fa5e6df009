"""Keyed aggregates: final values per key, running values per row, de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.slices import as_column, position, running

# Aggregates that can be taken in parts and merged: the partial and the merging function.
PARTS = {
    "sum": (F.sum, F.sum),
    "count": (F.count, F.sum),
    "min": (F.min, F.min),
    "max": (F.max, F.max),
}


def max_field(df: DataFrame, keys: Sequence[str], field: str, order: Sequence[str]) -> DataFrame:
    """The largest `field` per key beside the other columns of the key's first row."""
    at = F.struct(*order)
    rest = [c for c in df.columns if c not in keys and c != field]
    return df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), at).alias("_first"), F.max(field).alias(field)
    ).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest], field)


def max_row(df: DataFrame, keys: Sequence[str], field: str, order: Sequence[str]) -> DataFrame:
    """The whole row holding the largest `field` per key; on ties the latest."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(field, *order)).alias("_row")
    ).select(*keys, "_row.*")


def reduce_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], folds: dict[str, tuple[str, str]]
) -> DataFrame:
    """Fold the rows of a key field by field: first, last, min, max or sum of a column."""
    at = F.struct(*order)
    kinds = {
        "first": lambda c: F.min_by(c, at),
        "last": lambda c: F.max_by(c, at),
        "min": F.min,
        "max": F.max,
        "sum": F.sum,
    }
    return df.groupBy(*keys).agg(*[kinds[kind](c).alias(n) for n, (kind, c) in folds.items()])


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The earliest row per key. Works as a partial aggregate, so repeats go before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    ).select(*keys, "_row.*")


def running_distinct(df: DataFrame, key: str, order: Sequence[str], **options) -> DataFrame:
    """Every first appearance of a key with the number of keys seen so far."""
    firsts = first_rows(df.select(key, *order), [key], order)
    return running(firsts, [], order, {"seen": ("count", "1")}, **options)


def average_every(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, n: int, **options
) -> DataFrame:
    """On every n-th row of a key, the whole-number average of all its values so far."""
    totals = {"_sum": ("sum", value.cast("decimal(20,0)")), "_rows": ("count", "1")}
    return (
        running(df, keys, order, totals, **options)
        .filter(F.col("_rows") % n == 0)
        .withColumn("average", F.expr("_sum div _rows"))
        .withColumnRenamed("_rows", "n_rows")
        .drop("_sum")
    )


def salted_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    aggs: dict[str, tuple[str, Column | str]],
    spread_by: Sequence[str],
    salts: int = 8,
) -> DataFrame:
    """Aggregate per (key, salt), then per key. The salt comes from the row, so reruns agree."""
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts))
    partial = df.groupBy(*keys, salt.alias("_salt")).agg(
        *[PARTS[kind][0](as_column(c)).alias(n) for n, (kind, c) in aggs.items()])
    return partial.groupBy(*keys).agg(*[PARTS[kind][1](n).alias(n) for n, (kind, _) in aggs.items()])


def distinct_bitmaps(df: DataFrame, keys: Sequence[Column | str], of: str) -> DataFrame:
    """Exact, mergeable sets of whole numbers: the keys, `bucket` and `bits`, a bitmap of 32768 numbers.

    Bitmaps are partial aggregates, so a task sends at most one for each bucket of a key. They pay for dense
    numbers; text is numbered first.
    """
    return df.groupBy(*keys, F.bitmap_bucket_number(of).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(of)).alias("bits"))


def merged_bitmaps(bitmaps: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """The union of sets, by coarser keys."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(bitmaps: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """`n_distinct`: how many numbers the sets of each key hold."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("n_distinct"))


def time_of(df: DataFrame, column: str) -> Column:
    """Epoch microseconds of a time column."""
    return position(df, column)
