"""Ordered per-key work that survives a hot key.

A window over `partitionBy(key)` puts all rows of a key in one task. Here a key with more rows
than one task should sort is cut into slices of about equal size along its time axis. Each slice
is an ordinary window group, and what earlier slices contribute is carried in:

* `running` adds the folded total of the earlier slices (one row per slice),
* `with_neighbours` repeats the few rows that lie next to the slice.

Keys of up to `ROWS_PER_SLICE` rows stay whole (`_slice` 0) and need no carry. Work without keys is one
key that is always cut, into as many slices as a shuffle has partitions or more. The rows of a key are
counted by one small job before the plan is made; that count alone decides, whatever the size of the
input in bytes, and the cuts are rows' own order values, of whatever types.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# What one task is given to sort.
ROWS_PER_SLICE = 4_000_000


@dataclass(frozen=True)
class Sliced:
    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    is_cut: bool
    backwards: bool = False

    @property
    def group(self) -> list[str]:
        return [*self.keys, "_slice"] if self.is_cut else list(self.keys)

    def ordered(self, columns: Sequence[str]) -> list[Column]:
        """Columns in reading direction; nulls come first forwards and last backwards."""
        return [F.col(c).desc() if self.backwards else F.col(c).asc() for c in columns]

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.group).orderBy(*self.ordered(self.order))

    def cut_rows(self) -> DataFrame:
        return self.rows.filter(F.col("_slice") > 0)


def as_column(value: Column | str) -> Column:
    """A column, or a SQL expression as text."""
    return F.expr(value) if isinstance(value, str) else value


def position(df: DataFrame, column: str) -> Column:
    """A time column in microseconds, or a whole number as it is."""
    kind = dict(df.dtypes)[column]
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column).cast("long")


@dataclass(frozen=True)
class Cuts:
    """Where the hot keys of some rows are cut: the order values at which slices begin, one sorted
    list per hot key. `table` is None when no key is hot."""

    table: DataFrame | None = None
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()


def _at(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)])


def find_cuts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_slice: int | None = None
) -> Cuts:
    """Look for keys with too many rows and choose their cuts.

    Steps of one operator share the result, so the rows are counted once. Each hot key gets a slice
    for every `rows_per_slice` of its own rows: the rows of all hot keys are dealt out by ranges of
    (key, order values), and the first values of every range are its cut. The cuts are written to the
    shared folder, so each later step sees the same ones.
    """
    limit, keys = rows_per_slice or ROWS_PER_SLICE, tuple(keys)
    spark = df.sparkSession
    path = scratch_path(spark, "cuts")
    if keys:
        # Fewer than total / limit keys can be this large.
        counts = df.groupBy(*keys).count().filter(F.col("count") > limit)
        hot = counts.select(*keys, F.ceil(F.col("count") / limit).alias("_sl_n"))
        n_slices = hot.agg(F.sum("_sl_n")).first()[0]
        if not n_slices:
            return Cuts()
        hot.write.parquet(f"{path}/keys")
        rows = _match(df, spark.read.parquet(f"{path}/keys").select(*keys), keys, "left_semi")
    else:
        n_rows = df.count()
        n_slices = max(math.ceil(n_rows / limit), int(spark.conf.get("spark.sql.shuffle.partitions")))
        if n_rows < 2:
            return Cuts()
        rows = df
    ranges = rows.select(*keys, _at(order).alias("_sl_at")).repartitionByRange(
        int(n_slices), *keys, "_sl_at")
    first = ranges.groupBy(*keys, F.spark_partition_id().alias("_sl_part")).agg(F.min("_sl_at").alias("_sl_at"))
    first.groupBy(*keys).agg(F.sort_array(F.collect_list("_sl_at")).alias("_sl_cuts")).write.parquet(
        f"{path}/cuts")
    return Cuts(spark.read.parquet(f"{path}/cuts"), keys, tuple(order))


def _match(left: DataFrame, right: DataFrame, by: Sequence[str], how: str) -> DataFrame:
    """Join on keys that may be null. Spark knows the size of the written right side and decides
    whether to send it around."""
    renamed = right.withColumnsRenamed({k: f"_sl_hot_{k}" for k in by})
    on = [F.col(k).eqNullSafe(F.col(f"_sl_hot_{k}")) for k in by]
    return left.join(renamed, on, how).drop(*[f"_sl_hot_{k}" for k in by])


def slice_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_slice: int | None = None,
    cuts: Cuts | None = None, backwards: bool = False,
) -> Sliced:
    """Add `_slice`, numbered in reading direction; rows equal in all order columns of the cuts stay
    in one slice."""
    keys, order = tuple(keys), tuple(order)
    if cuts is None:
        cuts = find_cuts(df, keys, order, rows_per_slice)
    if cuts.table is None:
        return Sliced(df, keys, order, False, backwards)
    if cuts.keys:
        placed = _match(df, cuts.table, cuts.keys, "left")
    else:
        # One row: a value for every slice of the only key, so it is always sent around.
        only = F.pmod(F.xxhash64(*order), F.lit(1))
        placed = df.withColumn("_sl_all", only).join(
            F.broadcast(cuts.table.withColumn("_sl_all", F.lit(0).cast("long"))), "_sl_all").drop("_sl_all")
    passed = F.size(F.filter("_sl_cuts", lambda c: c <= F.col("_sl_at")))
    # The smallest row is a cut itself, so a row has passed at least one.
    number = F.size("_sl_cuts") + 1 - passed if backwards else passed
    placed = (
        placed.withColumn("_sl_at", _at(cuts.order))
        .withColumn("_slice", F.when(F.col("_sl_cuts").isNull(), 0).otherwise(number))
        .drop("_sl_cuts", "_sl_at"))
    return Sliced(placed, keys, order, True, backwards)


# How the results of two neighbouring stretches combine, per kind of running aggregate.
_FOLDS: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "count": F.sum,
    "min": F.min,
    "max": F.max,
    "last": lambda c: F.last(c, ignorenulls=True),
}


def _start(kind: str, column: Column) -> Column:
    if kind == "count":
        return F.count(column)
    return _FOLDS[kind](column)


def _join(kind: str, before: Column, here: Column) -> Column:
    if kind in ("sum", "count"):
        return F.when(before.isNull(), here).when(here.isNull(), before).otherwise(before + here)
    if kind == "min":
        return F.least(before, here)
    if kind == "max":
        return F.greatest(before, here)
    return F.coalesce(here, before)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggs: dict[str, tuple[str, Column | str]],
    peers: bool = False,
    rows_per_slice: int | None = None,
    cuts: Cuts | None = None,
    backwards: bool = False,
) -> DataFrame:
    """Add running aggregates from the first row of a key to the current one, or `backwards` from
    the last one.

    `aggs` maps a new column to (kind, expression), kind being sum, count, min, max or last
    (newest non-null). With `peers`, rows equal in the order columns share one value.
    """
    aggs = {n: (kind, as_column(c)) for n, (kind, c) in aggs.items()}
    s = slice_rows(df, keys, order, rows_per_slice, cuts, backwards)
    frame = s.window()
    first = Window.unboundedPreceding
    frame = frame.rangeBetween(first, 0) if peers else frame.rowsBetween(first, 0)
    local = s.rows.withColumns({n: _start(kind, c).over(frame) for n, (kind, c) in aggs.items()})
    if not s.is_cut:
        return local

    def fold(kind: str, column: Column) -> Column:
        if kind == "last":
            newest = F.min_by if backwards else F.max_by
            return newest(column, F.when(column.isNotNull(), _at(s.order)))
        return _start(kind, column)

    per_slice = s.cut_rows().groupBy(*s.group).agg(
        *[fold(kind, c).alias(f"_sl_{n}") for n, (kind, c) in aggs.items()])
    earlier = Window.partitionBy(*s.keys).orderBy("_slice").rowsBetween(first, -1)
    carry = per_slice.select(
        *[F.col(k).alias(f"_sl_k_{k}") for k in s.group],
        *[_FOLDS[kind](F.col(f"_sl_{n}")).over(earlier).alias(f"_sl_{n}")
          for n, (kind, _) in aggs.items()],
    )
    on = [F.col(k).eqNullSafe(F.col(f"_sl_k_{k}")) for k in s.group]
    return (
        local.join(carry, on, "left")
        .withColumns({n: _join(kind, F.col(f"_sl_{n}"), F.col(n)) for n, (kind, _) in aggs.items()})
        .select(*df.columns, *aggs)
    )


def _edge_rows(s: Sliced, n: int, following: bool) -> DataFrame:
    """For every slice the n nearest rows of the key before it (or after it), marked `_sl_seed`."""
    columns = s.rows.columns
    forward = [F.col(c) for c in s.order]
    backward = [F.col(c).desc() for c in s.order]
    near, away = (backward, forward) if not following else (forward, backward)
    edge = (
        s.cut_rows()
        .withColumn("_sl_rank", F.row_number().over(Window.partitionBy(*s.group).orderBy(*near)))
        .filter(F.col("_sl_rank") <= n)
    )
    slices = F.col("_slice") if not following else F.col("_slice").desc()
    along = Window.partitionBy(*s.keys).orderBy(slices, *away)
    return (
        edge.withColumn("_sl_list", F.collect_list(F.struct(*columns)).over(along.rowsBetween(-n, -1)))
        .withColumn("_sl_was", F.lag("_slice").over(along))
        .filter(F.col("_sl_was").isNotNull() & (F.col("_sl_was") != F.col("_slice")))
        .select("_slice", F.explode("_sl_list").alias("_sl_row"))
        .select(*[F.col("_slice") if c == "_slice" else F.col(f"_sl_row.`{c}`") for c in columns])
        .withColumn("_sl_seed", F.lit(True))
    )


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    body: Callable[[DataFrame, WindowSpec], DataFrame],
    before: int = 0,
    after: int = 0,
    rows_per_slice: int | None = None,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Apply a window expression that looks at most `before` rows back and `after` rows ahead.

    `body` gets the rows and the ordered window to use; it may add columns but not drop rows.
    """
    s = slice_rows(df, keys, order, rows_per_slice, cuts)
    if not s.is_cut:
        return body(s.rows, s.window())
    rows = s.rows.withColumn("_sl_seed", F.lit(False))
    if before:
        rows = rows.unionByName(_edge_rows(s, before, following=False))
    if after:
        rows = rows.unionByName(_edge_rows(s, after, following=True))
    return body(rows, s.window()).filter(~F.col("_sl_seed")).drop("_sl_seed", "_slice")


def _cascade(rows: DataFrame, window: WindowSpec, entry: str, n: int) -> DataFrame:
    """Running n largest values: what a slot gives up is offered to the next slot."""
    frame = window.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_sl_offer", F.col(entry))
    for i in range(1, n + 1):
        slot = f"_top{i}"
        rows = rows.withColumn(slot, F.max("_sl_offer").over(frame))
        held = F.lag(slot).over(window)
        rows = rows.withColumn(
            "_sl_offer",
            F.when(held.isNull() | F.col("_sl_offer").isNull(), F.lit(None)).otherwise(
                F.least(F.col("_sl_offer"), held)),
        )
    return rows.drop("_sl_offer")


def running_top(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    entry: Column,
    n: int,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Add `_top1.._topn`, the n largest `entry` values of the key so far; entries must be unique."""
    s = slice_rows(df.withColumn("_sl_entry", entry), keys, order, rows_per_slice)
    if not s.is_cut:
        return _cascade(s.rows, s.window(), "_sl_entry", n).drop("_sl_entry")
    best = Window.partitionBy(*s.group).orderBy(F.col("_sl_entry").desc())
    edge = (
        s.cut_rows()
        .withColumn("_sl_rank", F.row_number().over(best))
        .filter(F.col("_sl_rank") <= n)
        .drop("_sl_rank")
    )
    along = Window.partitionBy(*s.keys).orderBy("_slice", *s.order)
    slots = [f"_top{i}" for i in range(1, n + 1)]
    ahead = (
        _cascade(edge, along, "_sl_entry", n)
        .withColumn("_sl_next", F.lead("_slice").over(along))
        .filter(F.col("_sl_next") != F.col("_slice"))
        .withColumn("_sl_kept", F.explode(F.array_compact(F.array(*slots))))
    )
    # A carried entry stands before every row of its slice, so its other columns may stay empty.
    seeds = ahead.select(
        *s.keys,
        F.col("_sl_next").alias("_slice"),
        F.col("_sl_kept").alias("_sl_entry"),
        F.lit(True).alias("_sl_seed"),
    )
    rows = s.rows.withColumn("_sl_seed", F.lit(False)).unionByName(seeds, allowMissingColumns=True)
    seeds_first = Window.partitionBy(*s.group).orderBy(F.col("_sl_seed").desc(), *s.order, "_sl_entry")
    return (
        _cascade(rows, seeds_first, "_sl_entry", n)
        .filter(~F.col("_sl_seed"))
        .drop("_sl_seed", "_slice", "_sl_entry")
    )
