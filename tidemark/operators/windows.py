"""Group windows over time and over row counts, in one form for batch and streams."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.aggregates import PARTS
from tidemark.operators.slices import as_column, find_cuts, position, running, with_neighbours

_UNIT_MICROS = {
    "microsecond": 1, "millisecond": 1000, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6,
    "day": 86400 * 10**6, "week": 7 * 86400 * 10**6}
# Copies of a row from which sliding windows are computed from panes, and from changes.
PANES_FROM = 8
CHANGES_FROM = 64


def micros(duration: str) -> int:
    """'6 hours' to 21600000000; several parts ('1 hour 30 minutes') add up, a leading minus is for all."""
    sign, parts = (-1, duration[1:].split()) if duration.startswith("-") else (1, duration.split())
    return sign * sum(
        int(amount) * _UNIT_MICROS[unit.lower().rstrip("s")]
        for amount, unit in zip(parts[::2], parts[1::2], strict=True))


def seconds(duration: str) -> int | float:
    """'6 hours' to 21600, '500 milliseconds' to 0.5."""
    whole, rest = divmod(micros(duration), 10**6)
    return whole + rest / 10**6 if rest else whole


def _bounds(df: DataFrame, window: str = "_w") -> DataFrame:
    rest = [c for c in df.columns if c != window]
    return df.select(
        F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end"),
        *rest)


def tumble(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, aggs: Sequence[Column | str],
    offset: str = "0 seconds",
) -> DataFrame:
    """Fixed windows, shifted by `offset` from the epoch (may be negative)."""
    window = F.window(ts, size, size, offset)
    return _bounds(df.groupBy(*keys, window.alias("_w")).agg(*map(as_column, aggs)))


def hop(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str,
    aggs: dict[str, tuple[str, Column | str]], panes: bool | None = None,
) -> DataFrame:
    """Sliding windows.

    `window` copies each row once per window it lies in. With `panes` rows are first aggregated into
    panes that tile every window, and only the panes are copied, which gains where a pane of a key
    holds several rows and loses where most hold one; results are the same. The default is panes from
    PANES_FROM copies on, on a stream too, where both steps are windows over the same watermark, and
    changes (`hop_spans`) for a batch from CHANGES_FROM copies on, if the aggregates allow it.
    """
    size_us, slide_us = micros(size), micros(slide)
    if panes is None:
        if size_us // slide_us >= CHANGES_FROM and not df.isStreaming and exact_changes(df, aggs):
            return _each_window(hop_spans(df, keys, ts, size, slide, aggs), keys, ts, df, size_us, slide_us, aggs)
        panes = size_us // slide_us >= PANES_FROM
    if not panes:
        window = F.window(ts, size, slide).alias("_w")
        plain = [PARTS[kind][0](as_column(c)).alias(n) for n, (kind, c) in aggs.items()]
        return _bounds(df.groupBy(*keys, window).agg(*plain))
    pane = f"{math.gcd(size_us, slide_us)} microseconds"
    partial = df.groupBy(*keys, F.window(ts, pane).alias("_p")).agg(
        *[PARTS[kind][0](as_column(c)).alias(n) for n, (kind, c) in aggs.items()])
    # The time of a pane lies inside it, and so in the same windows as all its rows.
    starts = partial.withColumn("_at", F.window_time("_p"))
    merged = [PARTS[kind][1](n).alias(n) for n, (kind, _) in aggs.items()]
    return _bounds(starts.groupBy(*keys, F.window("_at", size, slide).alias("_w")).agg(*merged))


def exact_changes(df: DataFrame, aggs: dict[str, tuple[str, Column | str]]) -> bool:
    """Whether what leaves a window can be taken off exactly: counts, and sums of whole numbers and decimals."""
    for kind, column in aggs.values():
        of = df.select(as_column(column).alias("c")).schema["c"].dataType
        if kind != "count" and not (kind == "sum" and isinstance(of, (T.IntegralType, T.DecimalType))):
            return False
    return True


def hop_spans(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str,
    aggs: dict[str, tuple[str, Column | str]],
) -> DataFrame:
    """Sliding windows with equal contents next to each other, as one row.

    A pane comes in at the first window that holds it and goes after the last: two changes, however many
    windows there are between. Running sums of the changes along the windows of a key are the contents.
    Returns the keys, `first_start` and `last_start` of the windows in epoch microseconds, and the aggregates.
    """
    size_us, slide_us = micros(size), micros(slide)
    pane = F.window(ts, f"{math.gcd(size_us, slide_us)} microseconds").start.alias("_p")
    parts: dict[str, Column] = {"_n_rows": F.count("*")}
    for name, (kind, column) in aggs.items():
        parts[name] = PARTS[kind][0](as_column(column))
        parts[f"_n_{name}"] = F.count(as_column(column))
    partial = df.filter(F.col(ts).isNotNull()).groupBy(*keys, pane).agg(*[c.alias(n) for n, c in parts.items()])
    kinds = dict(partial.dtypes)
    came = F.expr(_floor_to(f"_p - {size_us}", slide_us)) + slide_us
    gone = F.expr(_floor_to("_p", slide_us)) + slide_us

    def change(at: Column, sign: int) -> Column:
        return F.struct(at.alias("_w"), *[(F.coalesce(n, F.lit(0)) * sign).alias(n) for n in parts])

    changes = (
        partial.withColumn("_p", position(partial, "_p"))
        .select(*keys, F.explode(F.array(change(came, 1), change(gone, -1))).alias("_c")).select(*keys, "_c.*")
        .groupBy(*keys, "_w").agg(*[F.sum(n).alias(n) for n in parts]))
    cuts = find_cuts(changes, keys, ["_w"])
    held = running(changes, keys, ["_w"], {n: ("sum", n) for n in parts}, cuts=cuts)

    def until_next(rows: DataFrame, window) -> DataFrame:
        return rows.withColumn("last_start", F.lead("_w").over(window) - slide_us)

    spans = with_neighbours(held, keys, ["_w"], until_next, after=1, cuts=cuts).filter("_n_rows > 0")
    return spans.select(
        *keys, F.col("_w").alias("first_start"), "last_start",
        *[F.when(F.col(f"_n_{n}") > 0, F.col(n)).cast(kinds[n]).alias(n) if kind == "sum" else F.col(n).alias(n)
          for n, (kind, _) in aggs.items()])


def _floor_to(value: str, step: int) -> str:
    """The largest multiple of `step` not above a whole number."""
    return f"({value} - pmod({value}, {step}L))"


def _each_window(
    spans: DataFrame, keys: Sequence[str], ts: str, df: DataFrame, size_us: int, slide_us: int, aggs: Iterable[str]
) -> DataFrame:
    kind = dict(df.dtypes)[ts]
    starts = F.sequence("first_start", "last_start", F.lit(slide_us).cast("long"))
    each = spans.withColumn("_w", F.explode(starts))
    return each.select(
        F.timestamp_micros("_w").cast(kind).alias("window_start"),
        F.timestamp_micros(F.col("_w") + size_us).cast(kind).alias("window_end"), *keys, *aggs)


def session(
    df: DataFrame, keys: Sequence[str], ts: str, gap: str,
    aggs: dict[str, tuple[str, Column | str]],
) -> DataFrame:
    """Windows that end after a pause longer than `gap`; the end is the last row plus the gap.

    A stream uses `session_window`. A batch first aggregates fixed panes as long as the gap: rows of
    one pane are always in one session, so what has to be put in order per key is one row per pane.
    """
    first = {n: PARTS[kind][0](as_column(c)).alias(n) for n, (kind, c) in aggs.items()}
    if df.isStreaming:
        window = F.session_window(ts, gap).alias("_w")
        return _bounds(df.groupBy(*keys, window).agg(*first.values()))
    pane = F.window(ts, gap).start.alias("_pane")
    panes = df.groupBy(*keys, pane).agg(
        F.min(ts).alias("_from"), F.max(ts).alias("_to"), *first.values())
    length = F.expr(f"interval {micros(gap)} microseconds")

    def since_last(rows: DataFrame, window) -> DataFrame:
        return rows.withColumn("_cut", (F.lag("_to").over(window) + length < F.col("_from")))

    cuts = find_cuts(panes, keys, ["_pane"])
    marked = with_neighbours(panes, keys, ["_pane"], since_last, before=1, cuts=cuts)
    cut = F.when(F.col("_cut"), 1).otherwise(0).cast("long")
    numbered = running(marked, keys, ["_pane"], {"_no": ("sum", cut)}, cuts=cuts)
    merged = [PARTS[kind][1](n).alias(n) for n, (kind, _) in aggs.items()]
    return numbered.groupBy(*keys, "_no").agg(
        F.min("_from").alias("window_start"), (F.max("_to") + length).alias("window_end"), *merged
    ).drop("_no")


def distinct_per_window(
    df: DataFrame, keys: Sequence[str], ts: str, of: str, size: str, offset: str = "0 seconds"
) -> DataFrame:
    """Distinct values per fixed window as `n_distinct`, without holding a set in one row."""
    window = F.window(ts, size, size, offset).alias("_w")
    once = df.select(*keys, window, of).filter(F.col(of).isNotNull()).dropDuplicates()
    return _bounds(once.groupBy(*keys, "_w").agg(F.count("*").alias("n_distinct")))


def count_tumble(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, aggs: Sequence[Column | str],
    **options,
) -> DataFrame:
    """Windows of exactly n consecutive rows per key, numbered from 0; unfilled ones do not fire."""
    numbered = running(df, keys, order, {"_row": ("count", "1")}, **options)
    return (
        numbered.groupBy(*keys, F.expr(f"(_row - 1) div {n}").alias("window_no"))
        .agg(F.count("*").alias("_filled"), *map(as_column, aggs))
        .filter(F.col("_filled") == n)
        .drop("_filled")
    )


def count_slide(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, slide: int,
    aggs: dict[str, Column | str], **options,
) -> DataFrame:
    """After every `slide`-th row of a key, aggregates over its last `size` rows."""

    def body(rows: DataFrame, window) -> DataFrame:
        frame = window.rowsBetween(-(size - 1), 0)
        return rows.withColumns({n: as_column(c).over(frame) for n, c in aggs.items()})

    cuts = find_cuts(df, keys, order, **options)
    numbered = running(df, keys, order, {"row_no": ("count", "1")}, cuts=cuts)
    looked = with_neighbours(numbered, keys, order, body, before=size - 1, cuts=cuts)
    return looked.filter(F.col("row_no") % slide == 0).select(*keys, "row_no", *aggs)
