"""Joins of event streams and tables.

Time-bounded joins match on (key, time bucket) rather than on the key alone, so rows of a busy
key meet only the rows near them in time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.slices import position, running, with_neighbours
from tidemark.operators.windows import micros


def window_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, size: str,
    how: str = "inner",
) -> DataFrame:
    """Pairs of rows with equal keys whose times lie in the same fixed window."""
    on = [*keys, "_w"]
    placed = right.withColumn("_w", F.window(right_ts, size).start)
    joined = left.withColumn("_w", F.window(left_ts, size).start).join(placed, on, how)
    return joined.withColumnRenamed("_w", "window_start")


def _bounded(at: Column, lower: int, upper: int, closed: str) -> Column:
    low = at >= lower if closed in ("both", "left") else at > lower
    high = at <= upper if closed in ("both", "right") else at < upper
    return low & high


def interval_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
    lower: str, upper: str, how: str = "inner", closed: str = "both",
) -> DataFrame:
    """Pairs with right time between left time + lower and left time + upper.

    `how` is inner, left, or left_anti; `closed` says which bounds count: both, left, right or
    neither. A left row lies in one bucket as wide as the interval; a right row is copied to the
    (at most two) buckets whose left rows it can match. Every match is therefore found exactly
    once, and outer and anti joins need no second pass. The right keys are dropped.
    """
    low, high = micros(lower), micros(upper)
    width = max(high - low, 1_000_000)
    l_at, r_at = position(left, left_ts), position(right, right_ts)
    l_rows = left.withColumn("_l_at", l_at).withColumn("_bucket", F.expr(_floor("_l_at", width)))
    first, last = _floor(f"(_r_at - {high})", width), _floor(f"(_r_at - {low})", width)
    r_rows = (
        right.withColumn("_r_at", r_at)
        .filter(F.col("_r_at").isNotNull())
        .withColumn("_bucket", F.explode(F.expr(f"sequence({first}, {last})")))
        .withColumnsRenamed({k: f"_r_{k}" for k in keys})
        .withColumnRenamed("_bucket", "_r_bucket")
    )
    on = [F.col(k) == F.col(f"_r_{k}") for k in keys]
    on += [F.col("_bucket") == F.col("_r_bucket")]
    on += [_bounded(F.col("_r_at") - F.col("_l_at"), low, high, closed)]
    return l_rows.join(r_rows, on, how).drop(
        "_l_at", "_bucket", "_r_at", "_r_bucket", *[f"_r_{k}" for k in keys])


def _floor(expression: str, width: int) -> str:
    """Whole-number floor division, also right below zero."""
    return f"(({expression} - pmod({expression}, {width}L)) div {width}L)"


def reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
    left_waits: str, right_waits: str,
) -> DataFrame:
    """Match both sides of a transaction; report who waited in vain.

    A left row waits `left_waits` for its counterpart, a right row `right_waits`. Adds `outcome`:
    matched, left_only or right_only. The column sets of both sides must differ but for the keys.

    One full join on key and bucket finds all three. A bucket is as wide as the interval, so a row's
    partners lie in its home bucket or a neighbour's, and every row is copied to one neighbour. In its home
    bucket a row meets all its partners: there it counts as unmatched, and the left row's home gives the pair.
    """
    low, high = -micros(right_waits), micros(left_waits)
    width = max(high - low, 1_000_000)

    def copies(rows: DataFrame, side: str, ts: str, home: str, other: int) -> DataFrame:
        at = f"_{side}_at"
        rows = rows.withColumn(at, position(rows, ts))
        home_bucket = F.expr(_floor(f"({at} + {home})", width))
        # A row without time has no partner and needs no copy.
        both = F.when(F.col(at).isNull(), F.array(F.lit(None).cast("long"))).otherwise(
            F.array(home_bucket, home_bucket + other))
        return (
            rows.select("*", F.posexplode(both).alias("_copy", f"_{side}_bucket"))
            .withColumn(f"_{side}_home", F.col("_copy") == 0).drop("_copy")
            .withColumnsRenamed({k: f"_{side}_{k}" for k in keys}))

    lefts, rights = copies(left, "l", left_ts, str(low), 1), copies(right, "r", right_ts, "0", -1)
    on = [F.col(f"_l_{k}") == F.col(f"_r_{k}") for k in keys]
    on += [F.col("_l_bucket") == F.col("_r_bucket")]
    on += [_bounded(F.col("_r_at") - F.col("_l_at"), low, high, "both")]
    kept = F.when(F.col("_l_at").isNotNull() & F.col("_r_at").isNotNull(), F.col("_l_home")).otherwise(
        F.coalesce("_l_home", "_r_home"))
    outcome = F.when(F.col("_r_home").isNull(), "left_only").when(
        F.col("_l_home").isNull(), "right_only").otherwise("matched")
    return lefts.join(rights, on, "full").filter(kept).select(
        *[F.coalesce(f"_l_{k}", f"_r_{k}").alias(k) for k in keys],
        *[c for c in left.columns if c not in keys], *[c for c in right.columns if c not in keys],
        outcome.alias("outcome"))


def as_of_control(
    rows: DataFrame, control: DataFrame, ts: str, value: str, default: str | None = None, **options
) -> DataFrame:
    """Add the control value in force at each row's time: the newest one not later than it."""
    tagged = rows.withColumn("_side", F.lit(1)).unionByName(
        control.select(ts, value).withColumn("_side", F.lit(0)), allowMissingColumns=True)
    known = running(
        tagged, [], [ts, "_side"], {"_now": ("last", F.col(value))}, peers=True, **options)
    now = F.col("_now") if default is None else F.coalesce("_now", F.lit(default))
    return (
        known.filter("_side = 1").withColumn(value, now).drop("_side", "_now")
    )


def rule_matches(
    actions: DataFrame, rules: DataFrame, key: str, order: Sequence[str], action: str, **options
) -> DataFrame:
    """Rows completing a rule (action1, action2) with the key's previous action.

    Rules are joined on both actions; Spark broadcasts them when they are small.
    """

    def body(rows: DataFrame, window) -> DataFrame:
        return rows.withColumn("_previous", F.lag(action).over(window))

    paired = with_neighbours(actions, [key], order, body, before=1, **options)
    on = (F.col("_previous") == F.col("action1")) & (F.col(action) == F.col("action2"))
    return paired.join(rules.select("action1", "action2"), on).drop("_previous")


def newest_rule(rules: DataFrame, order: Sequence[str]) -> DataFrame:
    """Only the latest rule, for jobs where a new rule replaces the old one."""
    rest = F.struct(*rules.columns)
    return rules.agg(F.max_by(rest, F.struct(*order)).alias("r")).select("r.*")


def look_up(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join to a table with one row per key."""
    return rows.join(dimension, key, "left")
