"""Sequences of events per key: alerts, runs, strict and relaxed succession, time-outs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.slices import (
    Cuts,
    as_column,
    find_cuts,
    position,
    running,
    slice_rows,
    with_neighbours,
)
from tidemark.operators.windows import micros
from tidemark.session import scratch_path

NEVER = (1 << 63) - 1


def jumps(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, by: float, **options
) -> DataFrame:
    """Rows whose value differs from the key's previous one by more than `by`."""

    def body(rows: DataFrame, window) -> DataFrame:
        return rows.withColumn("previous", F.lag(value).over(window))

    looked = with_neighbours(df, keys, order, body, before=1, **options)
    return looked.filter(F.abs(F.col(value) - F.col("previous")) > by)


def adjacent_pairs(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], matches: Column | str, within: str,
    strict: bool, **options,
) -> DataFrame:
    """Two neighbouring rows of a key that both match and lie within a time span.

    With `strict` the span must stay below `within`, else it may equal it. Returns the second row
    with `first_ts`, the time of the first.
    """
    ts = order[0]
    limit = micros(within)
    marked = df.withColumn("_hit", as_column(matches)).withColumn("_at", position(df, ts))

    def body(rows: DataFrame, window) -> DataFrame:
        before = F.lag(F.struct("_hit", "_at", F.col(ts).alias("ts"))).over(window)
        return rows.withColumn("_before", before)

    looked = with_neighbours(marked, keys, order, body, before=1, **options)
    span = F.col("_at") - F.col("_before._at")
    near = span < limit if strict else span <= limit
    return (
        looked.filter(F.col("_hit") & F.col("_before._hit") & near)
        .withColumn("first_ts", F.col("_before.ts"))
        .drop("_hit", "_at", "_before")
    )


def consecutive(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], matches: Column | str, times: int,
    within: str, **options,
) -> DataFrame:
    """Every row ending `times` matching neighbours in a row, less than `within` apart in total."""
    ts = order[0]
    limit = micros(within)
    marked = df.withColumn("_hit", as_column(matches).cast("int")).withColumn("_at", position(df, ts))

    def body(rows: DataFrame, window) -> DataFrame:
        back = window.rowsBetween(-(times - 1), 0)
        return rows.withColumns({
            "_hits": F.sum("_hit").over(back),
            "_from": F.lag("_at", times - 1).over(window),
            "first_ts": F.lag(ts, times - 1).over(window),
        })

    looked = with_neighbours(marked, keys, order, body, before=times - 1, **options)
    return looked.filter(
        (F.col("_hits") == times) & (F.col("_at") - F.col("_from") < limit)
    ).drop("_hit", "_at", "_hits", "_from")


def _follow_timers(
    batches: Iterator[pa.RecordBatch], run: list[str], limit: int
) -> Iterator[pa.RecordBatch]:
    """Walk sorted rows: the first row of a run arms a timer, the next row past it arms anew.

    Where `_carried` is set at the first row of a part, a timer armed then is still the run's last one.
    From one timer to the next the walk jumps by binary search, as the rows of a run are in order.
    Run columns stay Arrow values, which keep nulls and large numbers as they are.
    """
    armed = 0
    for batch in batches:
        at = batch["_at"].to_numpy(zero_copy_only=False)
        n = len(at)
        new = np.flatnonzero(batch["_new"].to_numpy(zero_copy_only=False))
        carried = batch["_carried"]
        heads, starts, low = [], [], 0
        for end in [*new[new > 0].tolist(), n] if n else []:
            is_new = bool(len(new)) and bool(np.isin(low, new))
            if is_new and carried[low].is_valid:
                armed, is_new = carried[low].as_py(), False
            while low < end:
                if is_new or at[low] > armed + limit:
                    armed, is_new = int(at[low]), False
                heads.append(low)
                starts.append(armed)
                low += int(np.searchsorted(at[low:end], armed + limit, "right"))
        if not heads:
            continue
        tails = np.append(heads[1:], n)
        first = batch.take(pa.array(heads))
        yield pa.RecordBatch.from_arrays(
            [*[first[c] for c in run], pa.array(starts, pa.int64()), first["_end"],
             pa.array(at[tails - 1], pa.int64()), pa.array(tails - heads, pa.int64())],
            names=[*run, "_armed", "_end", "_last", "_rows"])


def timer_groups(
    df: DataFrame, run: Sequence[str], order: Sequence[str], limit: int, cuts: Cuts | None = None,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """One row per timer: the run, `_armed` (when it was set), `_last` and `_rows` it covered.

    `run` identifies stretches of rows that share timers; `_at` is the row time and `_end` the end of
    the run. Each timer depends on the one before, yet a long run is read by many tasks: it is cut into
    slices, and `_carried_timers` finds which timer is set where a slice begins. `cuts` are those of the
    keys, if known: where no key is hot, no run is.
    """
    run = list(run)
    longs = [T.StructField(c, T.LongType()) for c in ("_armed", "_end", "_last", "_rows")]
    schema = T.StructType([*[df.schema[c] for c in run], *longs])
    rows = df.filter("_at is not null").withColumn("_end", F.coalesce("_end", F.lit(NEVER)))
    part = run
    if cuts is None or cuts.table is not None:
        cuts = find_cuts(rows, run, order, rows_per_slice)
    if cuts is not None and cuts.table is not None:
        part = [*run, "_slice"]
        sliced = slice_rows(rows, run, order, cuts=cuts).rows
        rows = _null_safe(sliced, _carried_timers(sliced.filter("_slice > 0"), run, limit), part, "left")
    else:
        rows = rows.withColumn("_carried", F.lit(None).cast("long"))
    # The window has already brought each part together; the sort is the one it needed anyway.
    first = F.row_number().over(Window.partitionBy(*part).orderBy(*order)) == 1
    ordered = rows.withColumn("_new", first).sortWithinPartitions(*part, *order).select(
        *run, "_at", "_end", "_new", "_carried")
    parts = ordered.mapInArrow(lambda batches: _follow_timers(batches, run, limit), schema)
    return parts.groupBy(*run, "_armed").agg(
        F.min("_end").alias("_end"), F.max("_last").alias("_last"), F.sum("_rows").alias("_rows"))


def _null_safe(left: DataFrame, right: DataFrame, by: Sequence[str], how: str) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_ns_{k}" for k in by})
    on = [F.col(k).eqNullSafe(F.col(f"_ns_{k}")) for k in by]
    return left.join(renamed, on, how).drop(*[f"_ns_{k}" for k in by])


def _last_timers(at: np.ndarray, limit: int) -> np.ndarray:
    """For each of some sorted times, the last timer of the slice if it armed one, by pointer doubling.

    A row points to the first row past its timer, or to itself if there is none; pointers are followed
    twice as far each time, until they no longer move.
    """
    after = np.searchsorted(at, at + limit, "right")
    place = np.arange(len(at))
    points = np.where(after < len(at), after, place)
    while True:
        further = points[points]
        if (further == points).all():
            return at[points]
        points = further


def _carried_timers(sliced: DataFrame, run: list[str], limit: int) -> DataFrame:
    """`_carried`: the timer that is set where each slice of a long run begins, if it is not the first.

    Every slice tells the last timers its rows could end with. A last timer leads to the first slice with
    a later row than it, and there to that slice's last timer: a graph with a few nodes a slice. Which of
    them the run's first row leads to is found by pointer doubling, with one join for each doubling.
    """
    kinds = {f.name: f.dataType for f in sliced.schema.fields}
    part = [*run, "_slice"]
    rows = sliced.select(*part, "_at")
    key_fields = [T.StructField(c, kinds[c]) for c in part]
    long = T.LongType()

    def keyed(key: tuple, columns: dict[str, np.ndarray]) -> pa.Table:
        n = len(next(iter(columns.values())))
        made = {c: pa.array([k.as_py()] * n, k.type) for c, k in zip(part, key, strict=True)}
        return pa.table(made | {c: pa.array(v, pa.int64()) for c, v in columns.items()})

    def ends(key: tuple, table: pa.Table) -> pa.Table:
        at = np.sort(table["_at"].to_numpy())
        last = _last_timers(at, limit)
        timers = np.unique(last)
        return keyed(key, {"_x": timers, "_first_x": np.full(len(timers), last[0]),
                           "_latest": np.full(len(timers), at[-1])})

    def leads(key: tuple, table: pa.Table, asked: pa.Table) -> pa.Table:
        """Where each timer of earlier slices leads in this one, whose rows are later."""
        if not table.num_rows or not asked.num_rows:
            return keyed(key, {c: np.empty(0, np.int64) for c in ("_from", "_x", "_y")})
        at = np.sort(table["_at"].to_numpy())
        x = asked["_x"].to_numpy()
        return keyed(key, {"_from": asked["_from"].to_numpy(), "_x": x,
                           "_y": _last_timers(at, limit)[np.searchsorted(at, x + limit, "right")]})

    spark = sliced.sparkSession
    path = scratch_path(spark, "timers")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    ended = kept(rows.groupBy(*part).applyInArrow(ends, T.StructType(
        [*key_fields, *[T.StructField(c, long) for c in ("_x", "_first_x", "_latest")]])), "ends")
    slices = ended.groupBy(*part).agg(F.first("_first_x").alias("_first_x"), F.first("_latest").alias("_latest"))
    later = slices.groupBy(*run).agg(F.sort_array(F.collect_list(F.struct("_slice", "_latest"))).alias("_later"))
    reached = F.filter("_later", lambda s: (s["_slice"] > F.col("_slice")) & (s["_latest"] > F.col("_x") + limit))
    asked = _null_safe(ended, later, run, "inner").withColumn("_next", F.get(reached, F.lit(0))["_slice"]).filter(
        "_next is not null").select(*run, F.col("_next").alias("_slice"), F.col("_slice").cast("long").alias("_from"), "_x")
    edges = kept(rows.groupBy(*part).cogroup(asked.groupBy(*part)).applyInArrow(leads, T.StructType(
        [*key_fields, *[T.StructField(c, long) for c in ("_from", "_x", "_y")]])), "edges-0")
    # Nodes are (run, slice, timer); an edge leads from (run, _from, _x) to (run, _slice, _y).
    edges = edges.select(*run, F.col("_from").cast("int").alias("_slice"), "_x", F.col("_slice").alias("_to"), "_y")
    roots = slices.groupBy(*run).agg(F.min_by(F.struct("_slice", F.col("_first_x").alias("_x")), "_slice").alias("_r"))
    seen = kept(roots.select(*run, "_r._slice", "_r._x"), "seen-0")
    rounds = int(slices.agg(F.max("_slice")).first()[0]).bit_length()
    for i in range(1, rounds + 1):
        step = _null_safe(seen, edges, [*run, "_slice", "_x"], "inner").select(
            *run, F.col("_to").alias("_slice"), F.col("_y").alias("_x"))
        seen = kept(seen.unionByName(step).distinct(), f"seen-{i}")
        onward = edges.select(*run, F.col("_slice").alias("_to"), F.col("_x").alias("_y"),
                              F.col("_to").alias("_to2"), F.col("_y").alias("_y2"))
        edges = kept(_null_safe(edges, onward, [*run, "_to", "_y"], "inner").select(
            *run, "_slice", "_x", F.col("_to2").alias("_to"), F.col("_y2").alias("_y")), f"edges-{i}")
    before = Window.partitionBy(*run).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    marked = _null_safe(slices.select(*part), seen, part, "left")
    return kept(marked.select(*part, F.last("_x", True).over(before).alias("_carried")), "carried")


def _with_runs(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], breaks: str, cuts: Cuts
) -> DataFrame:
    """Number the stretches between `breaks` rows as `_run`, and add `_end`, the next break's time.

    Both are running values over the same key, one read forwards and one backwards.
    """
    count = F.when(F.col(breaks), 1).otherwise(0).cast("long")
    numbered = running(df, keys, order, {"_run": ("sum", count)}, cuts=cuts)
    ahead = F.when(F.col(breaks), F.col("_at"))
    return running(numbered, keys, order, {"_end": ("last", ahead)}, cuts=cuts, backwards=True)


def not_falling(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, limit: str,
    arm_on_first: bool = False, **options,
) -> DataFrame:
    """Times at which a value had not fallen for `limit`.

    A rise (or an equal value) arms a timer unless one is set; a fall clears it; an expired timer
    alerts and the next row that does not fall arms again. By default a key's very first row and
    the row of a fall arm nothing. `arm_on_first` lets the very first row arm, and demands a true
    rise afterwards. Returns the key with `armed_at` and `alert_at`.
    """
    wait = micros(limit)
    base = df.select(*keys, *order, value).withColumn("_at", position(df, order[0]))

    def body(rows: DataFrame, window) -> DataFrame:
        return rows.withColumn("_last", F.lag(value).over(window))

    cuts = find_cuts(base, keys, order, **options)
    looked = with_neighbours(base, keys, order, body, before=1, cuts=cuts)
    if arm_on_first:
        arms = F.col("_last").isNull() | (F.col(value) > F.col("_last"))
    else:
        arms = F.col(value) >= F.col("_last")
    flagged = looked.withColumns({
        "_fell": F.coalesce(F.col(value) < F.col("_last"), F.lit(False)),
        "_arms": F.coalesce(arms, F.lit(False)),
    })
    candidates = _with_runs(flagged, keys, order, "_fell", cuts).filter("_arms")
    timers = timer_groups(candidates, [*keys, "_run"], order, wait, cuts, **options)
    return timers.filter(F.col("_end") > F.col("_armed") + wait).select(
        *keys, F.timestamp_micros("_armed").alias("armed_at"),
        F.timestamp_micros(F.col("_armed") + wait).alias("alert_at"))


def failure_bursts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], failed: Column | str, at_least: int,
    within: str, **options,
) -> DataFrame:
    """Failures counted from the first one until `within` later; a success wipes the count.

    Reports bursts of at least `at_least` rows with their first and last time. The failure after a
    finished burst starts the next one.
    """
    wait = micros(within)
    base = df.select(*keys, *order, as_column(failed).alias("_failed"))
    flagged = base.withColumns({"_at": position(df, order[0]), "_passed": ~F.col("_failed")})
    cuts = find_cuts(base, keys, order, **options)
    fails = _with_runs(flagged, keys, order, "_passed", cuts).filter("_failed")
    bursts = timer_groups(fails, [*keys, "_run"], order, wait, cuts, **options)
    found = (F.col("_rows") >= at_least) & (F.col("_end") > F.col("_armed") + wait)
    return bursts.filter(found).select(
        *keys, F.timestamp_micros("_armed").alias("first_ts"),
        F.timestamp_micros("_last").alias("last_ts"), F.col("_rows").alias("n_fails"))


def with_rank_per_day(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], zone_hours: int, **options
) -> DataFrame:
    """Add the local `day` of each row and its number among the key's rows of that day."""
    ts = order[0]
    day = F.to_date(F.col(ts) + F.expr(f"interval {zone_hours} hours"))
    return running(
        df.withColumn("day", day), [*keys, "day"], order, {"nth": ("count", "1")}, **options)


def order_outcomes(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], kind: str, limit: str, **options
) -> DataFrame:
    """Match every create of an order with the pay that comes next, cycle after cycle.

    Outcomes: paid (the next event is a pay, at most `limit` later), no_pay (nothing came in time),
    pay_without_create (no create open when the pay came). A create that another one follows in time
    is replaced by it. As each event clears what was open, an event depends on its neighbours only.
    """
    ts = order[0]
    wait = micros(limit)
    base = df.select(*keys, kind, *order).filter(F.col(kind).isin("create", "pay")).withColumn(
        "_at", position(df, ts))

    def body(rows: DataFrame, window) -> DataFrame:
        here = F.struct(F.col(kind).alias("kind"), F.col("_at").alias("at"), F.col(ts).alias("ts"))
        return rows.withColumns({"_before": F.lag(here).over(window), "_after": F.lead(here).over(window)})

    looked = with_neighbours(base, keys, order, body, before=1, after=1, **options)
    in_time = F.col("_after.at") - F.col("_at") <= wait
    answered = (F.col("_before.kind") == "create") & (F.col("_at") - F.col("_before.at") <= wait)
    outcome = F.when(
        F.col(kind) == "create",
        F.when(~F.coalesce(in_time, F.lit(False)), "no_pay").when(F.col("_after.kind") == "pay", "paid"),
    ).when(~F.coalesce(answered, F.lit(False)), "pay_without_create")
    return looked.withColumn("outcome", outcome).filter("outcome is not null").select(
        *keys, "outcome",
        F.when(F.col("outcome") != "pay_without_create", F.col(ts)).alias("create_ts"),
        F.when(F.col("outcome") == "paid", F.col("_after.ts"))
        .when(F.col("outcome") == "pay_without_create", F.col(ts)).alias("pay_ts"))


def followed_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column | str, then: Column | str,
    within: str, **options,
) -> DataFrame:
    """For every `first` row the next `then` row of the key, whatever lies between.

    `outcome` is matched when it comes less than `within` later, else timed_out. Reads each key
    backwards once, remembering the nearest `then`.
    """
    ts = order[0]
    limit = micros(within)
    base = df.select(*keys, *order, as_column(first).alias("_first"), as_column(then).alias("_then"))
    looked = running(
        base, keys, order, {"_next": ("last", F.when(F.col("_then") & ~F.col("_first"), F.col(ts)))},
        backwards=True, **options)
    span = F.unix_micros(F.col("_next").cast("timestamp")) - position(base, ts)
    matched = F.coalesce(span < limit, F.lit(False))
    return looked.filter("_first").select(
        *keys, F.col(ts).alias("start_ts"),
        F.when(matched, F.col("_next")).alias("end_ts"),
        F.when(matched, "matched").otherwise("timed_out").alias("outcome"))
