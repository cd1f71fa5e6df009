"""Patterns of events as data, matched by one automaton in batches and on streams.

    begin("small", "value < 1").next("large", "value > 500").followed_by("pay", "kind = 'pay'").times(2).within("1 hour")

`next` wants the very next row of the key, `followed_by` skips rows until one fits. `times(n)` repeats the
last condition, at any distance or `consecutive`. Every row that fits the first condition begins a match of
its own, and a match takes the first row that fits, so it never branches. With `within` the last row must come
less than that after the first; a match that is not whole by then times out.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.slices import as_column, find_cuts, position, slice_rows
from tidemark.operators.windows import micros
from tidemark.session import scratch_path

MATCHED, TIMED_OUT, OPEN = "matched", "timed_out", "open"
Event = tuple[int, int]  # time in epoch microseconds, id
Begun = tuple[Event, ...]


@dataclass(frozen=True)
class Pattern:
    """Conditions by name, and the steps of a match: the number of a condition, and whether the row must be
    the very next one."""

    names: tuple[str, ...]
    conditions: tuple[Column | str, ...]
    steps: tuple[tuple[int, bool], ...]
    limit: int | None = None

    def _then(self, name: str, condition: Column | str, strict: bool) -> Pattern:
        return replace(
            self, names=(*self.names, name), conditions=(*self.conditions, condition),
            steps=(*self.steps, (len(self.names), strict)))

    def next(self, name: str, condition: Column | str) -> Pattern:
        return self._then(name, condition, True)

    def followed_by(self, name: str, condition: Column | str) -> Pattern:
        return self._then(name, condition, False)

    def times(self, n: int, consecutive: bool = False) -> Pattern:
        return replace(self, steps=(*self.steps, *[(len(self.names) - 1, consecutive)] * (n - 1)))

    def within(self, duration: str) -> Pattern:
        return replace(self, limit=micros(duration))

    @property
    def hits(self) -> Column:
        """The conditions that a row fits, one bit each."""
        bits = [F.when(as_column(c), 1 << i).otherwise(0) for i, c in enumerate(self.conditions)]
        return sum(bits[1:], bits[0]).cast("long")

    @property
    def skips(self) -> bool:
        """Whether rows that fit no condition change nothing."""
        return not any(strict for _, strict in self.steps[1:])


def begin(name: str, condition: Column | str) -> Pattern:
    return Pattern((name,), (condition,), ((0, False),))


class Automaton:
    """The matches of one key that have begun, by the number of steps they have taken.

    All matches that wait for one step react alike, so they move, end or time out together. Those further
    on began earlier, so each group is ordered by its beginnings. A row costs a look at every group, and
    every match a move for each of its steps, however many matches are open.
    """

    def __init__(self, pattern: Pattern, groups: Sequence[Sequence[Begun]] | None = None):
        self.steps, self.limit = pattern.steps, pattern.limit
        self.groups: list[deque[Begun]] = [deque(g) for g in groups or [()] * len(self.steps)]

    def expire(self, until: int, found: list[tuple[str, Begun]]) -> None:
        """Time out what is not whole when `until` has come."""
        if self.limit is not None:
            for group in self.groups[:0:-1]:
                while group and group[0][0][0] + self.limit <= until:
                    found.append((TIMED_OUT, group.popleft()))

    def deadline(self) -> int | None:
        if self.limit is None:
            return None
        firsts = [group[0][0][0] for group in self.groups if group]
        return min(firsts) + self.limit if firsts else None

    def take(self, event: Event, hits: int, found: list[tuple[str, Begun]], begins: bool = True) -> None:
        self.expire(event[0], found)
        last = len(self.steps) - 1
        for n in range(last, 0, -1):  # a match moves once a row
            condition, strict = self.steps[n]
            if not (group := self.groups[n]):
                continue
            if hits >> condition & 1:
                if n == last:
                    found += [(MATCHED, (*m, event)) for m in group]
                else:
                    self.groups[n + 1].extend([(*m, event) for m in group])
                group.clear()
            elif strict:
                group.clear()
        if begins and hits >> self.steps[0][0] & 1:
            if last == 0:
                found.append((MATCHED, (event,)))
            else:
                self.groups[1].append((event,))

    def opened(self) -> Iterator[Begun]:
        for group in self.groups[:0:-1]:
            yield from group


_RESULT = [("outcome", pa.string()), ("at", pa.list_(pa.int64())), ("id", pa.list_(pa.int64()))]
_ROWS_OUT = 10_000


def _walk(
    batches: Iterator[pa.RecordBatch], part: list[str], pattern: Pattern
) -> Iterator[pa.RecordBatch]:
    """Matches, and what is open at the end, of every part of sorted rows. A row with `_begun` is a match
    that an earlier part began; parts that have any begin none themselves."""
    automaton, carried, values = Automaton(pattern), False, None
    keys: list[list] = []
    made: list[tuple[str, Begun]] = []
    types: list[pa.DataType] = []

    def batch_of() -> pa.RecordBatch:
        columns = [pa.array([k[i] for k in keys], t) for i, t in enumerate(types)]
        columns += [pa.array([m[0] for m in made], pa.string()),
                    pa.array([[e[0] for e in m[1]] for m in made], pa.list_(pa.int64())),
                    pa.array([[e[1] for e in m[1]] for m in made], pa.list_(pa.int64()))]
        keys.clear()
        made.clear()
        return pa.RecordBatch.from_arrays(columns, names=[*part, *(n for n, _ in _RESULT)])

    def close() -> None:
        made.extend((OPEN, m) for m in automaton.opened())
        keys.extend([values] * (len(made) - len(keys)))

    for batch in batches:
        types = [batch.schema.field(c).type for c in part]
        owners = list(zip(*(batch[c].to_pylist() for c in part)))
        columns = (batch[c].to_pylist() for c in ("_new", "_at", "_id", "_hits", "_begun"))
        for owner, new, at, id_, hits, begun in zip(owners, *columns, strict=True):
            if new:
                if values is not None:
                    close()
                automaton, values, carried = Automaton(pattern), owner, False
            if begun is not None:
                match = tuple((e["at"], e["id"]) for e in begun)
                automaton.groups[len(match)].append(match)
                carried = True
                continue
            automaton.take((at, id_), hits, made, not carried)
            keys.extend([values] * (len(made) - len(keys)))
        if len(made) >= _ROWS_OUT:
            yield batch_of()
    if values is not None:
        close()
    if made:
        yield batch_of()


def match_pattern(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], pattern: Pattern,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """The matches of a pattern along the rows of each key, ordered by time and a whole-number id.

    Returns the keys, `outcome` (matched or timed_out) and the times (epoch microseconds) and ids of the
    rows taken; when `within` is not given, what never ends is left out. A hot key is cut into slices that
    are walked side by side. What is open at the end of a slice goes on in the next one, in rounds: there
    are as many as slices that one match reaches over, each with only the slices that have something open.
    """
    keys, (ts, id_) = list(keys), order
    rows = df.select(*keys, position(df, ts).alias("_at"), F.col(id_).cast("long").alias("_id"),
                     pattern.hits.alias("_hits")).filter("_at is not null")
    if pattern.skips:
        rows = rows.filter("_hits <> 0")
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "matches")
    cuts = find_cuts(rows, keys, ["_at", "_id"], rows_per_slice)
    sliced = slice_rows(rows, keys, ["_at", "_id"], cuts=cuts)
    rows = sliced.rows if sliced.is_cut else rows.withColumn("_slice", F.lit(0))
    part = [*keys, "_slice"]
    schema = T.StructType([
        *[rows.schema[c] for c in part], T.StructField("outcome", T.StringType()),
        *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("at", "id")]])
    begun = "array<struct<at:bigint,id:bigint>>"

    def walked(some: DataFrame) -> DataFrame:
        place = ["_kind", "_at", "_id"]
        first = F.row_number().over(Window.partitionBy(*part).orderBy(*place)) == 1
        ordered = some.withColumn("_new", first).sortWithinPartitions(*part, *place)
        return ordered.select(*part, "_new", "_at", "_id", "_hits", "_begun").mapInArrow(
            lambda batches: _walk(batches, part, pattern), schema)

    plain = rows.withColumns({"_begun": F.lit(None).cast(begun), "_kind": F.lit(1)})
    found = walked(plain)
    if sliced.is_cut:
        rounds, n = [], 0
        slices = _kept(rows.groupBy(*keys).agg(F.max("_slice").alias("_last_slice")), f"{path}/slices")
        while True:
            found = _kept(found, f"{path}/round-{n}")
            ahead = _same_keys(found.filter(F.col("outcome") == OPEN), slices, keys, "inner")
            goes_on = ahead.filter("_slice < _last_slice and _slice > 0")
            rounds.append(found.filter(F.col("outcome") != OPEN).unionByName(
                ahead.filter("_slice >= _last_slice or _slice = 0").select(*found.columns)))
            if goes_on.isEmpty():
                break
            seeds = goes_on.select(
                *keys, (F.col("_slice") + 1).alias("_slice"), F.col("at")[0].alias("_at"), F.col("id")[0].alias("_id"),
                F.lit(0).cast("long").alias("_hits"), F.arrays_zip("at", "id").cast(begun).alias("_begun"),
                F.lit(0).alias("_kind"))
            touched = _same_keys(plain, seeds.select(*part).distinct(), part, "left_semi")
            # Matches further on began earlier: in the order of their beginnings every group is in order.
            found, n = walked(touched.unionByName(seeds)), n + 1
        found = rounds[0]
        for more in rounds[1:]:
            found = found.unionByName(more)
    if pattern.limit is None:
        found = found.filter(F.col("outcome") == MATCHED)
    outcome = F.when(F.col("outcome") == OPEN, TIMED_OUT).otherwise(F.col("outcome"))
    return found.select(*keys, outcome.alias("outcome"), "at", "id")


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same_keys(left: DataFrame, right: DataFrame, by: Sequence[str], how: str) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_sk_{k}" for k in by})
    on = [F.col(k).eqNullSafe(F.col(f"_sk_{k}")) for k in by]
    return left.join(renamed, on, how).drop(*[f"_sk_{k}" for k in by])
