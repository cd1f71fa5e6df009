"""Keyed stream logic that needs custom state: remembered rows, counters, timers.

`InOrder` holds the rows of a key until the watermark has passed them and hands them on by event
time, with deadlines in between where they fall due. Results therefore do not depend on how rows
were cut into batches, and equal those of the batch operators.
"""

from __future__ import annotations

import pickle
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator
from dataclasses import replace
from datetime import date, timedelta
from operator import itemgetter

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.automaton import Automaton, Pattern
from tidemark.operators.slices import as_column


class InOrder(StatefulProcessor):
    """Rows are tuples (at, id, *payload), `at` in epoch microseconds.

    Waiting rows lie in sorted chunks of up to CHUNK rows, each one value of a map. Beside them one value
    holds what is remembered and when each chunk begins, so a timer reads only the chunks that are due, and
    a key's rows are read and written a bounded number of times however many wait.
    """

    payload = ""  # DDL of the payload columns
    memory = ""  # DDL of what is remembered per key
    output = ""  # DDL of the result columns after the key
    # Column names of a row and of a result; set by `in_order`, as workers cannot read DDL.
    names: list[str]
    result_names: list[str]
    times: tuple[str, ...] = ()  # result columns given in epoch microseconds
    CHUNK = 1024

    def row_ddl(self) -> str:
        return "at long, id long" + (f", {self.payload}" if self.payload else "")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._known = handle.getValueState(
            "known", f"memory struct<{self.memory}>, waiting array<struct<first long, n long>>, next long")
        self._chunks = handle.getMapState("chunks", "n long", "rows binary")

    def _load(self) -> tuple[tuple | None, list[tuple[int, int]], int]:
        known = self._known.get()
        if known is None:
            return None, [], 0
        memory, waiting, n = known
        return _plain(memory), _plain(waiting), n

    def _put(self, rows: list[tuple], waiting: list[tuple[int, int]], n: int) -> int:
        for low in range(0, len(rows), self.CHUNK):
            chunk = rows[low:low + self.CHUNK]
            self._chunks.updateValue((n,), (pickle.dumps(chunk),))
            waiting.append((chunk[0][0], n))
            n += 1
        return n

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = next(rows, None)
        if first is not None:
            take = itemgetter(*[first.__fields__.index(n) for n in self.names])
            held = sorted([take(first), *map(take, rows)], key=itemgetter(0, 1))
            memory, waiting, n = self._load()
            n = self._put(held, waiting, n)
            self._known.update((memory, waiting, n))
            self._handle.registerTimer(_millis(held[0][0]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        named = Row(*self.result_names)
        # Later rows may still share the watermark's millisecond but lie behind it.
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        memory, waiting, n = self._load()
        state, later, rows = self.load(memory), [], []
        for first, number in waiting:
            if first > passed:
                later.append((first, number))
                continue
            rows += pickle.loads(self._chunks.getValue((number,))[0])
            self._chunks.removeKey((number,))
        rows.sort(key=itemgetter(0, 1))
        due = bisect_right(rows, passed, key=itemgetter(0))
        results: list[tuple] = []
        for row in rows[:due]:
            state = self._expire(state, row[0] - 1, results)
            state, found = self.on_row(state, row)
            results += found
        state = self._expire(state, passed, results)

        n = self._put(rows[due:], later, n)
        memory = self.dump(state)
        if memory is None and not later:
            self._known.clear()
        else:
            self._known.update((memory, later, n))
        if later:
            self._handle.registerTimer(_millis(min(first for first, _ in later)))
        deadline = self.deadline(state)
        if deadline is not None:
            self._handle.registerTimer(_millis(deadline))
        return iter([named(*key, *r) for r in results])

    def _expire(self, state, until: int, results: list):
        while (deadline := self.deadline(state)) is not None and deadline <= until:
            state, found = self.on_deadline(state)
            results += found
        return state

    def close(self) -> None:
        pass

    def start(self) -> tuple:
        """What a key remembers before its first row; a key back in this state is forgotten."""
        raise NotImplementedError

    def load(self, memory: tuple | None):
        """The state to work with, from what was remembered."""
        return self.start() if memory is None else memory

    def dump(self, state) -> tuple | None:
        """What to remember of a state; None for a key back at its start."""
        return None if state == self.start() else state

    def on_row(self, state, row: tuple) -> tuple:
        """The state after a row, and the results that it gives."""
        raise NotImplementedError

    def deadline(self, state) -> int | None:
        """When a timer of this state falls due, in epoch microseconds."""
        return None

    def on_deadline(self, state) -> tuple:
        raise NotImplementedError


def _plain(value):
    """A value of the state with tuples for its rows, at any depth: rows inside it could not be written back."""
    if isinstance(value, tuple):
        return tuple(_plain(v) for v in value)
    return [_plain(v) for v in value] if isinstance(value, list) else value


def _millis(micros: int) -> int:
    """The first whole millisecond at which a time has passed."""
    return -(-micros // 1000)


def in_order(df: DataFrame, key: list[str], processor: InOrder) -> DataFrame:
    """Run a processor over rows with the columns `at`, `id` and its payload."""
    processor.names = T.StructType.fromDDL(processor.row_ddl()).names
    fields = [df.schema[k] for k in key] + T.StructType.fromDDL(processor.output).fields
    processor.result_names = [f.name for f in fields]
    results = df.groupBy(*key).transformWithState(
        processor, T.StructType(fields), "append", "EventTime")
    return results.withColumns({c: F.timestamp_micros(c) for c in processor.times})


def shaped(df: DataFrame, key: list[str], ts: str, row_id: str, **payload) -> DataFrame:
    """Rows as processors take them. The time column stays for the watermark."""
    return df.select(
        *key, F.unix_micros(ts).alias("at"), F.col(row_id).alias("id"),
        *[as_column(e).alias(n) for n, e in payload.items()], ts)


class Previous(InOrder):
    """Every row beside the key's previous one."""

    def __init__(self, column: str):
        self.payload = f"value {column}"
        self.memory = f"at long, value {column}"
        self.output = f"id long, at long, value {column}, was_at long, was {column}"

    def start(self):
        return (None, None)

    def on_row(self, state, row):
        at, row_id, value = row
        return (at, value), [(row_id, at, value, *state)]


class RunningTotal(InOrder):
    """Every row with the key's sum and count up to it."""

    payload = "value double"
    memory = "total double, n long"
    output = "id long, at long, total double, n long"

    def start(self):
        return (0.0, 0)

    def on_row(self, state, row):
        total, n = state[0] + row[2], state[1] + 1
        return (total, n), [(row[1], row[0], total, n)]


class CountWindows(InOrder):
    """Count and sum of every full group of `size` rows."""

    payload = "value double"
    memory = "window_no long, n long, total double"
    output = "window_no long, n long, total double"

    def __init__(self, size: int):
        self.size = size

    def start(self):
        return (0, 0, 0.0)

    def on_row(self, state, row):
        window_no, n, total = state[0], state[1] + 1, state[2] + row[2]
        if n < self.size:
            return (window_no, n, total), []
        return (window_no + 1, 0, 0.0), [(window_no, n, total)]


class SlidingRows(InOrder):
    """After every `slide`-th row the number, sum and largest value of the last `size` rows."""

    payload = "value double"
    memory = "row_no long, recent array<double>"
    output = "row_no long, n long, total double, top double"

    def __init__(self, size: int, slide: int):
        self.size, self.slide = size, slide

    def start(self):
        return (0, [])

    def on_row(self, state, row):
        row_no, recent = state[0] + 1, [*state[1], row[2]][-self.size:]
        found = [(row_no, len(recent), sum(recent), max(recent))] if row_no % self.slide == 0 else []
        return (row_no, recent), found


class RowTimers(InOrder):
    """A timer for every row: it fires `wait` microseconds after the row, beside whatever else is set."""

    payload = ""
    memory = "open array<struct<at: long, id: long>>"
    output = "id long, fired_at long"
    times = ("fired_at",)

    def __init__(self, wait: int):
        self.wait = wait

    def load(self, memory):
        return deque(map(tuple, memory[0] if memory else ()))

    def dump(self, state):
        return (list(state),) if state else None

    def on_row(self, state, row):
        state.append(row[:2])
        return state, []

    def deadline(self, state):
        return state[0][0] + self.wait if state else None

    def on_deadline(self, state):
        at, row_id = state.popleft()
        return state, [(row_id, at + self.wait)]


class RunningTop(InOrder):
    """After every row the n largest values so far; among equals the earlier row stays ahead."""

    payload = "value double"
    memory = "best array<struct<value: double, id: long>>"
    output = "id long, best array<struct<value: double, id: long>>"

    def __init__(self, n: int = 3):
        self.n = n

    def start(self):
        return ([],)

    def on_row(self, state, row):
        best = [tuple(b) for b in state[0]] + [(row[2], row[1])]
        best = sorted(best, key=lambda b: -b[0])[: self.n]
        return (best,), [(row[1], best)]


class FirstPerField(StatefulProcessor):
    """The first row of every (key, field); what was seen sits in a map beside the key."""

    def __init__(self, key: list[str]):
        self.result_names = [*key, "field", "id", "at"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getMapState("seen", "field int", "id long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        named = Row(*self.result_names)
        first: dict[int, tuple] = {}
        for row in rows:
            candidate = (row["at"], row["id"])
            if row["field"] not in first or candidate < first[row["field"]]:
                first[row["field"]] = candidate
        for field, (at, row_id) in first.items():
            if not self._seen.containsKey((field,)):
                self._seen.updateValue((field,), (row_id,))
                yield named(*key, field, row_id, at)

    def close(self) -> None:
        pass


class SeenRecently(StatefulProcessor):
    """Passes a key's row unless one passed within the time to live (processing time)."""

    def __init__(self, key: list[str], ttl_ms: int):
        self.result_names, self.ttl_ms = [*key, "id"], ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState("seen", "id long", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = min(row["id"] for row in rows)
        if not self._seen.exists():
            self._seen.update((first,))
            yield Row(*self.result_names)(*key, first)

    def close(self) -> None:
        pass


class NotFalling(InOrder):
    """Alerts when a value has not fallen for `limit` microseconds after a rise."""

    payload = "value double"
    memory = "last double, armed long"
    output = "armed_at long, alert_at long"
    times = ("armed_at", "alert_at")

    def __init__(self, limit: int):
        self.limit = limit

    def start(self):
        return (None, None)

    def on_row(self, state, row):
        last, armed = state
        at, _, value = row
        if last is not None and value < last:
            armed = None
        elif last is not None and armed is None:
            armed = at
        return (value, armed), []

    def deadline(self, state):
        return None if state[1] is None else state[1] + self.limit

    def on_deadline(self, state):
        return (state[0], None), [(state[1], state[1] + self.limit)]


class FailureBursts(InOrder):
    """Counts failures from the first one for `limit` microseconds; a success wipes the count."""

    payload = "failed boolean"
    memory = "first long, last long, n long"
    output = "first_ts long, last_ts long, n_fails long"
    times = ("first_ts", "last_ts")

    def __init__(self, at_least: int, limit: int):
        self.at_least, self.limit = at_least, limit

    def start(self):
        return (None, None, 0)

    def on_row(self, state, row):
        at, _, failed = row
        if not failed:
            return self.start(), []
        first, _, n = state
        return (at if first is None else first, at, n + 1), []

    def deadline(self, state):
        return None if state[0] is None else state[0] + self.limit

    def on_deadline(self, state):
        first, last, n = state
        return self.start(), [(first, last, n)] if n >= self.at_least else []


class OrderTimeout(InOrder):
    """Matches every create of an order with the pay that comes next inside `limit` microseconds.

    A create that follows an open one replaces it. Nothing is remembered but the open create.
    """

    payload = "kind string"
    memory = "created long"
    output = "outcome string, create_ts long, pay_ts long"
    times = ("create_ts", "pay_ts")

    def __init__(self, limit: int):
        self.limit = limit

    def start(self):
        return (None,)

    def on_row(self, state, row):
        at, _, kind = row
        if kind == "create":
            return (at,), []
        if state[0] is None:
            return state, [("pay_without_create", None, at)]
        return self.start(), [("paid", state[0], at)]

    def deadline(self, state):
        return None if state[0] is None else state[0] + self.limit

    def on_deadline(self, state):
        return self.start(), [("no_pay", state[0], None)]


class Matches(InOrder):
    """The matches of a pattern, by the automaton that also walks batches; `hits` are the pattern's."""

    payload = "hits long"
    memory = "open array<struct<at array<long>, id array<long>>>"
    output = "outcome string, at array<long>, id array<long>"

    def __init__(self, pattern: Pattern):
        self.pattern = replace(pattern, conditions=())  # columns stay on the driver

    def load(self, memory):
        automaton = Automaton(self.pattern)
        for times, ids in memory[0] if memory else ():
            automaton.groups[len(times)].append(tuple(zip(times, ids, strict=True)))
        return automaton

    def dump(self, state):
        opened = [tuple(map(list, zip(*m, strict=True))) for m in state.opened()]
        return (opened,) if opened else None

    def on_row(self, state, row):
        found = []
        state.take(row[:2], row[2], found)
        return state, [self._result(*f) for f in found]

    def deadline(self, state):
        return state.deadline()

    def on_deadline(self, state):
        found = []
        state.expire(state.deadline(), found)
        return state, [self._result(*f) for f in found]

    @staticmethod
    def _result(outcome, match):
        return outcome, [e[0] for e in match], [e[1] for e in match]


class FollowedBy(InOrder):
    """Pairs every start with the next end less than `limit` microseconds later."""

    payload = "kind string"
    memory = "open array<long>"
    output = "start_ts long, end_ts long, outcome string"
    times = ("start_ts", "end_ts")

    def __init__(self, limit: int):
        self.limit = limit

    def load(self, memory):
        return deque(memory[0] if memory else ())

    def dump(self, state):
        return (list(state),) if state else None

    def on_row(self, state, row):
        at, _, kind = row
        if kind == "start":
            state.append(at)
            return state, []
        if kind != "end":
            return state, []
        # A start whose time is up exactly now was not followed in time.
        done = [(s, at, "matched") if at - s < self.limit else (s, None, "timed_out") for s in state]
        state.clear()
        return state, done

    def deadline(self, state):
        return state[0] + self.limit if state else None

    def on_deadline(self, state):
        return state, [(state.popleft(), None, "timed_out")]


class SlidingSpans(InOrder):
    """Sliding counts as spans: neighbouring windows with equal counts are one result, from the first
    window end to the last. A pane of rows comes in at the next window end and goes one size later."""

    payload = "n long"
    memory = "n long, since long, leaving array<struct<at long, n long>>"
    output = "first_end long, last_end long, n long"

    def __init__(self, size: int, slide: int):
        self.size, self.slide = size, slide

    def load(self, memory):
        n, since, leaving = memory or (0, 0, ())
        return [n, since, deque(map(tuple, leaving))]

    def dump(self, state):
        return (state[0], state[1], list(state[2])) if state[2] else None

    def _move(self, state, at: int, by: int) -> list[tuple]:
        n, since, _ = state
        span = [(since, at - self.slide, n)] if n and at > since else []
        state[0], state[1] = n + by, at
        return span

    def on_row(self, state, row):
        end = row[0] // self.slide * self.slide + self.slide
        found = []
        while state[2] and state[2][0][0] <= end:
            at, n = state[2].popleft()
            found += self._move(state, at, -n)
        found += self._move(state, end, row[2])
        state[2].append((end + self.size, row[2]))
        return state, found

    def deadline(self, state):
        return state[2][0][0] if state[2] else None

    def on_deadline(self, state):
        at, n = state[2].popleft()
        return state, self._move(state, at, -n)


class EarlyResults(InOrder):
    """Row counts of daily windows: on every n-th row, every `interval` if set, and at the end.

    With `purge` a firing gives the rows since the one before and forgets them, so the parts of a window add
    up to its count; a firing without new rows gives nothing.
    """

    payload = ""
    memory = "day long, n long, fired long, next_fire long"
    output = "day date, n long, fired_by string"
    DAY = 86_400_000_000

    def __init__(self, every_rows: int, interval: int | None = None, purge: bool = False):
        self.every_rows, self.interval, self.purge = every_rows, interval, purge

    def start(self):
        return (None, 0, 0, None)

    def _fire(self, day: int, n: int, fired: int, by: str) -> list[tuple]:
        if not self.purge:
            return [(_date(day), n, by)]
        return [(_date(day), n - fired, by)] if n > fired else []

    def on_row(self, state, row):
        at = row[0]
        day, n, fired, next_fire = state
        if day is None:
            day = at // self.DAY
            next_fire = at + self.interval if self.interval else None
        n += 1
        if n % self.every_rows:
            return (day, n, fired, next_fire), []
        return (day, n, n, next_fire), self._fire(day, n, fired, "count")

    def deadline(self, state):
        day, _, _, next_fire = state
        if day is None:
            return None
        end = (day + 1) * self.DAY - 1
        return end if next_fire is None else min(next_fire, end)

    def on_deadline(self, state):
        day, n, fired, next_fire = state
        if next_fire is not None and next_fire < (day + 1) * self.DAY - 1:
            news = n % self.every_rows != 0  # rows since the last firing by count
            found = self._fire(day, n, fired, "interval") if news else []
            return (day, n, n if news else fired, next_fire + self.interval), found
        return self.start(), self._fire(day, n, fired, "end")


class DailyLimit(InOrder):
    """Numbers the rows of a key within its local day; the count starts anew at midnight."""

    payload = ""
    memory = "day long, n long"
    output = "id long, at long, day date, nth long"
    DAY = 86_400_000_000

    def __init__(self, zone_hours: int):
        self.shift = zone_hours * 3_600_000_000

    def start(self):
        return (None, 0)

    def on_row(self, state, row):
        day = (row[0] + self.shift) // self.DAY
        n = state[1] + 1 if state[0] == day else 1
        return (day, n), [(row[1], row[0], _date(day), n)]


class Heartbeat(StatefulProcessor):
    """Emits a key's row count whenever its processing-time timer fires, then arms it again."""

    def __init__(self, key: list[str], every_ms: int):
        self.result_names, self.every_ms = [*key, "n"], every_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self._count.get()[0] if self._count.exists() else None
        self._count.update(((known or 0) + sum(1 for _ in rows),))
        if known is None:
            self._handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.every_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.every_ms)
        yield Row(*self.result_names)(*key, self._count.get()[0])

    def close(self) -> None:
        pass


def _date(day: int) -> date:
    return date(1970, 1, 1) + timedelta(days=day)
