"""Timer chains over slices, patterns as data, wide sliding windows, single-pass reconciliation, whole
microseconds, streams that take back, retain, buffer and resume."""

import datetime as dt
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import joins, patterns, windows
from tidemark.operators import aggregates as agg
from tidemark.operators.automaton import MATCHED, TIMED_OUT, Automaton, begin, match_pattern
from tidemark.sources import custom
from tidemark.streaming import processors as ps
from tidemark.streaming.changes import (
    Entries, JoinedChanges, NetChanges, full_groups, live_rows, retained_join, retracting_join)
from tidemark.streaming.run import StreamRun

EPOCH = dt.datetime(2020, 1, 1)


def timed(spark, rows, ddl, unit=1_000_000):
    """Rows with a time `ts` from their column `s`, in units of so many microseconds."""
    return spark.createDataFrame(rows, ddl).withColumn("ts", F.timestamp_micros(F.col("s") * unit))


def walk(seed, keys=(None, 1, 2), n=150):
    rng, rows = random.Random(seed), []
    for k in keys:
        t = 0
        for _ in range(n):
            t += rng.choice([0, 1, 1, 2, 5, 30])
            rows.append((k, t, len(rows), rng.choice("abcx")))
    return rows


def by_key(rows):
    found = {}
    for row in sorted(rows, key=lambda r: r[1:3]):
        found.setdefault(row[0], []).append(row)
    return found


@pytest.mark.parametrize("limit", [3, 20, 400])
@pytest.mark.parametrize("size", [7, 40, None])
def test_timer_chains_of_long_runs(spark, limit, size):
    rows, wanted = walk(limit), []
    for k, own in by_key(rows).items():
        first, last, n = None, None, 0
        for _, t, _, kind in [*own, (k, 10**9, 0, "b")]:
            if first is not None and t > first + limit:
                wanted += [(k, first, last, n)] if n > 1 else []
                first, n = None, 0
            if kind == "x":
                first, n = None, 0
                continue
            first, last, n = (t if first is None else first), t, n + 1
    df = timed(spark, rows, "k int, s long, id long, kind string")
    options = {"rows_per_slice": size} if size else {}
    got = patterns.failure_bursts(df, ["k"], ["ts", "id"], "kind <> 'x'", 2, f"{limit} seconds", **options)
    seconds = [F.unix_seconds(c).alias(c) for c in ("first_ts", "last_ts")]
    assert sorted(map(tuple, got.select("k", *seconds, "n_fails").collect()), key=str) == sorted(wanted, key=str)


# Patterns.

PATTERNS = {
    "next": begin("a", "kind = 'a'").next("b", "kind = 'b'").within("4 seconds"),
    "followed": begin("a", "kind = 'a'").followed_by("b", "kind = 'b'").within("10 seconds"),
    "times": begin("a", "kind in ('a', 'b')").times(3, consecutive=True).within("50 seconds"),
    "loose times": begin("a", "kind = 'a'").times(4),
    "mixed": begin("a", "kind = 'a'").next("b", "kind <> 'x'").followed_by("c", "kind in ('c', 'x')").times(2).next(
        "d", "kind <> 'a'").within("30 seconds"),
    "one": begin("a", "kind = 'c'"),
}
FITS = {
    "next": ["a", "b"], "followed": ["a", "b"], "times": ["ab"] * 3, "loose times": ["a"] * 4,
    "mixed": ["a", "abc", "cx", "cx", "bcx"], "one": ["c"]}


def brute_matches(rows, name):
    """Every first row on its own, row by row."""
    pattern, fits, found = PATTERNS[name], FITS[name], []
    limit = pattern.limit and pattern.limit // 1_000_000
    for k, own in by_key(rows).items():
        for i, (_, start, id_, kind) in enumerate(own):
            if kind not in fits[0]:
                continue
            taken, died = [id_], False
            for _, t, other, kind in own[i + 1:]:
                if len(taken) == len(fits) or (limit and t - start >= limit):
                    break
                if kind in fits[len(taken)]:
                    taken.append(other)
                elif pattern.steps[len(taken)][1]:
                    died = True
                    break
            if len(taken) == len(fits):
                found.append((k, MATCHED, taken))
            elif limit and not died:
                found.append((k, TIMED_OUT, taken))
    return sorted(found, key=str)


@pytest.mark.parametrize("name", PATTERNS)
@pytest.mark.parametrize("size", [None, 9])
def test_patterns_against_each_first_row(spark, name, size):
    rows = walk(len(name), n=60)
    df = timed(spark, rows, "k int, s long, id long, kind string")
    got = match_pattern(df, ["k"], ["ts", "id"], PATTERNS[name], size)
    assert sorted(((r.k, r.outcome, r.id) for r in got.collect()), key=str) == brute_matches(rows, name)


def test_many_open_matches_take_linear_time():
    def run(n):
        automaton, found, clock = Automaton(PATTERNS["followed"]), [], time.perf_counter()
        for i in range(n):
            automaton.take((i, i), 1, found)
        automaton.take((n, n), 2, found)
        return len(found), time.perf_counter() - clock

    run(20_000)
    (small, quick), (large, slow) = run(20_000), run(200_000)
    assert (small, large) == (20_000, 200_000) and slow < 40 * quick


# Windows and joins.


@pytest.mark.parametrize("size,slide", [(100, 1), (70, 1), (650, 10)])
def test_changes_give_the_windows_of_rows(spark, size, slide):
    rng = random.Random(size)
    rows = [(rng.choice([None, 1, 2]), rng.randrange(0, 3000), rng.choice([None, 1, 5, -2]), rng.randrange(100))
            for _ in range(60)] + [(1, None, 3, 4)]
    df = timed(spark, rows, "k int, s long, v int, w int").withColumn("d", F.col("w").cast("decimal(10,2)"))
    aggs = {"n": ("count", "1"), "nv": ("count", "v"), "total": ("sum", "v"), "d": ("sum", "d")}
    args = (["k"], "ts", f"{size} seconds", f"{slide} seconds", aggs)
    got, want = windows.hop(df, *args), windows.hop(df, *args, panes=False)
    assert dict(got.dtypes) == dict(want.dtypes)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert windows.hop_spans(df, *args).count() <= 2 * df.count()
    assert not windows.exact_changes(df, {"x": ("sum", F.col("v") * 0.5)})
    assert not windows.exact_changes(df, {"x": ("max", "v")})


def test_shorter_than_a_second(spark):
    rows = [(1, 0, 0), (1, 400, 1), (1, 900, 2), (1, 1500, 3)]
    df = timed(spark, rows, "k int, s long, id long", 1000)
    got = windows.hop(df, ["k"], "ts", "6 seconds", "500 milliseconds", {"n": ("count", "1")})
    assert got.agg(F.sum("n")).first()[0] == 48
    got = windows.hop(df, ["k"], "ts", "1 second", "10 milliseconds", {"n": ("count", "1")})
    assert got.agg(F.sum("n"), F.max("n")).first() == (400, 3)
    right = df.select("k", F.col("id").alias("rid"), F.col("ts").alias("rts"))
    pairs = joins.interval_join(df, right, ["k"], "ts", "rts", "-500 milliseconds", "500 milliseconds")
    assert rows_of(pairs.filter("id < rid"), "id", "rid") == [(0, 1), (1, 2)]
    left = df.filter("id < 2").select("k", "id", "ts")
    found = joins.reconcile(left, right.filter("rid >= 2"), ["k"], "ts", "rts", "500 milliseconds", "0 seconds")
    assert rows_of(found.fillna(-1), "id", "rid", "outcome") == [
        (-1, 3, "right_only"), (0, -1, "left_only"), (1, 2, "matched")]
    values = df.withColumn("v", F.lit(1))
    alerts = patterns.not_falling(values, ["k"], ["ts", "id"], "v", "500 milliseconds")
    assert alerts.count() == 2
    assert windows.micros("-1 second 5 milliseconds") == -1_005_000


@pytest.mark.parametrize("waits", [(4, 2), (0, 3), (5, 0), (0, 0)])
def test_reconciliation_in_one_pass(spark, waits):
    rng = random.Random(str(waits))
    def side(n):
        return [(rng.choice([None, 1, 2]), rng.choice([None, *range(-20, 20)]), i) for i in range(n)]

    lefts, rights, wanted = side(80), side(80), []
    def fits(a, b):
        return a[0] is not None and a[0] == b[0] and None not in (a[1], b[1]) and -waits[1] <= b[1] - a[1] <= waits[0]

    for a in lefts:
        own = [b for b in rights if fits(a, b)]
        wanted += [(a[2], b[2], "matched") for b in own] or [(a[2], -1, "left_only")]
    wanted += [(-1, b[2], "right_only") for b in rights if not any(fits(a, b) for a in lefts)]
    left = timed(spark, lefts, "k int, s long, a long").drop("s").withColumnRenamed("ts", "lt")
    right = timed(spark, rights, "k int, s long, b long").drop("s").withColumnRenamed("ts", "rt")
    found = joins.reconcile(left, right, ["k"], "lt", "rt", f"{waits[0]} seconds", f"{waits[1]} seconds")
    assert rows_of(found.fillna(-1, ["a", "b"]), "a", "b", "outcome") == sorted(wanted)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 2 and plan.count("Scan") <= 2


def test_bitmaps_merge(spark):
    rows = [(i % 3, i * 7919 % 70_000) for i in range(900)] + [(0, 5), (0, 5)]
    df = spark.createDataFrame(rows, "k int, v long")
    sets = agg.distinct_bitmaps(df, ["k"], "v")
    per_key = rows_of(agg.bitmap_counts(sets, ["k"]), "k", "n_distinct")
    assert per_key == [(k, len({v for a, v in rows if a == k})) for k in range(3)]
    whole = agg.bitmap_counts(agg.merged_bitmaps(sets, []), [])
    assert whole.first().n_distinct == len({v for _, v in rows})


# Streams.


class Value:
    def __init__(self):
        self.held, self.moved = None, 0

    def get(self):
        return self.held

    def update(self, value):
        self.held, self.moved = value, self.moved + 1

    def clear(self):
        self.held = None


class Chunks(dict):
    def __init__(self):
        self.moved = 0

    def updateValue(self, key, value):
        self[key], self.moved = value, self.moved + 1

    def getValue(self, key):
        return self[key]

    def removeKey(self, key):
        del self[key]


class Now:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at


class Handle:
    def __init__(self):
        self.timers = set()

    def getValueState(self, *_):
        self.value = Value()
        return self.value

    def getMapState(self, *_):
        self.map = Chunks()
        return self.map

    def registerTimer(self, at):
        self.timers.add(at)


def test_waiting_rows_are_read_when_they_are_due():
    from pyspark.sql import Row

    n, total = 20_000, ps.RunningTotal()
    total.names, total.result_names = ["at", "id", "value"], ["k", "id", "at", "total", "n"]
    handle = Handle()
    total.init(handle)
    rows = [Row(at=i * 1000, id=i, value=1.0) for i in range(n)]
    for low in range(0, n, n // 4):
        assert list(total.handleInputRows((1,), iter(rows[low:low + n // 4][::-1]), Now(-1))) == []
    results = []
    for at in range(0, n, 100):  # two hundred timers, each with a hundred rows due
        results += total.handleExpiredTimer((1,), Now(at), None)
    results += total.handleExpiredTimer((1,), Now(n), None)
    assert [(r.id, r.total) for r in results] == [(i, i + 1.0) for i in range(n)]
    assert not handle.map and handle.map.moved < 300


class Arrivals:
    """A folder into which batches come one after the other."""

    def __init__(self, spark, path, ddl):
        self.spark, self.path, self.ddl, self.n = spark, str(path), ddl, 0

    def bring(self, rows):
        self.n += 1
        self.spark.createDataFrame(rows, self.ddl).coalesce(1).write.parquet(f"{self.path}/{self.n}")

    def stream(self):
        return self.spark.readStream.schema(self.ddl).parquet(f"{self.path}/*")


def test_a_join_takes_back_what_changes(spark, tmp_path):
    ddl = "side string, op_type string, seq string, o int, c int, price int, ck int, name string"
    feed = Arrivals(spark, tmp_path / "in", ddl)
    run, n = StreamRun(spark, "retract"), 0
    result = retracting_join(feed.stream(), "o", "c", "ck", ["price"], ["name"])

    def left(op, seq, o, c, price):
        return ("left", op, seq, o, c, price, None, None)

    def right(op, seq, ck, name):
        return ("right", op, seq, None, None, None, ck, name)

    steps = [
        ([left("I", "1", 1, 10, 5), left("I", "1", 2, None, 6)], {("+I", 1, 5, None), ("+I", 2, 6, None)}),
        ([right("I", "1", 10, "x")], {("-U", 1, 5, None), ("+U", 1, 5, "x")}),
        ([left("U", "3", 1, 11, 7), left("U", "2", 1, 10, 9)], {("-U", 1, 5, "x"), ("+U", 1, 7, None)}),
        ([left("U", "2", 1, 10, 9)], set()),  # older than what is known
        ([right("I", "2", 11, "y"), left("I", "1", 3, 11, 1)],
         {("-U", 1, 7, None), ("+U", 1, 7, "y"), ("+I", 3, 1, "y")}),
        ([right("D", "3", 11, None), left("D", "9", 2, None, None)],
         {("-U", 1, 7, "y"), ("+U", 1, 7, None), ("-U", 3, 1, "y"), ("+U", 3, 1, None), ("-D", 2, 6, None)}),
    ]
    for rows, wanted in steps:
        feed.bring(rows)
        found = run.to_files(result)
        found.cache().count()
        new = [tuple(r) for r in found.collect()]
        assert len(new) - n == len(wanted) and wanted <= set(new), (rows, new[n:])
        n = len(new)
        found.unpersist()
    assert rows_of(live_rows(found), "o", "price", "name") == [(1, 7, None), (3, 1, None)]


class States:
    """A handle for the state of one key, that counts what is read and written."""

    def __init__(self):
        self.calls = 0

    def getValueState(self, *_):
        class One:
            value = None

            def get(own):
                self.calls += 1
                return own.value

            def update(own, value):
                self.calls += 1
                own.value = value

        return One()

    def getMapState(self, *_):
        class Many(dict):
            def getValue(own, key):
                self.calls += 1
                return own[key]

            def updateValue(own, key, value):
                self.calls += 1
                own[key] = value

            def removeKey(own, key):
                self.calls += 1
                del own[key]

        self.map = Many()
        return self.map


def test_a_batch_of_changes_costs_few_calls_to_the_state():
    from pyspark.sql import Row

    def changes(seq):
        return [Row(side="left", row_key=str(i), op_type="U", seq=seq, o=i, price=i + int(seq)) for i in range(5000)]

    states, net = States(), NetChanges(["o", "price"])
    net.init(states)
    assert [r.row_kind for r in net.handleInputRows((0,), iter(changes("1")), None)] == ["+I"] * 5000
    again = list(net.handleInputRows((0,), iter(changes("2")), None))
    assert {(r.row_kind, r.o, r.price) for r in again} == {
        x for i in range(5000) for x in (("-U", i, i + 1), ("+U", i, i + 2))}
    assert list(net.handleInputRows((0,), iter(changes("1")), None)) == []
    assert states.calls < 100


def test_a_join_of_changes_keeps_left_rows_in_chunks(monkeypatch):
    """Random changes of few and of very common links, against a table kept beside them."""
    from pyspark.sql import Row

    monkeypatch.setattr(Entries, "CHUNK", 4)
    chance, states, joined = random.Random(7), States(), JoinedChanges(["o", "price"], ["name"])
    joined.init(states)
    change = Row("side", "row_key", "row_kind", "_link", "o", "price", "name")
    lefts, rights, feed = {}, {}, Counter()
    for _ in range(150):
        rows = []
        for o in chance.sample([None, *range(80)], chance.choice([1, 5, 40])):
            key = None if o is None else str(o)
            if o in lefts:
                rows.append(change("left", key, "-D", lefts[o][0], o, lefts.pop(o)[1], None))
            if chance.random() < 0.7:
                lefts[o] = (chance.choice([None, "a", "a", "a", "b", str(chance.randrange(30))]), chance.random())
                rows.append(change("left", key, "+I", lefts[o][0], o, lefts[o][1], None))
        for link in chance.sample([None, "a", "b", *map(str, range(30))], chance.choice([0, 1, 8])):
            if link in rights:
                rows.append(change("right", link, "-D", link, None, None, rights.pop(link)))
            if chance.random() < 0.7:
                rights[link] = chance.random()
                rows.append(change("right", link, "+I", link, None, None, rights[link]))
        for kind, *row in joined.handleInputRows((0,), iter(rows), None):
            feed[tuple(row)] += 1 if kind in ("+I", "+U") else -1
        assert +feed == Counter((o, price, None if link is None else rights.get(link)) for o, (link, price) in lefts.items())
        assert not -feed
    assert len(states.map) > 5


@pytest.mark.parametrize("ttl,pairs", [(1, []), (600_000, [(1, 7, 8)])])
def test_idle_rows_no_longer_join(spark, tmp_path, ttl, pairs):
    left = Arrivals(spark, tmp_path / "l", "k int, a int")
    right = Arrivals(spark, tmp_path / "r", "k int, b int")
    run = StreamRun(spark, "retained")
    result = retained_join(left.stream(), right.stream(), ["k"], ttl)
    left.bring([(1, 7), (None, 1)])
    assert run.to_files(result).count() == 0
    time.sleep(0.5)
    right.bring([(1, 8), (None, 2)])
    # A new run over the same folder, as after a restart.
    again = StreamRun(spark, "retained", run.path)
    found = again.to_files(retained_join(left.stream(), right.stream(), ["k"], ttl))
    assert rows_of(found, "k", "a", "b") == pairs


def test_groups_stay_full_over_a_restart(spark, tmp_path):
    rows = [(i, EPOCH + dt.timedelta(seconds=i)) for i in range(47)]
    feed = Arrivals(spark, tmp_path / "in", "id long, ts timestamp")
    closes, path = 4_733_510_400_000, None
    for low, high, wanted in ((0, 8, 0), (8, 23, 20), (23, 24, 20), (24, 47, 47)):
        feed.bring(rows[low:high])
        run = StreamRun(spark, "groups", path)
        path = run.path
        timed_rows = run.with_event_time(feed.stream(), "ts", "1 second")
        grouped = full_groups(timed_rows, F.lit(0), ["id"], "id", closes)
        found = run.to_files(grouped, close=high == 47)
        sizes = sorted(r["count"] for r in found.groupBy("group_no").count().collect())
        assert found.count() == wanted and sizes == ([7] if high == 47 else []) + [10] * (wanted // 10)
        assert found.select("id").distinct().count() == wanted


def test_purged_parts_add_up(spark, tables):
    for fires in (ps.EarlyResults(3, purge=True), ps.EarlyResults(4, 3_600_000_000, purge=True)):
        run = StreamRun(spark, "purged")
        rows = ps.shaped(tables.stream("events"), ["user_id"], "ts", "event_id")
        found = run.to_files(ps.in_order(run.with_event_time(rows, "ts", "2 hours"), ["user_id"], fires))
        assert found.filter("n <= 0").count() == 0 and found.select("fired_by").distinct().count() >= 2
        whole = tables.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
        assert rows_of(found.groupBy("user_id", "day").agg(F.sum("n").alias("n")), "user_id", "day", "n") == rows_of(
            whole, "user_id", "day", "n")


# The user-written source.


@pytest.mark.parametrize("size", [1, 7, 64, 10_000])
@pytest.mark.parametrize("end", ["", "\n"])
def test_splits_hold_every_line_once(spark, tmp_path, size, end):
    lines = [f"{i},name {'x' * (i % 9)},{i / 4}" for i in range(30)]
    lines[5] = "5,,"
    (tmp_path / "a.csv").write_text("\n".join([*lines[:20], "", *lines[20:]]) + end)
    (tmp_path / "b.csv").write_text("")
    custom.register(spark)
    for path in (str(tmp_path), f"file://{tmp_path}"):
        reader = spark.read.format("record_folder").option("splitBytes", size).option("columns", "id,name,v")
        df = reader.schema("v double, id long").load(path)
        assert rows_of(df, "id", "v") == [(i, None if i == 5 else i / 4) for i in range(30)]
        assert size > 100 or df.rdd.getNumPartitions() > 3


def test_bad_fields_stop_the_source(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,a\nx,b\n")
    custom.register(spark)
    with pytest.raises(Exception, match="CSV conversion error"):
        spark.read.format("record_folder").schema("id long, name string").load(str(tmp_path)).collect()


def test_rules_go_to_the_stream_and_not_the_stream_to_the_rules(tables, monkeypatch):
    from tidemark.plans import QUERIES

    monkeypatch.setattr(StreamRun, "to_files", lambda self, result: result)
    matched = QUERIES["stream_rule_match"].run(tables)
    plan = matched._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint (strategy=broadcast)" in plan, plan
