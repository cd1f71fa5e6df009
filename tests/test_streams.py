"""Streams cut into several batches: same results as batch, disorder, restart, late rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import patterns, windows
from tidemark.plans.streams import MICROS_PER_HOUR
from tidemark.sinks.writers import KeyedTable
from tidemark.sources.files import from_rows
from tidemark.streaming import processors as ps
from tidemark.streaming.lateness import LateSplit
from tidemark.streaming.run import StreamRun
from tidemark.streaming.views import EnrichedView

SCHEMA = "event_id long, user_id long, ts timestamp, value double, event_type string"


class Folder:
    """A folder that files are dropped into one after another."""

    def __init__(self, spark, path, schema=SCHEMA):
        self.spark, self.path, self.schema, self.n = spark, str(path), schema, 0

    def drop(self, df):
        self.n += 1
        # One file per drop, in a folder whose name keeps the order.
        df.coalesce(1).write.parquet(f"{self.path}/part={self.n:04d}")

    def stream(self):
        reader = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
        return reader.parquet(f"{self.path}/part=*")


@pytest.fixture
def events(tables):
    return tables.events.select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value", "event_type")


@pytest.fixture
def shuffled(spark, tmp_path, events):
    """The events in three files; rows change places with rows up to two hours away."""
    folder = Folder(spark, tmp_path / "in")
    order = F.col("ts").cast("double") + F.pmod(F.xxhash64("event_id"), F.lit(7200))
    numbered = events.withColumn("_o", order)
    cuts = numbered.approxQuantile("_o", [0.4, 0.7], 0.0)
    edges = [float("-inf"), *cuts, float("inf")]
    for low, high in zip(edges, edges[1:]):
        folder.drop(numbered.filter((F.col("_o") > low) & (F.col("_o") <= high)).drop("_o"))
    return folder


def shaped(run, rows, **payload):
    return run.with_event_time(
        ps.shaped(rows, ["user_id"], "ts", "event_id", **payload), "ts", "3 hours")


def test_windows_over_disorder(spark, shuffled, events):
    run = StreamRun(spark, "t")
    rows = run.with_event_time(shuffled.stream(), "ts", "3 hours")
    aggs = ["count(*) AS n", "max(value) AS top"]
    names = ["user_id", "window_start", "window_end", "n", "top"]
    got = run.to_files(windows.tumble(rows, ["user_id"], "ts", "6 hours", aggs))
    assert rows_of(got, *names) == rows_of(
        windows.tumble(events, ["user_id"], "ts", "6 hours", aggs), *names)


def test_sessions_over_disorder(spark, shuffled, events):
    run = StreamRun(spark, "t")
    rows = run.with_event_time(shuffled.stream(), "ts", "3 hours")
    names = ["user_id", "window_start", "window_end", "n"]
    got = run.to_files(windows.session(rows, ["user_id"], "ts", "5 hours", {"n": ("count", "1")}))
    assert rows_of(got, *names) == rows_of(
        windows.session(events, ["user_id"], "ts", "5 hours", {"n": ("count", "1")}), *names)


def test_not_falling_over_disorder(spark, shuffled, events):
    run = StreamRun(spark, "t")
    got = run.to_files(ps.in_order(
        shaped(run, shuffled.stream(), value="value"), ["user_id"],
        ps.NotFalling(6 * MICROS_PER_HOUR)))
    expected = patterns.not_falling(
        events, ["user_id"], ["ts", "event_id"], "value", "6 hours")
    names = ["user_id", "armed_at", "alert_at"]
    assert rows_of(got, *names) == rows_of(expected, *names)


def test_bursts_and_followed_by_over_disorder(spark, shuffled, events):
    run = StreamRun(spark, "t")
    got = run.to_files(ps.in_order(
        shaped(run, shuffled.stream(), failed="event_type IN ('error', 'view')"), ["user_id"],
        ps.FailureBursts(2, 12 * MICROS_PER_HOUR)))
    expected = patterns.failure_bursts(
        events, ["user_id"], ["ts", "event_id"], "event_type IN ('error', 'view')", 2, "12 hours")
    names = ["user_id", "first_ts", "last_ts", "n_fails"]
    assert rows_of(got, *names) == rows_of(expected, *names)

    run = StreamRun(spark, "t")
    kind = "CASE event_type WHEN 'click' THEN 'start' WHEN 'purchase' THEN 'end' END"
    got = run.to_files(ps.in_order(
        shaped(run, shuffled.stream(), kind=kind), ["user_id"], ps.FollowedBy(6 * MICROS_PER_HOUR)))
    expected = patterns.followed_by(
        events, ["user_id"], ["ts", "event_id"], "event_type = 'click'", "event_type = 'purchase'",
        "6 hours")
    assert sorted(got.select("user_id", "start_ts", "outcome").collect()) == sorted(
        expected.select("user_id", "start_ts", "outcome").collect())


def test_restart_continues_from_the_checkpoint(spark, tmp_path, events):
    folder = Folder(spark, tmp_path / "in")
    middle = datetime(2024, 1, 15)
    folder.drop(events.filter(F.col("ts") < F.lit(middle)))

    def query():
        totals = ps.in_order(
            ps.shaped(folder.stream(), ["user_id"], "ts", "event_id", value="value")
            .withWatermark("ts", "0 seconds"), ["user_id"], ps.RunningTotal())
        return totals.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()

    query().awaitTermination()
    folder.drop(events.filter(F.col("ts") >= F.lit(middle)))
    folder.drop(from_rows(spark, [(-1, -1, datetime(2030, 1, 1), 0.0, "x")], SCHEMA))
    query().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).filter("user_id >= 0")
    last = got.groupBy("user_id").agg(F.max("n").alias("n"), F.round(F.max("total"), 2).alias("s"))
    expected = events.groupBy("user_id").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("s"))
    assert rows_of(last, "user_id", "n", "s") == rows_of(expected, "user_id", "n", "s")
    assert got.count() == events.count()


def at(seconds):
    return datetime(2024, 1, 1) + timedelta(seconds=seconds)


def test_late_rows_go_to_the_late_table(spark, tmp_path):
    folder = Folder(spark, tmp_path / "in", "n long, ts timestamp")
    for n, second in enumerate([1, 3, 12, 2, 30, 4]):
        folder.drop(from_rows(spark, [(n, at(second))], "n long, ts timestamp"))
    run = StreamRun(spark, "late")
    split = LateSplit(spark, run.path, [], "ts", "5 seconds", "5 seconds", "2 seconds", "10 seconds",
                      {"c": ("count", "1")})
    run.for_each_batch(folder.stream(), split)
    assert rows_of(split.late(), "n") == [(5,)]
    assert rows_of(split.windows(), "window_start", "c") == [(at(0), 3), (at(10), 1), (at(30), 1)]


def test_repeated_batch_changes_nothing(spark, tmp_path):
    split = LateSplit(spark, str(tmp_path / "late"), [], "ts", "5 seconds", "5 seconds", "0 seconds",
                      "0 seconds", {"c": ("count", "1")})
    first = from_rows(spark, [(1, at(1)), (2, at(20))], "n long, ts timestamp")
    second = from_rows(spark, [(3, at(2)), (4, at(21))], "n long, ts timestamp")
    for _ in range(2):
        split(first, 0)
        split(second, 1)
        split(second, 1)
    assert rows_of(split.late(), "n") == [(3,)]
    assert rows_of(split.windows(), "window_start", "c") == [(at(0), 1), (at(20), 2)]


def test_enriched_view_follows_both_sides(spark, tmp_path):
    view = EnrichedView(spark, str(tmp_path / "view"), "o", "p", "p_link", ["price"], ["name"])
    schema = ("side string, op_type string, seq int, o int, p_link int, price int, p int, name string")

    def batch(i, *changes):
        view(from_rows(spark, changes, schema), i)
        return rows_of(view.current().fillna({"name": "-"}), "o", "price", "name")

    assert batch(0, ("left", "I", 1, 1, 10, 5, None, None), ("left", "I", 1, 2, 11, 6, None, None)) == [
        (1, 5, "-"), (2, 6, "-")]
    assert batch(1, ("right", "I", 2, None, None, None, 10, "nail")) == [(1, 5, "nail"), (2, 6, "-")]
    assert batch(2, ("right", "U", 3, None, None, None, 10, "screw"),
                 ("left", "U", 3, 2, 10, 7, None, None)) == [(1, 5, "screw"), (2, 7, "screw")]
    assert batch(3, ("left", "D", 4, 1, 10, 5, None, None)) == [(2, 7, "screw")]
    assert batch(4, ("right", "D", 5, None, None, None, 10, "screw")) == [(2, 7, "-")]
    kinds = rows_of(view.view.changes_of(4).fillna({"name": "-"}), "row_kind", "o", "name")
    assert kinds == [("+U", 2, "-"), ("-U", 2, "screw")]


def test_time_to_live_and_heartbeat(spark, tmp_path):
    """Processing-time state: run by a short trigger and stopped, since idle batches go on."""
    folder = Folder(spark, tmp_path / "in", "k long, id long")
    folder.drop(from_rows(spark, [(1, 1), (1, 2), (2, 3)], "k long, id long"))
    folder.drop(from_rows(spark, [(1, 4), (3, 5)], "k long, id long"))
    once = folder.stream().groupBy("k").transformWithState(
        ps.SeenRecently(["k"], 3_600_000), "k long, id long", "update", "ProcessingTime")
    beats = folder.stream().groupBy("k").transformWithState(
        ps.Heartbeat(["k"], 500), "k long, n long", "update", "ProcessingTime")
    table = KeyedTable(spark, str(tmp_path / "beats"), ["k"])
    out = {}

    def keep(name):
        def work(rows, batch_id):
            out.setdefault(name, []).extend(tuple(r) for r in rows.collect())
        return work

    for name, df in (("once", once), ("beats", beats)):
        query = df.writeStream.foreachBatch(keep(name)).outputMode("update").option(
            "checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(processingTime="500 milliseconds").start()
        try:
            for _ in range(60):
                if name == "once" and len(out.get(name, [])) >= 3:
                    break
                if name == "beats" and {(1, 3), (2, 1), (3, 1)} <= set(out.get(name, [])):
                    break
                query.awaitTermination(1)
        finally:
            query.stop()
    assert sorted(out["once"]) == [(1, 1), (2, 3), (3, 5)]
    assert {(1, 3), (2, 1), (3, 1)} <= set(out["beats"])
    assert table.keys == ["k"]


def test_early_results_by_interval():
    hour = MICROS_PER_HOUR
    processor = ps.EarlyResults(every_rows=3, interval=5 * hour)
    state, fired = processor.start(), []
    for at_ in (1 * hour, 2 * hour, 10 * hour, 12 * hour):
        state = processor._expire(state, at_ - 1, fired)
        state, found = processor.on_row(state, (at_, at_))
        fired += found
    processor._expire(state, processor.DAY, fired)
    assert [f[1:] for f in fired] == [
        (2, "interval"), (3, "count"), (4, "interval"), (4, "interval"), (4, "end")]


def test_spans_remember_over_batches(spark, tmp_path):
    """A key whose memory holds rows gets more rows before a timer reads that memory."""
    folder = Folder(spark, tmp_path / "in", "k long, at long, id long, n long, ts timestamp")
    start = datetime(2030, 1, 1)
    minutes = [0, 1, 2, 200, 201, 230, 400]
    for minute in minutes:
        ts = start + timedelta(minutes=minute)
        at = int((ts - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
        folder.drop(from_rows(spark, [(1, at, minute, 1, ts)], folder.schema))
    run = StreamRun(spark, "spans")
    rows = run.with_event_time(folder.stream(), "ts", "1 hour")
    size, slide = 5 * MICROS_PER_HOUR, MICROS_PER_HOUR // 60
    found = run.to_files(ps.in_order(rows, ["k"], ps.SlidingSpans(size, slide))).collect()
    base = int((start - datetime(1970, 1, 1)).total_seconds()) // 60
    got = {end: r["n"] for r in found for end in range(
        r["first_end"] // slide - base, r["last_end"] // slide - base + 1)}
    expected = {e: sum(e - 300 <= m < e for m in minutes) for e in range(1, 900)}
    assert got == {e: n for e, n in expected.items() if n}
