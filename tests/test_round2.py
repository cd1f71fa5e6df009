"""Answers that earlier versions got wrong: types of order columns, nulls, late changes, repeats."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.functions import scalar
from tidemark.functions.udfs import WeightedAverage, aggregate_with
from tidemark.operators import patterns
from tidemark.operators.changelog import fold_to_current, parse_capture
from tidemark.operators.rows import parse_json, parse_lines
from tidemark.operators.slices import running, with_neighbours
from tidemark.operators.windows import seconds
from tidemark.session import shared_dir
from tidemark.sinks.writers import KeyedTable

ORDERS = {
    "date": [dt.date(2020, 1, 1) + dt.timedelta(i // 3) for i in range(60)],
    "string": ["k%03d" % (i // 2) for i in range(60)],
    "decimal(38,10)": [decimal.Decimal(i) * 10 ** 20 for i in range(60)],
    "int": [None if i % 7 == 0 else 5 for i in range(60)],
}


@pytest.mark.parametrize("kind", ORDERS)
@pytest.mark.parametrize("keys", [["k"], []])
def test_cuts_take_any_order_type(spark, kind, keys):
    rows = [(i % 2 if i % 5 else None, o, i) for i, o in enumerate(ORDERS[kind])]
    df = spark.createDataFrame(rows, f"k int, o {kind}, n int")
    window = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("o", "n")
    want = df.withColumns({"s": F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, 0)),
                           "p": F.lag("n").over(window)})
    back = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(F.desc("o"), F.desc("n"))
    want = want.withColumn("m", F.max("n").over(back.rowsBetween(Window.unboundedPreceding, 0)))
    got = running(df, keys, ["o", "n"], {"s": ("sum", "n")}, rows_per_slice=4)
    got = with_neighbours(got, keys, ["o", "n"], lambda r, w: r.withColumn("p", F.lag("n").over(w)), before=1,
                          rows_per_slice=4)
    got = running(got, keys, ["o", "n"], {"m": ("max", "n")}, rows_per_slice=4, backwards=True)
    names = ["n", "s", "p", "m"]
    assert sorted(map(str, got.select(names).collect())) == sorted(map(str, want.select(names).collect()))


def test_work_without_keys_is_never_one_task(spark):
    df = spark.range(100).select(F.col("id").alias("o"))
    got = running(df, [], ["o"], {"s": ("sum", "o")})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.filter("s <> o * (o + 1) / 2").count() == 0
    # Only the totals of slices meet in one task, never the rows.
    assert all("_slice" in line or "partial" in line or "_sl_" in line
               for line in plan.split("\n") if "SinglePartition" in line) or plan.count("SinglePartition") <= 1


def test_orders_are_paid_cycle_after_cycle(spark):
    events = [(1, "pay", 0), (1, "create", 10), (1, "pay", 20), (2, "create", 0), (2, "pay", 5),
              (2, "create", 9), (2, "pay", 12), (3, "create", 0), (3, "create", 4), (3, "pay", 6)]
    df = spark.createDataFrame([(i, *e) for i, e in enumerate(events)], "n long, o long, kind string, s long")
    df = df.withColumn("ts", scalar.from_epoch(F.col("s")))
    for options in ({}, {"rows_per_slice": 1}):
        found = patterns.order_outcomes(df, ["o"], ["ts", "n"], "kind", "15 minutes", **options)
        assert rows_of(found, "o", "outcome") == [
            (1, "paid"), (1, "pay_without_create"), (2, "paid"), (2, "paid"), (3, "paid")]


def test_unknown_operations_do_not_vanish(spark):
    rows = [('{"operation":"r","data":{"id":1,"v":2}}',), ('{"operation":"truncate","data":{"id":1,"v":3}}',)]
    df = spark.createDataFrame(rows, "value string")
    known = parse_capture(df.limit(1), "id int, v int")
    assert known.first().op_type == "I"
    with pytest.raises(Exception, match="unknown operation"):
        parse_capture(df, "id int, v int").collect()
    kept = parse_capture(df, "id int, v int", on_unknown="PERMISSIVE")
    assert sorted(str(r.op_type) for r in kept.collect()) == ["I", "None"]
    changes = spark.createDataFrame([(1, 1, "I"), (1, 2, None), (2, 1, "D")], "id int, seq int, op_type string")
    assert [r.id for r in fold_to_current(changes, ["id"], ["seq"]).collect()] == [1]


def test_blank_records_are_dropped(spark):
    df = spark.createDataFrame([("",), (" \t",), (None,), ("1,a",), ('{"a":1}',)], "value string")
    assert parse_lines(df.filter("value not like '{%' or value is null"), "x int, y string",
                       on_error="DROPMALFORMED").count() == 1
    assert parse_json(df, "a int").count() == 1


def test_large_keys_stay_apart_beside_null(spark):
    rows = [(9007199254740992, 1.0), (9007199254740993, 5.0), (None, 7.0), (9007199254740993, 5.0)]
    df = spark.createDataFrame(rows, "k long, v double").coalesce(1)
    got = aggregate_with(df, ["k"], "v", WeightedAverage())
    assert sorted(map(tuple, got.collect()), key=str) == [
        (9007199254740992, 1.0), (9007199254740993, 5.0), (None, 7.0)]
    times = [(9007199254740993, 0, 1), (9007199254740993, 1, 2), (9007199254740993, 100, 3), (None, 0, 1), (None, 1, 2)]
    df = spark.createDataFrame([(k, i, s, v) for i, (k, s, v) in enumerate(times)], "k long, n long, s long, v int")
    df = df.withColumn("ts", scalar.from_epoch(F.col("s")))
    found = patterns.not_falling(df, ["k"], ["ts", "n"], "v", "10 seconds")
    assert 9007199254740993 in {r.k for r in found.collect()}


def test_an_older_change_in_a_later_batch_changes_nothing(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], "seq")
    table.upsert(spark.createDataFrame([(1, 5, "new")], "id int, seq int, v string"), 0)
    table.upsert(spark.createDataFrame([(1, 2, "old"), (2, 1, "x")], "id int, seq int, v string"), 1)
    assert rows_of(table.current(), "id", "v") == [(1, "new"), (2, "x")]
    assert [(r.row_kind, r.id) for r in table.changes_of(1).collect()] == [("+I", 2)]


def test_keys_as_text_differ(spark):
    rows = [("a_b", "c"), ("a", "b_c"), ("a", None), ("a", ""), (None, "a"), ("a\\", "b"), ("a\\_b\\", "c"),
            ("a\\", "b_c"), ("\\N", "a"), ("a", "\\N")]
    df = spark.createDataFrame(rows, "x string, y string")
    texts = {r[0] for r in df.select(scalar.composite_key(F.col("x"), F.col("y"))).collect()}
    assert len(texts) == len(rows)


def test_durations():
    assert seconds("500 milliseconds") == 0.5 and seconds("1 hour 30 minutes") == 5400


def test_a_cluster_needs_a_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda name, default=None: None)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session)
