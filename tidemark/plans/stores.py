"""Files, keyed tables and processing time, checked through what comes back from them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.registry import Tables, query
from tidemark.session import scratch_path
from tidemark.sinks.writers import KeyedTable, append_delimited
from tidemark.sources import custom
from tidemark.sources.files import TableSpec, read_delimited

PER_TYPE = "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1"


def _delimited(t: Tables) -> str:
    """The events as delimited files, appended by a stream; returns their folder."""
    path = scratch_path(t.spark, "delimited")
    rows = t.stream("events").select(
        "event_id", "event_type", "value", F.unix_micros("ts").alias("at"), "user_id")
    append_delimited(rows, f"{path}/rows", f"{path}/checkpoint", "|").trigger(
        availableNow=True).start().awaitTermination()
    return f"{path}/rows"


@query("delimited_round_trip", PER_TYPE)
def delimited_round_trip(t: Tables) -> DataFrame:
    """Events written as delimited files by a stream and read back with their schema."""
    back = read_delimited(
        t.spark, _delimited(t), "event_id long, event_type string, value double, at long, user_id long", "|")
    return back.groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("record_folder", PER_TYPE)
def record_folder(t: Tables) -> DataFrame:
    """The same files through the user-written source, in splits that cut lines, with two of five columns."""
    custom.register(t.spark)
    reader = t.spark.read.format("record_folder").schema("value double, event_type string").option(
        "columns", "event_id,event_type,value,at,user_id").option("sep", "|").option("splitBytes", 50_000)
    return reader.load(_delimited(t)).groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("declared_table", """
    SELECT CAST(extract(hour FROM ts) AS INTEGER) AS hour, count(*) AS n FROM events GROUP BY 1""")
def declared_table(t: Tables) -> DataFrame:
    """The same files as a declared table whose event time is computed from microseconds."""
    spec = TableSpec(
        "declared_events", "event_id long, event_type string, value double, at long, user_id long", "csv",
        _delimited(t), {"sep": "|"}, {"ts": "timestamp_micros(at)"}, "ts", "2 hours")
    return spec.register(t.spark).groupBy(F.hour("ts").alias("hour")).agg(F.count("*").alias("n"))


@query("keyed_changes", """
    SELECT row_kind, o_orderkey, price FROM (
        SELECT '-U' AS row_kind, o_orderkey, o_totalprice AS price FROM orders WHERE o_orderkey % 3 = 0
        UNION ALL SELECT '+U', o_orderkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 3 = 0)""")
def keyed_changes(t: Tables) -> DataFrame:
    """What a second batch changes in a keyed table: every third order gets a new price, and an older
    price that comes with it for the others changes nothing."""
    table = KeyedTable(t.spark, scratch_path(t.spark, "keyed"), ["o_orderkey"], "seq")
    orders = t.orders.select("o_orderkey", F.col("o_totalprice").alias("price"), F.lit(2).alias("seq"))
    table.upsert(orders, 0)
    third = F.col("o_orderkey") % 3 == 0
    table.upsert(orders.select(
        "o_orderkey", (F.col("price") + 1).alias("price"), F.when(third, 3).otherwise(1).alias("seq")), 1)
    return table.changes_of(1).select("row_kind", "o_orderkey", "price")


@query("processing_time", "SELECT count(*) AS n, true AS in_window FROM events")
def processing_time(t: Tables) -> DataFrame:
    """Windows over the time of processing: every row is in one, and it holds the present."""
    now = t.events.select(F.current_timestamp().alias("proc_time"))
    counted = now.groupBy(F.window("proc_time", "10 minutes").alias("w")).agg(
        F.count("*").alias("n"), F.max("proc_time").alias("last"))
    inside = (F.col("last") >= F.col("w.start")) & (F.col("last") < F.col("w.end"))
    return counted.agg(F.sum("n").alias("n"), F.bool_and(inside).alias("in_window"))


@query("processing_time_sliding", """
    SELECT 'sliding' AS kind, 2 AS n_windows, 2 * count(*) AS n, true AS in_window FROM events
    UNION ALL SELECT 'session', 1, count(*), true FROM events""")
def processing_time_sliding(t: Tables) -> DataFrame:
    """Sliding and session windows over the time of processing: every row in two windows, and in one."""
    now = t.events.select(F.current_timestamp().alias("proc_time"))
    kinds = {
        "sliding": F.window("proc_time", "10 minutes", "5 minutes"), "session": F.session_window("proc_time", "10 minutes")}
    counted = []
    for kind, window in kinds.items():
        rows = now.groupBy(window.alias("w")).agg(F.count("*").alias("n"), F.max("proc_time").alias("last"))
        inside = (F.col("last") >= F.col("w.start")) & (F.col("last") < F.col("w.end"))
        counted.append(rows.agg(
            F.count("*").cast("int").alias("n_windows"), F.sum("n").alias("n"), F.bool_and(inside).alias("in_window")
        ).withColumn("kind", F.lit(kind)))
    return counted[0].unionByName(counted[1])
