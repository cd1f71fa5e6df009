"""Keyed aggregates over the event and document tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.udfs import TopValues, WeightedAverage, aggregate_with
from tidemark.operators import aggregates as agg
from tidemark.operators.rows import words
from tidemark.operators.slices import running
from tidemark.operators.windows import distinct_per_window, hop
from tidemark.plans import sql
from tidemark.plans.registry import Tables, item_of, query

ORDER = ["ts", "event_id"]
# Averages are taken over whole cents, whose sums do not depend on the order of addition.
CENTS = "CAST(round(value * 100) AS BIGINT) AS cents"


@query("word_count", r"""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split_regex(text, '[ \n\t\r]+')) AS word FROM documents)
    WHERE word <> '' GROUP BY word""")
def word_count(t: Tables) -> DataFrame:
    return words(t.documents, "text").groupBy("word").agg(F.count("*").alias("n"))


@query("running_sum", """
    SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS UNBOUNDED PRECEDING), 2) AS total FROM events""")
def running_sum(t: Tables) -> DataFrame:
    rows = t.events.select(*ORDER, "user_id", "value")
    summed = running(rows, ["user_id"], ORDER, {"total": ("sum", "value")})
    return summed.select("event_id", "user_id", F.round("total", 2).alias("total"))


@query("max_field", """
    SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id, min(ts) AS ts,
        max(value) AS value FROM events GROUP BY user_id""")
def max_field(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_id", "ts", "value")
    return agg.max_field(rows, ["user_id"], "value", ORDER)


@query("max_row", """
    SELECT user_id, event_id, ts, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id
        ORDER BY value DESC, ts DESC, event_id DESC) = 1""")
def max_row(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_id", "ts", "event_type", "value")
    return agg.max_row(rows, ["user_id"], "value", ORDER)


@query("reduce_fold", """
    SELECT user_id, arg_min(event_id, (ts, event_id)) AS first_event, max(ts) AS last_ts,
        max(value) AS top_value FROM events GROUP BY user_id""")
def reduce_fold(t: Tables) -> DataFrame:
    return agg.reduce_rows(t.events, ["user_id"], ORDER, {
        "first_event": ("first", "event_id"),
        "last_ts": ("last", "ts"),
        "top_value": ("max", "value"),
    })


@query("running_count", """
    SELECT event_id, event_type, user_id % 7 AS channel, count(*) OVER (
        PARTITION BY event_type, user_id % 7 ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n
    FROM events""")
def running_count(t: Tables) -> DataFrame:
    rows = t.events.select(*ORDER, "event_type", (F.col("user_id") % 7).alias("channel"))
    counted = running(rows, ["event_type", "channel"], ORDER, {"n": ("count", "1")})
    return counted.select("event_id", "event_type", "channel", "n")


@query("count_by_two_keys", """
    SELECT user_id % 7 AS province, CAST(json_extract_string(props, '$.k') AS INTEGER) AS ad_id,
        count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1, 2""")
def count_by_two_keys(t: Tables) -> DataFrame:
    keys = [(F.col("user_id") % 7).alias("province"), item_of(F.col("props")).alias("ad_id")]
    return t.of_type("click").groupBy(*keys).agg(F.count("*").alias("n"))


@query("running_distinct", """
    SELECT user_id, event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS seen
    FROM (SELECT user_id, event_id, ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1)""")
def running_distinct(t: Tables) -> DataFrame:
    return agg.running_distinct(t.events, "user_id", ORDER)


@query("total_users", "SELECT count(DISTINCT user_id) AS n_users FROM events")
def total_users(t: Tables) -> DataFrame:
    return t.events.agg(F.countDistinct("user_id").alias("n_users"))


@query("dedupe_first", f"""
    SELECT user_id, item, event_id, ts FROM {sql.VIEWS}
    QUALIFY row_number() OVER (PARTITION BY user_id, item ORDER BY ts, event_id) = 1""")
def dedupe_first(t: Tables) -> DataFrame:
    rows = t.views.select("user_id", "item", "event_id", "ts")
    return agg.first_rows(rows, ["user_id", "item"], ORDER)


@query("sql_group_agg", """
    SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, max(value) AS top
    FROM events WHERE value >= 30 GROUP BY event_type""")
def sql_group_agg(t: Tables) -> DataFrame:
    return t.spark.sql(
        """SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, max(value) AS top
           FROM {events} WHERE value >= 30 GROUP BY event_type""", events=t.events)


@query("table_group_agg", """
    SELECT o_custkey, count(*) AS n, max(o_orderdate) AS newest FROM orders
    WHERE o_orderstatus = 'F' GROUP BY o_custkey""")
def table_group_agg(t: Tables) -> DataFrame:
    return (
        t.orders.where(F.col("o_orderstatus") == "F")
        .groupBy("o_custkey")
        .agg(F.count("*").alias("n"), F.max("o_orderdate").alias("newest")))


@query("running_avg", """
    SELECT event_id, user_id, CAST(sum(c) OVER w AS DOUBLE) / count(c) OVER w AS average_cents
    FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS c FROM events)
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def running_avg(t: Tables) -> DataFrame:
    rows = t.events.selectExpr(*ORDER, "user_id", CENTS)
    folded = running(rows, ["user_id"], ORDER, {"s": ("sum", "cents"), "n": ("count", "cents")})
    return folded.select(
        "event_id", "user_id", (F.col("s") / F.col("n")).alias("average_cents"))


@query("avg_every_5th", """
    SELECT user_id, event_id, n_rows, average FROM (
        SELECT user_id, event_id, count(*) OVER w AS n_rows,
            CAST(sum(epoch_us(ts)) OVER w // count(*) OVER w AS BIGINT) AS average
        FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
    WHERE n_rows % 5 = 0""")
def avg_every_5th(t: Tables) -> DataFrame:
    rows = t.events.select(*ORDER, "user_id")
    return agg.average_every(rows, ["user_id"], ORDER, agg.time_of(rows, "ts"), 5).drop("ts")


@query("pv_uv_ratio", f"""
    SELECT window_start, window_end, count(*) AS pv, count(DISTINCT user_id) AS uv,
        count(*) / count(DISTINCT user_id) AS ratio
    FROM {sql.hops("events", 24 * sql.HOUR, 6 * sql.HOUR)} GROUP BY 1, 2""")
def pv_uv_ratio(t: Tables) -> DataFrame:
    per_user = hop(t.events, ["user_id"], "ts", "24 hours", "6 hours", {"n": ("count", "1")})
    return per_user.groupBy("window_start", "window_end").agg(
        F.sum("n").alias("pv"), F.count("*").alias("uv")
    ).withColumn("ratio", F.col("pv") / F.col("uv"))


@query("approx_users", f"""
    SELECT {sql.bucket("ts", sql.HOUR)} AS hour, count(DISTINCT user_id) AS n_users, true AS within_bound
    FROM events GROUP BY 1""")
def approx_users(t: Tables) -> DataFrame:
    """Distinct users per hour by mergeable sketches, beside the exact number: a sketch of 2**14
    slots is off by 0.8 percent on average, and here by 4 percent (5 deviations) and one at most."""
    hour = F.window("ts", "1 hour").start.alias("hour")
    sketched = t.events.groupBy(hour).agg(F.hll_sketch_agg("user_id", 14).alias("sketch")).select(
        "hour", F.hll_sketch_estimate("sketch").alias("estimate"))
    exact = distinct_per_window(t.events, [], "ts", "user_id", "1 hour").select(
        F.col("window_start").alias("hour"), F.col("n_distinct").alias("n_users"))
    off = F.abs(F.col("estimate") - F.col("n_users"))
    return exact.join(sketched, "hour").select(
        "hour", "n_users", (off <= 0.04 * F.col("n_users") + 1).alias("within_bound"))


@query("exact_users", f"""
    SELECT {sql.bucket("ts", sql.HOUR)} AS hour, count(DISTINCT user_id) AS n_users
    FROM events GROUP BY 1""")
def exact_users(t: Tables) -> DataFrame:
    counted = distinct_per_window(t.events, [], "ts", "user_id", "1 hour")
    return counted.select(
        F.col("window_start").alias("hour"), F.col("n_distinct").alias("n_users"))


@query("users_bitmap", f"""
    SELECT 'hour' AS level, {sql.bucket("ts", sql.HOUR)} AS start, count(DISTINCT user_id) AS n_users
        FROM events GROUP BY 2
    UNION ALL SELECT 'day', {sql.bucket("ts", 24 * sql.HOUR)}, count(DISTINCT user_id) FROM events GROUP BY 2
    UNION ALL SELECT 'all', NULL, count(DISTINCT user_id) FROM events""")
def users_bitmap(t: Tables) -> DataFrame:
    """Exact distinct users per hour as bitmaps, and from those bitmaps per day and over all: an hour is read
    once, however many longer spans it counts in."""
    hour = F.window("ts", "1 hour").start.alias("hour")
    hours = agg.distinct_bitmaps(t.events.filter("user_id is not null"), [hour], "user_id")
    days = agg.merged_bitmaps(hours, [F.window("hour", "1 day").start.alias("day")])
    whole = agg.merged_bitmaps(days, [])
    parts = [("hour", hours, F.col("hour")), ("day", days, F.col("day")), ("all", whole, F.lit(None))]
    counted = [
        agg.bitmap_counts(df, [at.cast("timestamp_ntz").alias("start")]).select(
            F.lit(level).alias("level"), "start", F.col("n_distinct").alias("n_users"))
        for level, df, at in parts]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query("salted_count", f"""
    SELECT event_type, {sql.bucket("ts", sql.HOUR)} AS hour, count(*) AS n,
        round(sum(value), 2) AS total FROM events GROUP BY 1, 2""")
def salted_count(t: Tables) -> DataFrame:
    rows = t.events.withColumn("hour", F.window("ts", "1 hour").start)
    summed = agg.salted_aggregate(
        rows, ["event_type", "hour"],
        {"n": ("count", "1"), "total": ("sum", "value")}, ["event_id"])
    return summed.withColumn("total", F.round("total", 2))


@query("global_count", "SELECT count(*) AS n FROM lineitem")
def global_count(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count("*").alias("n"))


@query("global_running_count", """
    SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS n FROM events""")
def global_running_count(t: Tables) -> DataFrame:
    counted = running(t.events.select(*ORDER), [], ORDER, {"n": ("count", "1")})
    return counted.select("event_id", "n")


AVERAGE_SQL = """
    SELECT {key}, CAST(sum(c) AS DOUBLE) / count(c) AS average
    FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS c FROM events) WHERE {kept} GROUP BY 1"""


@query("weighted_avg", AVERAGE_SQL.format(key="event_type", kept="true"))
def weighted_avg(t: Tables) -> DataFrame:
    rows = t.events.selectExpr("event_type", CENTS)
    return aggregate_with(rows, ["event_type"], "cents", WeightedAverage())


@query("weighted_avg_retracted", AVERAGE_SQL.format(key="user_id", kept="event_type <> 'error'"))
def weighted_avg_retracted(t: Tables) -> DataFrame:
    """All rows are added, then the error rows are taken back."""
    plus = t.events.selectExpr("user_id", CENTS, "1 AS sign")
    minus = t.of_type("error").selectExpr("user_id", CENTS, "-1 AS sign")
    return aggregate_with(
        plus.unionByName(minus), ["user_id"], "cents", WeightedAverage(), sign="sign")


@query("top3_values_aggregate", """
    SELECT user_id, value, CAST(row_number() OVER w AS INTEGER) AS rk FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY value DESC)
    QUALIFY row_number() OVER w <= 3""")
def top3_values_aggregate(t: Tables) -> DataFrame:
    return aggregate_with(t.events, ["user_id"], "value", TopValues(3))
