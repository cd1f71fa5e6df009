"""Group windows, OVER windows and rankings."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import lateness, topn, windows
from tidemark.operators.aggregates import first_rows
from tidemark.operators.slices import running, running_top, with_neighbours
from tidemark.plans import sql
from tidemark.plans.registry import Tables, query

ORDER = ["ts", "event_id"]
COUNT = "count(*) AS n"
TOTAL = "round(sum(value), 2) AS total"
H = sql.HOUR

HOT = f"""
    SELECT window_end, item, n, rk FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY n DESC, item) AS INTEGER) AS rk
        FROM (SELECT window_end, item, count(*) AS n FROM {sql.hops(sql.VIEWS, 24 * H, 6 * H)}
            GROUP BY 1, 2)) WHERE rk <= 3"""


@query("hot_items_top3", HOT)
def hot_items_top3(t: Tables) -> DataFrame:
    ranked = topn.hot_items(t.views, "item", "ts", "24 hours", "6 hours", 3)
    return ranked.select("window_end", "item", "n", "rk")


@query("hot_items_sql", HOT)
def hot_items_sql(t: Tables) -> DataFrame:
    """The same question as nested SQL."""
    counted = t.spark.sql(
        """SELECT window.end AS window_end, item, count(*) AS n
           FROM {views} GROUP BY window(ts, '24 hours', '6 hours'), item""", views=t.views)
    return t.spark.sql(
        """SELECT window_end, item, n, rk FROM (
               SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY n DESC, item) AS rk
               FROM {counted}) WHERE rk <= 3""", counted=counted)


@query("hot_urls_top5", f"""
    SELECT window_end, item, n, rk FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY n DESC, item) AS INTEGER) AS rk
        FROM (SELECT window_end, item, count(*) AS n
            FROM {sql.hops(sql.VIEWS, 48 * H, 2 * H)} GROUP BY 1, 2)) WHERE rk <= 5""")
def hot_urls_top5(t: Tables) -> DataFrame:
    """24 windows per row, so rows are aggregated into panes first."""
    ranked = topn.hot_items(t.views, "item", "ts", "48 hours", "2 hours", 5)
    return ranked.select("window_end", "item", "n", "rk")


@query("window_all_top2", f"""
    SELECT window_start, window_end, item, n, rk FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY n DESC, item) AS INTEGER) AS rk
        FROM (SELECT window_start, window_end, item, count(*) AS n
            FROM {sql.hops(sql.VIEWS, 10 * H, 5 * H)} GROUP BY 1, 2, 3)) WHERE rk <= 2""")
def window_all_top2(t: Tables) -> DataFrame:
    counts = windows.hop(t.views, ["item"], "ts", "10 hours", "5 hours", {"n": ("count", "1")})
    ranked = topn.top_n(counts, ["window_end"], [F.col("n").desc(), F.col("item")], 2)
    return ranked.select("window_start", "window_end", "item", "n", "rk")


@query("window_all_count", f"""
    SELECT window_start, window_end, count(*) AS n FROM {sql.hops("events", 10 * H, 5 * H)}
    GROUP BY 1, 2""")
def window_all_count(t: Tables) -> DataFrame:
    return windows.hop(t.events, [], "ts", "10 hours", "5 hours", {"n": ("count", "1")})


@query("top3_values", """
    SELECT user_id, event_id, value, CAST(row_number() OVER w AS INTEGER) AS rk FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY value DESC, event_id)
    QUALIFY row_number() OVER w <= 3""")
def top3_values(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_id", "value")
    return topn.top_n(rows, ["user_id"], [F.col("value").desc(), F.col("event_id")], 3)


@query("top3_rows", """
    WITH e AS (SELECT user_id, event_id, row_number() OVER w AS rn, list(value) OVER w AS vs,
            list(event_id) OVER w AS ids
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
    x AS (SELECT user_id, event_id, unnest(vs) AS v, unnest(ids) AS id FROM e),
    r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY v DESC, id) AS rk FROM x)
    SELECT user_id, event_id, max(v) FILTER (rk = 1) AS v1, max(id) FILTER (rk = 1) AS id1,
        max(v) FILTER (rk = 2) AS v2, max(id) FILTER (rk = 2) AS id2,
        max(v) FILTER (rk = 3) AS v3, max(id) FILTER (rk = 3) AS id3
    FROM r GROUP BY 1, 2""", as_text=("id2", "id3"))
def top3_rows(t: Tables) -> DataFrame:
    """After every row the three largest rows of its user so far; among equals the earlier one."""
    entry = F.struct("value", (-F.unix_micros(F.col("ts").cast("timestamp"))).alias("age"),
                     (-F.col("event_id")).alias("id"))
    rows = t.events.select("user_id", *ORDER, "value")
    ranked = running_top(rows, ["user_id"], ORDER, entry, 3)
    slots = []
    for i in (1, 2, 3):
        slots += [F.col(f"_top{i}.value").alias(f"v{i}"), (-F.col(f"_top{i}.id")).alias(f"id{i}")]
    return ranked.select("user_id", "event_id", *slots)


@query("tumble_sum", f"""
    SELECT {sql.bucket("ts", 6 * H)} AS window_start,
        {sql.bucket("ts", 6 * H)} + INTERVAL 6 HOURS AS window_end, user_id, count(*) AS n,
        round(sum(value), 2) AS total FROM events GROUP BY 1, 2, 3""")
def tumble_sum(t: Tables) -> DataFrame:
    return windows.tumble(t.events, ["user_id"], "ts", "6 hours", [COUNT, TOTAL])


@query("tumble_offset", f"""
    SELECT {sql.bucket("ts", 5 * H, H)} AS window_start,
        {sql.bucket("ts", 5 * H, H)} + INTERVAL 5 HOURS AS window_end, event_type, count(*) AS n
    FROM events GROUP BY 1, 2, 3""")
def tumble_offset(t: Tables) -> DataFrame:
    return windows.tumble(t.events, ["event_type"], "ts", "5 hours", [COUNT], "1 hour")


@query("hop_sum", f"""
    SELECT window_start, window_end, user_id, round(sum(value), 2) AS total
    FROM {sql.hops("events", 6 * H, 2 * H)} GROUP BY 1, 2, 3""")
def hop_sum(t: Tables) -> DataFrame:
    summed = windows.hop(
        t.events, ["user_id"], "ts", "6 hours", "2 hours", {"total": ("sum", "value")})
    return summed.withColumn("total", F.round("total", 2))


@query("hop_panes", f"""
    SELECT window_start, window_end, event_type, count(*) AS n, max(value) AS top,
        min(value) AS low, round(sum(value), 2) AS total
    FROM {sql.hops("events", 24 * H, H)} GROUP BY 1, 2, 3""")
def hop_panes(t: Tables) -> DataFrame:
    return by_panes(t.events)


def by_panes(rows: DataFrame) -> DataFrame:
    value = F.col("value")
    summed = windows.hop(rows, ["event_type"], "ts", "24 hours", "1 hour", {
        "n": ("count", "1"), "top": ("max", value), "low": ("min", value),
        "total": ("sum", value)})
    return summed.withColumn("total", F.round("total", 2))


SESSION_AGGS = {"n": ("count", "1"), "total": ("sum", "value")}
SESSIONS = """
    WITH marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 6 HOURS THEN 1 ELSE 0 END AS cut
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    numbered AS (SELECT *, sum(cut) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS UNBOUNDED PRECEDING) AS s FROM marked)
    SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 6 HOURS AS window_end,
        count(*) AS n, round(sum(value), 2) AS total FROM numbered GROUP BY user_id, s"""


@query("session_count", SESSIONS)
def session_count(t: Tables) -> DataFrame:
    return windows.session(t.events, ["user_id"], "ts", "6 hours", SESSION_AGGS).withColumn(
        "total", F.round("total", 2))


@query("tumble_sql", f"""
    SELECT user_id, {sql.bucket("ts", 12 * H)} AS window_start, max(value) AS top, count(*) AS n
    FROM events GROUP BY 1, 2""")
def tumble_sql(t: Tables) -> DataFrame:
    return t.spark.sql(
        """SELECT user_id, window.start AS window_start, max(value) AS top, count(*) AS n
           FROM {events} GROUP BY user_id, window(ts, '12 hours')""", events=t.events)


@query("hop_sql", f"""
    SELECT user_id, window_start, window_end, max(value) AS top
    FROM {sql.hops("events", 6 * H, 3 * H)} GROUP BY 1, 2, 3""")
def hop_sql(t: Tables) -> DataFrame:
    return t.spark.sql(
        """SELECT user_id, window.start AS window_start, window.end AS window_end,
               max(value) AS top
           FROM {events} GROUP BY user_id, window(ts, '6 hours', '3 hours')""", events=t.events)


@query("window_functions", f"""
    SELECT {sql.bucket("ts", 24 * H)} AS window_start,
        {sql.bucket("ts", 24 * H)} + INTERVAL 24 HOURS AS window_end, user_id,
        arg_min(event_id, (ts, event_id)) AS first_event, max(ts) AS last_ts, max(value) AS top,
        CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*) AS average_cents, count(*) AS n
    FROM events GROUP BY 1, 2, 3""")
def window_functions(t: Tables) -> DataFrame:
    """A fold, aggregates and the window bounds side by side."""
    at = F.struct(*ORDER)
    return windows.tumble(t.events, ["user_id"], "ts", "24 hours", [
        F.min_by("event_id", at).alias("first_event"), F.max("ts").alias("last_ts"),
        F.max("value").alias("top"),
        "CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*) AS average_cents",
        COUNT])


COUNT_TUMBLE = """
    SELECT user_id, (rn - 1) // {n} AS window_no, count(*) AS n, round(sum(value), 2) AS total
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
    GROUP BY 1, 2 HAVING count(*) = {n}"""


@query("count_tumble", COUNT_TUMBLE.format(n=5))
def count_tumble(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", *ORDER, "value")
    return windows.count_tumble(rows, ["user_id"], ORDER, 5, [COUNT, TOTAL])


@query("count_tumble_2", COUNT_TUMBLE.format(n=2))
def count_tumble_2(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", *ORDER, "value")
    return windows.count_tumble(rows, ["user_id"], ORDER, 2, [COUNT, TOTAL])


COUNT_SLIDE = """
    SELECT user_id, row_no, n, total FROM (
        SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS row_no,
            count(*) OVER w AS n, round(sum(value) OVER w, 2) AS total
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN {before} PRECEDING AND CURRENT ROW)) WHERE row_no % 2 = 0"""


def _count_slide(t: Tables, size: int) -> DataFrame:
    rows = t.events.select("user_id", *ORDER, "value")
    slid = windows.count_slide(rows, ["user_id"], ORDER, size, 2, {
        "n": F.count("*"), "total": F.sum("value")})
    return slid.withColumn("total", F.round("total", 2))


@query("count_slide", COUNT_SLIDE.format(before=5))
def count_slide(t: Tables) -> DataFrame:
    return _count_slide(t, 6)


@query("count_slide_4", COUNT_SLIDE.format(before=3))
def count_slide_4(t: Tables) -> DataFrame:
    return _count_slide(t, 4)


@query("day_utc8_uv", f"""
    SELECT {sql.bucket("ts", 24 * H, -8 * H)} AS window_start, count(DISTINCT user_id) AS uv
    FROM events GROUP BY 1""")
def day_utc8_uv(t: Tables) -> DataFrame:
    counted = windows.distinct_per_window(t.events, [], "ts", "user_id", "24 hours", "-8 hours")
    return counted.select("window_start", F.col("n_distinct").alias("uv"))


@query("hourly_pv", f"""
    SELECT {sql.bucket("ts", H)} AS window_start, {sql.bucket("ts", H)} + INTERVAL 1 HOUR AS window_end,
        count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1, 2""")
def hourly_pv(t: Tables) -> DataFrame:
    return windows.tumble(t.of_type("view"), [], "ts", "1 hour", [COUNT])


@query("manual_window", """
    SELECT user_id, make_timestamp(epoch_us(ts) // 36000000000 * 36000000000) AS window_start,
        count(*) AS n FROM events GROUP BY 1, 2""")
def manual_window(t: Tables) -> DataFrame:
    counted = windows.tumble(t.events, ["user_id"], "ts", "10 hours", [COUNT])
    return counted.select("user_id", "window_start", "n")


JITTERED = """(SELECT event_id, user_id, value,
    ts - (event_id * 7 % 5) * INTERVAL 1 HOUR AS ts FROM events)"""


def jittered(t: Tables) -> DataFrame:
    """Events whose times lie up to four hours before their arrival order suggests."""
    back = F.make_dt_interval(hours=(F.col("event_id") * 7 % 5).cast("int"))
    return t.events.select("event_id", "user_id", "value", (F.col("ts") - back).alias("ts"))


LATE_ARGS = ("2 hours", "1 hour", "30 minutes", "30 minutes")
NEWEST = f"""(SELECT *, max(ts) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS newest
    FROM {JITTERED})"""


@query("late_rows", f"""
    SELECT event_id, user_id, ts FROM {NEWEST}
    WHERE {sql.bucket("ts", H)} + INTERVAL 3 HOURS <= newest""")
def late_rows(t: Tables) -> DataFrame:
    late = lateness.late_rows(jittered(t), ["event_id"], "ts", *LATE_ARGS)
    return late.select("event_id", "user_id", "ts")


@query("late_windows", f"""
    SELECT user_id, window_start, window_end, count(*) AS n, round(sum(value), 2) AS total
    FROM {sql.hops(NEWEST, 2 * H, H)} WHERE window_end + INTERVAL 1 HOUR > newest
    GROUP BY 1, 2, 3""")
def late_windows(t: Tables) -> DataFrame:
    return lateness.on_time_windows(
        jittered(t), ["user_id"], ["event_id"], "ts", *LATE_ARGS, [COUNT, TOTAL])


@query("over_range", """
    SELECT event_id, item, n, CAST(sum(n) OVER (PARTITION BY item ORDER BY hour) AS BIGINT) AS total FROM (
        SELECT min(event_id) AS event_id, item, date_trunc('hour', ts) AS hour, count(*) AS n
        FROM %s GROUP BY item, date_trunc('hour', ts), user_id %% 2)""" % sql.VIEWS)
def over_range(t: Tables) -> DataFrame:
    """Rows of one hour are peers and share the value."""
    hours = t.views.groupBy(
        "item", F.date_trunc("hour", "ts").alias("hour"), (F.col("user_id") % 2).alias("half")
    ).agg(F.min("event_id").alias("event_id"), F.count("*").alias("n"))
    summed = running(hours, ["item"], ["hour"], {"total": ("sum", F.col("n"))}, peers=True)
    return summed.select("event_id", "item", "n", "total")


def _over_rows(t: Tables, before: int) -> DataFrame:
    def body(rows: DataFrame, window) -> DataFrame:
        return rows.withColumn("total", F.round(
            F.sum("value").over(window.rowsBetween(-before, 0)), 2))

    rows = t.events.select("user_id", *ORDER, "value")
    summed = with_neighbours(rows, ["user_id"], ORDER, body, before=before)
    return summed.select("event_id", "user_id", "total")


OVER_ROWS = """
    SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS BETWEEN {n} PRECEDING AND CURRENT ROW), 2) AS total FROM events"""


@query("over_rows4", OVER_ROWS.format(n=3))
def over_rows4(t: Tables) -> DataFrame:
    return _over_rows(t, 3)


@query("over_rows3", OVER_ROWS.format(n=2))
def over_rows3(t: Tables) -> DataFrame:
    return _over_rows(t, 2)


@query("first_per_day", """
    SELECT user_id, CAST(ts AS DATE) AS day, event_id, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1""",
       as_text=("day",))
def first_per_day(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", F.to_date("ts").alias("day"), "event_id", "ts")
    return first_rows(rows, ["user_id", "day"], ORDER)
