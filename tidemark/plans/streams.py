"""Streaming forms. Each reads its table as a stream to the end and returns what it wrote."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import topn, windows
from tidemark.operators.rows import route, words
from tidemark.plans import changes, joined, sequences, sql, windowed
from tidemark.plans.registry import QUERIES, Tables, item_of, query
from tidemark.sinks.writers import KeyedTable
from tidemark.sources.files import from_rows
from tidemark.streaming import processors as ps
from tidemark.streaming.changes import full_groups, live_rows, retained_join, retracting_join
from tidemark.streaming.lateness import LateSplit
from tidemark.streaming.run import StreamRun, plain_times
from tidemark.streaming.views import ControlledBranch, EnrichedView

H = sql.HOUR
DELAY = "2 hours"
MICROS_PER_HOUR = 3_600_000_000
# Half a century before the closing row of a run, and after all events.
CLOSES_MS = 4_733_510_400_000


def twin(name: str):
    """Register the streaming form of a batch query, checked by the same SQL."""
    batch = QUERIES[name]
    return query(f"stream_{name}", batch.sql, batch.as_text)


def events(run: StreamRun, t: Tables, *columns: str, where: str = "true") -> DataFrame:
    rows = t.stream("events").filter(where).selectExpr(*columns)
    return run.with_event_time(rows, "ts", DELAY)


def keyed(run: StreamRun, t: Tables, where: str = "true", **payload: str) -> DataFrame:
    """Events as the processors take them, keyed by user."""
    rows = ps.shaped(t.stream("events").filter(where), ["user_id"], "ts", "event_id", **payload)
    return run.with_event_time(rows, "ts", DELAY)


@twin("tumble_sum")
def tumble_sum(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "tumble")
    rows = events(run, t, "user_id", "ts", "value")
    summed = windows.tumble(rows, ["user_id"], "ts", "6 hours", [windowed.COUNT, windowed.TOTAL])
    return plain_times(run.to_files(summed))


@twin("hop_sum")
def hop_sum(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "hop")
    rows = events(run, t, "user_id", "ts", "value")
    summed = windows.hop(rows, ["user_id"], "ts", "6 hours", "2 hours", {"total": ("sum", "value")})
    return plain_times(run.to_files(summed)).withColumn("total", F.round("total", 2))


@twin("hop_panes")
def hop_panes(t: Tables) -> DataFrame:
    """24 windows per row, by panes: two windowed aggregates under one watermark."""
    run = StreamRun(t.spark, "hop-panes")
    rows = events(run, t, "event_type", "ts", "value")
    return plain_times(run.to_files(windowed.by_panes(rows)))


@query("stream_join_inner", """
    SELECT o_orderkey, l_linenumber, o_totalprice, l_quantity FROM orders JOIN lineitem
    ON o_orderkey = l_orderkey AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 122 DAYS""")
def join_inner(t: Tables) -> DataFrame:
    """Two streams joined on a key. Items ship within 122 days of their order, which bounds the state:
    a side's row is dropped once the watermark has passed all its partners."""
    run = StreamRun(t.spark, "join-inner")
    orders = t.stream("orders").select(
        "o_orderkey", "o_totalprice", F.col("o_orderdate").cast("timestamp").alias("ordered"))
    items = t.stream("lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_shipdate").cast("timestamp").alias("shipped"))
    left = run.with_event_time(orders, "ordered", "1 day")
    right = run.with_event_time(items, "shipped", "1 day")
    on = F.expr("o_orderkey = l_orderkey AND shipped >= ordered AND shipped <= ordered + interval 122 days")
    return run.to_files(left.join(right, on).select("o_orderkey", "l_linenumber", "o_totalprice", "l_quantity"))


@twin("session_count")
def session_count(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "session")
    rows = events(run, t, "user_id", "ts", "value")
    counted = windows.session(rows, ["user_id"], "ts", "6 hours", windowed.SESSION_AGGS)
    return plain_times(run.to_files(counted)).withColumn("total", F.round("total", 2))


@query("stream_session_sql", QUERIES["session_count"].sql)
def session_sql(t: Tables) -> DataFrame:
    """The same windows asked for in SQL over a stream."""
    run = StreamRun(t.spark, "session-sql")
    counted = t.spark.sql(
        """SELECT session_window.start AS window_start, session_window.end AS window_end, user_id,
               count(*) AS n, round(sum(value), 2) AS total
           FROM {rows} GROUP BY user_id, session_window(ts, '6 hours')""",
        rows=events(run, t, "user_id", "ts", "value"))
    return plain_times(run.to_files(counted))


@twin("day_utc8_uv")
def day_utc8_uv(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "uv")
    rows = events(run, t, "user_id", "ts")
    counted = windows.distinct_per_window(rows, [], "ts", "user_id", "24 hours", "-8 hours")
    return plain_times(run.to_files(counted)).select(
        "window_start", F.col("n_distinct").alias("uv"))


@twin("hot_items_top3")
def hot_items_top3(t: Tables) -> DataFrame:
    """A window's counts all leave in the batch that closes it, so ranking them there is final."""
    run = StreamRun(t.spark, "hot")
    rows = t.stream("events").filter("event_type = 'view'").select(
        item_of(F.col("props")).alias("item"), "ts")
    counts = windows.hop(
        run.with_event_time(rows, "ts", DELAY), ["item"], "ts", "24 hours", "6 hours",
        {"n": ("count", "1")})
    ranked = run.to_batch_files(
        counts,
        lambda batch: topn.top_n(batch, ["window_end"], [F.col("n").desc(), F.col("item")], 3)
        .select("window_end", "item", "n", "rk"),
        "window_end timestamp, item int, n long, rk int")
    return plain_times(ranked)


@twin("word_count")
def word_count(t: Tables) -> DataFrame:
    """Running totals; every batch upserts the words it changed."""
    run = StreamRun(t.spark, "words")
    table = KeyedTable(t.spark, f"{run.path}/table", ["word"])
    counts = words(t.stream("documents"), "text").groupBy("word").agg(F.count("*").alias("n"))
    run.for_each_batch(counts, table.upsert, "update")
    return table.current()


@twin("count_by_two_keys")
def count_by_two_keys(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "ads")
    table = KeyedTable(t.spark, f"{run.path}/table", ["province", "ad_id"])
    keys = [(F.col("user_id") % 7).alias("province"), item_of(F.col("props")).alias("ad_id")]
    clicks = t.stream("events").filter("event_type = 'click'")
    counts = clicks.groupBy(*keys).agg(F.count("*").alias("n"))
    run.for_each_batch(counts, table.upsert, "update")
    return table.current()


@twin("global_count")
def global_count(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "count")
    table = KeyedTable(t.spark, f"{run.path}/table", ["all_rows"])
    counts = t.stream("lineitem").groupBy(F.lit(0).alias("all_rows")).agg(F.count("*").alias("n"))
    run.for_each_batch(counts, table.upsert, "update")
    return table.current().select("n")


@query("stream_dedupe", """
    SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events""", as_text=("day",))
def dedupe(t: Tables) -> DataFrame:
    """One row per user, type and day; what was seen is dropped once the watermark passed it."""
    run = StreamRun(t.spark, "dedupe")
    rows = events(run, t, "user_id", "event_type", "to_date(ts) AS day", "ts")
    once = rows.dropDuplicatesWithinWatermark(["user_id", "event_type", "day"])
    # Repeats can lie further apart than the watermark delay, so the table is keyed as well.
    table = KeyedTable(t.spark, f"{run.path}/table", ["user_id", "event_type", "day"], "ts")
    run.for_each_batch(once, table.upsert)
    return table.current().select("user_id", "event_type", "day")


@query("stream_route", """
    SELECT event_id, CASE WHEN value < 30 THEN 'low' WHEN event_type = 'error' THEN 'error'
        ELSE 'main' END AS tag FROM events""")
def route_tags(t: Tables) -> DataFrame:
    """One output folder per tag."""
    run = StreamRun(t.spark, "route")
    routed = route(t.stream("events"), {
        "low": F.col("value") < 30, "error": F.col("event_type") == "error"})

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.select("event_id", "tag").write.mode("overwrite").partitionBy("tag").parquet(
            f"{run.path}/out/batch={batch_id}")

    run.for_each_batch(routed, write)
    return t.spark.read.parquet(f"{run.path}/out").select("event_id", "tag")


def _side(run: StreamRun, t: Tables, kind: str, prefix: str) -> DataFrame:
    rows = joined.renamed(t.stream("events").filter(F.col("event_type") == kind), prefix)
    return run.with_event_time(
        rows.withColumnRenamed("user_id", f"{prefix}_user"), f"{prefix}_ts", DELAY)


@twin("join_interval")
def join_interval(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "interval")
    pays, receipts = _side(run, t, "purchase", "pay"), _side(run, t, "view", "receipt")
    pairs = pays.join(receipts, F.expr("""
        pay_user = receipt_user AND receipt_ts BETWEEN
            pay_ts - INTERVAL 1 HOUR AND pay_ts + INTERVAL 2 HOURS"""))
    return plain_times(run.to_files(pairs)).withColumnRenamed("pay_user", "user_id").drop(
        "receipt_user")


@twin("join_interval_left")
def join_interval_left(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "interval-left")
    clicks, edits = _side(run, t, "click", "click"), _side(run, t, "signup", "change")
    pairs = clicks.join(edits, F.expr("""
        click_user = change_user AND change_ts BETWEEN click_ts - INTERVAL 10 HOURS AND click_ts"""),
        "left_outer")
    return run.to_files(pairs).select(F.col("click_user").alias("user_id"), "click_id", "change_id")


@twin("join_window")
def join_window(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "window-join")
    clicks, buys = _side(run, t, "click", "click"), _side(run, t, "purchase", "buy")
    clicks = clicks.withColumn("click_w", F.window("click_ts", "6 hours"))
    buys = buys.withColumn("buy_w", F.window("buy_ts", "6 hours"))
    pairs = clicks.join(buys, F.expr("click_user = buy_user AND click_w = buy_w"))
    return plain_times(run.to_files(pairs.select(
        F.col("click_user").alias("user_id"), "click_id", "buy_id",
        F.col("click_w.start").alias("window_start"))))


@query("stream_reconcile", """
    SELECT p.event_id AS pay_id, r.event_id AS receipt_id,
        CASE WHEN r.ts IS NULL THEN 'left_only' WHEN p.ts IS NULL THEN 'right_only'
            ELSE 'matched' END AS outcome
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    FULL JOIN (SELECT * FROM events WHERE event_type = 'view') r ON p.user_id = r.user_id
        AND r.ts BETWEEN p.ts - INTERVAL 2 HOURS AND p.ts + INTERVAL 4 HOURS""",
       as_text=("pay_id", "receipt_id"))
def reconcile(t: Tables) -> DataFrame:
    """Both sides wait for each other; who waited in vain leaves when the watermark says so."""
    run = StreamRun(t.spark, "reconcile")
    pays, receipts = _side(run, t, "purchase", "pay"), _side(run, t, "view", "receipt")
    both = pays.join(receipts, F.expr("""
        pay_user = receipt_user AND receipt_ts BETWEEN
            pay_ts - INTERVAL 2 HOURS AND pay_ts + INTERVAL 4 HOURS"""), "full_outer")
    outcome = F.when(F.col("receipt_id").isNull(), "left_only").when(
        F.col("pay_id").isNull(), "right_only").otherwise("matched")
    return run.to_files(both.select("pay_id", "receipt_id", outcome.alias("outcome")))


@query("stream_control", QUERIES["control_asof"].sql)
def control(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "control")
    branch = F.when(F.col("event_type") == "signup", (F.col("event_id") % 3).cast("string"))
    rows = t.stream("events").select(
        "event_id", "ts", branch.alias("branch"),
        (F.col("event_type") == "signup").alias("is_control"))
    view = ControlledBranch(t.spark, run.path, "ts", "branch", "other")
    run.for_each_batch(rows, view)
    return view.current().select("event_id", "branch")


@twin("jump_alert")
def jump_alert(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "jump")
    paired = ps.in_order(keyed(run, t, value="value"), ["user_id"], ps.Previous("double"))
    alerts = paired.filter("abs(value - was) > 50")
    return run.to_files(alerts).select(
        "user_id", F.col("id").alias("event_id"), "value", F.col("was").alias("previous"))


def matches_of(run: StreamRun, t: Tables, pattern) -> DataFrame:
    rows = keyed(run, t, where="true", hits=pattern.hits)
    return ps.in_order(rows, ["user_id"], ps.Matches(pattern))


@twin("pattern_next")
def pattern_next(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "next")
    return plain_times(run.to_files(sequences.as_pair(matches_of(run, t, sequences.NEXT))))


@twin("rule_match")
def rule_match(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "rules")
    rules = from_rows(t.spark, joined.RULES, "action1 string, action2 string, version int")
    paired = ps.in_order(keyed(run, t, value="event_type"), ["user_id"], ps.Previous("string"))
    # Spark does not know the size of rows given in code and would send all pairs through a shuffle, to the few
    # tasks that have their actions.
    matched = paired.join(F.broadcast(rules), F.expr("was = action1 AND value = action2"))
    return run.to_files(matched.select(
        "user_id", F.col("id").alias("event_id"), "action1", "action2"))


@twin("running_reduce")
def running_reduce(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "running")
    totals = ps.in_order(keyed(run, t, value="value"), ["user_id"], ps.RunningTotal())
    return plain_times(run.to_files(totals.select(
        "user_id", F.col("id").alias("event_id"), F.timestamp_micros("at").alias("ts"),
        F.round("total", 2).alias("total"))))


@twin("count_tumble")
def count_tumble(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "count-window")
    filled = ps.in_order(keyed(run, t, value="value"), ["user_id"], ps.CountWindows(5))
    return run.to_files(filled).withColumn("total", F.round("total", 2))


@twin("count_slide")
def count_slide(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "count-slide")
    slid = ps.in_order(keyed(run, t, value="value"), ["user_id"], ps.SlidingRows(6, 2))
    return run.to_files(slid).select("user_id", "row_no", "n", F.round("total", 2).alias("total"))


@twin("pattern_times")
def pattern_times(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "times")
    return plain_times(run.to_files(sequences.as_pair(matches_of(run, t, sequences.TIMES))))


@twin("cep_mixed")
def cep_mixed(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "mixed")
    return run.to_files(sequences.as_steps(matches_of(run, t, sequences.MIXED)))


@query("stream_row_timers", """
    SELECT user_id, event_id, ts + INTERVAL 1 HOUR AS fired_at FROM events WHERE event_type = 'click'""")
def row_timers(t: Tables) -> DataFrame:
    """One timer for every click, an hour after it."""
    run = StreamRun(t.spark, "row-timers")
    fired = ps.in_order(
        keyed(run, t, where="event_type = 'click'"), ["user_id"], ps.RowTimers(MICROS_PER_HOUR))
    return plain_times(run.to_files(fired.select("user_id", F.col("id").alias("event_id"), "fired_at")))


@twin("top3_rows")
def top3_rows(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "top")
    best = ps.in_order(keyed(run, t, value="value"), ["user_id"], ps.RunningTop(3))
    slots = []
    for i in (1, 2, 3):
        entry = F.get("best", F.lit(i - 1))
        slots += [entry.getField("value").alias(f"v{i}"), entry.getField("id").alias(f"id{i}")]
    return run.to_files(best).select("user_id", F.col("id").alias("event_id"), *slots)


@query("stream_first_per_field", f"SELECT DISTINCT user_id, item AS field FROM {sql.VIEWS}")
def first_per_field(t: Tables) -> DataFrame:
    """Items a user viewed for the first time, remembered in a map per user."""
    run = StreamRun(t.spark, "first")
    rows = t.stream("events").filter("event_type = 'view'").withColumn("item", item_of(F.col("props")))
    shaped = run.with_event_time(
        ps.shaped(rows, ["user_id"], "ts", "event_id", field="item"), "ts", DELAY)
    firsts = shaped.groupBy("user_id").transformWithState(
        ps.FirstPerField(["user_id"]), "user_id long, field int, id long, at long", "append", "EventTime")
    return run.to_files(firsts).select("user_id", "field")


@twin("not_falling_alert")
def not_falling_alert(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "not-falling")
    alerts = ps.in_order(
        keyed(run, t, value="value"), ["user_id"], ps.NotFalling(6 * MICROS_PER_HOUR))
    return plain_times(run.to_files(alerts))


@twin("login_fail_span")
def login_fail_span(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "bursts")
    bursts = ps.in_order(
        keyed(run, t, failed=sequences.FAILED), ["user_id"],
        ps.FailureBursts(2, 12 * MICROS_PER_HOUR))
    return plain_times(run.to_files(bursts))


@twin("order_timeout")
def order_timeout(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "orders")
    rows = t.stream("events").filter("event_type IN ('click', 'purchase')").withColumn(
        "day", F.to_date("ts"))
    shaped = run.with_event_time(
        ps.shaped(rows, ["user_id", "day"], "ts", "event_id",
                  kind="if(event_type = 'click', 'create', 'pay')"), "ts", DELAY)
    outcomes = ps.in_order(
        shaped, ["user_id", "day"], ps.OrderTimeout(6 * MICROS_PER_HOUR))
    return plain_times(run.to_files(outcomes))


@twin("pattern_followed")
def pattern_followed(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "followed")
    return plain_times(run.to_files(sequences.as_outcomes(matches_of(run, t, sequences.FOLLOWED))))


PURGED = """
    WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, ts, row_number() OVER w AS rn, min(ts) OVER d AS first
        FROM events WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id),
            d AS (PARTITION BY user_id, CAST(ts AS DATE))),
    parts AS (SELECT user_id, day, rn, {k} AS k, first FROM e),
    summed AS (SELECT user_id, day, k, min(first) AS first, count(*) AS n, max(rn) % {every} = 0 AS full_part
        FROM parts GROUP BY user_id, day, k, (rn - 1) // {every})
    SELECT user_id, day, n, CASE WHEN full_part THEN 'count' WHEN {timed} THEN 'interval' ELSE 'end' END AS fired_by
    FROM summed"""


@query("stream_purged_by_count", PURGED.format(k="0", every=3, timed="false"), as_text=("day",))
def purged_by_count(t: Tables) -> DataFrame:
    """Daily windows that give and forget every three rows; the rest comes at the end of the day."""
    run = StreamRun(t.spark, "purged-count")
    return run.to_files(ps.in_order(keyed(run, t), ["user_id"], ps.EarlyResults(3, purge=True)))


@query("stream_purged_by_interval", PURGED.format(
    k="greatest(1, (epoch_us(ts) - epoch_us(first) + 21599999999) // 21600000000)", every=5,
    timed="epoch_us(first) + k * 21600000000 < epoch_us(day + INTERVAL 1 DAY) - 1"), as_text=("day",))
def purged_by_interval(t: Tables) -> DataFrame:
    """The same every five rows or six hours from the day's first row on, whichever comes first."""
    run = StreamRun(t.spark, "purged-interval")
    return run.to_files(ps.in_order(
        keyed(run, t), ["user_id"], ps.EarlyResults(5, 6 * MICROS_PER_HOUR, purge=True)))


@twin("province_clicks_5s")
def province_clicks_5s(t: Tables) -> DataFrame:
    """Clicks pass the daily limit, panes of 5 seconds count them, and spans of equal counts leave."""
    run = StreamRun(t.spark, "clicks-5s")
    numbered = ps.in_order(
        keyed(run, t, where="event_type = 'click'"), ["user_id"], ps.DailyLimit(8))
    kept = numbered.filter(F.col("nth") < sequences.CLICK_LIMIT).select(
        (F.col("user_id") % 7).alias("province"), F.timestamp_micros("at").alias("ts"), "id")
    passed = run.to_files(kept)
    return sequences.by_hour(spans_of(t, passed))


def spans_of(t: Tables, kept: DataFrame) -> DataFrame:
    run = StreamRun(t.spark, "spans")
    size, slide = MICROS_PER_HOUR, 5_000_000
    folder = f"{run.path}/kept"
    kept.write.parquet(folder)
    rows = run.with_event_time(t.spark.readStream.schema(kept.schema).parquet(folder), "ts", DELAY)
    panes = rows.groupBy("province", F.window("ts", "5 seconds")).agg(F.count("*").alias("n"))
    panes = panes.withColumn("ts", F.window_time("window")).select(
        "province", F.unix_micros(F.col("window.start")).alias("at"), F.lit(0).cast("long").alias("id"), "n", "ts")
    spans = run.to_files(ps.in_order(panes, ["province"], ps.SlidingSpans(size, slide)))
    ends = F.sequence("first_end", "last_end", F.lit(slide).cast("long"))
    each = spans.select("province", "n", F.explode(ends).alias("end"))
    return plain_times(each.select("province", "n", F.timestamp_micros("end").alias("window_end")))


@twin("early_results")
def early_results(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "early")
    fired = ps.in_order(keyed(run, t), ["user_id"], ps.EarlyResults(2))
    return run.to_files(fired)


@twin("blacklist_pass")
def blacklist_pass(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "blacklist")
    numbered = ps.in_order(
        keyed(run, t, where="event_type = 'click'"), ["user_id"], ps.DailyLimit(8))
    kept = numbered.filter(F.col("nth") < sequences.CLICK_LIMIT)
    return plain_times(run.to_files(kept.select(
        "user_id", F.col("id").alias("event_id"), F.timestamp_micros("at").alias("ts"))))


@query("stream_late_windows", f"""
    SELECT user_id, window_start, window_end, count(*) AS n, max(value) AS top
    FROM {sql.hops("events", 2 * H, H)} GROUP BY 1, 2, 3""")
def late_windows(t: Tables) -> DataFrame:
    """Windows under allowed lateness. The given events arrive in order, so none is late."""
    run = StreamRun(t.spark, "late")
    split = LateSplit(
        t.spark, run.path, ["user_id"], "ts", *windowed.LATE_ARGS,
        {"n": ("count", "1"), "top": ("max", "value")})
    run.for_each_batch(t.stream("events").select("event_id", "user_id", "ts", "value"), split)
    return plain_times(split.windows())


def arriving(
    t: Tables, run: StreamRun, rows: DataFrame, batch: Column, batches: int
) -> tuple[DataFrame, list[Callable[[], None]]]:
    """The rows as a stream, and the arrivals that bring each number of `batch` as a batch of its own, with as
    many files as Spark has tasks."""
    folder = f"{run.path}/arrivals"

    def bring(i: int) -> Callable[[], None]:
        return lambda: rows.filter(batch == i).write.parquet(f"{folder}/{i}")

    return t.spark.readStream.schema(rows.schema).parquet(f"{folder}/*"), [bring(i) for i in range(batches)]


def disordered(t: Tables, run: StreamRun, rows: DataFrame, batches: int = 4):
    """Batches that each reach over all times: row r comes in batch event_id % batches, so later batches are
    full of late rows."""
    return arriving(t, run, rows, F.col("event_id") % batches, batches)


# The newest event time of the batches before that of a row `e`.
BEFORE = "(SELECT max(b.ts) FROM events b WHERE b.event_id % 4 < e.event_id % 4)"


@query("stream_late_output", f"""
    SELECT event_id, user_id, ts FROM events e
    WHERE {sql.bucket("ts", H)} + INTERVAL 3 HOURS <= {BEFORE}""")
def late_output(t: Tables) -> DataFrame:
    """The late output of a disordered stream in four batches."""
    run = StreamRun(t.spark, "late-output")
    rows = t.events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    split = LateSplit(
        t.spark, run.path, ["user_id"], "ts", *windowed.LATE_ARGS,
        {"n": ("count", "1"), "top": ("max", "value")})
    stream, arrivals = disordered(t, run, rows)
    run.for_each_batch(stream, split, arrivals=arrivals)
    return plain_times(split.late().select("event_id", "user_id", "ts"))


@query("stream_hot_urls_each", f"""
    WITH w AS (SELECT r.event_id % 4 AS b, r.item, r.window_end FROM {sql.hops(
        f"(SELECT e.event_id, e.ts, e.item, {BEFORE} AS newest FROM {sql.VIEWS} e)", 48 * H, 2 * H)} r
        WHERE r.newest IS NULL OR r.window_end + INTERVAL 61 SECONDS > r.newest),
    parts AS (SELECT b, window_end, item, count(*) AS n FROM w GROUP BY 1, 2, 3),
    batches AS (SELECT DISTINCT b, window_end FROM parts),
    totals AS (SELECT batches.b, parts.window_end, parts.item, CAST(sum(parts.n) AS BIGINT) AS n
        FROM batches JOIN parts ON parts.window_end = batches.window_end AND parts.b <= batches.b
        GROUP BY 1, 2, 3)
    SELECT b AS batch, window_end, item, n, CAST(rk AS INTEGER) AS rk FROM (SELECT *, row_number() OVER (
        PARTITION BY b, window_end ORDER BY n DESC, item) AS rk FROM totals) WHERE rk <= 5""")
def hot_urls_each(t: Tables) -> DataFrame:
    """Every ranking as it was after each batch that touched its window: first the one from the rows
    in time, then each correction by late rows that were still accepted."""
    run = StreamRun(t.spark, "hot-urls-each")
    # The newest event is known from all events, whatever their type.
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.when(
        F.col("event_type") == "view", item_of(F.col("props"))).alias("item"))
    split = LateSplit(
        t.spark, run.path, ["item"], "ts", "48 hours", "2 hours", "1 second", "1 minute",
        {"n": ("count", "1")})
    by, out = [F.col("n").desc(), F.col("item")], f"{run.path}/rankings"

    def work(batch: DataFrame, batch_id: int) -> None:
        split(batch, batch_id)
        touched = t.spark.read.parquet(f"{run.path}/parts/batch={batch_id}").filter(
            "item is not null").select(F.col("_w.end").alias("window_end")).distinct()
        now = split.windows().filter("item is not null").join(touched, "window_end", "left_semi")
        topn.top_n(now, ["window_end"], by, 5).select("window_end", "item", "n", "rk").write.mode(
            "overwrite").parquet(f"{out}/batch={batch_id}")

    stream, arrivals = disordered(t, run, rows)
    run.for_each_batch(stream, work, arrivals=arrivals)
    ranked = t.spark.read.parquet(out).select(F.col("batch").cast("long").alias("batch"), "window_end", "item", "n", "rk")
    return plain_times(ranked)


@query("stream_hot_urls", QUERIES["hot_urls_top5"].sql)
def hot_urls(t: Tables) -> DataFrame:
    """Hot items under allowed lateness: late rows correct the counts, the last ranking stands."""
    run = StreamRun(t.spark, "hot-urls")
    split = LateSplit(
        t.spark, run.path, ["item"], "ts", "48 hours", "2 hours", "1 second", "1 minute",
        {"n": ("count", "1")})
    views = t.stream("events").filter("event_type = 'view'").select(
        item_of(F.col("props")).alias("item"), "ts")
    run.for_each_batch(views, split)
    by = [F.col("n").desc(), F.col("item")]
    ranked = topn.top_n(split.windows(), ["window_end"], by, 5)
    return plain_times(ranked.select("window_end", "item", "n", "rk"))


def order_log_stream(t: Tables) -> DataFrame:
    parsed = changes.changelog.parse_log(
        changes.order_log_of(t.stream("orders", zoned=False)), changes.ORDER_ROW)
    return parsed.select("op_type", "op_ts", "pos", "data.*")


@twin("changelog_fold")
def changelog_fold(t: Tables) -> DataFrame:
    """The current order table, kept by upserts and deletes."""
    run = StreamRun(t.spark, "fold")
    rows = order_log_stream(t).withColumn("seq", F.struct("op_ts", "pos")).drop("op_ts", "pos")
    table = KeyedTable(t.spark, f"{run.path}/table", ["o_orderkey"], "seq")
    run.for_each_batch(rows, lambda batch, i: table.upsert(batch, i, "op_type"))
    return table.current().drop("op_type", "seq").withColumn("price", F.col("price").cast("double"))


@query("stream_changelog_enrich", f"""
    SELECT o.o_orderkey, o.price, o.status, c_name FROM {changes.CURRENT} o
    LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 4 <> 0) ON o.o_custkey = c_custkey""")
def changelog_enrich(t: Tables) -> DataFrame:
    """Orders joined with customers while both change; every fourth customer is deleted."""
    run = StreamRun(t.spark, "enrich")
    orders = order_log_stream(t).select(
        F.lit("left").alias("side"), "op_type", F.concat("op_ts", "pos").alias("seq"),
        "o_orderkey", "o_custkey", "price", "status")
    customers = t.stream("customer").select(
        "c_custkey", "c_name", F.posexplode(F.when(
            F.col("c_custkey") % 4 == 0, F.array(F.lit("I"), F.lit("D"))).otherwise(
            F.array(F.lit("I")))).alias("n", "op_type"))
    rights = customers.select(
        F.lit("right").alias("side"), "op_type", F.col("n").cast("string").alias("seq"),
        "c_custkey", "c_name")
    view = EnrichedView(
        t.spark, run.path, "o_orderkey", "c_custkey", "o_custkey", ["price", "status"], ["c_name"])
    run.for_each_batch(orders.unionByName(rights, allowMissingColumns=True), view)
    return view.current().withColumn("price", F.col("price").cast("double"))


@query("stream_changelog_join", f"""
    SELECT o.o_orderkey, o.price, o.status, c_name FROM {changes.CURRENT} o
    LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 4 <> 0) ON o.o_custkey = c_custkey""")
def changelog_join(t: Tables) -> DataFrame:
    """The same join as a feed of changes, from ten batches in which updates may come before inserts; what the
    feed leaves at its end is the table."""
    run = StreamRun(t.spark, "changelog-join")
    log = changes.order_changes(t)
    orders = log.select(
        F.lit("left").alias("side"), "op_type", F.concat(F.col("op_ts").cast("string"), "pos").alias("seq"),
        "o_orderkey", "o_custkey", "price", "status")
    ops = F.when(F.col("c_custkey") % 4 == 0, F.array(F.lit("I"), F.lit("D"))).otherwise(F.array(F.lit("I")))
    customers = t.customer.select("c_custkey", "c_name", F.posexplode(ops).alias("n", "op_type"))
    rights = customers.select(
        F.lit("right").alias("side"), "op_type", F.col("n").cast("string").alias("seq"), "c_custkey", "c_name")
    feed = orders.unionByName(rights, allowMissingColumns=True)
    number = F.pmod(F.xxhash64("side", "o_orderkey", "c_custkey", "op_type"), F.lit(10))
    folder = f"{run.path}/arrivals"
    feed.withColumn("n_batch", number).repartition(10, "n_batch").write.partitionBy("n_batch").parquet(folder)
    stream = t.spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    joined_feed = retracting_join(
        stream, "o_orderkey", "o_custkey", "c_custkey", ["price", "status"], ["c_name"])
    return live_rows(run.to_files(joined_feed)).withColumn("price", F.col("price").cast("double"))


@query("stream_join_retained", """
    SELECT p.user_id, p.event_id AS pay_id, s.event_id AS sign_id FROM events p JOIN events s
    ON p.user_id = s.user_id AND p.event_type = 'purchase' AND s.event_type = 'signup'""")
def join_retained(t: Tables) -> DataFrame:
    """Two streams joined without a bound in time; rows are remembered for an hour after they came."""
    run = StreamRun(t.spark, "retained")
    sides = [t.stream("events").filter(F.col("event_type") == kind).select(
        "user_id", F.col("event_id").alias(name)) for kind, name in (("purchase", "pay_id"), ("signup", "sign_id"))]
    return run.to_files(retained_join(*sides, ["user_id"], 3_600_000))


@query("stream_full_groups", """
    SELECT event_id % 4 AS shard, CAST(count(*) // 10 AS BIGINT) AS n_full, count(*) % 10 AS n_left
    FROM events GROUP BY 1""")
def full_groups_of_ten(t: Tables) -> DataFrame:
    """A buffering sink: groups of ten in four shards, from three batches; the rest comes at the end."""
    run = StreamRun(t.spark, "full-groups")
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    stream, arrivals = arriving(t, run, rows, F.pmod(F.xxhash64("event_id"), F.lit(3)), 3)
    # The batches come in no order, so none may be late.
    timed = run.with_event_time(stream, "ts", "3650 days")
    grouped = run.to_files(
        full_groups(timed, F.col("event_id") % 4, ["event_id", "value"], "event_id", CLOSES_MS), arrivals)
    sizes = grouped.groupBy("shard", "group_no").agg(F.count("*").alias("n"))
    return sizes.groupBy("shard").agg(
        F.count_if(F.col("n") == 10).alias("n_full"),
        F.coalesce(F.sum(F.when(F.col("n") != 10, F.col("n"))), F.lit(0).cast("long")).alias("n_left"))


@query("stream_users_per_hour", QUERIES["exact_users"].sql)
def users_per_hour(t: Tables) -> DataFrame:
    run = StreamRun(t.spark, "users")
    rows = events(run, t, "user_id", "ts")
    counted = windows.distinct_per_window(rows, [], "ts", "user_id", "1 hour")
    return plain_times(run.to_files(counted)).select(
        F.col("window_start").alias("hour"), F.col("n_distinct").alias("n_users"))
