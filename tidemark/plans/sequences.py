"""Alerts and event sequences per key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import patterns, windows
from tidemark.operators.automaton import MATCHED, begin, match_pattern
from tidemark.operators.slices import running
from tidemark.plans import sql
from tidemark.plans.registry import Tables, item_of, query

ORDER = ["ts", "event_id"]
FAILED = "event_type = 'error'"
H = sql.HOUR


def sensor(t: Tables) -> DataFrame:
    return t.events.select("user_id", *ORDER, "value")


def logins(t: Tables) -> DataFrame:
    """Errors stand for failed log-ins, every other event for a successful one."""
    return t.events.select("user_id", *ORDER, "event_type")


def plain_times(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("jump_alert", """
    SELECT user_id, event_id, value, previous FROM (
        SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events)
    WHERE abs(value - previous) > 50""")
def jump_alert(t: Tables) -> DataFrame:
    alerts = patterns.jumps(sensor(t), ["user_id"], ORDER, "value", 50)
    return alerts.select("user_id", "event_id", "value", "previous")


@query("running_reduce", """
    SELECT user_id, event_id, max(ts) OVER w AS ts, round(sum(value) OVER w, 2) AS total FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def running_reduce(t: Tables) -> DataFrame:
    summed = running(sensor(t), ["user_id"], ORDER, {"total": ("sum", "value")})
    return summed.select("user_id", "event_id", "ts", F.round("total", 2).alias("total"))


def not_falling_sql(arms: str) -> str:
    return f"""
    WITH RECURSIVE base AS (
        SELECT user_id, event_id, ts, value, lag(value) OVER w AS was FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    runs AS (SELECT *, CASE WHEN value < was THEN 1 ELSE 0 END AS fell,
        sum(CASE WHEN value < was THEN 1 ELSE 0 END) OVER (
            PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM base),
    candidates AS (SELECT user_id, run, ts FROM runs WHERE {arms}),
    {sql.timers("candidates", "user_id, run", "INTERVAL 6 HOURS")}
    SELECT a.user_id, a.armed AS armed_at, a.armed + INTERVAL 6 HOURS AS alert_at FROM arms a
    LEFT JOIN (SELECT user_id, run - 1 AS run, ts FROM runs WHERE fell = 1) e
        ON a.user_id = e.user_id AND a.run = e.run
    WHERE e.ts IS NULL OR e.ts > a.armed + INTERVAL 6 HOURS"""


@query("not_falling_alert", not_falling_sql("value >= was"))
def not_falling_alert(t: Tables) -> DataFrame:
    alerts = patterns.not_falling(sensor(t), ["user_id"], ORDER, "value", "6 hours")
    return plain_times(alerts, "armed_at", "alert_at")


@query("not_falling_first", not_falling_sql("value > was OR was IS NULL"))
def not_falling_first(t: Tables) -> DataFrame:
    """The form in which the very first row arms and an equal value does not."""
    alerts = patterns.not_falling(
        sensor(t), ["user_id"], ORDER, "value", "6 hours", arm_on_first=True)
    return plain_times(alerts, "armed_at", "alert_at")


CLICK_LIMIT = 3
NTH = """(SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS nth
    FROM (SELECT *, CAST(ts + INTERVAL 8 HOURS AS DATE) AS day FROM events
        WHERE event_type = 'click'))"""


def numbered_clicks(t: Tables) -> DataFrame:
    clicks = t.of_type("click").select("user_id", *ORDER)
    return patterns.with_rank_per_day(clicks, ["user_id"], ORDER, 8)


@query("blacklist_pass", f"SELECT user_id, event_id, ts FROM {NTH} WHERE nth < {CLICK_LIMIT}")
def blacklist_pass(t: Tables) -> DataFrame:
    """Clicks that stay below the daily limit of their user."""
    return numbered_clicks(t).filter(F.col("nth") < CLICK_LIMIT).select("user_id", "event_id", "ts")


@query("blacklist_alert", f"SELECT user_id, day, ts FROM {NTH} WHERE nth = {CLICK_LIMIT}", as_text=("day",))
def blacklist_alert(t: Tables) -> DataFrame:
    """One alert per user and day, at the click that reaches the limit."""
    return numbered_clicks(t).filter(F.col("nth") == CLICK_LIMIT).select("user_id", "day", "ts")


@query("province_clicks", f"""
    SELECT province, window_end, count(*) AS n FROM {sql.hops(
        f"(SELECT user_id % 7 AS province, ts FROM {NTH} WHERE nth < {CLICK_LIMIT})", 24 * H, H)}
    GROUP BY 1, 2""")
def province_clicks(t: Tables) -> DataFrame:
    """Clicks per province over the rows the blacklist let through; 24 windows per row, by panes."""
    kept = numbered_clicks(t).filter(F.col("nth") < CLICK_LIMIT)
    rows = kept.select((F.col("user_id") % 7).alias("province"), "ts")
    counted = windows.hop(rows, ["province"], "ts", "24 hours", "1 hour", {"n": ("count", "1")})
    return counted.select("province", "window_end", "n")


@query("province_clicks_5s", f"""
    SELECT province, hour, CAST(sum(n) AS BIGINT) AS total, max(n) AS most, count(*) AS n_windows FROM (
        SELECT province, {sql.bucket("window_end", H)} AS hour, n FROM (
            SELECT province, window_end, count(*) AS n FROM {sql.hops(
                f"(SELECT user_id % 7 AS province, ts FROM {NTH} WHERE nth < {CLICK_LIMIT})", H, 5)}
            GROUP BY 1, 2)) GROUP BY 1, 2""")
def province_clicks_5s(t: Tables) -> DataFrame:
    """Clicks of the last hour every 5 seconds, 720 windows a row, summed up by the hour they end in."""
    kept = numbered_clicks(t).filter(F.col("nth") < CLICK_LIMIT)
    rows = kept.select((F.col("user_id") % 7).alias("province"), "ts")
    return by_hour(windows.hop(rows, ["province"], "ts", "1 hour", "5 seconds", {"n": ("count", "1")}))


def by_hour(counted: DataFrame) -> DataFrame:
    """The windows of each province by the hour in which they end."""
    hour = F.window("window_end", "1 hour").start.alias("hour")
    return counted.groupBy("province", hour).agg(
        F.sum("n").alias("total"), F.max("n").alias("most"), F.count("*").alias("n_windows"))


@query("login_fail_span", f"""
    WITH RECURSIVE runs AS (SELECT user_id, event_id, ts, event_type = 'error' AS failed,
        sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (
            PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM events),
    fails AS (SELECT user_id, run, ts FROM runs WHERE failed),
    {sql.timers("fails", "user_id, run", "INTERVAL 12 HOURS")}
    SELECT a.user_id, a.armed AS first_ts, max(f.ts) AS last_ts, count(*) AS n_fails
    FROM arms a JOIN fails f ON a.user_id = f.user_id AND a.run = f.run
        AND f.ts >= a.armed AND f.ts <= a.armed + INTERVAL 12 HOURS
    LEFT JOIN (SELECT user_id, run - 1 AS run, ts FROM runs WHERE NOT failed) e
        ON a.user_id = e.user_id AND a.run = e.run
    WHERE e.ts IS NULL OR e.ts > a.armed + INTERVAL 12 HOURS
    GROUP BY a.user_id, a.run, a.armed HAVING count(*) >= 2""")
def login_fail_span(t: Tables) -> DataFrame:
    bursts = patterns.failure_bursts(logins(t), ["user_id"], ORDER, FAILED, 2, "12 hours")
    return plain_times(bursts, "first_ts", "last_ts")


PAIR = """
    SELECT user_id, event_id, ts, first_ts FROM (
        SELECT *, lag(event_type) OVER w AS was, lag(ts) OVER w AS first_ts FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE event_type = 'error' AND was = 'error' AND ts - first_ts {op} INTERVAL 6 HOURS"""


@query("login_fail_pair", PAIR.format(op="<="))
def login_fail_pair(t: Tables) -> DataFrame:
    pairs = patterns.adjacent_pairs(
        logins(t), ["user_id"], ORDER, FAILED, "6 hours", strict=False)
    return pairs.select("user_id", "event_id", "ts", "first_ts")


@query("pattern_next", PAIR.format(op="<"))
def pattern_next(t: Tables) -> DataFrame:
    pairs = patterns.adjacent_pairs(logins(t), ["user_id"], ORDER, FAILED, "6 hours", strict=True)
    return pairs.select("user_id", "event_id", "ts", "first_ts")


@query("pattern_times", """
    SELECT user_id, event_id, ts, first_ts FROM (
        SELECT *, count(*) FILTER (event_type = 'error') OVER w AS hits,
            lag(ts, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS first_ts FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
    WHERE hits = 3 AND ts - first_ts < INTERVAL 48 HOURS""")
def pattern_times(t: Tables) -> DataFrame:
    """Three failures in a row."""
    found = patterns.consecutive(logins(t), ["user_id"], ORDER, FAILED, 3, "48 hours")
    return found.select("user_id", "event_id", "ts", "first_ts")


def order_events(t: Tables) -> DataFrame:
    """An order per user and day: clicks create it, purchases pay it."""
    kind = F.when(F.col("event_type") == "click", "create").otherwise("pay")
    return t.of_type("click", "purchase").select(
        "user_id", F.to_date("ts").alias("day"), *ORDER, kind.alias("kind"))


ORDER_TIMEOUT = """
    WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, ts,
            event_type = 'click' AS made, lag(ts) OVER w AS before, lead(ts) OVER w AS after,
            lag(event_type) OVER w = 'click' AS made_before, lead(event_type) OVER w = 'click' AS made_after
        FROM events WHERE event_type IN ('click', 'purchase')
        WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id))
    SELECT user_id, day, 'paid' AS outcome, ts AS create_ts, after AS pay_ts FROM e
        WHERE made AND after - ts <= INTERVAL 6 HOURS AND NOT made_after
    UNION ALL SELECT user_id, day, 'no_pay', ts, NULL FROM e
        WHERE made AND (after IS NULL OR after - ts > INTERVAL 6 HOURS)
    UNION ALL SELECT user_id, day, 'pay_without_create', NULL, ts FROM e
        WHERE NOT made AND (before IS NULL OR NOT made_before OR ts - before > INTERVAL 6 HOURS)"""


@query("order_timeout", ORDER_TIMEOUT, as_text=("day",))
def order_timeout(t: Tables) -> DataFrame:
    return patterns.order_outcomes(order_events(t), ["user_id", "day"], ORDER, "kind", "6 hours")


@query("pattern_followed", """
    SELECT user_id, ts AS start_ts,
        CASE WHEN next_pay - ts < INTERVAL 6 HOURS THEN next_pay END AS end_ts,
        CASE WHEN next_pay - ts < INTERVAL 6 HOURS THEN 'matched' ELSE 'timed_out' END AS outcome
    FROM (SELECT *, min(ts) FILTER (event_type = 'purchase') OVER (PARTITION BY user_id
            ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_pay
        FROM events) WHERE event_type = 'click'""")
def pattern_followed(t: Tables) -> DataFrame:
    return patterns.followed_by(
        logins(t), ["user_id"], ORDER, F.col("event_type") == "click",
        F.col("event_type") == "purchase", "6 hours")


def cep_query(name: str, like: str):
    """The same question through the pattern automaton, checked by the same SQL."""
    from tidemark.plans.registry import QUERIES

    return query(name, QUERIES[like].sql)


NEXT = begin("first", FAILED).next("second", FAILED).within("6 hours")
TIMES = begin("fails", FAILED).times(3, consecutive=True).within("48 hours")
FOLLOWED = begin("click", "event_type = 'click'").followed_by("pay", "event_type = 'purchase'").within("6 hours")
# A click, a view right after it, then two purchases whatever lies between, within two days.
MIXED = (
    begin("click", "event_type = 'click'").next("view", "event_type = 'view'")
    .followed_by("pay", "event_type = 'purchase'").times(2).within("48 hours"))


def as_pair(matches: DataFrame) -> DataFrame:
    """Last id and time, and first time, of what matched."""
    return matches.filter(F.col("outcome") == MATCHED).select(
        "user_id", F.element_at("id", -1).alias("event_id"), F.timestamp_micros(F.element_at("at", -1)).alias("ts"),
        F.timestamp_micros(F.col("at")[0]).alias("first_ts"))


def as_outcomes(matches: DataFrame) -> DataFrame:
    return matches.select(
        "user_id", F.timestamp_micros(F.col("at")[0]).alias("start_ts"),
        F.when(F.col("outcome") == MATCHED, F.timestamp_micros(F.element_at("at", -1))).alias("end_ts"), "outcome")


def as_steps(matches: DataFrame) -> DataFrame:
    """The ids taken; a match that timed out has as many as it had found, at least the first."""
    steps = [F.coalesce(F.get("id", F.lit(i)), F.lit(-1)).alias(f"id{i + 1}") for i in range(4)]
    return matches.select("user_id", "outcome", *steps)


@cep_query("cep_next", "pattern_next")
def cep_next(t: Tables) -> DataFrame:
    return plain_times(as_pair(match_pattern(logins(t), ["user_id"], ORDER, NEXT)), "ts", "first_ts")


@cep_query("cep_times", "pattern_times")
def cep_times(t: Tables) -> DataFrame:
    return plain_times(as_pair(match_pattern(logins(t), ["user_id"], ORDER, TIMES)), "ts", "first_ts")


@cep_query("cep_followed", "pattern_followed")
def cep_followed(t: Tables) -> DataFrame:
    found = match_pattern(logins(t), ["user_id"], ORDER, FOLLOWED)
    return plain_times(as_outcomes(found), "start_ts", "end_ts")


@query("cep_mixed", """
    WITH e AS (SELECT user_id, event_id, ts, event_type, row_number() OVER w AS rn, lead(event_type) OVER w AS next_type,
            lead(event_id) OVER w AS view_id, lead(ts) OVER w AS view_ts
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    starts AS (SELECT *, coalesce(next_type = 'view' AND view_ts - ts < INTERVAL 48 HOURS, false) AS viewed,
            next_type IS NULL OR view_ts - ts >= INTERVAL 48 HOURS AS waits FROM e WHERE event_type = 'click'),
    pays AS (SELECT user_id, event_id, ts, rn, row_number() OVER (PARTITION BY user_id ORDER BY rn) AS nth
        FROM e WHERE event_type = 'purchase'),
    first_pay AS (SELECT s.user_id, s.event_id, min(p.nth) AS nth FROM starts s JOIN pays p
        ON p.user_id = s.user_id AND p.rn > s.rn + 1 WHERE s.viewed GROUP BY 1, 2),
    found AS (SELECT s.*, p1.event_id AS pay1, p2.event_id AS pay2 FROM starts s
        LEFT JOIN first_pay f ON f.event_id = s.event_id
        LEFT JOIN pays p1 ON p1.user_id = s.user_id AND p1.nth = f.nth AND p1.ts - s.ts < INTERVAL 48 HOURS
        LEFT JOIN pays p2 ON p2.user_id = s.user_id AND p2.nth = f.nth + 1 AND p2.ts - s.ts < INTERVAL 48 HOURS)
    SELECT user_id, CASE WHEN pay2 IS NOT NULL THEN 'matched' ELSE 'timed_out' END AS outcome, event_id AS id1,
        CASE WHEN viewed THEN view_id ELSE -1 END AS id2, coalesce(pay1, -1) AS id3, coalesce(pay2, -1) AS id4
    FROM found WHERE viewed OR waits""")
def cep_mixed(t: Tables) -> DataFrame:
    """Strict and loose steps in one pattern, with what timed out."""
    return as_steps(match_pattern(logins(t), ["user_id"], ORDER, MIXED))


@query("early_results", """
    SELECT user_id, day, n, fired_by FROM (
        SELECT user_id, CAST(ts AS DATE) AS day, row_number() OVER w AS n, 'count' AS fired_by
        FROM events WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id))
    WHERE n % 2 = 0
    UNION ALL SELECT user_id, CAST(ts AS DATE), count(*), 'end' FROM events GROUP BY 1, 2""", as_text=("day",))
def early_results(t: Tables) -> DataFrame:
    """The results of a daily window that also fires on every second row."""
    rows = t.events.select("user_id", F.to_date("ts").alias("day"), *ORDER)
    counted = running(rows, ["user_id", "day"], ORDER, {"n": ("count", "1")})
    early = counted.filter("n % 2 = 0").select(
        "user_id", "day", "n", F.lit("count").alias("fired_by"))
    final = rows.groupBy("user_id", "day").agg(F.count("*").alias("n")).withColumn(
        "fired_by", F.lit("end"))
    return early.unionByName(final)


@query("item_jumps", """
    SELECT item, event_id, user_id, previous FROM (
        SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS item, event_id, user_id,
            lag(user_id) OVER (PARTITION BY json_extract_string(props, '$.k')
                ORDER BY ts, event_id) AS previous FROM events)
    WHERE abs(user_id - previous) > 10""")
def item_jumps(t: Tables) -> DataFrame:
    rows = t.events.select(item_of(F.col("props")).alias("item"), *ORDER, "user_id")
    found = patterns.jumps(rows, ["item"], ORDER, "user_id", 10)
    return found.select("item", "event_id", "user_id", "previous")
