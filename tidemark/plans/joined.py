"""Joins of tables and of event streams."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import joins
from tidemark.operators.aggregates import first_rows
from tidemark.plans import sql
from tidemark.plans.registry import Tables, item_of, query
from tidemark.sources.files import from_rows

ORDER = ["ts", "event_id"]
H = sql.HOUR


def renamed(df: DataFrame, prefix: str) -> DataFrame:
    """A stream as one side of a join: the key, and its own names for id and time."""
    return df.select(
        "user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"))


@query("join_inner", """
    SELECT o_orderkey, o_totalprice, c_custkey, c_name, c_mktsegment
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_inner(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    customers = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey")


@query("join_left3", """
    SELECT o_orderkey, o_totalprice, c_name, l_linenumber, l_shipdate FROM orders
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN lineitem ON o_orderkey = l_orderkey""", as_text=("l_linenumber",))
def join_left3(t: Tables) -> DataFrame:
    customers = t.customer.select("c_custkey", "c_name")
    items = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    return (
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select("o_orderkey", "o_totalprice", "c_name", "l_linenumber", "l_shipdate"))


def _window_sql(kind: str) -> str:
    return f"""
    SELECT c.user_id, c.event_id AS click_id, p.event_id AS buy_id,
        {sql.bucket("c.ts", 6 * H)} AS window_start
    FROM (SELECT * FROM events WHERE event_type = 'click') c
    {kind} JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
        ON c.user_id = p.user_id AND {sql.bucket("c.ts", 6 * H)} = {sql.bucket("p.ts", 6 * H)}"""


def _window_join(t: Tables, how: str) -> DataFrame:
    clicks, buys = renamed(t.of_type("click"), "click"), renamed(t.of_type("purchase"), "buy")
    joined = joins.window_join(clicks, buys, ["user_id"], "click_ts", "buy_ts", "6 hours", how)
    return joined.select("user_id", "click_id", "buy_id", "window_start")


@query("join_window", _window_sql("INNER"))
def join_window(t: Tables) -> DataFrame:
    return _window_join(t, "inner")


@query("join_cogroup", _window_sql("LEFT"), as_text=("buy_id",))
def join_cogroup(t: Tables) -> DataFrame:
    """Both sides of a key and window together, used as a left join."""
    return _window_join(t, "left")


@query("join_interval", """
    SELECT p.user_id, p.event_id AS pay_id, r.event_id AS receipt_id,
        p.ts AS pay_ts, r.ts AS receipt_ts
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    JOIN (SELECT * FROM events WHERE event_type = 'view') r ON p.user_id = r.user_id
        AND r.ts BETWEEN p.ts - INTERVAL 1 HOUR AND p.ts + INTERVAL 2 HOURS""")
def join_interval(t: Tables) -> DataFrame:
    pays, receipts = renamed(t.of_type("purchase"), "pay"), renamed(t.of_type("view"), "receipt")
    return joins.interval_join(
        pays, receipts, ["user_id"], "pay_ts", "receipt_ts", "-1 hour", "2 hours")


@query("join_interval_left", """
    SELECT c.user_id, c.event_id AS click_id, s.event_id AS change_id
    FROM (SELECT * FROM events WHERE event_type = 'click') c
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s ON c.user_id = s.user_id
        AND s.ts BETWEEN c.ts - INTERVAL 10 HOURS AND c.ts""", as_text=("change_id",))
def join_interval_left(t: Tables) -> DataFrame:
    clicks, changes = renamed(t.of_type("click"), "click"), renamed(t.of_type("signup"), "change")
    return joins.interval_join(
        clicks, changes, ["user_id"], "click_ts", "change_ts", "-10 hours", "0 seconds", "left"
    ).select("user_id", "click_id", "change_id")


FIRSTS = """(SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS ts FROM events
    WHERE event_type = '{kind}' GROUP BY 1, 2)"""


def daily_first(t: Tables, kind: str, prefix: str) -> DataFrame:
    """One transaction per user and day: the first event of a type."""
    return t.of_type(kind).groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min("ts").alias(f"{prefix}_ts"))


@query("reconcile", f"""
    SELECT user_id, day, p.ts AS pay_ts, r.ts AS receipt_ts
    FROM {FIRSTS.format(kind="purchase")} p JOIN {FIRSTS.format(kind="view")} r
    USING (user_id, day)""", as_text=("day",))
def reconcile(t: Tables) -> DataFrame:
    return daily_first(t, "purchase", "pay").join(
        daily_first(t, "view", "receipt"), ["user_id", "day"])


RECONCILE_TIMEOUT = f"""
    SELECT coalesce(p.user_id, r.user_id) AS user_id, coalesce(p.day, r.day) AS day,
        p.ts AS pay_ts, r.ts AS receipt_ts,
        CASE WHEN r.ts IS NULL THEN 'left_only' WHEN p.ts IS NULL THEN 'right_only'
            ELSE 'matched' END AS outcome
    FROM {FIRSTS.format(kind="purchase")} p FULL JOIN {FIRSTS.format(kind="view")} r
        ON p.user_id = r.user_id AND p.day = r.day
        AND r.ts BETWEEN p.ts - INTERVAL 2 HOURS AND p.ts + INTERVAL 4 HOURS"""


@query("reconcile_timeout", RECONCILE_TIMEOUT, as_text=("day",))
def reconcile_timeout(t: Tables) -> DataFrame:
    return joins.reconcile(
        daily_first(t, "purchase", "pay"), daily_first(t, "view", "receipt"),
        ["user_id", "day"], "pay_ts", "receipt_ts", "4 hours", "2 hours")


@query("control_asof", """
    WITH both_sides AS (
        SELECT ts, event_id, 1 AS side, NULL::VARCHAR AS switch FROM events WHERE event_type <> 'signup'
        UNION ALL SELECT ts, NULL, 0, CAST(event_id % 3 AS VARCHAR) FROM events
            WHERE event_type = 'signup')
    SELECT event_id, branch FROM (
        SELECT event_id, side, coalesce(last_value(switch IGNORE NULLS) OVER (
            ORDER BY ts, side ROWS UNBOUNDED PRECEDING), 'other') AS branch FROM both_sides)
    WHERE side = 1""")
def control_asof(t: Tables) -> DataFrame:
    """Sign-ups act as switch messages; every other event takes the branch last switched to."""
    control = t.of_type("signup").select("ts", (F.col("event_id") % 3).cast("string").alias("branch"))
    rows = t.events.filter("event_type <> 'signup'").select("event_id", "ts")
    return joins.as_of_control(rows, control, "ts", "branch", "other").select("event_id", "branch")


RULES = [("click", "purchase", 1), ("error", "error", 2), ("signup", "view", 3)]

RULE_MATCH = """
    WITH r(action1, action2) AS (VALUES {rules}),
    a AS (SELECT user_id, event_id, event_type, lag(event_type) OVER (
        PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events)
    SELECT user_id, event_id, action1, action2 FROM a JOIN r
        ON previous = action1 AND event_type = action2"""


def _rule_match(t: Tables, latest_only: bool) -> DataFrame:
    rules = from_rows(t.spark, RULES, "action1 string, action2 string, version int")
    if latest_only:
        rules = joins.newest_rule(rules, ["version"])
    actions = t.events.select("user_id", *ORDER, "event_type")
    matched = joins.rule_matches(actions, rules, "user_id", ORDER, "event_type")
    return matched.select("user_id", "event_id", "action1", "action2")


@query("rule_match", RULE_MATCH.format(
    rules="('click', 'purchase'), ('error', 'error'), ('signup', 'view')"))
def rule_match(t: Tables) -> DataFrame:
    return _rule_match(t, latest_only=False)


@query("rule_match_newest", RULE_MATCH.format(rules="('signup', 'view')"))
def rule_match_newest(t: Tables) -> DataFrame:
    return _rule_match(t, latest_only=True)


@query("dim_lookup", """
    SELECT l_orderkey, l_linenumber, l_partkey, p_name, p_retailprice
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def dim_lookup(t: Tables) -> DataFrame:
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_retailprice")
    items = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.look_up(items, parts, "l_partkey")


@query("item_user_pairs", f"""
    SELECT item, arg_min(user_id, (ts, event_id)) AS first_user, count(DISTINCT user_id) AS n_users
    FROM {sql.VIEWS} GROUP BY item""")
def item_user_pairs(t: Tables) -> DataFrame:
    """Users per item: first viewers joined with distinct counts."""
    views = t.of_type("view").select(
        item_of(F.col("props")).alias("item"), "user_id", "ts", "event_id")
    firsts = first_rows(views, ["item"], ORDER).select("item", F.col("user_id").alias("first_user"))
    users = views.groupBy("item").agg(F.countDistinct("user_id").alias("n_users"))
    return firsts.join(users, "item")
