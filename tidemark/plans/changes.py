"""Row-change feeds made from the order table, folded and enriched."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import changelog
from tidemark.plans.registry import Tables, query

ORDER_ROW = "o_orderkey long, o_custkey long, price decimal(20,2), status string"
CUSTOMER_ROW = "c_custkey long, c_name string, c_mktsegment string"


def order_log_of(orders: DataFrame) -> DataFrame:
    """Replication-log JSON: every order is inserted, every 10th updated, every 50th deleted."""
    row = F.struct(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(20,2)").alias("price"),
        F.col("o_orderstatus").alias("status"))
    changed = F.struct(
        "o_orderkey", "o_custkey",
        (F.col("o_totalprice").cast("decimal(20,2)") + 1).cast("decimal(20,2)").alias("price"),
        F.lit("X").alias("status"))
    key = F.col("o_orderkey")

    def change(op: str, days: int, before, after, wanted):
        entry = F.struct(
            F.lit("SHOP.ORDERS").alias("table"), F.lit(op).alias("op_type"),
            (F.col("o_orderdate") + F.expr(f"interval {days} days")).alias("op_ts"),
            F.lpad(F.concat(key.cast("string"), F.lit(str(days))), 20, "0").alias("pos"),
            F.array(F.lit("o_orderkey")).alias("primary_keys"),
            before.alias("before"), after.alias("after"))
        return F.when(wanted, F.to_json(entry))

    nothing = F.lit(None).cast(f"struct<{changelog.struct_fields(ORDER_ROW)}>")
    entries = F.array(
        change("I", 0, nothing, row, F.lit(True)),
        change("U", 1, row, changed, key % 10 == 0),
        change("D", 2, changed, nothing, key % 50 == 0))
    return orders.select(F.explode(F.array_compact(entries)).alias("value"))


def order_changes(t: Tables) -> DataFrame:
    parsed = changelog.parse_log(order_log_of(t.orders), ORDER_ROW)
    return parsed.select("op_type", "op_ts", "pos", "data.*")


def current_orders(t: Tables) -> DataFrame:
    folded = changelog.fold_to_current(order_changes(t), ["o_orderkey"], ["op_ts", "pos"])
    return folded.withColumn("price", F.col("price").cast("double"))


CURRENT = """(SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderkey % 10 = 0 THEN round(o_totalprice + 1, 2) ELSE o_totalprice END AS price,
    CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS status
    FROM orders WHERE o_orderkey % 50 <> 0)"""


@query("changelog_parse", """
    SELECT op_type, count(*) AS n, count(DISTINCT o_orderkey) AS n_orders FROM (
        SELECT 'I' AS op_type, o_orderkey FROM orders
        UNION ALL SELECT 'U', o_orderkey FROM orders WHERE o_orderkey % 10 = 0
        UNION ALL SELECT 'D', o_orderkey FROM orders WHERE o_orderkey % 50 = 0) GROUP BY 1""")
def changelog_parse(t: Tables) -> DataFrame:
    return order_changes(t).groupBy("op_type").agg(
        F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("n_orders"))


@query("changelog_fold", f"SELECT * FROM {CURRENT}")
def changelog_fold(t: Tables) -> DataFrame:
    return current_orders(t)


@query("changelog_enrich", f"""
    SELECT o.o_orderkey, o.price, o.status, c_name, l_linenumber, l_shipdate FROM {CURRENT} o
    LEFT JOIN customer ON o.o_custkey = c_custkey
    LEFT JOIN lineitem ON o.o_orderkey = l_orderkey""", as_text=("l_linenumber",))
def changelog_enrich(t: Tables) -> DataFrame:
    customers = t.customer.select("c_custkey", "c_name")
    items = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    enriched = changelog.enrich(current_orders(t), [
        (customers, "o_custkey", "c_custkey"), (items, "o_orderkey", "l_orderkey")])
    return enriched.drop("o_custkey")


@query("changelog_view", """
    SELECT '-U' AS row_kind, o_orderkey, o_totalprice AS price, o_orderstatus AS status FROM orders
        WHERE o_orderkey % 10 = 0 AND o_orderkey % 50 <> 0
    UNION ALL SELECT '+U', o_orderkey, round(o_totalprice + 1, 2), 'X' FROM orders
        WHERE o_orderkey % 10 = 0 AND o_orderkey % 50 <> 0
    UNION ALL SELECT '-D', o_orderkey, o_totalprice, o_orderstatus FROM orders
        WHERE o_orderkey % 50 = 0""")
def changelog_view(t: Tables) -> DataFrame:
    """What the updates and deletes changed, as retractions and additions."""
    changes = order_changes(t).drop("o_custkey")
    keys, order = ["o_orderkey"], ["op_ts", "pos"]
    before = changelog.fold_to_current(changes.filter("op_type = 'I'"), keys, order)
    after = changelog.fold_to_current(changes, keys, order)
    return changelog.as_changelog(before, after, keys).withColumn(
        "price", F.col("price").cast("double"))


@query("capture_fold", """
    SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 4 <> 0""")
def capture_fold(t: Tables) -> DataFrame:
    """Capture records: all customers are read, then every fourth one is deleted."""
    data = F.struct("c_custkey", "c_name", "c_mktsegment")

    def record(operation: str, wanted):
        return F.when(wanted, F.to_json(F.struct(
            F.lit(operation).alias("operation"), data.alias("data"),
            F.lit("shop").alias("database"), F.lit("customer").alias("table"))))

    records = t.customer.select(F.posexplode(F.array_compact(F.array(
        record("read", F.lit(True)), record("delete", F.col("c_custkey") % 4 == 0)))
    ).alias("pos", "value"))
    parsed = changelog.parse_capture(records, CUSTOMER_ROW, keep=["pos"])
    flat = parsed.select("pos", "op_type", "data.*")
    return changelog.fold_to_current(flat, ["c_custkey"], ["pos"])
