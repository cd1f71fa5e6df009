"""Parsing, routing, merging and scalar functions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar, udfs
from tidemark.operators import rows as ops
from tidemark.operators.aggregates import time_of
from tidemark.plans.registry import Tables, item_of, query


@query("parse_csv", """
    SELECT user_id AS id, epoch_us(ts) // 1000000 AS ts, value AS vc FROM events""")
def parse_csv(t: Tables) -> DataFrame:
    ev = t.events
    line = F.concat_ws(
        ",", F.col("user_id").cast("string"),
        F.floor(time_of(ev, "ts") / 1_000_000).cast("string"), F.col("value").cast("string"))
    return ops.parse_lines(ev.select(line.alias("value")), "id long, ts long, vc double")


@query("parse_json", """
    SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events""")
def parse_json(t: Tables) -> DataFrame:
    message = F.to_json(F.struct(
        "event_id", "user_id", "event_type", F.from_json("props", "k int").alias("props")))
    parsed = ops.parse_json(
        t.events.select(message.alias("value")),
        "event_id long, user_id long, event_type string, props struct<k: int>")
    return parsed.select("event_id", "user_id", "event_type", "props.k")


@query("drop_bad_records", """
    SELECT event_id, user_id FROM events WHERE event_type <> 'error'""")
def drop_bad_records(t: Tables) -> DataFrame:
    """Messages of error events are cut short, so they do not parse and must vanish."""
    message = F.to_json(F.struct("event_id", "user_id"))
    broken = F.when(F.col("event_type") == "error", F.expr("left(m, length(m) - 3)")).otherwise(
        F.col("m"))
    lines = t.events.withColumn("m", message).select(broken.alias("value"))
    return ops.parse_json(lines, "event_id long, user_id long")


@query("filter_gt", "SELECT event_id, user_id, value FROM events WHERE value > 30")
def filter_gt(t: Tables) -> DataFrame:
    return t.events.filter(F.col("value") > 30).select("event_id", "user_id", "value")


@query("parse_and_filter", r"""
    SELECT page_id, split_part(url, '/', 3) AS host FROM pages WHERE url LIKE 'https:%'""")
def parse_and_filter(t: Tables) -> DataFrame:
    return t.pages.filter(F.col("url").startswith("https:")).select(
        "page_id", F.split("url", "/")[2].alias("host"))


@query("split_words", r"""
    SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM conversations""")
def split_words(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", F.explode(F.split("text", " ")).alias("word"))


@query("route_tags", """
    SELECT tag, count(*) AS n, round(sum(value), 2) AS total FROM (
        SELECT value, CASE WHEN value < 30 THEN 'low' WHEN event_type = 'error' THEN 'error'
            ELSE 'main' END AS tag FROM events) GROUP BY tag""")
def route_tags(t: Tables) -> DataFrame:
    routed = ops.route(t.events, {
        "low": F.col("value") < 30, "error": F.col("event_type") == "error"})
    return routed.groupBy("tag").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("side_output", """
    SELECT user_id, value FROM events WHERE value < 30""")
def side_output(t: Tables) -> DataFrame:
    routed = ops.route(t.events, {"low": F.col("value") < 30})
    return ops.branch(routed, "low").select("user_id", "value")


@query("connect_union", """
    SELECT 'order' AS kind, o_orderkey AS id, o_totalprice AS amount FROM orders
    UNION ALL SELECT 'item', l_orderkey, l_extendedprice FROM lineitem""")
def connect_union(t: Tables) -> DataFrame:
    return ops.connect(
        t.orders, t.lineitem,
        {"kind": F.lit("order"), "id": F.col("o_orderkey"), "amount": F.col("o_totalprice")},
        {"kind": F.lit("item"), "id": F.col("l_orderkey"), "amount": F.col("l_extendedprice")})


@query("union_all", """
    SELECT event_type, count(*) AS n FROM (
        SELECT * FROM events UNION ALL SELECT * FROM events) GROUP BY 1""")
def union_all(t: Tables) -> DataFrame:
    both = t.events.unionByName(t.events)
    return both.groupBy("event_type").agg(F.count("*").alias("n"))


@query("nested_project", """
    SELECT o_orderkey, o_totalprice AS price, o_orderpriority AS priority, o_custkey AS cust
    FROM orders""")
def nested_project(t: Tables) -> DataFrame:
    nested = t.orders.select(
        "o_orderkey",
        F.struct(
            F.struct(F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("cust"))
            .alias("after"), F.col("o_orderpriority").alias("priority")).alias("bct"))
    return nested.select(
        "o_orderkey", "bct.after.price", "bct.priority", "bct.after.cust")


@query("repartition_count", """
    SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_suppkey""")
def repartition_count(t: Tables) -> DataFrame:
    """Rows spread evenly, whatever their keys, then aggregated in part where they are."""
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    even = ops.spread(t.lineitem.select("l_suppkey", "l_quantity"), "round_robin", n)
    return even.groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("mask_digits", r"""
    WITH digits AS (SELECT o_orderkey, CAST(o_orderkey * 7654321 AS VARCHAR) AS c, o_orderpriority
        FROM orders)
    SELECT o_orderkey,
        CASE WHEN length(c) > 8 THEN left(c, 4) || repeat('*', CAST(length(c) - 8 AS INTEGER)) || right(c, 4)
            ELSE c END AS masked,
        CASE WHEN length(c) > 5 THEN left(c, 3) || repeat('*', CAST(length(c) - 5 AS INTEGER)) || right(c, 2)
            ELSE c END AS masked_3_2,
        o_orderpriority AS unmasked FROM digits""")
def mask_digits(t: Tables) -> DataFrame:
    content = (F.col("o_orderkey") * 7654321).cast("string")
    return t.orders.select(
        "o_orderkey", scalar.mask_digits(content).alias("masked"),
        scalar.mask_digits(content, 3, 2).alias("masked_3_2"),
        scalar.mask_digits(F.col("o_orderpriority")).alias("unmasked"))


@query("mask_digits_sql", r"""
    SELECT c_custkey, CASE WHEN length(c) > 8
        THEN left(c, 4) || repeat('*', CAST(length(c) - 8 AS INTEGER)) || right(c, 4) ELSE c END AS masked,
        CAST(length(c_name) AS INTEGER) AS n
    FROM (SELECT c_custkey, c_name, CAST(c_custkey * 123456789 AS VARCHAR) AS c FROM customer)""")
def mask_digits_sql(t: Tables) -> DataFrame:
    udfs.register(t.spark)
    return t.spark.sql(
        """SELECT c_custkey, mask_digits(cast(c_custkey * 123456789 AS string)) AS masked,
           text_length(c_name) AS n FROM {customer}""", customer=t.customer)


@query("text_length", """
    SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents""")
def text_length(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.length("text").alias("n"))


@query("text_length_arrow", """
    SELECT conv_id, turn, CAST(length(text) AS INTEGER) AS n FROM conversations""")
def text_length_arrow(t: Tables) -> DataFrame:
    length = udfs.text_length_arrow()
    return t.conversations.select("conv_id", "turn", length("text").alias("n"))


@query("lateral_split", """
    SELECT page_id, unnest(string_split(url, '/')) AS word FROM pages""")
def lateral_split(t: Tables) -> DataFrame:
    udfs.register(t.spark)
    return t.spark.sql(
        "SELECT page_id, s.word FROM {pages}, LATERAL split_words(url, '/') s", pages=t.pages)


@query("lateral_split_left", """
    SELECT p.page_id, w.word FROM pages p LEFT JOIN (
        SELECT page_id, word FROM (SELECT page_id, unnest(string_split(url, '/')) AS word FROM pages)
        WHERE length(word) > 20) w USING (page_id)""")
def lateral_split_left(t: Tables) -> DataFrame:
    udfs.register(t.spark)
    return t.spark.sql(
        """SELECT page_id, s.word FROM {pages} LEFT JOIN LATERAL (
           SELECT word FROM split_words(url, '/') WHERE length(word) > 20) s ON true""",
        pages=t.pages)


@query("lateral_python", """
    SELECT page_id, word, CAST(length(word) AS INTEGER) AS n
    FROM (SELECT page_id, unnest(string_split(url, '/')) AS word FROM pages)""")
def lateral_python(t: Tables) -> DataFrame:
    """The same with a table function written in Python."""
    udfs.register(t.spark)
    return t.spark.sql(
        "SELECT page_id, s.word, s.n FROM {pages}, LATERAL word_lengths(url, '/') s", pages=t.pages)


@query("weblog_parse", """
    SELECT '10.0.0.' || (user_id % 256) AS ip, CAST(user_id AS VARCHAR) AS user_id,
        date_trunc('second', ts) AS ts, 'GET' AS method,
        '/item/' || json_extract_string(props, '$.k') AS url
    FROM events WHERE event_type = 'view'""")
def weblog_parse(t: Tables) -> DataFrame:
    """Access log lines written out of the events, parsed, and filtered by method."""
    method = F.when(F.col("event_type") == "view", "GET").otherwise("POST")
    line = F.concat_ws(
        " ", F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")),
        F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"),
        F.lit("+0000"), method,
        F.concat(F.lit("/item/"), item_of(F.col("props")).cast("string")))
    fields = scalar.web_log_fields(F.col("line"))
    parsed = t.events.select(line.alias("line")).select(*[c.alias(n) for n, c in fields.items()])
    return parsed.filter("method = 'GET'").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("date_fmt", """
    SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS at_ms,
        strftime(ts, '%Y-%m-%d %H:%M') AS minute,
        date_trunc('day', ts + INTERVAL 8 HOURS)::TIMESTAMP AS local_day FROM events""")
def date_fmt(t: Tables) -> DataFrame:
    ev = t.events
    millis = F.floor(time_of(ev, "ts") / 1000)
    return ev.select(
        "event_id", scalar.from_epoch(millis, "ms").cast("timestamp_ntz").alias("at_ms"),
        scalar.minute_text(F.col("ts")).alias("minute"),
        scalar.local_day(F.col("ts")).cast("timestamp_ntz").alias("local_day"))


@query("json_roundtrip", """
    SELECT o_orderkey, o_orderstatus AS status, CAST(o_custkey AS VARCHAR) AS cust FROM orders""")
def json_roundtrip(t: Tables) -> DataFrame:
    record = F.to_json(F.struct(
        F.lit("orders").alias("table"),
        F.struct(F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status"))
        .alias("data")))
    return t.orders.select("o_orderkey", record.alias("j")).select(
        "o_orderkey", F.get_json_object("j", "$.data.status").alias("status"),
        F.get_json_object("j", "$.data.cust").alias("cust"))


@query("composite_key_count", """
    SELECT user_id || '_' || json_extract_string(props, '$.k') AS user_ad, count(*) AS n
    FROM events WHERE event_type = 'click' GROUP BY 1""")
def composite_key_count(t: Tables) -> DataFrame:
    key = scalar.composite_key(F.col("user_id"), item_of(F.col("props")))
    return t.of_type("click").groupBy(key.alias("user_ad")).agg(F.count("*").alias("n"))


@query("number_folds", """
    SELECT l_orderkey, l_linenumber, abs(l_quantity - 25) AS off, greatest(l_tax, l_discount) AS hi,
        least(l_tax, l_discount) AS lo FROM lineitem
    WHERE l_quantity BETWEEN 10 AND 40""")
def number_folds(t: Tables) -> DataFrame:
    return t.lineitem.filter(F.col("l_quantity").between(10, 40)).select(
        "l_orderkey", "l_linenumber", F.abs(F.col("l_quantity") - 25).alias("off"),
        F.greatest("l_tax", "l_discount").alias("hi"), F.least("l_tax", "l_discount").alias("lo"))
