"""Operators against answers worked out by hand."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.functions import scalar
from tidemark.operators import aggregates, changelog, joins, lateness, patterns, rows, topn, windows
from tidemark.operators.slices import running, running_top, with_neighbours
from tidemark.sources.files import from_rows

SENSOR = [
    ("ws_001", 1577844001, 45), ("ws_002", 1577844015, 43), ("ws_003", 1577844020, 42),
    ("ws_001", 1577844001, 22), ("ws_006", 1577844015, 16), ("ws_007", 1577844020, 42),
    ("ws_001", 1577844010, 48), ("ws_001", 1577844020, 48),
]
LOGINS = [
    (1035, "fail", 842), (1035, "fail", 843), (1035, "fail", 844), (5692, "fail", 833),
    (5692, "success", 840), (83419, "success", 881), (83419, "fail", 882), (83419, "success", 884),
    (83419, "success", 885), (83419, "fail", 886), (83419, "success", 886), (23565, "fail", 862),
    (23565, "success", 881),
]


def at(seconds):
    return datetime(2020, 1, 1) + timedelta(seconds=seconds)


@pytest.fixture
def sensor(spark):
    raw = from_rows(spark, [(i, *r) for i, r in enumerate(SENSOR)], "n long, id string, s long, vc int")
    return raw.withColumn("ts", scalar.from_epoch(F.col("s")))


@pytest.fixture
def logins(spark):
    raw = from_rows(spark, [(i, *r) for i, r in enumerate(LOGINS)], "n long, u long, kind string, s long")
    return raw.withColumn("ts", scalar.from_epoch(F.col("s")))


def test_word_count(spark):
    lines = from_rows(spark, [(w,) for w in (
        "hello spark", "hello hive", "hello kafka", "hello kafka", "hello hive")], "line string")
    counted = rows.words(lines, "line").groupBy("word").count()
    assert rows_of(counted, "word", "count") == [
        ("hello", 5), ("hive", 2), ("kafka", 2), ("spark", 1)]


def test_filter(sensor):
    assert sensor.filter("vc > 30").count() == 6


def test_tumbling_sums(sensor):
    summed = windows.tumble(sensor, ["id"], "ts", "5 seconds", ["sum(vc) AS total"])
    start = F.unix_seconds("window_start") - 1577844000
    assert rows_of(summed.withColumn("s", start), "id", "s", "total") == [
        ("ws_001", 0, 67), ("ws_001", 10, 48), ("ws_001", 20, 48), ("ws_002", 15, 43),
        ("ws_003", 20, 42), ("ws_006", 15, 16), ("ws_007", 20, 42)]


def test_max_keeps_first_row_and_max_row_takes_latest(sensor):
    top = aggregates.max_field(sensor.select("id", "s", "n", "vc"), ["id"], "vc", ["n"])
    assert ("ws_001", 1577844001, 48) in rows_of(top, "id", "s", "vc")
    row = aggregates.max_row(sensor.select("id", "s", "n", "vc"), ["id"], "vc", ["n"])
    assert ("ws_001", 1577844020, 48) in rows_of(row, "id", "s", "vc")


def test_adjacent_failures(logins):
    pairs = patterns.adjacent_pairs(logins, ["u"], ["ts", "n"], "kind = 'fail'", "2 seconds", False)
    assert rows_of(pairs, "u", "s") == [(1035, 843), (1035, 844)]
    strict = patterns.adjacent_pairs(logins, ["u"], ["ts", "n"], "kind = 'fail'", "5 seconds", True)
    twice = patterns.consecutive(logins, ["u"], ["ts", "n"], "kind = 'fail'", 2, "5 seconds")
    assert rows_of(strict, "u", "s") == rows_of(twice, "u", "s") == [(1035, 843), (1035, 844)]


def test_pair_exactly_at_the_limit(logins):
    one = "1 second"
    assert patterns.adjacent_pairs(logins, ["u"], ["ts", "n"], "kind = 'fail'", one, False).count() == 2
    assert patterns.adjacent_pairs(logins, ["u"], ["ts", "n"], "kind = 'fail'", one, True).count() == 0


def test_failure_burst(logins):
    bursts = patterns.failure_bursts(logins, ["u"], ["ts", "n"], "kind = 'fail'", 2, "2 seconds")
    assert rows_of(bursts, "u", "n_fails") == [(1035, 3)]


def test_order_outcomes(spark):
    orders = [
        (34729, "create", 842), (34729, "pay", 844),  # in time
        (34756, "create", 913), (34756, "pay", 1951),  # 1038 s: too late
        (34767, "create", 949), (34767, "pay", 2021),  # 1072 s: too late
        (34768, "pay", 950),  # never created
        (7, "create", 0), (7, "pay", 900),  # exactly at the limit still counts
    ]
    df = from_rows(spark, [(i, *o) for i, o in enumerate(orders)], "n long, o long, kind string, s long")
    df = df.withColumn("ts", scalar.from_epoch(F.col("s")))
    found = patterns.order_outcomes(df, ["o"], ["ts", "n"], "kind", "15 minutes")
    assert rows_of(found, "o", "outcome") == [
        (7, "paid"), (34729, "paid"), (34756, "no_pay"), (34756, "pay_without_create"),
        (34767, "no_pay"), (34767, "pay_without_create"), (34768, "pay_without_create")]
    chained = patterns.followed_by(
        df, ["o"], ["ts", "n"], "kind = 'create'", "kind = 'pay'", "15 minutes")
    assert rows_of(chained, "o", "outcome") == [
        (7, "timed_out"), (34729, "matched"), (34756, "timed_out"), (34767, "timed_out")]


def test_blacklist(spark):
    clicks = [(937166, 1715, i) for i in range(121)] + [(1, 1715, 5), (1, 2, 9)]
    df = from_rows(spark, [(i, *c) for i, c in enumerate(clicks)], "n long, u long, ad long, s long")
    df = df.withColumn("ts", scalar.from_epoch(F.col("s") + 1511658000))
    numbered = patterns.with_rank_per_day(df, ["u", "ad"], ["ts", "n"], 8)
    assert numbered.filter("nth < 100").count() == 99 + 2
    assert numbered.filter("nth >= 100").count() == 22
    assert numbered.filter("nth = 100").count() == 1


def test_not_falling_alerts_again_after_an_alert(spark):
    values = [(0, 1.0), (2, 2.0), (5, 3.0), (13, 4.0), (14, 9.0), (30, 10.0), (31, 1.0), (32, 2.0)]
    df = from_rows(spark, [(i, "a", at(s), v) for i, (s, v) in enumerate(values)],
                   "n long, id string, ts timestamp_ntz, v double")
    found = patterns.not_falling(df, ["id"], ["ts", "n"], "v", "10 seconds")
    seconds = [(F.unix_seconds(F.col(c)) - 1577836800).alias(c) for c in ("armed_at", "alert_at")]
    # Armed at 2; alert at 12; armed again at 13; alert at 23; armed at 30 but fell at 31; at 32 to the end.
    assert rows_of(found.select(*seconds), "armed_at", "alert_at") == [(2, 12), (13, 23), (32, 42)]


def test_interval_join_bounds(spark):
    orders = from_rows(spark, [
        ("Mary", "order-1", 5000), ("Alice", "order-2", 5000), ("Bob", "order-3", 20000),
        ("Alice", "order-4", 20000), ("Cary", "order-5", 51000)], "user string, o string, o_ms long")
    clicks = from_rows(spark, [
        ("Bob", "./cart", 2000), ("Alice", "./prod?id=100", 3000), ("Alice", "./prod?id=200", 3500),
        ("Bob", "./prod?id=2", 2500), ("Alice", "./prod?id=300", 36000), ("Bob", "./home", 30000),
        ("Bob", "./prod?id=1", 23000), ("Bob", "./prod?id=3", 33000)],
        "user string, url string, c_ms long")
    orders = orders.withColumn("o_ts", scalar.from_epoch(F.col("o_ms"), "ms"))
    clicks = clicks.withColumn("c_ts", scalar.from_epoch(F.col("c_ms"), "ms"))

    def found(**options):
        joined = joins.interval_join(
            orders, clicks, ["user"], "o_ts", "c_ts", "-2 seconds", "2 seconds", **options)
        return rows_of(joined, "o", *([] if options.get("how") == "left_anti" else ["url"]))

    both = [("order-2", "./prod?id=100"), ("order-2", "./prod?id=200")]
    assert found() == both
    assert found(closed="right") == both[1:]
    assert found(how="left_anti") == [("order-1",), ("order-3",), ("order-4",), ("order-5",)]


def test_window_join_and_cogroup(spark):
    left = from_rows(spark, [(k, ms) for k, ms in (
        ("a", 1000), ("b", 1000), ("c", 1000), ("a", 3000), ("b", 3000))], "k string, l_ms long")
    right = from_rows(spark, [("a", 2000), ("b", 2000), ("a", 5000), ("b", 5000)], "k string, r_ms long")
    left = left.withColumn("l_ts", scalar.from_epoch(F.col("l_ms"), "ms"))
    right = right.withColumn("r_ts", scalar.from_epoch(F.col("r_ms"), "ms"))
    joined = joins.window_join(left, right, ["k"], "l_ts", "r_ts", "2 seconds", "left")
    found = {(r.k, r.l_ms): r.r_ms for r in joined.collect()}
    assert found == {("a", 1000): None, ("b", 1000): None, ("c", 1000): None,
                     ("a", 3000): 2000, ("b", 3000): 2000}


def test_reconcile(spark):
    app = from_rows(spark, [("order-1", 1000), ("order-2", 2000)], "o string, a_ms long")
    bank = from_rows(spark, [("order-1", 3000), ("order-3", 4000)], "o string, b_ms long")
    app = app.withColumn("a_ts", scalar.from_epoch(F.col("a_ms"), "ms"))
    bank = bank.withColumn("b_ts", scalar.from_epoch(F.col("b_ms"), "ms"))
    found = joins.reconcile(app, bank, ["o"], "a_ts", "b_ts", "5 seconds", "5 seconds")
    assert rows_of(found, "o", "outcome") == [
        ("order-1", "matched"), ("order-2", "left_only"), ("order-3", "right_only")]


def test_rules_all_and_newest(spark):
    actions = from_rows(spark, [
        (1, "Alice", "login"), (2, "Alice", "pay"), (3, "Bob", "login"), (4, "Bob", "buy")],
        "n long, user string, action string")
    rules = from_rows(spark, [("login", "pay", 1), ("login", "buy", 2)],
                      "action1 string, action2 string, v int")
    every = joins.rule_matches(actions, rules, "user", ["n"], "action")
    assert rows_of(every, "user", "action2") == [("Alice", "pay"), ("Bob", "buy")]
    newest = joins.rule_matches(actions, joins.newest_rule(rules, ["v"]), "user", ["n"], "action")
    assert rows_of(newest, "user") == [("Bob",)]


def test_masking(spark):
    given = ["1111222233331111", "2222123456782222", "2342123456784324"[:14], "12345678", "12ab", "", None]
    df = from_rows(spark, [(i, g) for i, g in enumerate(given)], "i int, c string")
    got = [r.m for r in df.select("i", scalar.mask_digits(F.col("c")).alias("m")).orderBy("i").collect()]
    assert got == ["1111********1111", "2222********2222", "2342******7843", "12345678", "12ab", "", ""]


def test_enriched_orders(spark):
    products = from_rows(spark, [(102, "car battery"), (104, "hammer"), (105, "hammer"), (106, "hammer")],
                         "product_id int, name string")
    orders = from_rows(spark, [
        (1, "I", 10001, 102), (1, "I", 10002, 105), (1, "I", 10003, 106), (2, "I", 10004, 104),
        (3, "U", 10004, 104), (4, "D", 10004, 104)], "pos int, op_type string, order_id int, product_id int")
    shipments = from_rows(spark, [(1001, 10001), (1002, 10002), (1003, 10003), (1004, 10004)],
                          "shipment_id int, s_order int")

    def enriched(upto):
        current = changelog.fold_to_current(orders.filter(F.col("pos") <= upto), ["order_id"], ["pos"])
        joined = changelog.enrich(current, [
            (products.withColumnRenamed("product_id", "p_id"), "product_id", "p_id"),
            (shipments, "order_id", "s_order")])
        return rows_of(joined, "order_id", "name", "shipment_id")

    assert enriched(1) == [(10001, "car battery", 1001), (10002, "hammer", 1002), (10003, "hammer", 1003)]
    assert enriched(2)[-1] == (10004, "hammer", 1004)
    assert enriched(4) == enriched(1)


def test_replication_log(spark):
    row = "ACCTNO string, TRANAM decimal(20,2)"
    head = '"table":"BANK.BILL","op_ts":"2021-10-14 17:14:00.523297","pos":"00000000050001564502"'
    data = '{"ACCTNO":"0109000000001113001008","TRANAM":6421.23}'
    records = from_rows(spark, [
        (f'{{{head},"op_type":"U","primary_keys":["TRANDT"],"before":{data},"after":{data}}}',),
        (f'{{{head},"op_type":"I","after":{data}}}',), ("not json",)], "value string")
    parsed = changelog.parse_log(records, row).collect()
    assert [(r.op_type, r.data.ACCTNO, str(r.data.TRANAM)) for r in parsed] == [
        ("U", "0109000000001113001008", "6421.23"), ("I", "0109000000001113001008", "6421.23")]
    assert parsed[0].op_ts == datetime(2021, 10, 14, 17, 14, 0, 523297)


def test_changelog_entries(spark):
    old = from_rows(spark, [(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = from_rows(spark, [(1, "a"), (2, "c"), (4, "d")], "k int, v string")
    got = [tuple(r) for r in changelog.as_changelog(old, new, ["k"]).collect()]
    assert sorted(got, key=str) == [("+I", 4, "d"), ("+U", 2, "c"), ("-D", 3, None), ("-U", 2, "b")]


# Edge cases


def test_empty_input(spark):
    empty = from_rows(spark, [], "k string, n long, ts timestamp_ntz, v double")
    assert running(empty, ["k"], ["ts", "n"], {"s": ("sum", "v")}).count() == 0
    assert windows.session(empty, ["k"], "ts", "5 seconds", {"n": ("count", "1")}).count() == 0
    assert windows.count_tumble(empty, ["k"], ["n"], 2, ["count(*) AS c"]).count() == 0
    assert patterns.not_falling(empty, ["k"], ["ts", "n"], "v", "1 second").count() == 0


def test_null_keys_keep_their_rows_when_cut(spark):
    data = [(i, None if i % 2 else "a", float(i)) for i in range(40)]
    df = from_rows(spark, data, "n long, k string, v double")
    whole = running(df, ["k"], ["n"], {"s": ("sum", "v"), "m": ("min", "v")})
    cut = running(df, ["k"], ["n"], {"s": ("sum", "v"), "m": ("min", "v")}, rows_per_slice=4)
    assert {tuple(r) for r in whole.collect()} == {tuple(r) for r in cut.collect()}


def test_neighbours_reach_across_short_slices(spark):
    df = from_rows(spark, [("a", i, i * i) for i in range(30)], "k string, n long, v long")

    def body(rows, window):
        return rows.withColumns({
            "before": F.sum("v").over(window.rowsBetween(-3, 0)), "after": F.lead("v", 2).over(window)})

    whole = with_neighbours(df, ["k"], ["n"], body, before=3, after=2)
    cut = with_neighbours(df, ["k"], ["n"], body, before=3, after=2, rows_per_slice=2)
    names = ["k", "n", "v", "before", "after"]
    assert {tuple(r) for r in whole.select(names).collect()} == {tuple(r) for r in cut.select(names).collect()}


def test_running_top_ties_prefer_the_earlier(spark):
    df = from_rows(spark, [("a", i, 5) for i in range(20)], "k string, n long, v int")
    entry = F.struct("v", (-F.col("n")).alias("age"))
    for options in ({}, {"rows_per_slice": 4}):
        last = running_top(df, ["k"], ["n"], entry, 3, **options).orderBy(F.desc("n")).first()
        assert [-last[f"_top{i}"]["age"] for i in (1, 2, 3)] == [0, 1, 2]


def test_session_gap_exactly_equal_merges(spark):
    df = from_rows(spark, [("a", at(0)), ("a", at(5)), ("a", at(11)), ("b", at(3))],
                   "k string, ts timestamp_ntz")
    got = rows_of(windows.session(df, ["k"], "ts", "5 seconds", {"n": ("count", "1")}),
                  "k", "window_start", "window_end", "n")
    assert got == [("a", at(0), at(10), 2), ("a", at(11), at(16), 1), ("b", at(3), at(8), 1)]


def test_hop_panes_equal_direct(spark, tables):
    def counted(panes):
        hopped = windows.hop(tables.events, ["event_type"], "ts", "9 hours", "2 hours", {
            "n": ("count", "1"), "top": ("max", "value")}, panes=panes)
        return rows_of(hopped, "event_type", "window_start", "window_end", "n", "top")

    assert counted(True) == counted(False)


def test_count_windows_fire_only_when_full(spark):
    df = from_rows(spark, [("a", i, 1) for i in range(12)] + [("b", 1, 1)], "k string, n long, v int")
    full = windows.count_tumble(df, ["k"], ["n"], 5, ["sum(v) AS s"])
    assert rows_of(full, "k", "window_no", "s") == [("a", 0, 5), ("a", 1, 5)]
    slid = windows.count_slide(df, ["k"], ["n"], 6, 2, {"s": "sum(v)"})
    assert rows_of(slid, "k", "row_no", "s") == [
        ("a", 2, 2), ("a", 4, 4), ("a", 6, 6), ("a", 8, 6), ("a", 10, 6), ("a", 12, 6)]


def test_late_rows_by_arrival(spark):
    arrivals = [1, 3, 12, 2, 30, 4]
    df = from_rows(spark, [(i, at(s)) for i, s in enumerate(arrivals)], "n long, ts timestamp_ntz")
    late = lateness.late_rows(df, ["n"], "ts", "5 seconds", "5 seconds", "2 seconds", "0 seconds")
    assert rows_of(late, "n") == [(3,), (5,)]
    kept = lateness.late_rows(df, ["n"], "ts", "5 seconds", "5 seconds", "2 seconds", "10 seconds")
    assert rows_of(kept, "n") == [(5,)]
    counted = lateness.on_time_windows(
        df, [], ["n"], "ts", "5 seconds", "5 seconds", "2 seconds", "10 seconds", ["count(*) AS c"])
    assert rows_of(counted, "window_start", "c") == [(at(0), 3), (at(10), 1), (at(30), 1)]


def test_fewer_items_than_ranks(spark):
    df = from_rows(spark, [("x", at(1)), ("x", at(2)), ("y", at(3))], "item string, ts timestamp_ntz")
    ranked = topn.hot_items(df, "item", "ts", "10 seconds", "10 seconds", 5)
    assert rows_of(ranked, "rk", "item", "n") == [(1, "x", 2), (2, "y", 1)]


def test_bad_lines(spark):
    lines = from_rows(spark, [("a,1",), ("b,x",), ("c,3",)], "value string")
    kept = rows.parse_lines(lines, "id string, n int", on_error="DROPMALFORMED")
    assert rows_of(kept, "id", "n") == [("a", 1), ("c", 3)]
    with pytest.raises(Exception, match="(?i)malformed"):
        rows.parse_lines(lines, "id string, n int").collect()


def test_web_log(spark):
    line = "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logo.png"
    fields = scalar.web_log_fields(F.col("line"))
    got = from_rows(spark, [(line,)], "line string").select(
        *[c.alias(n) for n, c in fields.items()]).first()
    assert (got.ip, got.method, got.url) == ("83.149.9.216", "GET", "/presentations/logo.png")
    assert got.ts == datetime(2015, 5, 17, 10, 5, 3)
