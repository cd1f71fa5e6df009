"""Every registered query against its checking SQL."""

import os

import pytest

from tests.compare import differences
from tidemark.plans import QUERIES

CHECKED = [n for n, q in QUERIES.items() if q.sql]
BATCH = [n for n in CHECKED if not n.startswith("stream_")]

# Each stream starts Spark state stores and Python workers; TEST_ALL=1 runs all of them.
FEW = ["tumble_sum", "session_count", "hot_items_top3", "word_count", "join_interval_left", "reconcile",
       "pattern_next", "order_timeout", "changelog_fold"]
STREAMS = [n for n in CHECKED if n.startswith("stream_")
           and (os.environ.get("TEST_ALL") or n.removeprefix("stream_") in FEW)]

# Queries that put the rows of a key in order, one per way of doing so.
ORDERED = [
    "running_sum", "running_distinct", "control_asof", "not_falling_alert", "login_fail_span",
    "pattern_times", "pattern_followed", "top3_rows", "count_slide", "late_windows", "over_range",
    "session_count",
]


@pytest.mark.parametrize("name", BATCH)
def test_batch(name, tables, duck):
    assert differences(QUERIES[name].run(tables), duck, QUERIES[name].sql) == []


@pytest.mark.parametrize("name", ORDERED)
def test_same_result_when_keys_are_cut(name, tables, duck, cut_everywhere):
    assert differences(QUERIES[name].run(tables), duck, QUERIES[name].sql) == []


@pytest.mark.parametrize("name", STREAMS)
def test_stream(name, tables, duck):
    assert differences(QUERIES[name].run(tables), duck, QUERIES[name].sql) == []


def test_approximate_users_close_to_exact(tables):
    exact = {r.hour: r.n_users for r in QUERIES["exact_users"].run(tables).collect()}
    for row in QUERIES["approx_users"].run(tables).collect():
        assert abs(row.n_users - exact[row.hour]) <= max(1, 0.05 * exact[row.hour])


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
