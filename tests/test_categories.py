from __future__ import annotations

from helpers import action, plan_of, rows
from footfall.operators import categories
from footfall.staging import stage


def test_events_and_counts(actions_of):
    actions = actions_of([
        action(category=1), action(category=1), action(category=12),
        action(orders="1,12,12"), action(orders=""), action(orders="7,,x"),
        action(pays="1"), action(),
    ])
    assert rows(categories.click_counts(actions)) == [(1, 2), (12, 1)]
    assert rows(categories.order_counts(actions)) == [(1, 1), (7, 1), (12, 2)]
    assert rows(categories.pay_counts(actions)) == [(1, 1)]
    assert rows(categories.active_categories(actions)) == [(1,), (7,), (12,)]
    full = categories.full_counts(categories.category_events(actions))
    assert rows(full) == [(1, 2, 1, 1), (7, 0, 1, 0), (12, 1, 2, 0)]


def test_counts_of_kept_sessions(actions_of, spark):
    actions = actions_of([
        action("a", category=1), action("a", category=1), action("b", category=2),
        action("a", orders="3,3"), action("b", orders="3"), action("a", pays="4"), action("b", pays="5"),
    ])
    kept = spark.createDataFrame([("a",)], "session_id STRING")
    assert rows(categories.click_counts(actions, kept)) == [(1, 2)]
    assert rows(categories.order_counts(actions, kept)) == [(3, 2)]
    assert rows(categories.pay_counts(actions, kept)) == [(4, 1)]
    assert rows(categories.active_categories(actions, kept)) == [(1,), (3,), (4,)]
    full = categories.full_counts(categories.session_category_counts(actions, kept))
    assert rows(full) == [(1, 2, 0, 0), (3, 0, 2, 0), (4, 0, 0, 1)]


def test_one_action_with_all_three_behaviours(actions_of):
    events = categories.category_events(actions_of([action(category=3, orders="4", pays="5")]))
    assert rows(events) == [("s1", 3, 1, 0, 0), ("s1", 4, 0, 1, 0), ("s1", 5, 0, 0, 1)]


def test_top_categories_order(spark):
    counts = spark.createDataFrame(
        [(1, 2412, 2284, 2430), (2, 2143, 2320, 2366), (3, 2404, 2199, 2529), (4, 2143, 2320, 2500)],
        "category_id BIGINT, click_count BIGINT, order_count BIGINT, pay_count BIGINT",
    )
    assert [r.category_id for r in categories.top_categories(counts).collect()] == [1, 3, 4, 2]
    big = spark.createDataFrame(
        [(1, 0, 0, 0), (2, 2**40, 0, 0), (3, 2**40, 0, 0)], counts.schema)
    assert [r.category_id for r in categories.top_categories(big, 2).collect()] == [2, 3]


def test_top_sessions(spark):
    counts = spark.createDataFrame(
        [("s%02d" % i, 1, 1 + i % 3, 0, 0) for i in range(30)] + [("x", 2, 9, 0, 0), ("y", 1, 0, 5, 0)],
        "session_id STRING, category_id BIGINT, clicks BIGINT, orders BIGINT, pays BIGINT",
    )
    top = spark.createDataFrame([(1,)], "category_id BIGINT")
    assert rows(categories.top_sessions(counts, top, 12)) == rows(
        categories.top_sessions(counts, stage(top, "top"), 12))
    # As after top_categories, whose limit bounds it, the size of ``top`` is known to the planner.
    found = categories.top_sessions(counts, stage(top, "top"), 12)
    ordered = sorted(((-r.click_count, r.session_id) for r in found.collect()))
    brute = sorted((-(1 + i % 3), "s%02d" % i) for i in range(30))[:12]
    assert ordered == brute
    plan = plan_of(found, "simple")
    assert plan.count("WindowGroupLimit") == 2


def test_session_category_counts_only_for_kept(actions_of, spark):
    actions = actions_of([action("a", category=5), action("a", category=5), action("b", category=5)])
    kept = spark.createDataFrame([("a",)], "session_id STRING")
    assert rows(categories.session_category_counts(actions, kept)) == [("a", 5, 2, 0, 0)]


def test_one_scan_gives_what_two_give(actions_of, users):
    from footfall.operators import sessions
    from footfall.params import TaskParams

    log = actions_of([
        action("a", user=1, category=5, keyword="kw"), action("a", user=1, orders="5,7,x"), action("a", user=-1),
        action("b", user=2, pays="5,5"), action("b", user=2, keyword="other"), action("c", user=-1, category=5),
        action("d", user=1), action("e", user=99, category=7), action("f", user=4, category=7),
    ])
    dates = {"start_date": "2024-01-01", "end_date": "2024-01-31"}
    for more in ({}, {"keywords": ("kw", "z")}, {"category_ids": (7, 5)}, {"start_age": 30, "end_age": 60}):
        params = TaskParams(**dates, **more)
        kept = sessions.kept_sessions(log, users, params)
        expected = rows(categories.session_category_counts(log, kept))
        assert rows(categories.kept_category_counts(log, users, params)) == expected
        rolled = categories.roll_up(log, params)
        whole = sessions.aggregate_sessions(log, params)
        assert sorted(map(str, rows(categories.rolled_sessions(rolled).select(*whole.columns)))) == sorted(
            map(str, rows(whole)))
    assert rows(categories.kept_category_counts(log, users, TaskParams(**dates))) != []
