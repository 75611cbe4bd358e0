from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import action, plan_of
from footfall.operators import funnel


def brute_force(log, flow):
    """Counts of adjacent pairs, actions ordered by time and page."""
    by_session = {}
    for session, second, page in log:
        by_session.setdefault(session, []).append((second, page))
    counts = {}
    for visits in by_session.values():
        pages = [page for _, page in sorted(visits)]
        for pair in zip(pages, pages[1:]):
            counts[pair] = counts.get(pair, 0) + 1
    start = sum(page == flow[0] for _, _, page in log)
    return start, [counts.get(pair, 0) for pair in zip(flow, flow[1:])]


def spark_counts(actions_of, log, flow):
    actions = actions_of([
        action(session, f"2024-01-05 10:{second // 60:02d}:{second % 60:02d}", page=page)
        for session, second, page in log
    ])
    row = funnel.count_splits(actions, flow).first()
    return row.start_pv, [row[f"split_{i}"] for i in range(len(flow) - 1)]


@pytest.mark.parametrize("seed", range(6))
def test_against_brute_force(actions_of, seed):
    """Few seconds and pages, so that many actions of a session share a time."""
    draw = random.Random(seed)
    pages = draw.choice([3, 5, 9])
    seconds = draw.choice([1, 4, 50])
    log = [(f"s{draw.randrange(4)}", draw.randrange(seconds), draw.randrange(1, pages + 1))
           for _ in range(120)]
    flow = tuple(draw.randrange(1, pages + 2) for _ in range(8))
    assert spark_counts(actions_of, log, flow) == brute_force(log, flow)


def test_flow_of_more_pages_than_one_word_has_flags(actions_of):
    draw = random.Random(1)
    log = [("s", draw.randrange(20), 2 * draw.randrange(1, 60)) for _ in range(200)]
    flow = tuple(range(2, 120, 2)) + tuple(range(2, 120, 4))
    assert spark_counts(actions_of, log, flow) == brute_force(log, flow)


def test_rates(actions_of):
    log = [("a", 1, 1), ("a", 2, 2), ("a", 3, 1), ("b", 1, 1), ("b", 5, 2), ("b", 6, 3)]
    actions = actions_of([action(s, f"2024-01-05 10:00:{t:02d}", page=p) for s, t, p in log])
    found = [tuple(r) for r in funnel.page_convert_rates(actions, (1, 2, 3, 4, 5)).collect()]
    assert found == [
        (1, "1_2", 2, 3, 2 / 3), (2, "2_3", 1, 2, 0.5), (3, "3_4", 0, 1, 0.0), (4, "4_5", 0, 0, None),
    ]
    text = funnel.convert_rate_text(funnel.page_convert_rates(actions, (1, 2, 3, 4, 5))).first()[0]
    assert text == "1_2=0.6666666666666666|2_3=0.5|3_4=0.0|4_5=null"


def test_pairs_that_occur(actions_of):
    actions = actions_of([action(time=f"2024-01-05 10:00:0{i}", page=p) for i, p in enumerate((1, 2, 1, 2))])
    assert [tuple(r) for r in funnel.page_split_counts(actions, (1, 2, 1, 2, 3)).collect()] == [
        ("1_2", 2), ("2_1", 1)]


def test_nobody_on_the_start_page(actions_of):
    actions = actions_of([action(page=5)])
    assert [tuple(r) for r in funnel.page_convert_rates(actions, (1, 2)).collect()] == [
        (1, "1_2", 0, 0, None)]
    empty = actions.filter("page_id = 0")
    assert [tuple(r) for r in funnel.page_convert_rates(empty, (1, 2)).collect()] == [
        (1, "1_2", 0, 0, None)]


def test_flow_of_one_page_has_no_pairs(actions_of):
    with pytest.raises(ValueError):
        funnel.page_convert_rates(actions_of([action()]), (1,))


def test_hot_session_is_merged_before_the_window(spark, actions_of):
    """A million-row session with 30 distinct times sorts 30 rows."""
    seed = actions_of([action("hot", page=1)])
    hot = seed.crossJoin(spark.range(300_000, numPartitions=8).toDF("i")).select(
        "session_id", F.expr("action_time + make_dt_interval(0, 0, 0, i % 30)").alias("action_time"),
        F.expr("1 + i % 3").alias("page_id"))
    row = funnel.count_splits(hot, (1, 2, 3, 1)).first()
    # Second k holds page 1 + k % 3 ten thousand times.
    assert (row.start_pv, row.split_0, row.split_1, row.split_2) == (100_000, 10, 10, 9)
    plan = plan_of(funnel.count_splits(actions_of([action()]), (1, 2)), "simple")
    assert plan.count("Exchange hashpartitioning") == 3 and "Join" not in plan
    assert "windowspecdefinition(session_id" in plan
    wide = [line for line in plan.splitlines() if "Window" in line and "action_time" in line]
    assert wide and all("session_id" in line and "cell" in line for line in wide)


@pytest.mark.parametrize("seed", range(4))
def test_pairs_across_cells_at_microsecond_times(spark, seed):
    draw = random.Random(seed)
    log = [(f"s{draw.randrange(3)}", draw.randrange(4 * 60 * 1_000_000), draw.randrange(1, 5)) for _ in range(300)]
    log += [("s0", 60_000_000 * k + d, 1 + k % 4) for k in range(4) for d in (-1, 0, 1) if k or d >= 0]
    flow = (1, 2, 3, 4, 1, 1, 3)
    made = spark.createDataFrame(log, "session_id STRING, at BIGINT, page_id BIGINT").select(
        "session_id", F.timestamp_micros("at").cast("timestamp_ntz").alias("action_time"), "page_id")
    for cell in ("minute", "hour", "second"):
        row = funnel.count_splits(made, flow, cell).first()
        assert (row.start_pv, [row[f"split_{i}"] for i in range(len(flow) - 1)]) == brute_force(log, flow)
