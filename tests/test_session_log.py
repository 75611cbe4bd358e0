from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from footfall.operators import session_log, sessions
from footfall.params import TaskParams
from footfall.staging import stage
from helpers import action, final_plan, rows

WHOLE = TaskParams()


@pytest.fixture
def log_of(spark, tmp_path):
    def make(actions, **options):
        name = f"log_{uuid.uuid4().hex}"
        return session_log.write_session_log(actions, name, 4, path=str(tmp_path), **options)

    return make


def days(actions_of):
    """Ten sessions over three days, one of 40 actions, and actions without a session."""
    made = [action(f"s{i % 9}", f"2024-01-0{1 + i % 3} 10:00:{i:02d}", user=1 + i % 3, page=i) for i in range(60)]
    made += [action("hot", f"2024-01-0{1 + i % 3} 11:00:{i:02d}", page=i, category=i % 5) for i in range(40)]
    made += [action(None, "2024-01-02 12:00:00", page=i) for i in range(3)]
    return actions_of(made)


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("partition_by", [("date",), ()])
@pytest.mark.parametrize("hot_rows", [0, 30, 1000])
def test_same_as_the_plain_log(actions_of, users, log_of, hot_rows, partition_by):
    actions = days(actions_of)
    log = log_of(actions, hot_rows=hot_rows, partition_by=partition_by)
    assert log.even.count() + log.hot.count() == 103
    assert log.even.select("session_id").intersect(log.hot.select("session_id")).count() == 0
    task = TaskParams(start_date="2024-01-02", end_date="2024-01-03", start_age=10, end_age=50)
    assert rows_of(session_log.aggregate_log(log)) == rows_of(sessions.aggregate_sessions(actions))
    kept = sessions.kept_sessions(actions, users, task)
    assert kept.count()
    assert rows_of(session_log.kept_log_sessions(log, users, task)) == rows_of(kept)
    few = stage(kept.select("session_id"), "kept")
    columns = ("session_id", "page_id", "action_time")
    assert rows(session_log.restrict_log(log, few).select(*columns)) == rows(
        sessions.restrict_to_sessions(actions, few).select(*columns))


def rows_of(result):
    columns = sorted(result.columns)
    return sorted(map(str, result.select(columns).collect()))


def test_hot_sessions_are_told_by_their_size(actions_of, log_of):
    log = log_of(days(actions_of), hot_rows=30)
    assert {r.session_id for r in log.hot.collect()} == {"hot", None}


def test_roll_up_shuffles_nothing_of_the_bucketed_table(actions_of, log_of):
    log = log_of(days(actions_of))
    rolled = sessions.aggregate_sessions(log.even)
    rolled.collect()
    plan = final_plan(rolled)
    assert "Exchange" not in plan and "Bucketed: true" in plan


def test_restriction_shuffles_only_the_kept_sessions(spark, actions_of, log_of, no_broadcast):
    log = log_of(days(actions_of))
    kept = stage(spark.createDataFrame([("s1",), ("hot",)], "session_id STRING"), "kept")
    restricted = sessions.restrict_to_sessions(log.even, kept)
    assert restricted.count() == 47
    restricted.collect()
    plan = final_plan(restricted).split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    left = plan.index("Bucketed: true")
    assert plan.index("Exchange hashpartitioning") > left  # the second side of the join


def test_dates_are_pruned(actions_of, log_of):
    log = log_of(days(actions_of), hot_rows=30)
    task = TaskParams(start_date="2024-01-02", end_date="2024-01-02")
    for part in session_log.scan_log(log, task):
        assert "PartitionFilters: [isnotnull(date" in final_plan(part)


def test_an_empty_log(actions_of, log_of):
    log = log_of(days(actions_of).limit(0))
    assert session_log.aggregate_log(log).count() == 0
