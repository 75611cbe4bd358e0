from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import action, final_plan, plan_of, rows
from footfall.operators import sessions
from footfall.params import TaskParams
from footfall.staging import stage


def one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0]


def test_roll_up_of_one_session(actions_of):
    row = one(sessions.aggregate_sessions(actions_of([
        action(time="2024-01-05 9:05:06", keyword="ab"),
        action(time="2024-01-05 09:05:09", keyword="b", category=11),
        action(time="2024-01-05 9:05:08", keyword="ab", category=1),
        action(time="2024-01-05 9:05:07", keyword="", category=1),
    ])))
    assert (row.user_id, row.visit_length, row.step_length) == (1, 3, 4)
    assert row.search_keywords == ["ab", "b"]
    assert row.click_category_ids == [1, 11]
    assert str(row.start_time) == "2024-01-05 09:05:06"


def test_first_real_user_counts(actions_of):
    row = one(sessions.aggregate_sessions(actions_of([action(user=-1), action(user=7)])))
    assert row.user_id == 7


def test_sessions_of_unknown_users_drop_out(actions_of, users):
    actions = actions_of([action("a", user=1), action("b", user=99)])
    full = sessions.full_sessions(actions, users)
    assert [r.session_id for r in full.collect()] == ["a"]


PEOPLE = [action(f"s{u}", user=u, keyword=f"k{u}", category=u) for u in (1, 2, 3, 4)]


@pytest.mark.parametrize("params, expected", [
    (TaskParams(), {"s1", "s2", "s3", "s4"}),
    (TaskParams(start_age=20, end_age=50), {"s1", "s2"}),
    (TaskParams(start_age=30), {"s1", "s2", "s3", "s4"}),
    (TaskParams(professionals=("teacher", "cook")), {"s1", "s3"}),
    (TaskParams(cities=("south",)), {"s2", "s3"}),
    (TaskParams(sex="male"), {"s1", "s3"}),
    (TaskParams(keywords=("k2", "k4", "zz")), {"s2", "s4"}),
    (TaskParams(category_ids=(1, 3)), {"s1", "s3"}),
    (TaskParams(keywords=("k1", "k3"), sex="male", cities=("south",)), {"s3"}),
    (TaskParams(start_date="2024-01-06"), set()),
])
def test_filter(actions_of, users, params, expected):
    actions = actions_of(PEOPLE)
    kept = sessions.kept_sessions(actions, users, params)
    assert {r.session_id for r in kept.collect()} == expected
    if not params.start_date:
        from_lists = sessions.filter_sessions(sessions.full_sessions(actions, users), params)
        assert {r.session_id for r in from_lists.collect()} == expected


def test_null_lists_fail_their_condition(actions_of, users):
    actions = actions_of([action("a", user=1)])
    for params in (TaskParams(keywords=("x",)), TaskParams(category_ids=(-1,))):
        assert sessions.kept_sessions(actions, users, params).count() == 0


def test_classes_at_their_edges(spark):
    lengths = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    steps = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 62]
    made = [(length, 1) for length in lengths] + [(0, step) for step in steps]
    found = dict(rows(sessions.session_buckets(
        spark.createDataFrame(made, "visit_length BIGINT, step_length BIGINT"))))
    assert found["session_count"] == len(made)
    visit = {k: v for k, v in found.items() if k.startswith("visit_")}
    assert visit == {
        "visit_1s_3s": 2, "visit_4s_6s": 2, "visit_7s_9s": 2, "visit_10s_30s": 2,
        "visit_30s_60s": 2, "visit_1m_3m": 2, "visit_3m_10m": 2, "visit_10m_30m": 2, "visit_30m": 1,
    }
    step = {k: v for k, v in found.items() if k.startswith("step_")}
    assert step == {"step_1_3": len(lengths) + 2, "step_4_6": 2, "step_7_9": 2, "step_10_30": 2,
                    "step_30_60": 2, "step_60": 2}


def test_ratio_is_exact_half_up(spark):
    made = [(5, 1)] + [(0, 1)] * 199
    row = one(sessions.session_ratio(
        spark.createDataFrame(made, "visit_length BIGINT, step_length BIGINT")))
    assert row.visit_length_4s_6s_ratio == 0.01  # 1/200 = 0.005
    assert row.step_length_1_3_ratio == 1.0
    assert len(row) == 16


def test_ratio_without_sessions(spark):
    row = one(sessions.session_ratio(
        spark.createDataFrame([], "visit_length BIGINT, step_length BIGINT")))
    assert row.session_count == 1 and set(row[1:]) == {0.0}


def test_reports_without_lists_are_plain_hash_aggregates(actions_of, users):
    params = TaskParams(keywords=("k1",), category_ids=(1,))
    ratio = sessions.session_ratio(sessions.kept_sessions(actions_of(PEOPLE), users, params))
    plan = plan_of(ratio)
    assert "collect_set" not in plan and "ObjectHashAggregate" not in plan


def test_filters_reach_the_parquet_scan(spark, actions_of, users, tmp_path):
    path = str(tmp_path / "actions")
    actions_of(PEOPLE).write.partitionBy("date").parquet(path)
    people = str(tmp_path / "users")
    users.write.parquet(people)
    params = TaskParams(start_date="2024-01-05", end_date="2024-01-06", sex="male",
                        start_age=20, end_age=50)
    kept = sessions.kept_sessions(spark.read.parquet(path), spark.read.parquet(people), params)
    plan = plan_of(sessions.session_ratio(kept))
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "GreaterThanOrEqual(age,20)" in plan and "EqualTo(sex,male)" in plan
    assert "search_keyword" not in plan and "username" not in plan


def test_one_very_long_session(spark, actions_of, users):
    """A session with most of the log crosses the shuffle as partial results."""
    base = actions_of([action("hot"), action("cold", user=2)])
    hot = base.filter("session_id = 'hot'").crossJoin(spark.range(50_000, numPartitions=8).toDF("i"))
    hot = hot.withColumn("action_time", F.expr("action_time + make_dt_interval(0, 0, 0, i % 60)")).drop("i")
    found = {r.session_id: (r.step_length, r.visit_length)
             for r in sessions.aggregate_sessions(hot.unionByName(base)).collect()}
    assert found == {"hot": (50_001, 59), "cold": (1, 0)}


def test_sessions_per_hour(actions_of):
    sessions_ = sessions.aggregate_sessions(actions_of([
        action("a", "2024-01-05 10:59:59"), action("b", "2024-01-05 10:00:00"),
        action("c", "2024-01-05 11:00:00"), action("d", "2024-01-06 10:00:00"),
    ]))
    found = {(str(r.date), r.hour): r.n for r in sessions.sessions_per_hour(sessions_).collect()}
    assert found == {("2024-01-05", 10): 2, ("2024-01-05", 11): 1, ("2024-01-06", 10): 1}


def test_restrict_keeps_only_kept(actions_of, spark):
    actions = actions_of([action("a"), action("a", page=2), action("b")])
    kept = spark.createDataFrame([("a",)], "session_id STRING")
    assert sorted(r.page_id for r in sessions.restrict_to_sessions(actions, kept).collect()) == [1, 2]


def test_joins_of_a_hot_session_and_a_hot_user_are_split(spark, actions_of, users, tmp_path):
    """AQE cuts the partition of the hot key into several tasks in both joins on raw rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        wide = spark.range(60_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), "id")).alias("session_id"),
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 1000).alias("user_id"),
            F.sha2(F.col("id").cast("string"), 512).alias("payload"))
        wide.write.parquet(str(tmp_path / "wide"))
        wide = spark.read.parquet(str(tmp_path / "wide"))
        kept = stage(wide.select("session_id").distinct(), "kept")
        people = spark.range(1000).select(
            F.col("id").alias("user_id"), F.lit(30).alias("age"), F.lit("p").alias("professional"),
            F.lit("c").alias("city"), F.lit("m").alias("sex"))
        for joined in (sessions.restrict_to_sessions(wide, kept), sessions.with_user(wide, people)):
            assert joined.agg(F.count("payload")).first()[0] == 60_000
            counted = joined.agg(F.max("payload"))
            counted.collect()
            assert "skew=true" in final_plan(counted)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
