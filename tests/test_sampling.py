from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from footfall.operators.sampling import hour_quotas, sample_sessions

FIELDS = ("session_id STRING, start_time TIMESTAMP_NTZ, search_keywords ARRAY<STRING>, "
          "click_category_ids ARRAY<BIGINT>")


def make(spark, per_hour):
    """Sessions from {(day, hour): count}."""
    import datetime

    made = [
        (f"s{day}-{hour}-{i}", datetime.datetime(2024, 1, day, hour, 5), ["k"], [1])
        for (day, hour), count in per_hour.items() for i in range(count)
    ]
    return spark.createDataFrame(made, FIELDS)


def expected(per_hour, size, seed):
    days = defaultdict(int)
    for (day, _), n in per_hour.items():
        days[day] += n
    per_day = size // len(days)
    chosen = set()
    for (day, hour), n in per_hour.items():
        quota = min(n, n * per_day // days[day])
        ids = [f"s{day}-{hour}-{i}" for i in range(n)]
        ids.sort(key=lambda s: (hashlib.md5(f"{s}|{seed}".encode()).hexdigest(), s))
        chosen.update(ids[:quota])
    return chosen


@pytest.mark.parametrize("size", [1, 7, 40, 100_000])
def test_against_brute_force(spark, size):
    per_hour = {(1, 0): 30, (1, 5): 1, (1, 23): 9, (2, 7): 400, (3, 1): 2}
    found = [r.session_id for r in sample_sessions(make(spark, per_hour), size, "x").collect()]
    assert len(found) == len(set(found))
    assert set(found) == expected(per_hour, size, "x")


def test_seed_changes_the_draw_not_the_quotas(spark):
    per_hour = {(1, 0): 50, (1, 1): 50}
    made = make(spark, per_hour)
    one = {r.session_id for r in sample_sessions(made, 20, "1").collect()}
    two = {r.session_id for r in sample_sessions(made, 20, "2").collect()}
    assert one != two
    for drawn in (one, two):
        assert Counter(s.split("-")[1] for s in drawn) == {"0": 10, "1": 10}


def test_quota_is_whole_number_arithmetic(spark):
    hourly = spark.createDataFrame([("d", 1, 1), ("d", 2, 2)], "date STRING, hour INT, n BIGINT")
    found = {r.hour: r.quota for r in hour_quotas(hourly, 30).collect()}
    assert found == {1: 1, 2: 2}  # share of 10 and 20, but no more than there are


def test_an_hour_with_most_sessions_ranks_only_what_may_win(spark):
    """Of 40 000 sessions in one hour, only those with small hashes reach the ranking."""
    hot = spark.range(40_000).select(
        F.concat(F.lit("h"), F.col("id").cast("string")).alias("session_id"),
        F.lit("2024-01-01 03:00:00").cast("timestamp_ntz").alias("start_time"),
        F.array(F.lit("k")).alias("search_keywords"),
        F.array(F.lit(1).cast("bigint")).alias("click_category_ids"),
    )
    ids = [f"h{i}" for i in range(40_000)]
    ids.sort(key=lambda s: (hashlib.md5(f"{s}|0".encode()).hexdigest(), s))
    assert {r.session_id for r in sample_sessions(hot, 1500).collect()} == set(ids[:1500])
