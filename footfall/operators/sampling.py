"""Proportional sample of sessions over days and hours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BUCKET_DIGITS = 3


def hour_quotas(hourly: DataFrame, size: int) -> DataFrame:
    """Rows (date, hour, quota) from rows (date, hour, n).

    Each day gets an equal whole share of ``size``; an hour gets its part of the day's sessions,
    rounded down. The window here runs over one row per day, which is all that is left by then.
    """
    days = (
        hourly.groupBy("date")
        .agg(F.sum("n").alias("day_n"), F.collect_list(F.struct("hour", "n")).alias("hours"))
        .withColumn("per_day", F.expr(f"{int(size)} DIV count(1) OVER ()"))
    )
    return (
        days.select("date", "day_n", "per_day", F.inline("hours"))
        .select("date", "hour", F.least(F.col("n"), F.expr("n * per_day DIV day_n")).alias("quota"))
    )


def sample_sessions(sessions: DataFrame, size: int = 1000, seed: str = "0") -> DataFrame:
    """Sample about ``size`` sessions, spread evenly over the days and proportionally over hours.

    The order within an hour is that of a seeded hash, so a run can be repeated. Nothing sorts an
    hour as a whole: a count per leading hash digits shows which digits can hold the first
    ``quota`` hashes of each hour, and only sessions with those are ranked. ``sessions`` is read
    twice; stage it if it is costly.
    """
    drawn = sessions.select(
        "session_id", "start_time", "search_keywords", "click_category_ids",
        F.to_date("start_time").alias("date"), F.hour("start_time").alias("hour"),
        F.md5(F.concat_ws("|", "session_id", F.lit(seed))).alias("draw"),
    ).withColumn("bucket", F.substring("draw", 1, BUCKET_DIGITS))

    buckets = drawn.groupBy("date", "hour", "bucket").agg(F.count(F.lit(1)).alias("n"))
    hourly = buckets.groupBy("date", "hour").agg(F.sum("n").alias("n"))
    earlier = (
        Window.partitionBy("date", "hour").orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # At most 24 rows a day, so broadcast.
    cuts = (
        buckets.join(F.broadcast(hour_quotas(hourly, size)), ["date", "hour"])
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .filter(F.col("before") < F.col("quota"))
        .groupBy("date", "hour", "quota").agg(F.max("bucket").alias("last_bucket"))
    )
    by_hash = Window.partitionBy("date", "hour").orderBy("draw", "session_id")
    return (
        drawn.join(F.broadcast(cuts), ["date", "hour"])
        .filter(F.col("bucket") <= F.col("last_bucket"))
        .withColumn("pick", F.row_number().over(by_hash))
        .filter(F.col("pick") <= F.col("quota"))
        .select("session_id", "start_time", "search_keywords", "click_category_ids")
    )
