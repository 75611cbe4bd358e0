"""Sessions: roll-up of actions, user attributes, filter, length and step distributions."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions.expressions import ratio_2dp, seconds_between
from footfall.params import TaskParams
from footfall.sources.tables import NO_CLICK, scan_actions

# Name, least and greatest seconds of each visit-length class. A visit of 0 seconds
# is in none of them.
VISIT_CLASSES = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)

# Name, least and greatest number of actions of each step-length class.
STEP_CLASSES = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)


def session_aggregates(params: TaskParams, counted: Column | None = None) -> list[Column]:
    """What a session is rolled up to; ``counted`` tells the rows that are actions from others."""
    clicked = F.col("click_category_id") != NO_CLICK
    columns = [
        F.coalesce(
            F.min(F.when(F.col("user_id") != -1, F.col("user_id"))), F.lit(-1)
        ).alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        (F.count(F.lit(1)) if counted is None else F.count_if(counted)).alias("step_length"),
        F.array_sort(
            F.collect_set(F.nullif(F.col("search_keyword"), F.lit("")))
        ).alias("search_keywords"),
        F.array_sort(
            F.collect_set(F.when(clicked, F.col("click_category_id")))
        ).alias("click_category_ids"),
    ]
    if params.keywords:
        hit = F.col("search_keyword").isin(*params.keywords)
        columns.append(F.bool_or(F.coalesce(hit, F.lit(False))).alias("keyword_match"))
    if params.category_ids:
        hit = clicked & F.col("click_category_id").isin(*params.category_ids)
        columns.append(F.bool_or(F.coalesce(hit, F.lit(False))).alias("category_match"))
    return columns


def aggregate_sessions(actions: DataFrame, params: TaskParams = TaskParams()) -> DataFrame:
    """One row per session.

    Every aggregate is merged map-side first, so a session that holds a large part of the log
    crosses the shuffle as one row per task. Whether any action matches the wanted keywords or
    categories is folded into the same pass, so a report that does not show the two list columns
    never builds them: the optimizer drops them and the roll-up becomes a plain hash aggregate.
    """
    return actions.groupBy("session_id").agg(*session_aggregates(params)).withColumn(
        "visit_length", seconds_between("start_time", "end_time"))


def session_values(actions: DataFrame) -> DataFrame:
    """What the two list columns hold, as rows (session_id, kind, value), each once.

    For sessions with very many different values: nothing gathers a session in one place.
    """
    clicked = F.col("click_category_id") != NO_CLICK
    values = F.stack(
        F.lit(2),
        F.lit("keyword"), F.nullif(F.col("search_keyword"), F.lit("")),
        F.lit("category"), F.when(clicked, F.col("click_category_id").cast("string")),
    ).alias("kind", "value")
    return actions.select("session_id", values).filter(F.col("value").isNotNull()).distinct()


def with_user(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Add age, profession, city and sex; sessions of unknown users drop out, those without a user
    before the join, so that they do not meet in one task.

    The join is left unhinted: the planner broadcasts the user table only below its own size
    limit, else both sides shuffle and AQE splits the partition of a very active user.
    """
    attributes = users.select("user_id", "age", "professional", "city", "sex").filter("user_id <> -1")
    return sessions.filter("user_id <> -1").join(attributes, "user_id", "inner")


def full_sessions(actions: DataFrame, users: DataFrame, params: TaskParams = TaskParams()) -> DataFrame:
    return with_user(aggregate_sessions(actions, params), users)


def session_predicate(params: TaskParams, available: list[str]) -> Column:
    """The task's conditions as one filter predicate. A null attribute fails its condition.

    An age range counts only if both ends are given. Keywords and categories match if any one
    of the session's values is wanted.
    """
    conditions = []
    if params.start_age is not None and params.end_age is not None:
        conditions.append(F.col("age").between(params.start_age, params.end_age))
    if params.professionals:
        conditions.append(F.col("professional").isin(*params.professionals))
    if params.cities:
        conditions.append(F.col("city").isin(*params.cities))
    if params.sex:
        conditions.append(F.col("sex") == params.sex)
    if params.keywords:
        conditions.append(
            F.col("keyword_match") if "keyword_match" in available
            else _overlaps("search_keywords", params.keywords, "array<string>")
        )
    if params.category_ids:
        conditions.append(
            F.col("category_match") if "category_match" in available
            else _overlaps("click_category_ids", params.category_ids, "array<bigint>")
        )
    return reduce(and_, conditions, F.lit(True))


def _overlaps(column: str, wanted: tuple, kind: str) -> Column:
    return F.arrays_overlap(F.col(column), F.array(*map(F.lit, wanted)).cast(kind))


def filter_sessions(sessions: DataFrame, params: TaskParams) -> DataFrame:
    return sessions.filter(session_predicate(params, sessions.columns))


def kept_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions of the task's dates that pass its filter, with their user's attributes."""
    return filter_sessions(full_sessions(scan_actions(actions, params), users, params), params)


def restrict_to_sessions(actions: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows that belong to one of the kept sessions.

    For raw actions stage ``kept`` first. Then both sides of the join are plain shuffles, and AQE
    can split the partition of a session with very many actions. Rows that are already counted by
    session need no such care.
    """
    return actions.join(kept.select("session_id"), "session_id", "left_semi")


def _in_class(column: str, low: int, high: int | None) -> Column:
    value = F.col(column)
    return value >= low if high is None else value.between(low, high)


def _class_counts(sessions: DataFrame) -> DataFrame:
    """All class counts and the session count in one row, in one pass."""
    counts = [F.count(F.lit(1)).alias("session_count")]
    counts += [F.count_if(_in_class("visit_length", low, high)).alias(f"visit_{name}")
               for name, low, high in VISIT_CLASSES]
    counts += [F.count_if(_in_class("step_length", low, high)).alias(f"step_{name}")
               for name, low, high in STEP_CLASSES]
    return sessions.agg(*counts)


def session_buckets(sessions: DataFrame) -> DataFrame:
    """Rows (bucket, n): the session count, then every visit-length and step-length class."""
    wide = _class_counts(sessions)
    pairs = [F.struct(F.lit(name).alias("bucket"), F.col(name).alias("n")) for name in wide.columns]
    return wide.select(F.inline(F.array(*pairs)))


def session_ratio(sessions: DataFrame) -> DataFrame:
    """One row: the session count and each class's share of it, to two places.

    With no sessions the count is reported as 1 and every share as 0.
    """
    wide = _class_counts(sessions).withColumn(
        "session_count", F.greatest(F.col("session_count"), F.lit(1))
    )
    shares = [ratio_2dp(f"visit_{name}", "session_count").alias(f"visit_length_{name}_ratio")
              for name, _, _ in VISIT_CLASSES]
    shares += [ratio_2dp(f"step_{name}", "session_count").alias(f"step_length_{name}_ratio")
               for name, _, _ in STEP_CLASSES]
    return wide.select("session_count", *shares)


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """Rows (date, hour, n) by the hour in which a session starts; hours without any are absent."""
    return (
        sessions
        .groupBy(F.to_date("start_time").alias("date"), F.hour("start_time").alias("hour"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
