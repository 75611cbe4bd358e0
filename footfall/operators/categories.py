"""Categories: clicks, orders and payments, the most popular ones and their busiest sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.functions.expressions import seconds_between, split_ids
from footfall.operators.sessions import (
    filter_sessions, restrict_to_sessions, session_aggregates, with_user,
)
from footfall.params import TaskParams
from footfall.sources.tables import NO_CLICK, scan_actions


def _is_click() -> Column:
    return F.col("click_category_id") != NO_CLICK


def category_events(actions: DataFrame) -> DataFrame:
    """One row per category an action touches: session, category, and 1 in clicks, orders or pays.

    One scan gives all three behaviours. An entry of a list that is not a number is dropped.
    """
    clicked = F.when(_is_click(), F.col("click_category_id").cast("string"))
    lists = F.stack(
        F.lit(3),
        F.lit("click"), clicked,
        F.lit("order"), F.col("order_category_ids"),
        F.lit("pay"), F.col("pay_category_ids"),
    ).alias("kind", "ids")
    return (
        actions.select("session_id", lists).filter(F.col("ids").isNotNull())
        .select("session_id", "kind", F.explode(F.split("ids", ",")).alias("item"))
        .select(
            "session_id", F.col("item").try_cast("bigint").alias("category_id"),
            *((F.col("kind") == kind).cast("int").alias(alias)
              for kind, alias in (("click", "clicks"), ("order", "orders"), ("pay", "pays"))),
        )
        .filter(F.col("category_id").isNotNull())
    )


def _sum_events(events: DataFrame, *keys: str) -> DataFrame:
    return events.groupBy(*keys).agg(
        F.sum("clicks").alias("clicks"), F.sum("orders").alias("orders"), F.sum("pays").alias("pays")
    )


def session_category_counts(actions: DataFrame, kept: DataFrame) -> DataFrame:
    """Clicks, orders and pays per (session, category), for the kept sessions.

    Counting comes before the join, so a session with very many actions enters it with one row
    per category.
    """
    return restrict_to_sessions(_sum_events(category_events(actions), "session_id", "category_id"), kept)


def roll_up(actions: DataFrame, params: TaskParams = TaskParams()) -> DataFrame:
    """One scan for sessions and their categories.

    Per session one row whose category is null, with what ``aggregate_sessions`` gives, and one row per
    category it touched, with clicks, orders and pays.
    """
    clicked = F.when(_is_click(), F.col("click_category_id").cast("string"))
    lists = F.stack(
        F.lit(4),
        F.lit("action"), F.lit(None).cast("string"),
        F.lit("click"), clicked,
        F.lit("order"), F.col("order_category_ids"),
        F.lit("pay"), F.col("pay_category_ids"),
    ).alias("kind", "ids")
    carried = ("user_id", "action_time", "search_keyword", "click_category_id")
    is_action = F.col("kind") == "action"
    events = (
        actions.select("session_id", *carried, lists).filter(is_action | F.col("ids").isNotNull())
        .select("session_id", "kind", *(F.when(is_action, F.col(c)).alias(c) for c in carried),
                F.explode_outer(F.split("ids", ",")).alias("item"))
        .withColumn("category_id", F.col("item").try_cast("bigint"))
        .filter(is_action | F.col("category_id").isNotNull())
    )
    rolled = events.groupBy("session_id", "category_id").agg(
        *(F.count_if(F.col("kind") == kind).alias(alias)
          for kind, alias in (("click", "clicks"), ("order", "orders"), ("pay", "pays"))),
        *session_aggregates(params, is_action),
    )
    return rolled.withColumn("visit_length", seconds_between("start_time", "end_time"))


def rolled_sessions(rolled: DataFrame) -> DataFrame:
    """The sessions of ``roll_up``."""
    return rolled.filter("category_id IS NULL").drop("category_id", "clicks", "orders", "pays")


def rolled_categories(rolled: DataFrame) -> DataFrame:
    """Clicks, orders and pays per (session, category) of ``roll_up``."""
    return rolled.filter("category_id IS NOT NULL").select(
        "session_id", "category_id", "clicks", "orders", "pays")


def kept_category_counts(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Clicks, orders and pays per (session, category), for the sessions that pass the task's filter.

    The log is scanned once. A session's own row lends its user and its matches to the session's category
    rows, at most one per category, before the user table is joined.
    """
    rolled = roll_up(scan_actions(actions, params), params)
    of_session = Window.partitionBy("session_id")
    lent = ["user_id", *(name for name in ("keyword_match", "category_match") if name in rolled.columns)]
    own = F.col("category_id").isNull()
    shared = rolled.select(
        "session_id", "category_id", "clicks", "orders", "pays",
        *(F.max(F.when(own, F.col(name))).over(of_session).alias(name) for name in lent),
    ).filter("category_id IS NOT NULL")
    return filter_sessions(with_user(shared, users), params).select(
        "session_id", "category_id", "clicks", "orders", "pays")


def _count(touched: DataFrame, kept: DataFrame | None, alias: str) -> DataFrame:
    """Rows (session_id, category_id) counted by category, for all sessions or the kept ones."""
    if kept is None:
        return touched.groupBy("category_id").agg(F.count(F.lit(1)).alias(alias))
    by_session = touched.groupBy("session_id", "category_id").agg(F.count(F.lit(1)).alias(alias))
    return (
        restrict_to_sessions(by_session, kept)
        .groupBy("category_id").agg(F.sum(alias).alias(alias))
    )


def active_categories(actions: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """Distinct categories clicked, ordered or paid for, in all sessions or the kept ones."""
    touched = category_events(actions).select("session_id", "category_id").distinct()
    if kept is not None:
        touched = restrict_to_sessions(touched, kept)
    return touched.select("category_id").distinct()


def click_counts(actions: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    clicks = actions.filter(_is_click()).select(
        "session_id", F.col("click_category_id").alias("category_id")
    )
    return _count(clicks, kept, "click_count")


def _listed(actions: DataFrame, column: str) -> DataFrame:
    return actions.filter(F.col(column).isNotNull()).select(
        "session_id", F.explode(split_ids(column)).alias("category_id")
    )


def order_counts(actions: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """Each occurrence of a category in an order's list counts."""
    return _count(_listed(actions, "order_category_ids"), kept, "order_count")


def pay_counts(actions: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """Each occurrence of a category in a payment's list counts."""
    return _count(_listed(actions, "pay_category_ids"), kept, "pay_count")


def full_counts(events: DataFrame) -> DataFrame:
    """Click, order and pay counts of every active category, 0 where there is none.

    ``events`` are category events of all sessions, or ``session_category_counts`` of some.
    """
    return _sum_events(events, "category_id").select(
        "category_id",
        F.col("clicks").alias("click_count"),
        F.col("orders").alias("order_count"),
        F.col("pays").alias("pay_count"),
    )


def top_categories(counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` categories with most clicks, then orders, then pays, then the lowest id."""
    return counts.orderBy(
        F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")
    ).limit(n)


def top_sessions(session_counts: DataFrame, top: DataFrame, n: int = 10) -> DataFrame:
    """For each top category the ``n`` sessions that clicked it most; ties go to the lower id.

    How ``top`` reaches the tasks is left to the planner. The ranking is cut to ``n`` inside each task
    before the shuffle by category.
    """
    by_clicks = Window.partitionBy("category_id").orderBy(F.desc("click_count"), "session_id")
    return (
        session_counts.filter(F.col("clicks") > 0)
        .join(top.select("category_id"), "category_id", "left_semi")
        .select("category_id", "session_id", F.col("clicks").alias("click_count"))
        .withColumn("place", F.row_number().over(by_clicks))
        .filter(F.col("place") <= int(n))
        .drop("place")
    )
