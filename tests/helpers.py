"""Rows, plans and inputs that several test modules use."""

from __future__ import annotations

import contextlib
import io

ACTION_FIELDS = (
    "date STRING, user_id BIGINT, session_id STRING, page_id BIGINT, action_time STRING, "
    "search_keyword STRING, click_category_id BIGINT, click_product_id BIGINT, "
    "order_category_ids STRING, pay_category_ids STRING, city_id BIGINT"
)


def action(session="s1", time="2024-01-05 10:00:00", user=1, page=1, keyword=None, category=-1,
           product=-1, orders=None, pays=None, city=0, date=None):
    return (date or time.split(" ")[0], user, session, page, time, keyword, category, product,
            orders, pays, city)


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def plan_of(df, mode="formatted"):
    """The plan before it is run."""
    return final_plan(df.select("*"), mode)


def final_plan(df, mode="simple"):
    """The plan, after a run with what AQE made of it."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()
