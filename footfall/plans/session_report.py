"""The whole session analysis: six reports for one set of task parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from footfall.functions.expressions import format_time, join_sorted
from footfall.operators import categories, funnel, regions, sampling, sessions
from footfall.params import TaskParams
from footfall.sinks.writers import publish_view, with_task
from footfall.sources.tables import clicked_products, scan_actions
from footfall.staging import stage


def sample_report(kept: DataFrame, size: int = 1000, seed: str = "0") -> DataFrame:
    """The sampled sessions with their lists as text."""
    return sampling.sample_sessions(kept, size, seed).select(
        F.col("session_id").alias("sessionid"),
        format_time("start_time").alias("startTime"),
        join_sorted("search_keywords").alias("searchKeywords"),
        join_sorted("click_category_ids").alias("clickCategoryIds"),
    )


def region_report(actions: DataFrame, products: DataFrame, cities: DataFrame,
                  params: TaskParams, n: int = 3) -> DataFrame:
    """The top products of every sales area."""
    counts = regions.area_product_counts(clicked_products(actions, params), cities)
    return regions.top_products(regions.area_product_info(counts, products), n)


def publish_region_views(actions: DataFrame, products: DataFrame, cities: DataFrame,
                         params: TaskParams) -> None:
    """Let SQL users query the steps of the region report: clicks with their area, clicks per area
    and product, and those with product name and status."""
    clicks = clicked_products(actions, params)
    counts = regions.area_product_counts(clicks, cities)
    publish_view(regions.area_product_clicks(clicks, cities), "temp_area_product_info")
    publish_view(counts, "temp_area_product_count")
    publish_view(regions.area_product_info(counts, products), "temp_area_count_product_info")


def build_reports(actions: DataFrame, users: DataFrame, products: DataFrame, cities: DataFrame,
                  params: TaskParams, task_id: str, sample_size: int = 1000,
                  seed: str = "0") -> dict[str, DataFrame]:
    """The result tables by name, each with the task id in front.

    Sessions and their categories come from one scan of the log and are staged, as are the kept sessions,
    which feed four reports, and their category counts, which feed two.
    """
    dated = scan_actions(actions, params)
    rolled = stage(categories.roll_up(dated, params), "roll-up")
    full = sessions.with_user(categories.rolled_sessions(rolled), users)
    kept = stage(sessions.filter_sessions(full, params), "kept-sessions")
    by_category = stage(sessions.restrict_to_sessions(
        categories.rolled_categories(rolled), kept), "session-categories")
    top = categories.top_categories(categories.full_counts(by_category))
    area_top = region_report(actions, products, cities, params)
    reports = {
        "session_aggr_stat": sessions.session_ratio(kept),
        "session_random_extract": sample_report(kept, sample_size, seed),
        "top10_category": top.select(
            F.col("category_id").alias("categoryid"), F.col("click_count").alias("clickCount"),
            F.col("order_count").alias("orderCount"), F.col("pay_count").alias("payCount"),
        ),
        "top10_session": categories.top_sessions(by_category, top).select(
            F.col("category_id").alias("categoryid"), F.col("session_id").alias("sessionid"),
            F.col("click_count").alias("clickCount"),
        ),
        "area_top3_product": area_top.select(
            "area", F.col("area_level").alias("areaLevel"),
            F.col("click_product_id").alias("productid"), F.col("city_infos").alias("cityInfos"),
            F.col("click_count").alias("clickCount"), F.col("product_name").alias("productName"),
            F.col("product_status").alias("productStatus"),
        ),
    }
    if len(params.target_page_flow) > 1:
        rates = funnel.page_convert_rates(dated, params.target_page_flow)
        reports["page_convert_rate"] = funnel.convert_rate_text(rates).select(
            F.col("convert_rate").alias("convertRate")
        )
    return {name: with_task(report, task_id) for name, report in reports.items()}


def save_reports(reports: dict[str, DataFrame], append: Callable[[DataFrame, str], None]) -> None:
    """Append each report to the table of its name with a sink of ``footfall.sinks.writers``."""
    for name, report in reports.items():
        append(report, name)


def report_values(report: DataFrame, name: str) -> DataFrame:
    """A report in long form: (report, taskid, row, column, value).

    Rows are numbered by all their values as text, with one sort per run, so equal reports have equal long
    forms; reports have a few thousand rows at most.
    """
    columns = [c for c in report.columns if c != "taskid"]
    text = [F.col(c).cast("string").alias(c) for c in columns]
    numbered = report.select("taskid", *text).withColumn(
        "row", F.row_number().over(Window.partitionBy("taskid").orderBy(*(F.col(c).asc_nulls_first() for c in columns))))
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns)))
    return numbered.select(F.lit(name).alias("report"), "taskid", "row", cells.alias("cell")).select(
        "report", "taskid", "row", "cell.column", "cell.value")
