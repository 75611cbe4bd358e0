"""The given tables in the shape of a shop log: an order is a session, a line item an action."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from footfall.params import TaskParams
from footfall.sources.tables import NO_CLICK

DATES = TaskParams(start_date="2024-01-05", end_date="2024-01-24")
FLOW = (1, 2, 3, 4, 5, 6, 7)
TASK = TaskParams(
    start_date="2024-01-05", end_date="2024-01-24", start_age=20, end_age=50, target_page_flow=FLOW
)
FULL_TASK = TaskParams(
    start_date="2024-01-05", end_date="2024-01-24", start_age=20, end_age=50,
    professionals=("BUILDING", "MACHINERY"), sex="male", keywords=("kw1", "kw2", "kw3"),
    cities=tuple(f"city{i}" for i in range(20)), category_ids=tuple(range(60)),
    target_page_flow=FLOW,
)
SAMPLE_SIZE = 3000
AD_THRESHOLD = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: Column) -> Column:
    return column.cast("string")


KIND = "(l_partkey + l_suppkey) % 4"
SECOND = """((l_partkey * 7 + l_suppkey * 13 + l_linenumber * 101) % (CASE l_orderkey % 9 WHEN 0 THEN 4
    WHEN 1 THEN 7 WHEN 2 THEN 10 WHEN 3 THEN 31 WHEN 4 THEN 61 WHEN 5 THEN 181 WHEN 6 THEN 601
    WHEN 7 THEN 1801 ELSE 3600 END))"""
SECOND_OF_MONTH = f"((l_orderkey % 30) * 86400 + (l_orderkey DIV 30) % 24 * 3600 + {SECOND})"


def visit_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A behaviour per line item: search, click, order or pay. Days fold to one month and the
    seconds of a session depend on its id, so that every visit-length class occurs."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "o_custkey AS user_id",
        "concat('s', CAST(l_orderkey AS STRING)) AS session_id",
        "CAST(l_linenumber AS BIGINT) AS page_id",
        f"TIMESTAMP_NTZ '2024-01-01 00:00:00' + {SECOND_OF_MONTH} * INTERVAL '1' SECOND AS action_time",
        "date_add(DATE '2024-01-01', CAST(l_orderkey % 30 AS INT)) AS date",
        f"CASE WHEN {KIND} = 0 THEN concat('kw', CAST(l_partkey % 10 AS STRING)) END AS search_keyword",
        f"CASE WHEN {KIND} = 1 THEN l_suppkey % 100 ELSE {NO_CLICK} END AS click_category_id",
        f"CASE WHEN {KIND} = 1 THEN l_partkey % 100 ELSE {NO_CLICK} END AS click_product_id",
        f"""CASE WHEN {KIND} = 2 THEN concat_ws(',', CAST(l_partkey % 100 AS STRING),
            CAST(l_suppkey % 100 AS STRING)) END AS order_category_ids""",
        f"CASE WHEN {KIND} = 2 THEN CAST(l_partkey AS STRING) END AS order_product_ids",
        f"CASE WHEN {KIND} = 3 THEN CAST(l_partkey % 100 AS STRING) END AS pay_category_ids",
        f"CASE WHEN {KIND} = 3 THEN CAST(l_partkey AS STRING) END AS pay_product_ids",
        "l_suppkey % 10 AS city_id",
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("user_id"),
        F.concat(F.lit("user"), _text(key)).alias("username"),
        F.col("c_name").alias("name"),
        (key % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.concat(F.lit("city"), _text(F.col("c_nationkey"))).alias("city"),
        F.when(key % 2 == 0, "male").otherwise("female").alias("sex"),
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), _text(F.col("p_size") % 2), F.lit("}"))
        .alias("extend_info"),
    )


def ad_lines(events: DataFrame) -> DataFrame:
    """Events, batch or stream, as ad-log lines with the day they belong to."""
    number = F.col("event_id")
    moment = F.col("ts").cast("timestamp_ntz")
    millis = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), moment)
    return events.select(
        F.concat_ws(" ", *(_text(c) for c in (
            millis, number % 10, number % 10, F.col("user_id"), number % 5
        ))).alias("value"),
        F.date_format(moment, "yyyy-MM-dd").alias("day"),
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document."""
    texts = table(spark, sf_dir, "documents").select("text")
    return texts.select(F.explode(F.split("text", "\n")).alias("value"))
