"""Batch tables: visit actions, users, products, cities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from footfall.functions.expressions import parse_time
from footfall.params import TaskParams

NO_CLICK = -1

# City id, city name, sales area.
CITY_ROWS = (
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
)


def load_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or a folder of parquet files by path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A whole database table. Give partitionColumn, lowerBound, upperBound and numPartitions to
    read a large one with many tasks."""
    return spark.read.format("jdbc").options(**options).load()


def in_date_range(params: TaskParams) -> Column:
    """Both ends included; an absent end is open. Works on date and on yyyy-MM-dd columns."""
    keep = F.lit(True)
    if params.start_date:
        keep = keep & (F.col("date") >= params.start_date)
    if params.end_date:
        keep = keep & (F.col("date") <= params.end_date)
    return keep


def scan_actions(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Actions of the task's dates. On a table partitioned by date this prunes partitions."""
    return actions.filter(in_date_range(params))


def typed_actions(raw: DataFrame) -> DataFrame:
    """Give a log whose times are strings a timestamp column; hours may lack their zero."""
    return raw.withColumn("action_time", parse_time("action_time"))


def clicked_products(actions: DataFrame, params: TaskParams) -> DataFrame:
    """City and product of every product click in the task's dates."""
    return (
        actions.filter(in_date_range(params) & (F.col("click_product_id") != NO_CLICK))
        .select("city_id", "click_product_id")
    )


def city_areas(spark: SparkSession) -> DataFrame:
    """The fixed dimension of ten cities in seven sales areas.

    As a table of literals its size is known to the planner, which broadcasts it unasked.
    """
    values = ", ".join(f"({city}L, '{name}', '{area}')" for city, name, area in CITY_ROWS)
    return spark.sql(f"SELECT * FROM VALUES {values} AS cities(city_id, city_name, area)")


def rows_to_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Small in-memory rows as a DataFrame with declared types."""
    return spark.createDataFrame(list(rows), schema)
