"""Sales areas: product clicks by area and the top products of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.functions.expressions import concat_long_string, group_concat_distinct, product_status


def area_product_clicks(clicks: DataFrame, cities: DataFrame, how: str = "inner") -> DataFrame:
    """Each click with its city's name and area; ``how="left"`` keeps clicks of unknown cities."""
    return clicks.join(cities, "city_id", how).select(
        "city_id", "city_name", "area", "click_product_id"
    )


def area_product_counts(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Rows (area, click_product_id, click_count, city_infos).

    Clicks are counted by city and product before the cities are looked up, so the text of the
    city list is built from one row per city.
    """
    by_city = clicks.groupBy("city_id", "click_product_id").agg(F.count(F.lit(1)).alias("n"))
    located = by_city.join(cities, "city_id")
    city_info = concat_long_string("city_id", "city_name", ":")
    return located.groupBy("area", "click_product_id").agg(
        F.sum("n").alias("click_count"), group_concat_distinct(city_info).alias("city_infos")
    )


def area_product_info(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Add product name and status; products that are not in the product table drop out."""
    described = products.select(
        F.col("product_id").alias("click_product_id"), "product_name",
        product_status("extend_info").alias("product_status"),
    )
    return counts.join(described, "click_product_id").select(
        "area", "city_infos", "click_product_id", "click_count", "product_name", "product_status"
    )


def area_level(area: str = "area") -> Column:
    value = F.col(area)
    return (
        F.when(value.isin("华北", "华东"), "A_Level")
        .when(value.isin("华中", "华南"), "B_Level")
        .when(value.isin("西南", "西北"), "C_Level")
        .otherwise("D_Level")
    )


def top_products(info: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most clicked products of each area with its level; ties go to the lower id.

    Each task keeps only its own best ``n`` per area before the shuffle by area.
    """
    by_clicks = Window.partitionBy("area").orderBy(F.desc("click_count"), "click_product_id")
    return (
        info.withColumn("place", F.row_number().over(by_clicks))
        .filter(F.col("place") <= int(n))
        .select("area", area_level().alias("area_level"), "click_product_id", "city_infos",
                "click_count", "product_name", "product_status")
    )
