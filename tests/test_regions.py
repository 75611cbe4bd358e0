from __future__ import annotations

from pyspark.sql import functions as F

from helpers import action, plan_of, rows
from footfall.operators import regions
from footfall.params import TaskParams
from footfall.plans.session_report import publish_region_views
from footfall.schemas import PRODUCT_INFO
from footfall.sources.tables import city_areas, clicked_products


def test_clicks_of_the_dates_only(actions_of):
    actions = actions_of([
        action(product=3, city=1), action(product=-1), action(product=4, time="2024-01-07 00:00:00"),
    ])
    clicks = clicked_products(actions, TaskParams(start_date="2024-01-05", end_date="2024-01-06"))
    assert rows(clicks) == [(1, 3)]


def test_counts_and_city_lists(spark):
    clicks = spark.createDataFrame(
        [(1, 5), (1, 5), (2, 5), (0, 5), (77, 5), (1, 6)], "city_id BIGINT, click_product_id BIGINT")
    cities = city_areas(spark)
    assert rows(regions.area_product_counts(clicks, cities)) == [
        ("华东", 5, 3, "1:上海,2:南京"), ("华东", 6, 1, "1:上海"), ("华北", 5, 1, "0:北京")]
    assert regions.area_product_clicks(clicks, cities).count() == 5
    left = regions.area_product_clicks(clicks, cities, "left")
    assert [r.city_id for r in left.collect() if r.area is None] == [77]


def test_literal_cities_are_broadcast_unasked(spark):
    clicks = spark.range(10).select(F.col("id").alias("city_id"), F.lit(1).alias("click_product_id"))
    assert city_areas(spark).dtypes == [
        ("city_id", "bigint"), ("city_name", "string"), ("area", "string")]
    assert "BroadcastHashJoin" in plan_of(regions.area_product_counts(clicks, city_areas(spark)), "simple")


def test_sql_over_the_published_steps(spark, actions_of):
    actions = actions_of([action(product=1, city=1), action(product=1, city=2), action(product=2, city=0)])
    products = spark.createDataFrame([(1, "a", '{"product_status": 0}')], PRODUCT_INFO)
    publish_region_views(actions, products, city_areas(spark), TaskParams())
    assert spark.sql("SELECT * FROM temp_area_product_info").count() == 3
    assert spark.sql("SELECT * FROM temp_area_product_count").count() == 2
    found = spark.sql("SELECT area, click_count, product_status FROM temp_area_count_product_info")
    assert rows(found) == [("华东", 2, "Self")]


def test_city_names_that_contain_each_other_stay(spark):
    cities = spark.createDataFrame([(1, "x", "A"), (11, "x", "A")],
                                   "city_id BIGINT, city_name STRING, area STRING")
    clicks = spark.createDataFrame([(11, 5), (1, 5)], "city_id BIGINT, click_product_id BIGINT")
    assert rows(regions.area_product_counts(clicks, cities)) == [("A", 5, 2, "11:x,1:x")]


def test_product_status_and_unknown_products(spark):
    counts = spark.createDataFrame(
        [("华北", i, 10 - i, "c") for i in range(1, 6)],
        "area STRING, click_product_id BIGINT, click_count BIGINT, city_infos STRING")
    products = spark.createDataFrame(
        [(1, "a", '{"product_status": 0}'), (2, "b", '{"product_status": 1}'),
         (3, "c", '{"other": 1}'), (4, "d", "no json")], PRODUCT_INFO)
    info = regions.area_product_info(counts, products)
    assert {r.click_product_id: r.product_status for r in info.collect()} == {
        1: "Self", 2: "Third Party", 3: "Third Party", 4: "Third Party"}
    top = regions.top_products(info)
    assert sorted(r.click_product_id for r in top.collect()) == [1, 2, 3]
    assert plan_of(top, "simple").count("WindowGroupLimit") == 2


def test_levels_and_ties(spark):
    areas = ["华北", "华东", "华中", "华南", "西南", "西北", "东北"]
    info = spark.createDataFrame(
        [(area, "c", p, 1, "n", "Self") for area in areas for p in (9, 8, 7, 6)],
        "area STRING, city_infos STRING, click_product_id BIGINT, click_count BIGINT, "
        "product_name STRING, product_status STRING")
    top = regions.top_products(info).collect()
    assert {r.area: r.area_level for r in top} == dict(zip(areas, [
        "A_Level", "A_Level", "B_Level", "B_Level", "C_Level", "C_Level", "D_Level"]))
    assert {r.click_product_id for r in top} == {6, 7, 8}
