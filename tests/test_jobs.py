from __future__ import annotations

from helpers import action, rows
from footfall.plans import session_job
from footfall.schemas import PRODUCT_INFO
from footfall.streaming import ad_job
from footfall.streaming.ad_clicks import AdTables, running_table


def test_session_job(spark, users, tmp_path):
    log = [action("a", "2024-01-05 9:00:00", 1, page=1, category=5, product=1, city=1),
           action("a", "2024-01-05 9:00:04", 1, page=2)]
    from helpers import ACTION_FIELDS
    spark.createDataFrame(log, ACTION_FIELDS).write.partitionBy("date").parquet(f"{tmp_path}/actions")
    users.createOrReplaceTempView("job_users")
    products = spark.createDataFrame([(1, "phone", '{"product_status": 1}')], PRODUCT_INFO)
    products.write.parquet(f"{tmp_path}/products")
    args = session_job.arguments([
        "--actions", f"{tmp_path}/actions", "--users", "job_users", "--products", f"{tmp_path}/products",
        "--params", '{startDate:"2024-01-01", endDate:"2024-01-31", targetPageFlow:"1,2"}',
        "--task-id", "t9", "--out", f"{tmp_path}/out",
    ])
    assert session_job.run(spark, args) == "t9"
    read = lambda name: rows(spark.read.parquet(f"{tmp_path}/out/{name}"))
    assert read("page_convert_rate") == [("t9", "1_2=1.0")]
    assert read("top10_session") == [("t9", 5, "a", 1)]
    assert read("area_top3_product") == [
        ("t9", "华东", "A_Level", 1, "1:上海", 1, "phone", "Third Party")]
    assert read("session_random_extract") == [("t9", "a", "2024-01-05 09:00:00", None, "5")]


def test_ad_job(spark, tmp_path, capsys):
    spark.createDataFrame([("1704067200005 p c 7 1",)] * 3, "value STRING").write.text(f"{tmp_path}/in")
    args = ad_job.arguments(["--folder", f"{tmp_path}/in", "--root", str(tmp_path), "--threshold", "2",
                             "--once", "--show"])
    ad_job.start(spark, args).awaitTermination()
    tables = AdTables(f"{tmp_path}/tables")
    assert rows(tables.user_clicks.latest(spark)) == [("20240101", 7, 1, 3)]
    assert rows(tables.blacklist.latest(spark)) == [(7,)]


def test_jdbc_options_of_a_table():
    given = ["isolationLevel=NONE", "top10_session:batchsize=5", "top10_session:truncate=true"]
    assert session_job.table_options(given, "page_convert_rate") == {"batchsize": "10000", "isolationLevel": "NONE"}
    assert session_job.table_options(given, "top10_session") == {
        "batchsize": "5", "isolationLevel": "NONE", "truncate": "true"}


def test_ad_job_keeps_running_totals(spark, tmp_path):
    spark.createDataFrame([("1704067200005 p c 7 1",)] * 3, "value STRING").write.text(f"{tmp_path}/in")
    args = ad_job.arguments(["--folder", f"{tmp_path}/in", "--root", str(tmp_path), "--once", "--running",
                             "--option", "maxFilesPerTrigger=1", "--watermark", "2 days"])
    ad_job.start(spark, args).awaitTermination()
    totals = running_table(f"{tmp_path}/running").latest(spark)
    assert rows(totals) == [("20240101", "p", "c", 1, 3)]
