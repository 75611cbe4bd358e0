from __future__ import annotations

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter, functions as F

from helpers import action, rows
from footfall.params import TaskParams
from footfall.plans.session_report import build_reports, report_values, save_reports
from footfall.schemas import PRODUCT_INFO
from footfall.sinks import writers
from footfall.sources.streams import kafka_options
from footfall.sources.tables import city_areas, read_jdbc
from footfall.staging import scratch_dir, stage


def test_jdbc_options():
    options = writers.jdbc_options("jdbc:x", "t", "u", "p", batchsize=10000, isolationLevel="NONE",
                                   truncate="false")
    assert options == {"url": "jdbc:x", "dbtable": "t", "user": "u", "password": "p",
                       "batchsize": "10000", "isolationLevel": "NONE", "truncate": "false"}


def test_jdbc_append_is_handed_to_the_writer(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(DataFrameWriter, "format", lambda w, f: seen.update(format=f) or w)
    monkeypatch.setattr(DataFrameWriter, "options", lambda w, **o: seen.update(o) or w)
    monkeypatch.setattr(DataFrameWriter, "mode", lambda w, m: seen.update(mode=m) or w)
    monkeypatch.setattr(DataFrameWriter, "save", lambda w: seen.update(saved=True))
    writers.append_jdbc(spark.range(1), {"url": "jdbc:x", "dbtable": "t"})
    assert seen == {"format": "jdbc", "url": "jdbc:x", "dbtable": "t", "mode": "append", "saved": True}


def test_jdbc_read_is_handed_to_the_reader(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(DataFrameReader, "format", lambda r, f: seen.update(format=f) or r)
    monkeypatch.setattr(DataFrameReader, "options", lambda r, **o: seen.update(o) or r)
    monkeypatch.setattr(DataFrameReader, "load", lambda r: seen.update(loaded=True))
    read_jdbc(spark, writers.jdbc_options("jdbc:x", "ad_blacklist", numPartitions=8))
    assert seen == {"format": "jdbc", "url": "jdbc:x", "dbtable": "ad_blacklist",
                    "numPartitions": "8", "loaded": True}


def test_table_append(spark, tmp_path):
    df = spark.createDataFrame([(1, "d1"), (2, "d2")], "id BIGINT, date STRING")
    writers.append_table(df, "footfall_test_table", str(tmp_path / "t"), ("date",))
    writers.append_table(df, "footfall_test_table", str(tmp_path / "t"), ("date",))
    assert rows(spark.table("footfall_test_table").filter("date = 'd1'").select("id")) == [(1,), (1,)]
    spark.sql("DROP TABLE footfall_test_table")


def test_view(spark):
    writers.publish_view(spark.range(3), "footfall_numbers")
    assert spark.sql("SELECT sum(id) FROM footfall_numbers").first()[0] == 3


def test_keyed_text(spark, tmp_path):
    df = spark.createDataFrame([("(a,1)", 0), ("(b,2)", 1), ("(c,3)", 2)], "line STRING, p INT")
    writers.write_keyed_text(df, "line", "p", str(tmp_path / "out"))
    for p, line in enumerate(("(a,1)", "(b,2)", "(c,3)")):
        assert [r.value for r in spark.read.text(str(tmp_path / "out" / f"p={p}")).collect()] == [line]


def test_staging_uses_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(5), "test")
    assert rows(staged) == [(i,) for i in range(5)]
    assert scratch_dir(spark, "x").startswith(root)
    assert all(root in name for name in staged.inputFiles())


def test_staging_refuses_a_cluster_without_shared_folder():
    class Cluster:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError):
        scratch_dir(Cluster, "x")


def test_kafka_options():
    assert kafka_options("b1:9092,b2:9092", "log") == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "log", "startingOffsets": "latest"}


def test_all_reports(spark, actions_of, users, tmp_path):
    actions = actions_of([
        action("a", "2024-01-05 10:00:00", 1, page=1, category=5, product=1, city=1),
        action("a", "2024-01-05 10:00:09", 1, page=2, keyword="kw"),
        action("b", "2024-01-05 11:00:00", 2, page=1, orders="5,6"),
        action("c", "2024-01-05 11:00:00", 3, page=1, category=9, product=1, city=2),
        action("d", "2023-01-05 11:00:00", 1, page=1, category=9, product=1, city=2),
    ])
    products = spark.createDataFrame([(1, "phone", '{"product_status": 0}')], PRODUCT_INFO)
    params = TaskParams("2024-01-01", "2024-01-31", 20, 50, target_page_flow=(1, 2, 3))
    reports = build_reports(actions, users, products, city_areas(spark), params, "t1", 10)
    assert rows(reports["top10_category"]) == [("t1", 5, 1, 1, 0), ("t1", 6, 0, 1, 0)]
    assert rows(reports["top10_session"]) == [("t1", 5, "a", 1)]
    assert sorted(reports["session_random_extract"].collect()) == [
        ("t1", "a", "2024-01-05 10:00:00", "kw", "5"), ("t1", "b", "2024-01-05 11:00:00", None, None)]
    assert reports["session_aggr_stat"].first().session_count == 2
    assert reports["session_aggr_stat"].first().visit_length_7s_9s_ratio == 0.5
    assert rows(reports["page_convert_rate"]) == [("t1", "1_2=0.3333333333333333|2_3=0.0")]
    assert rows(reports["area_top3_product"]) == [
        ("t1", "华东", "A_Level", 1, "1:上海,2:南京", 2, "phone", "Self")]
    save_reports(reports, lambda df, name: writers.append_files(df, f"{tmp_path}/{name}"))
    save_reports(reports, lambda df, name: writers.append_files(df, f"{tmp_path}/{name}"))
    assert spark.read.parquet(f"{tmp_path}/top10_category").count() == 4


def test_a_run_that_is_saved_again_replaces_itself(spark, tmp_path):
    """Saved twice, found once; other runs of the same report stay."""
    def save(run, n):
        report = writers.with_task(spark.range(n).select(F.col("id").alias("v")), run)
        save_reports({"r": report}, lambda df, name: writers.replace_run(df, f"{tmp_path}/{name}"))

    for run, n in (("a", 3), ("b", 2), ("a", 3), ("a", 3)):
        save(run, n)
    assert rows(spark.read.parquet(f"{tmp_path}/r").select("taskid", "v")) == [
        ("a", 0), ("a", 1), ("a", 2), ("b", 0), ("b", 1)]
    long = report_values(spark.read.parquet(f"{tmp_path}/r"), "r")
    assert rows(long.filter("taskid = 'b'")) == [("r", "b", 1, "v", "0"), ("r", "b", 2, "v", "1")]


def test_files_of_key_partitions_follow_their_bytes(spark, tmp_path):
    """Sixteen tasks that all have every key partition make one small file each, not sixteen."""
    df = spark.range(4_000).repartition(16).select(
        F.col("id").cast("string").alias("line"), (F.col("id") % 3).cast("int").alias("p"))
    writers.write_keyed_text(df, "line", "p", str(tmp_path / "out"))
    for p in range(3):
        files = list((tmp_path / "out" / f"p={p}").glob("part-*"))
        assert len(files) == 1
    assert spark.read.text(str(tmp_path / "out")).count() == 4_000
