from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from helpers import plan_of, rows
from footfall.operators import generic
from footfall.sources import files
from footfall.sources.tables import rows_to_frame
from footfall.staging import stage


def test_map_join_keeps_duplicates_either_way(spark):
    left = spark.createDataFrame([(k, 1) for k in (30, 40, 50, 60, 70)], "k INT, v INT")
    right = spark.createDataFrame([(k, "a") for k in (30, 40, 50, 60, 70, 70)], "k INT, w STRING")
    right = stage(right, "lookup")  # a written side has a size
    small = generic.map_join(left, right, "k")
    assert "BroadcastHashJoin" in plan_of(small, "simple")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = generic.map_join(left, right, "k")
        plan = plan_of(large, "simple")
        assert "SortMergeJoin" in plan and "GlobalLimit" not in plan
        assert rows(large) == rows(small)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(rows(small)) == 6


def test_explode_delimited(spark):
    users = rows_to_frame(spark, [
        (1, "盖伦", 20, "德玛西亚|班德尔城|黑色玫瑰"), (2, "赵信", 25, "艾欧尼亚|诺克萨斯"),
        (3, "皇子", 30, "德玛西亚"),
    ], "id INT, name STRING, age INT, addr STRING")
    pieces = generic.explode_delimited(users, "addr", r"\|", "addr-split")
    assert pieces.columns == ["id", "name", "age", "addr-split"]
    odd = spark.createDataFrame([(1, "a|"), (2, "|"), (3, ""), (4, None), (5, "|b||c||")], "id INT, s STRING")
    assert rows(generic.explode_delimited(odd, "s", r"\|", "p")) == [
        (1, "a"), (3, ""), (5, ""), (5, ""), (5, "b"), (5, "c")]
    assert len(rows(pieces)) == 6 and (1, "盖伦", 20, "班德尔城") in rows(pieces)


def test_explode_chars(spark):
    df = spark.createDataFrame([(1, "a\n😀")], "id INT, s STRING")
    assert [r.col1 for r in generic.explode_chars(df, "s").collect()] == ["a", "\n", "😀"]


def test_word_count_of_a_file(spark, tmp_path):
    path = tmp_path / "word.txt"
    path.write_text("hello spark hadoop flink\nspark flink spark", encoding="utf-8")
    assert rows(generic.word_count(files.read_lines(spark, str(path)))) == [
        ("flink", 2), ("hadoop", 1), ("hello", 1), ("spark", 3)]


def test_words_between_blanks(spark):
    lines = spark.createDataFrame([("a  b  ",), ("",), ("   ",), (None,)], "value STRING")
    assert rows(generic.word_count(lines)) == [("", 2), ("a", 1), ("b", 1)]
    commas = spark.createDataFrame([("hello,spark,hadoop",), ("flink,spark",)], "value STRING")
    assert [r.words for r in generic.split_words(commas, ",").collect()] == [
        ["hello", "spark", "hadoop"], ["flink", "spark"]]
    assert ("spark", 2) in rows(generic.word_count(commas, ","))
    ends = spark.createDataFrame([("a,b,,",), (",a",), (",,",)], "value STRING")
    assert [r.words for r in generic.split_words(ends, ",").collect()] == [["a", "b"], ["", "a"], []]


def test_average_age_of_people(spark, tmp_path):
    path = tmp_path / "user.csv"
    path.write_text('"1","盖伦","20","德玛西亚"\n"2","张无忌","30","光明顶"\n'
                    '"3","张翠山","40","武当派"\n"4","张三丰","100","武当派"', encoding="utf-8")
    people = files.read_people(spark, str(path))
    average = people.groupBy("addr").agg(F.avg("age").alias("a"))
    assert rows(average) == [("光明顶", 30.0), ("德玛西亚", 20.0), ("武当派", 70.0)]


def test_employees(spark, tmp_path):
    path = tmp_path / "employees.json"
    path.write_text('{"name":"M","salary":3000}\n{"name":"A","salary":4501}\n')
    assert files.read_employees(spark, str(path)).agg(F.avg("salary")).first()[0] == 3750.5


def test_group_rows_is_whole_however_large_the_key(spark):
    log = spark.range(5_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 2, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") % 700).alias("x"))
    grouped = generic.group_rows(log, "k", ["x"], parts=16).collect()
    for hot in ("hot", None):
        parts = [g for g in grouped if g.k == hot]
        assert len(parts) == 16 and max(len(g.rows) for g in parts) < 100
    assert all(g.part < 16 for g in grouped)
    rebuilt = sorted((str(g.k), r.x) for g in grouped for r in g.rows for _ in range(r.copies))
    assert rebuilt == sorted((str(r.k), r.x) for r in log.collect())
    assert all(g.n == sum(r.copies for r in g.rows) for g in grouped)


def test_golden_partitions(spark):
    pairs = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k STRING, v INT")
    named = {"a": 0, "b": 1}
    tagged = generic.tag_partitions(generic.partition_by_key(pairs, "k", named, 2))
    assert rows(tagged) == [("a", 1, 0), ("b", 2, 1), ("c", 3, 2)]
    assert tagged.rdd.getNumPartitions() == 3


def test_spread_partitions_stay_within_their_key(spark):
    many = spark.range(3_000).select(F.when(F.col("id") < 10, "a").otherwise("z").alias("k"), "id")
    tagged = generic.tag_partitions(generic.partition_by_key(many, "k", {"a": 0, "b": 1}, 2, spread=4))
    used = {(r.k, r.partition_id) for r in tagged.select("k", "partition_id").distinct().collect()}
    assert {p // 4 for k, p in used if k == "a"} == {0}
    assert {p for k, p in used if k == "z"} == {8, 9, 10, 11}


def test_row_keys(spark, tmp_path):
    path = tmp_path / "behavior.csv"
    path.write_text("1, 2 ,3,pv ,1511544070\n1,2,3,buy,1511544071\n")
    keyed = generic.with_row_key(files.read_behaviors(spark, str(path))).collect()
    assert [(r.item_id, r.behavior) for r in keyed] == [("2", "pv"), ("2", "buy")]
    assert all(len(r.row_key.split("_")[0]) == 10 for r in keyed)
    assert [r.row_key.split("_")[1] for r in keyed] == ["1511544070", "1511544071"]
    assert keyed[0].row_key[:10] != keyed[1].row_key[:10]


def test_long_runs_of_separators_take_linear_time(spark):
    """A million blanks, before a letter and after one; a million letters."""
    blanks, letters = " " * 1_000_000, "x" * 1_000_000
    lines = spark.createDataFrame([(blanks + "a",), ("a" + blanks,), (blanks,)], "value STRING")
    generic.word_count(lines.limit(1)).collect()
    begin = time.time()
    assert rows(generic.word_count(lines)) == [("", 1_000_000), ("a", 2)]
    chars = spark.createDataFrame([(letters,)], "s STRING")
    assert generic.explode_chars(chars, "s").count() == 1_000_000
    assert time.time() - begin < 20


def test_pieces_are_those_of_a_split_without_empty_end(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices("ab,", k=rng.randrange(8))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "value STRING")
    for text, r in zip(texts, generic.split_words(df, ",").collect()):
        expected = text.split(",")
        while len(expected) > 1 and not expected[-1]:
            expected.pop()
        assert r.words == ([] if expected == [""] and text else expected)


def test_group_places_has_no_cell_that_grows(spark):
    """A third of the rows in one key, a third in the null key: parts follow each key's own count."""
    log = spark.range(6_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 2, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") % 1500).alias("x"), F.lit(None).cast("string").alias("y"))
    placed = generic.group_places(log, "k", ["x", "y"], part_rows=100).collect()
    assert sorted((str(r.k), r.x) for r in placed for _ in range(r.copies)) == sorted((str(r.k), r.x) for r in log.collect())
    parts = {}
    for r in placed:
        parts.setdefault((r.k, r.part), []).append((r.place, r.x))
    for (k, part), held in parts.items():
        assert [x for _, x in sorted(held)] == sorted(x for _, x in held)
        assert sorted(place for place, _ in held) == list(range(1, len(held) + 1))
        assert part == 0 or k in ("hot", None)
    assert len({part for k, part in parts if k == "hot"}) == 5
    assert max(len(held) for held in parts.values()) < 200
