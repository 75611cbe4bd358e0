from __future__ import annotations

from pyspark.sql import functions as F

from footfall.functions import expressions as fx
from footfall.functions.sql import register_functions
from footfall.params import TaskParams


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_times(spark):
    for text in ("2024-01-05 9:05:06", "2024-01-05 09:05:06"):
        assert value(spark, fx.format_time(fx.parse_time(F.lit(text)))) == "2024-01-05 09:05:06"
    assert value(spark, fx.parse_time(F.lit("soon"))) is None
    at = fx.parse_time(F.lit("2024-01-05 23:45:06"))
    assert value(spark, fx.date_hour(at)) == "2024-01-05_23"
    assert value(spark, fx.format_minute(at)) == "202401052345"
    assert value(spark, fx.date_key(at)) == "20240105"
    assert str(value(spark, fx.parse_date_key(F.lit("20240105")))) == "2024-01-05"
    later = fx.parse_time(F.lit("2024-01-06 00:00:00"))
    assert value(spark, fx.seconds_between(at, later)) == 894
    assert value(spark, fx.is_before(at, later)) and not value(spark, fx.is_after(at, later))


def test_epoch_millis_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "Asia/Shanghai"):
            spark.conf.set("spark.sql.session.timeZone", other)
            at = fx.epoch_millis_to_time(F.lit(1704067199999).cast("bigint"))
            assert value(spark, fx.date_key(at)) == "20231231"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_numbers(spark):
    assert value(spark, fx.half_up(F.lit(2.726), 1)) == 2.7
    assert value(spark, fx.half_up(F.lit(0.125), 2)) == 0.13
    assert value(spark, fx.ratio_2dp(F.lit(1), F.lit(200))) == 0.01
    assert value(spark, fx.ratio_2dp(F.lit(1), F.lit(201))) == 0.0
    assert value(spark, fx.ratio_2dp(F.lit(1), F.lit(0))) is None


def test_strings(spark):
    assert value(spark, fx.trim_commas(F.lit(",a,b,"))) == "a,b"
    assert [value(spark, fx.zero_pad_2(F.lit(x))) for x in ("7", "07", "123")] == ["07", "07", "123"]
    assert value(spark, fx.split_ids(F.lit("1,,2,x"))) == [1, 2]
    assert value(spark, fx.split_ids(F.lit(None).cast("string"))) == []
    assert value(spark, fx.join_sorted(F.array(F.lit(11), F.lit(2)))) == "2,11"
    assert value(spark, fx.join_sorted(F.array().cast("array<string>"))) is None
    assert value(spark, fx.is_empty(F.lit(""))) and not value(spark, fx.is_empty(F.lit("a")))


def test_delimited_records(spark):
    record = F.lit("sessionid=a|kw=|age=12|homepage=x=y")
    assert value(spark, fx.kv_get(record, "age")) == "12"
    assert value(spark, fx.kv_get(record, "kw")) is None
    assert value(spark, fx.kv_get(record, "page")) is None
    assert value(spark, fx.kv_get(record, "homepage")) == "x=y"
    assert value(spark, fx.kv_set(record, "age", F.lit("$1"))) == "sessionid=a|kw=|age=$1|homepage=x=y"
    assert value(spark, fx.kv_set(record, "none", F.lit("1"))) == "sessionid=a|kw=|age=12|homepage=x=y"


def test_averages(spark):
    ages = spark.createDataFrame([(1, "a"), (2, "a"), (None, "a"), (None, "b")], "n BIGINT, k STRING")
    found = {r.k: r.v for r in ages.groupBy("k").agg(fx.user_avg("n").alias("v")).collect()}
    assert found == {"a": 1.5, "b": None}


def test_sql_functions(spark):
    register_functions(spark)
    row = spark.sql("""SELECT concat_long_string(1, 'x', ':') a, concat_long_str('hello', 100, '=') b,
        get_json_field('{"product_status": 0}', 'product_status') c, plus_one(1) d""").first()
    assert tuple(row) == ("1:x", "hello=100", "0", 2)
    chars = spark.sql("SELECT col1 FROM user_udtf('武当\\n派')").collect()
    assert [r.col1 for r in chars] == ["武", "当", "\n", "派"]


def test_task_params_from_json(spark):
    params = TaskParams.from_json(spark, """{startDate:"2020-03-01", endDate:"2020-05-31",
        startAge: 20, endAge: 50, professionals: "", cities: "a,b", sex:"", keywords:"",
        categoryIds:"3,4", targetPageFlow:"1,2,3,4,5,6,7"}""")
    assert params == TaskParams("2020-03-01", "2020-05-31", 20, 50, (), ("a", "b"), None, (), (3, 4),
                                (1, 2, 3, 4, 5, 6, 7))
