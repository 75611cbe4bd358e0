"""Every query by name, run on the given tables: ``query(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import functools

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from checks import views
from checks.views import AD_THRESHOLD, FLOW, FULL_TASK, SAMPLE_SIZE, TASK
from footfall.functions import expressions as fx
from footfall.functions.sql import register_functions
from footfall.operators import categories, funnel, generic, regions, session_log, sessions
from footfall.plans.session_report import (
    build_reports, region_report, report_values as long_form, sample_report, save_reports,
)
from footfall.sinks import writers
from footfall.sources import files, streams
from footfall.sources.tables import (
    city_areas, clicked_products, rows_to_frame, scan_actions, typed_actions,
)
from footfall.staging import scratch_dir, stage
from footfall.streaming import ad_clicks

LOG_BUCKETS = 8

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def _actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_actions(views.visit_actions(spark, sf_dir), TASK)


def _kept(spark: SparkSession, sf_dir: str, task=TASK) -> DataFrame:
    return sessions.kept_sessions(
        views.visit_actions(spark, sf_dir), views.user_info(spark, sf_dir), task
    )


def _session_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.kept_category_counts(
        views.visit_actions(spark, sf_dir), views.user_info(spark, sf_dir), TASK)


def _session_row(rows: DataFrame, *more: str) -> DataFrame:
    """Session rows with times and lists as text."""
    return rows.select(
        "session_id", "user_id", "visit_length", "step_length",
        fx.format_time("start_time").alias("start_time"),
        fx.format_time("end_time").alias("end_time"),
        fx.join_sorted("search_keywords").alias("search_keywords"),
        fx.join_sorted("click_category_ids").alias("click_category_ids"),
        *more,
    )


# --- sessions --------------------------------------------------------------------------------

@query
def action_scan(spark, sf_dir):
    return (
        _actions(spark, sf_dir)
        .withColumn("action_time", fx.format_time("action_time"))
        .withColumn("date", fx.format_date("date"))
    )


@query
def session_aggregate(spark, sf_dir):
    return _session_row(sessions.aggregate_sessions(_actions(spark, sf_dir)))


@query
def session_values(spark, sf_dir):
    return sessions.session_values(views.visit_actions(spark, sf_dir))


@query
def session_full(spark, sf_dir):
    full = sessions.full_sessions(_actions(spark, sf_dir), views.user_info(spark, sf_dir))
    return _session_row(full, "age", "professional", "city", "sex")


@query
def session_filter(spark, sf_dir):
    return _session_row(_kept(spark, sf_dir, FULL_TASK), "age", "professional", "city", "sex")


@query
def session_actions(spark, sf_dir):
    """The actions of the sessions that pass the full filter."""
    kept = stage(_kept(spark, sf_dir, FULL_TASK).select("session_id"), "kept")
    return sessions.restrict_to_sessions(_actions(spark, sf_dir), kept).select(
        "session_id", "page_id", fx.format_time("action_time").alias("action_time"), "search_keyword"
    )


def _session_log(spark: SparkSession, sf_dir: str) -> session_log.SessionLog:
    path = scratch_dir(spark, "session-log")
    name = "footfall_log_" + path.rsplit("-", 1)[1]
    actions = views.visit_actions(spark, sf_dir)
    return session_log.write_session_log(actions, name, LOG_BUCKETS, path=path, partition_by=())


@query
def session_log_filter(spark, sf_dir):
    """The sessions that pass the full filter, from the log laid out by session."""
    kept = session_log.kept_log_sessions(_session_log(spark, sf_dir), views.user_info(spark, sf_dir), FULL_TASK)
    return _session_row(kept, "age", "professional", "city", "sex")


@query
def session_log_actions(spark, sf_dir):
    """The actions of the sessions that pass the full filter, from the log laid out by session."""
    log = _session_log(spark, sf_dir)
    kept = stage(session_log.kept_log_sessions(log, views.user_info(spark, sf_dir), FULL_TASK)
                 .select("session_id"), "kept")
    return session_log.restrict_log(session_log.scan_log(log, TASK), kept).select(
        "session_id", "page_id", fx.format_time("action_time").alias("action_time"), "search_keyword"
    )


@query
def session_buckets(spark, sf_dir):
    return sessions.session_buckets(_kept(spark, sf_dir))


@query
def session_ratio(spark, sf_dir):
    return sessions.session_ratio(_kept(spark, sf_dir))


@query
def sessions_per_hour(spark, sf_dir):
    hour = F.concat(fx.format_date("date"), F.lit("_"), fx.zero_pad_2("hour"))
    day_n = F.sum("n").over(Window.partitionBy("date"))
    rows = sessions.sessions_per_hour(_kept(spark, sf_dir))
    return rows.select(hour.alias("date_hour"), "n", day_n.alias("day_n"))


@query
def session_sample(spark, sf_dir):
    return sample_report(stage(_kept(spark, sf_dir), "kept"), SAMPLE_SIZE)


# --- categories ------------------------------------------------------------------------------

@query
def active_categories(spark, sf_dir):
    return categories.active_categories(_actions(spark, sf_dir), _kept(spark, sf_dir))


@query
def category_click_counts(spark, sf_dir):
    return categories.click_counts(_actions(spark, sf_dir), _kept(spark, sf_dir))


@query
def category_order_counts(spark, sf_dir):
    return categories.order_counts(_actions(spark, sf_dir), _kept(spark, sf_dir))


@query
def category_pay_counts(spark, sf_dir):
    return categories.pay_counts(_actions(spark, sf_dir), _kept(spark, sf_dir))


@query
def category_full_counts(spark, sf_dir):
    return categories.full_counts(_session_categories(spark, sf_dir))


@query
def top10_categories(spark, sf_dir):
    return categories.top_categories(categories.full_counts(_session_categories(spark, sf_dir)))


@query
def top10_sessions(spark, sf_dir):
    counts = stage(_session_categories(spark, sf_dir), "session-categories")
    return categories.top_sessions(counts, categories.top_categories(categories.full_counts(counts)))


# --- page flow -------------------------------------------------------------------------------

@query
def page_split_counts(spark, sf_dir):
    return funnel.page_split_counts(_actions(spark, sf_dir), FLOW)


@query
def page_convert_rate(spark, sf_dir):
    return funnel.page_convert_rates(_actions(spark, sf_dir), FLOW)


@query
def page_convert_rate_text(spark, sf_dir):
    return funnel.convert_rate_text(funnel.page_convert_rates(_actions(spark, sf_dir), FLOW))


# --- sales areas -----------------------------------------------------------------------------

def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicked_products(views.visit_actions(spark, sf_dir), TASK)


def _area_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.area_product_counts(_clicks(spark, sf_dir), city_areas(spark))


@query
def city_product_clicks(spark, sf_dir):
    return _clicks(spark, sf_dir)


@query
def area_product_clicks(spark, sf_dir):
    return regions.area_product_clicks(_clicks(spark, sf_dir), city_areas(spark))


@query
def area_product_clicks_left(spark, sf_dir):
    known = city_areas(spark).filter("area != '东北'")
    return regions.area_product_clicks(_clicks(spark, sf_dir), known, how="left")


@query
def area_product_counts(spark, sf_dir):
    return _area_counts(spark, sf_dir)


@query
def area_product_info(spark, sf_dir):
    return regions.area_product_info(_area_counts(spark, sf_dir), views.product_info(spark, sf_dir))


@query
def area_top3_products(spark, sf_dir):
    return region_report(
        views.visit_actions(spark, sf_dir), views.product_info(spark, sf_dir), city_areas(spark), TASK
    )


# --- functions -------------------------------------------------------------------------------

@query
def product_status(spark, sf_dir):
    return views.product_info(spark, sf_dir).select(
        "product_id", fx.json_field("extend_info", "product_status").alias("status_code"),
        fx.product_status("extend_info").alias("product_status"),
    )


@query
def json_field_sql(spark, sf_dir):
    """The registered JSON function for SQL users, over a published view."""
    register_functions(spark)
    writers.publish_view(views.product_info(spark, sf_dir), "footfall_check_products")
    return spark.sql("""
        SELECT get_json_field(extend_info, 'product_status') AS status_code, count(*) AS n
        FROM footfall_check_products GROUP BY ALL""")


@query
def concat_long_string(spark, sf_dir):
    register_functions(spark)
    return spark.sql("""
        SELECT user_id, concat_long_string(user_id, city, ':') AS number_first,
               concat_long_str(city, user_id, '=') AS text_first
        FROM {users}""", users=views.user_info(spark, sf_dir))


@query
def group_avg(spark, sf_dir):
    return views.user_info(spark, sf_dir).groupBy("city").agg(F.avg("age").alias("avg_age"))


@query
def udaf_avg(spark, sf_dir):
    return views.visit_actions(spark, sf_dir).groupBy("city_id").agg(fx.user_avg("page_id").alias("avg_page"))


@query
def global_avg(spark, sf_dir):
    return views.visit_actions(spark, sf_dir).agg(F.avg("page_id").alias("avg_page"))


@query
def char_explode(spark, sf_dir):
    texts = views.table(spark, sf_dir, "documents").select("lang", "text")
    chars = generic.explode_chars(texts, "text", "col1")
    return chars.groupBy("lang", "col1").agg(F.count(F.lit(1)).alias("n"))


@query
def udtf_chars(spark, sf_dir):
    register_functions(spark)
    return spark.sql("SELECT user_id, t.col1 FROM {users}, LATERAL user_udtf(city) t",
                     users=views.user_info(spark, sf_dir))


@query
def explode_delimited(spark, sf_dir):
    orders = views.visit_actions(spark, sf_dir).filter("order_category_ids IS NOT NULL").select(
        "session_id", "page_id", F.translate("order_category_ids", ",", "|").alias("ids")
    )
    return generic.explode_delimited(orders, "ids", r"\|", "category")


@query
def date_functions(spark, sf_dir):
    rows = sessions.aggregate_sessions(views.visit_actions(spark, sf_dir))
    shown = rows.withColumn("text", fx.format_time("start_time"))
    return shown.select(
        "session_id",
        fx.format_time(fx.parse_time("text")).alias("time"),
        fx.format_date("start_time").alias("date"),
        fx.format_minute("start_time").alias("minute"),
        fx.date_key("start_time").alias("date_key"),
        fx.format_date(fx.parse_date_key(fx.date_key("start_time"))).alias("key_date"),
        fx.date_hour("start_time").alias("date_hour"),
        fx.seconds_between("start_time", "end_time").alias("seconds"),
        fx.is_before("start_time", "end_time").alias("starts_before_end"),
        fx.is_after("start_time", "end_time").alias("starts_after_end"),
        fx.zero_pad_2(F.minute("start_time")).alias("minute_of_hour"),
    )


@query
def relative_dates(spark, sf_dir):
    """Today and yesterday against the session's own date, the same for every user."""
    shown = views.user_info(spark, sf_dir).select(
        "user_id", fx.today().cast("date").alias("today"), fx.yesterday().cast("date").alias("yesterday"))
    return shown.select(
        "user_id", (F.col("today") == F.current_date()).alias("is_today"),
        F.date_diff("today", "yesterday").alias("days_between"))


@query
def kv_string_fields(spark, sf_dir):
    rows = sessions.aggregate_sessions(views.visit_actions(spark, sf_dir))
    record = fx.kv_record(
        sessionid=F.col("session_id"),
        searchKeywords=fx.join_sorted("search_keywords"),
        clickCategoryIds=fx.join_sorted("click_category_ids"),
        stepLength=F.col("step_length"),
    )
    padded = F.concat(F.lit(","), fx.join_sorted("search_keywords"), F.lit(","))
    return rows.select("session_id", record.alias("record"), padded.alias("padded")).select(
        "session_id", "record",
        fx.kv_get("record", "searchKeywords").alias("keywords"),
        fx.is_empty(fx.kv_get("record", "clickCategoryIds")).alias("no_category"),
        fx.kv_set("record", "stepLength", F.lit("0")).alias("reset"),
        fx.kv_set("record", "age", F.lit("1")).alias("unchanged"),
        fx.trim_commas("padded").alias("trimmed"),
    )


# --- general operators -----------------------------------------------------------------------

@query
def map_join(spark, sf_dir):
    customers = views.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = views.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name"
    )
    return generic.map_join(customers, nations, "c_nationkey")


@query
def word_count(spark, sf_dir):
    return generic.word_count(views.document_lines(spark, sf_dir))


@query
def word_split(spark, sf_dir):
    """Split without and with explosion: lines, and the pieces all lines together have."""
    pieces = generic.split_words(
        views.visit_actions(spark, sf_dir).select(F.col("order_category_ids").alias("value")), ","
    ).filter("words IS NOT NULL")
    return pieces.groupBy(F.size("words").alias("pieces")).agg(F.count(F.lit(1)).alias("lines"))


@query
def grouped_rows(spark, sf_dir):
    rows = views.visit_actions(spark, sf_dir).select(
        "session_id", "page_id", fx.format_time("action_time").alias("at"), "city_id"
    )
    grouped = generic.group_rows(rows, "session_id", ["page_id", "at", "city_id"], parts=4)
    text = F.transform("rows", lambda r: F.concat_ws(
        "@", r["page_id"].cast("string"), r["at"], r["city_id"].cast("string"),
        r["copies"].cast("string")))
    return grouped.select("session_id", "part", "n", F.array_join(text, ";").alias("content"))


@query
def grouped_row_places(spark, sf_dir):
    """The groups as rows, summed up per key: a city has many parts, each of some hundred rows."""
    rows = views.visit_actions(spark, sf_dir).select("session_id", "page_id", "city_id")
    placed = generic.group_places(rows, "city_id", ["session_id", "page_id"], part_rows=500)
    return placed.groupBy("city_id").agg(
        F.sum("copies").alias("n"), F.count(F.lit(1)).alias("entries"),
        F.count_distinct("part").alias("parts"),
        F.sum(F.col("page_id") * F.col("copies")).alias("pages"))


@query
def behavior_ingest(spark, sf_dir):
    path = scratch_dir(spark, "behavior-csv")
    event = views.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string"), F.concat(F.lit(" "), F.col("event_id").cast("string")),
        (F.col("event_id") % 100).cast("string"), F.concat("event_type", F.lit(" ")),
        F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss"),
    )
    event.write.option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    exported = scratch_dir(spark, "behavior-export")
    writers.export_behaviors(generic.with_row_key(files.read_behaviors(spark, path)), exported)
    return spark.read.parquet(exported).withColumn("behavior", F.col("behavior").cast("string"))


@query
def people_csv(spark, sf_dir):
    path = scratch_dir(spark, "people-csv")
    views.user_info(spark, sf_dir).select("user_id", "name", "age", "city").write.csv(path)
    people = files.read_people(spark, path)
    return people.groupBy("addr").agg(fx.user_avg(F.col("age").cast("bigint")).alias("avg_age"))


@query
def json_ingest(spark, sf_dir):
    path = scratch_dir(spark, "employees-json")
    views.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), (F.col("c_custkey") * 10).alias("salary")
    ).write.json(path)
    return files.read_employees(spark, path)


@query
def text_lines(spark, sf_dir):
    path = scratch_dir(spark, "lines")
    views.document_lines(spark, sf_dir).write.text(path)
    return generic.word_count(files.read_lines(spark, path))


@query
def rows_to_df(spark, sf_dir):
    """Rows from memory, renamed and joined to the log; column arithmetic in place of map."""
    kinds = rows_to_frame(spark, [(0, "even"), (1, "odd")], "parity INT, kind STRING").toDF(
        "page_parity", "page_kind"
    )
    pages = views.visit_actions(spark, sf_dir).select(
        "page_id", (F.col("page_id") % 2).cast("int").alias("page_parity"),
        (F.col("page_id") + 1).alias("plus_one"), (F.col("page_id") * 2).alias("doubled"),
    )
    counted = pages.groupBy(*pages.columns).agg(F.count(F.lit(1)).alias("n"))
    return generic.map_join(counted, kinds, "page_parity").drop("page_parity")


@query
def time_parse(spark, sf_dir):
    """A log whose times are text without a leading zero of the hour."""
    raw = views.visit_actions(spark, sf_dir).select(
        "session_id", "page_id",
        F.date_format("action_time", "yyyy-MM-dd H:mm:ss").alias("action_time"),
    )
    return typed_actions(raw).withColumn("action_time", fx.format_time("action_time"))


STATUS_PARTITIONS = {"F": 0, "O": 1}


@query
def custom_partition(spark, sf_dir):
    spread = 4
    orders = views.table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey")
    moved = generic.partition_by_key(orders, "o_orderstatus", STATUS_PARTITIONS, 2, spread)
    home = F.expr(f"CAST(partition_id DIV {spread} AS INT)").alias("key_partition")
    return (
        generic.tag_partitions(moved).select("o_orderstatus", home)
        .groupBy("o_orderstatus", "key_partition").agg(F.count(F.lit(1)).alias("n"))
    )


@query
def keyed_text(spark, sf_dir):
    path = scratch_dir(spark, "keyed-text")
    orders = views.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("("), "o_orderstatus", F.lit(","), F.col("o_orderkey").cast("string"),
                 F.lit(")")).alias("line"),
        generic.key_partition("o_orderstatus", STATUS_PARTITIONS, 2).alias("key_partition"),
    )
    writers.write_keyed_text(orders, "line", "key_partition", path)
    return spark.read.schema("value STRING, key_partition INT").text(path)


@query
def partition_tag(spark, sf_dir):
    """Of each key, whether all its rows carry one number, and one that there is."""
    rows = views.table(spark, sf_dir, "lineitem").select("l_suppkey").repartition(8, "l_suppkey")
    return generic.tag_partitions(rows).groupBy("l_suppkey").agg(
        (F.min("partition_id") == F.max("partition_id")).alias("in_one"),
        (F.min("partition_id").between(0, 7) & F.max("partition_id").between(0, 7)).alias("in_range"))


# --- sinks -----------------------------------------------------------------------------------

@query
def report_append(spark, sf_dir):
    """All six reports appended for two runs, read back as rows per table and run."""
    root = scratch_dir(spark, "reports")
    inputs = (
        views.visit_actions(spark, sf_dir), views.user_info(spark, sf_dir),
        views.product_info(spark, sf_dir), city_areas(spark), TASK,
    )
    reports = build_reports(*inputs, task_id="run-1", sample_size=SAMPLE_SIZE)
    again = {name: report.withColumn("taskid", F.lit("run-2")) for name, report in reports.items()}
    for run in (reports, again):
        save_reports(run, lambda report, name: writers.append_files(report, f"{root}/{name}"))
    counted = [
        spark.read.parquet(f"{root}/{name}").groupBy("taskid").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("report"), "taskid", "n")
        for name in sorted(reports)
    ]
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result


@query
def report_values(spark, sf_dir):
    """Every value of the six reports. Each report is built and staged once, saved for two runs, the first
    of them twice, and read back."""
    root = scratch_dir(spark, "reports")
    built = build_reports(
        views.visit_actions(spark, sf_dir), views.user_info(spark, sf_dir),
        views.product_info(spark, sf_dir), city_areas(spark), TASK, task_id="run-1", sample_size=SAMPLE_SIZE)
    staged = {name: stage(report, name) for name, report in built.items()}
    second = {name: report.withColumn("taskid", F.lit("run-2")) for name, report in staged.items()}
    for run in (staged, second, staged):
        save_reports(run, lambda report, name: writers.replace_run(report, f"{root}/{name}"))
    parts = [long_form(spark.read.parquet(f"{root}/{name}"), name) for name in sorted(staged)]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def table_append(spark, sf_dir):
    path = scratch_dir(spark, "user-table")
    name = "footfall_" + path.rsplit("-", 1)[1]
    users = views.user_info(spark, sf_dir)
    writers.append_table(users, name, path)
    writers.append_table(users, name, path)
    return spark.table(name).groupBy("professional").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users")
    )


# --- ad clicks -------------------------------------------------------------------------------

def _ad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.ad_lines(views.table(spark, sf_dir, "events"))


@query
def ad_log_parse(spark, sf_dir):
    return ad_clicks.parse_ad_log(_ad_lines(spark, sf_dir)).drop("time")


@query
def ad_user_click_counts(spark, sf_dir):
    return ad_clicks.user_click_counts(ad_clicks.parse_ad_log(_ad_lines(spark, sf_dir)))


@query
def ad_blacklist(spark, sf_dir):
    counts = ad_clicks.user_click_counts(ad_clicks.parse_ad_log(_ad_lines(spark, sf_dir)))
    return ad_clicks.over_threshold(counts, AD_THRESHOLD)


DAYS_PER_BATCH = 10


def _run_blacklist_stream(spark: SparkSession, sf_dir: str) -> ad_clicks.AdTables:
    """Feed the events to one checkpointed stream, ten days of them in each micro-batch.

    The stream runs once per arrival of new files and takes all that is there, so the batches are
    the same on every run.
    """
    root = scratch_dir(spark, "ad-stream")
    tables = ad_clicks.AdTables(f"{root}/tables")
    log = f"{root}/log"
    _ad_lines(spark, sf_dir).write.partitionBy("day").text(log)
    by_day = spark.read.schema("value STRING, day STRING").text(log)
    days = [row["day"] for row in by_day.select("day").distinct().orderBy("day").collect()]
    for start in range(0, len(days), DAYS_PER_BATCH):
        arriving = by_day.filter(F.col("day").isin(days[start:start + DAYS_PER_BATCH]))
        arriving.select("value").write.mode("append").text(f"{root}/incoming")
        ad_clicks.start_ad_stream(
            streams.file_lines(spark, f"{root}/incoming"), tables, f"{root}/checkpoint",
            AD_THRESHOLD, availableNow=True,
        ).awaitTermination()
    return tables


@query
def ad_blacklist_stream(spark, sf_dir):
    """Clicks per user that the stream counted before the user was listed, and the listing."""
    tables = _run_blacklist_stream(spark, sf_dir)
    counted = tables.user_clicks.latest(spark).groupBy("userid").agg(F.sum("click_count").alias("clicks"))
    listed = tables.blacklist.latest(spark).select("userid", F.lit(True).alias("listed"))
    return counted.join(listed, "userid", "left").withColumn(
        "listed", F.coalesce("listed", F.lit(False))
    )


@query
def ad_place_counts_stream(spark, sf_dir):
    """Clicks per place that the blacklisting stream let through."""
    return _run_blacklist_stream(spark, sf_dir).place_clicks.latest(spark)


@query
def ad_running_counts(spark, sf_dir):
    """Running totals in Spark's state store, read from the log as a stream."""
    root = scratch_dir(spark, "ad-running")
    # A file source wants a folder or a pattern.
    source = f"{sf_dir}/events.parque[t]"
    events = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    clicks = ad_clicks.parse_ad_log(views.ad_lines(events))
    ad_clicks.start_running_counts(
        clicks, f"{root}/totals", f"{root}/checkpoint", availableNow=True
    ).awaitTermination()
    return ad_clicks.running_totals(spark, f"{root}/checkpoint")
