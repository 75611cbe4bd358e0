from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from footfall.streaming import ad_clicks
from footfall.streaming.late import LateRows

DAY = 24 * 3600 * 1000
START = 1704067200000  # 2024-01-01, UTC


def line(day=0, user=1, ad=1, province="p", city="c"):
    return f"{START + day * DAY + 5} {province} {city} {user} {ad}"


def frame(spark, lines):
    return spark.createDataFrame([(text,) for text in lines], "value STRING")


def test_parse(spark):
    good, bad = line(user=7, ad=8), ["", "x", "1 2 3", "nan p c 1 2", "1 p c u 2", "1 p c 3"]
    parsed = ad_clicks.parse_ad_log(frame(spark, [good, *bad])).drop("time").collect()
    assert [tuple(r) for r in parsed] == [(START + 5, "p", "c", 7, 8, "20240101")]


def test_threshold_is_strict(spark):
    clicks = ad_clicks.parse_ad_log(frame(spark, [line(user=1)] * 100 + [line(user=2)] * 101))
    counts = ad_clicks.user_click_counts(clicks)
    assert rows(counts) == [("20240101", 1, 1, 100), ("20240101", 2, 1, 101)]
    assert rows(ad_clicks.over_threshold(counts)) == [(2,)]


def test_each_listed_user_once(spark):
    clicks = ad_clicks.parse_ad_log(frame(spark, [line(user=1, ad=a) for a in (1, 1, 2, 2)]))
    assert rows(ad_clicks.over_threshold(ad_clicks.user_click_counts(clicks), 1)) == [(1,)]


def simulate(batches, threshold):
    """The rule by hand: filter by the list, add up, extend the list."""
    counts, places, listed = {}, {}, set()
    for batch in batches:
        newly = set()
        for day, user, ad, province in batch:
            if user in listed:
                continue
            date = f"202401{day + 1:02d}"
            counts[date, user, ad] = counts.get((date, user, ad), 0) + 1
            places[date, province, "c", ad] = places.get((date, province, "c", ad), 0) + 1
            if counts[date, user, ad] > threshold:
                newly.add(user)
        listed |= newly
    return counts, places, listed


def as_rows(counts):
    return sorted((*key, n) for key, n in counts.items())


def check(spark, tables, expected):
    counts, places, listed = expected
    assert rows(tables.user_clicks.latest(spark)) == as_rows(counts)
    assert rows(tables.place_clicks.latest(spark)) == as_rows(places)
    assert rows(tables.blacklist.latest(spark)) == sorted((user,) for user in listed)


def arrive(spark, batch, incoming):
    frame(spark, [line(d, u, a, p) for d, u, a, p in batch]).coalesce(1).write.mode("append").text(incoming)


def take(spark, incoming, tables, checkpoint, threshold, **options):
    ad_clicks.start_ad_stream(spark.readStream.text(incoming), tables, checkpoint, threshold,
                              availableNow=True, **options).awaitTermination()


def test_stream_against_simulation_with_a_failure(spark, tmp_path):
    """Three arrivals; the second batch fails when its rows are written, and is run again after a restart."""
    draw = random.Random(5)
    batches = [
        [(draw.randrange(2), draw.randrange(6), draw.randrange(2), draw.choice("pq"))
         for _ in range(14)] for _ in range(3)
    ]
    incoming, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    tables, seen = ad_clicks.AdTables(str(tmp_path / "tables")), []

    def after(session, batch_id):
        seen.append(batch_id)
        if seen == [0, 1]:
            raise RuntimeError("lost after writing")

    for number, batch in enumerate(batches):
        arrive(spark, batch, incoming)
        if number == 1:
            with pytest.raises(Exception, match="lost after writing"):
                take(spark, incoming, tables, checkpoint, 3, after_batch=after)
        take(spark, incoming, tables, checkpoint, 3, after_batch=after)
    assert seen == [0, 1, 1, 2]
    check(spark, tables, simulate(batches, 3))
    for done in (1, 2, 3):  # what the state held after each batch
        counts, _, listed = simulate(batches[:done], 3)
        assert rows(ad_clicks.user_totals(spark, checkpoint, done - 1)) == as_rows(counts)
        assert rows(ad_clicks.listed_users(spark, checkpoint, done - 1)) == sorted((u,) for u in listed)
    assert rows(ad_clicks.user_totals(spark, checkpoint)) == rows(tables.user_clicks.latest(spark))


def test_fresh_checkpoint_takes_over_old_tables(spark, tmp_path):
    tables = ad_clicks.AdTables(str(tmp_path / "tables"))
    first, second = [(0, 7, 1, "p")] * 4 + [(0, 8, 1, "p")] * 2, [(0, 7, 1, "p")] * 3 + [(0, 8, 1, "q"), (1, 8, 1, "q")] * 2
    for number, batch in enumerate((first, second)):
        arrive(spark, batch, f"{tmp_path}/in{number}")
        take(spark, f"{tmp_path}/in{number}", tables, f"{tmp_path}/checkpoint{number}", 3)
    check(spark, tables, simulate([first, second], 3))
    assert rows(tables.blacklist.latest(spark)) == [(7,), (8,)]


def test_look_up_reads_its_own_bucket(spark, tmp_path):
    tables = ad_clicks.AdTables(str(tmp_path))
    schema = ad_clicks.ALLOWED
    for batch_id in (0, 1, 1):  # the second batch is written twice
        made = [(f"2024010{day}", "p", "c", user, 1, 5, 5 * (batch_id + 1), False)
                for day in (1, 2) for user in range(40)]
        tables.changes.write(spark.createDataFrame(made, schema), "a", batch_id)
    assert tables.user_clicks.latest(spark).count() == 80
    assert rows(tables.place_clicks.latest(spark)) == [(f"2024010{d}", "p", "c", 1, 400) for d in (1, 2)]
    found = tables.user_clicks.look_up(spark, 17, date="20240102")
    assert rows(found) == [("20240102", 17, 1, 10)]
    plan = plan_of(found)
    filters = next(text for text in plan.splitlines() if "PartitionFilters" in text)
    assert "bucket" in filters and "date" in filters


def test_no_tables_yet(spark, tmp_path):
    tables = ad_clicks.AdTables(str(tmp_path / "none"))
    assert tables.user_clicks.latest(spark).count() == tables.blacklist.latest(spark).count() == 0
    assert ad_clicks.known_before(spark, tables, str(tmp_path / "never")).count() == 0


def test_rejected_lines_are_kept(spark, tmp_path):
    lines = frame(spark, [line(), "x", "1 p c u 2"])
    assert rows(ad_clicks.rejected_lines(lines)) == [("1 p c u 2",), ("x",)]
    lines.write.text(str(tmp_path / "in"))
    ad_clicks.start_ad_stream(
        spark.readStream.text(str(tmp_path / "in")), ad_clicks.AdTables(str(tmp_path / "t")),
        str(tmp_path / "c"), rejects=str(tmp_path / "rejects"), availableNow=True).awaitTermination()
    assert rows(spark.read.text(f"{tmp_path}/rejects").select("value")) == [("1 p c u 2",), ("x",)]


@pytest.mark.parametrize("watermark", [None, "2 days"])
def test_running_totals_over_batches(spark, tmp_path, watermark):
    incoming, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    for batch in ([line(0), line(0, city="d")], [line(0), line(1, ad=2)]):
        frame(spark, batch).write.mode("append").text(incoming)
        clicks = ad_clicks.parse_ad_log(spark.readStream.text(incoming))
        ad_clicks.start_running_counts(
            clicks, str(tmp_path / "totals"), checkpoint, watermark,
            availableNow=True).awaitTermination()
    totals = ad_clicks.running_table(str(tmp_path / "totals")).latest(spark)
    expected = [("20240101", "p", "c", 1, 2), ("20240101", "p", "d", 1, 1), ("20240102", "p", "c", 2, 1)]
    assert rows(totals) == rows(ad_clicks.running_totals(spark, checkpoint)) == expected
    assert rows(ad_clicks.running_totals(spark, checkpoint, 0)) == [
        ("20240101", "p", "c", 1, 1), ("20240101", "p", "d", 1, 1)]


def test_late_clicks_are_recorded(spark, tmp_path):
    """A click of a day that the state has let go is not counted, and the listener says so."""
    incoming, late = str(tmp_path / "in"), LateRows()
    spark.streams.addListener(late)
    try:
        for batch in ([line(0)], [line(9)], [line(0), line(9)]):
            frame(spark, batch).coalesce(1).write.mode("append").text(incoming)
            clicks = ad_clicks.parse_ad_log(spark.readStream.text(incoming))
            query = ad_clicks.start_running_counts(
                clicks, str(tmp_path / "totals"), str(tmp_path / "checkpoint"), "2 days", availableNow=True)
            query.awaitTermination()
        for _ in range(100):
            if late.dropped:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(late)
    assert late.dropped == {str(query.id): 1} and [n for *_, n in late.batches] == [1]
    totals = ad_clicks.running_table(str(tmp_path / "totals")).latest(spark)
    assert rows(totals) == [("20240101", "p", "c", 1, 1), ("20240110", "p", "c", 1, 2)]


def test_console(spark, tmp_path):
    frame(spark, [line()]).write.text(str(tmp_path / "in"))
    counts = ad_clicks.running_place_counts(
        ad_clicks.parse_ad_log(spark.readStream.text(str(tmp_path / "in"))))
    query = ad_clicks.start_console(counts, "update", str(tmp_path / "checkpoint"), availableNow=True)
    query.awaitTermination()
    assert query.exception() is None


def test_hot_user_crosses_as_a_few_rows(spark):
    """100 000 clicks of one user on one ad: a row per Arrow batch of a task."""
    hot = spark.range(100_000, numPartitions=8).select(F.lit(line(user=9)).alias("value"))
    counted = ad_clicks.finest_counts(ad_clicks.parse_ad_log(hot)).collect()
    assert len(counted) <= 16 and sum(r.click_count for r in counted) == 100_000


def test_a_batch_writes_a_file_per_place(spark, tmp_path):
    """Not one per task and place, however many tasks the state has; adaptive planning stays off for the state."""
    clicks, seen = [(user % 2, user, 1, "p") for user in range(200)], []
    arrive(spark, clicks, f"{tmp_path}/in")
    tables = ad_clicks.AdTables(f"{tmp_path}/tables")
    take(spark, f"{tmp_path}/in", tables, f"{tmp_path}/checkpoint", 3,
         after_batch=lambda session, _: seen.append(session.conf.get("spark.sql.adaptive.enabled")))
    files = list((tmp_path / "tables" / "allowed").rglob("*.parquet"))
    assert len(files) == 2 * tables.changes.buckets and seen == ["false"]
    check(spark, tables, simulate([clicks], 3))


def test_a_user_is_one_row_to_the_rule(spark):
    clicks = [line(day, user, ad, province) for day in (0, 1) for user in range(5) for ad in (1, 2) for province in "pq"]
    counted = ad_clicks.finest_counts(ad_clicks.parse_ad_log(frame(spark, clicks * 3)))
    packed = ad_clicks.packed_by_user(counted)
    assert [(r.userid, sum(r.click_count)) for r in packed.orderBy("userid").collect()] == [(u, 24) for u in range(5)]
    told = packed.withColumns({"total": F.expr("transform(adid, x -> CAST(NULL AS BIGINT))"), "listed": F.lit(True)})
    single = ad_clicks.unpacked(told)
    assert f"{single.count()} {single.filter('listed').count()} {single.columns}" == (
        f"40 5 {[field.split(' ')[0] for field in ad_clicks.ALLOWED.split(', ')]}")
    assert {r.click_count for r in single.collect()} == {3}


def test_users_in_several_packed_rows(spark, tmp_path, monkeypatch):
    """Tasks that pack five rows at a time, over two months; a total is still told once and a listing too."""
    draw = random.Random(7)
    batches = [[(draw.randrange(28, 34), draw.randrange(4), 1, draw.choice("pq")) for _ in range(60)] for _ in range(2)]
    monkeypatch.setattr(ad_clicks, "PACK_ROWS", 5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        tables = ad_clicks.AdTables(f"{tmp_path}/tables")
        for batch in batches:
            arrive(spark, batch, f"{tmp_path}/in")
            take(spark, f"{tmp_path}/in", tables, f"{tmp_path}/checkpoint", 5)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    counts, places, listed = simulate(batches, 5)
    held = rows(ad_clicks.user_totals(spark, f"{tmp_path}/checkpoint"))
    dated = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("day")), "yyyyMMdd")
    days = [(int(key[0][6:]) - 1, *key[1:], n) for key, n in counts.items()]
    expected = spark.createDataFrame(days, "day INT, userid BIGINT, adid BIGINT, n BIGINT").select(dated, "userid", "adid", "n")
    assert listed and held == rows(expected) == rows(tables.user_clicks.latest(spark))
    assert tables.blacklist.rows(spark).count() == len(listed)
    told = tables.user_clicks.rows(spark).groupBy("batch_id", *ad_clicks.USER_KEYS).count()
    assert told.filter("count > 1").isEmpty()


def test_restart_after_taking_over(spark, tmp_path):
    """A stream that began with old tables goes on without them."""
    tables = ad_clicks.AdTables(f"{tmp_path}/tables")
    batches = [[(0, 7, 1, "p")] * 4 + [(0, 8, 1, "p")] * 2, [(0, 8, 1, "q")], [(0, 8, 1, "q"), (0, 7, 1, "p"), (1, 9, 1, "p")]]
    for batch, name in zip(batches, ("old", "new", "new")):
        arrive(spark, batch, f"{tmp_path}/in-{name}")
        take(spark, f"{tmp_path}/in-{name}", tables, f"{tmp_path}/{name}", 3)
    check(spark, tables, simulate(batches, 3))
