"""Ad clicks as a stream: click counts per user, a blacklist that feeds back, counts per place."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from footfall.functions.expressions import date_key, epoch_millis_to_time
from footfall.schemas import PLACE_CLICKS
from footfall.streaming.state import BatchTable, read_state

USER_KEYS = ("date", "userid", "adid")
PLACE_KEYS = ("date", "province", "city", "adid")
FINEST_KEYS = ("date", "province", "city", "userid", "adid")
DEFAULT_THRESHOLD = 100
#: What the ad stream's state needs: a store with named variables, which commits changes, not copies.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# --- rules shared by batch and stream --------------------------------------------------------

def parse_ad_log(lines: DataFrame) -> DataFrame:
    """Lines ``millis province city userid adid`` as typed clicks with their date key.

    Lines without a readable time, user or ad are left to ``rejected_lines``.
    """
    parsed = lines.select(*_fields()).dropna(subset=["ts_ms", "userid", "adid"])
    return parsed.select(
        "*", F.timestamp_millis("ts_ms").alias("time"),
        date_key(epoch_millis_to_time("ts_ms")).alias("date"),
    )


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The lines that ``parse_ad_log`` does not read."""
    unread = F.col("ts_ms").isNull() | F.col("userid").isNull() | F.col("adid").isNull()
    return lines.select("value", *_fields()).filter(unread).select("value")


def _fields():
    part = F.split(F.col("value"), " ")

    def field(position: int):
        return F.try_element_at(part, F.lit(position))

    return (
        field(1).try_cast("bigint").alias("ts_ms"),
        field(2).alias("province"),
        field(3).alias("city"),
        field(4).try_cast("bigint").alias("userid"),
        field(5).try_cast("bigint").alias("adid"),
    )


def user_click_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per day, user and ad."""
    return clicks.groupBy(*USER_KEYS).agg(F.count(F.lit(1)).alias("click_count"))


def place_click_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per day, province, city and ad."""
    return clicks.groupBy(*PLACE_KEYS).agg(F.count(F.lit(1)).alias("click_count"))


def over_threshold(counts: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """Users with more than ``threshold`` clicks on one ad in one day, each once."""
    return counts.filter(F.col("click_count") > threshold).select("userid").distinct()


def drop_blacklisted(rows: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Rows of users that are not on the list. The list grows, so the planner sizes it up."""
    return rows.join(blacklist.select("userid"), "userid", "left_anti")


# --- the stream: totals and listing in Spark's state -------------------------------------------

FINEST = "date STRING, province STRING, city STRING, userid BIGINT, adid BIGINT, click_count BIGINT"
ALLOWED = f"{FINEST}, total BIGINT, listed BOOLEAN"
HELD = "dates ARRAY<STRING>, ads ARRAY<BIGINT>, clicks ARRAY<BIGINT>"
KNOWN = f"userid BIGINT, month STRING, {HELD}"
#: The finest counts of one user side by side.
PACKED = ("userid BIGINT, date ARRAY<STRING>, province ARRAY<STRING>, city ARRAY<STRING>, adid ARRAY<BIGINT>, "
          "click_count ARRAY<BIGINT>")
PACKED_ALLOWED = f"{PACKED}, total ARRAY<BIGINT>, listed BOOLEAN"
#: Rows that a task packs at a time.
PACK_ROWS = 500_000


@dataclass(frozen=True)
class AdTables:
    """What a stream maintains under one shared root: one folder of changes, seen in three ways."""

    root: str

    def _view(self, keys: tuple[str, ...], **more: object) -> BatchTable:
        return BatchTable(f"{self.root}/allowed", ALLOWED, keys, "userid", partitions=("listed", "date"), **more)

    @property
    def changes(self) -> BatchTable:
        """Every batch's ``allowed_clicks``."""
        return self._view(FINEST_KEYS, value="click_count", adds=True)

    @property
    def user_clicks(self) -> BatchTable:
        """Clicks per day, user and ad: the greatest total."""
        return self._view(USER_KEYS, value="click_count", column="total", where="total IS NOT NULL")

    @property
    def place_clicks(self) -> BatchTable:
        """Clicks per day, province, city and ad: the sum of what the batches add."""
        return self._view(PLACE_KEYS, value="click_count", adds=True)

    @property
    def blacklist(self) -> BatchTable:
        """Users whose clicks are dropped."""
        return self._view(("userid",), where="listed")


def finest_counts(clicks: DataFrame) -> DataFrame:
    """Clicks counted by the finest key within each Arrow batch of a task, without state or shuffle.

    So a user with a third of all clicks crosses the shuffle as a few rows per task.
    """
    names = list(FINEST_KEYS)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            counted = pa.Table.from_batches([batch]).group_by(names).aggregate([([], "count_all")])
            yield from counted.rename_columns([*names, "click_count"]).to_batches()

    return clicks.select(*names).mapInArrow(run, FINEST)


def packed_by_user(counts: DataFrame) -> DataFrame:
    """The finest counts of a user as arrays side by side, one row per user and ``PACK_ROWS`` rows of a task.

    The rule of listing is told its rows value by value; as arrays, all clicks of a user in a batch cost little more
    than one did.
    """
    names, limit = list(FINEST_KEYS), PACK_ROWS
    arrays = ["date", "province", "city", "adid", "click_count"]

    def pack(batches: list) -> list:
        import pyarrow as pa

        counted = pa.Table.from_batches(batches).group_by(names, use_threads=False).aggregate([("click_count", "sum")])
        counted = counted.rename_columns([*names, "click_count"])
        packed = counted.group_by("userid", use_threads=False).aggregate([(name, "list") for name in arrays])
        return packed.rename_columns(["userid", *arrays]).to_batches(max_chunksize=10_000)

    def run(batches: Iterator) -> Iterator:
        waiting, rows = [], 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows >= limit:
                yield from pack(waiting)
                waiting, rows = [], 0
        if waiting:
            yield from pack(waiting)

    return counts.repartition("userid").mapInArrow(run, PACKED)


def unpacked(packed: DataFrame) -> DataFrame:
    """The rows that ``packed_by_user`` put side by side, with ``total`` and, on the first of them, ``listed``."""
    arrays = F.arrays_zip(*(name for name in packed.columns if name not in ("userid", "listed")))
    rows = packed.select("userid", "listed", F.posexplode(arrays).alias("place", "click"))
    return rows.select("click.date", "click.province", "click.city", "userid", "click.adid", "click.click_count",
                       "click.total", (F.col("listed") & (F.col("place") == 0)).alias("listed"))


def listing_state(threshold: int) -> StatefulProcessor:
    """The rule that keeps totals and listing. The class is made here so that it travels by value, and
    workers need not have this package."""
    fields = HELD

    class ListingState(StatefulProcessor):
        """One user's totals per ad and day, a row of state per month, and whether the user is listed.

        Clicks of a listed user are dropped. A user whose total on some ad passes the threshold in a batch is
        listed with it, and dropped from the next batch on. The rows of one key carry its new total once, and
        those of one user the listing once.
        """

        def init(self, handle) -> None:
            self.listed = handle.getValueState("listed", "since BIGINT")
            self.totals = handle.getMapState("totals", "month STRING", fields)

        def handleInputRows(self, key, rows, timers) -> Iterator[Row]:
            if self.listed.exists():
                return
            allowed, added = [], defaultdict(Counter)
            for row in rows:
                allowed.append(row)
                for date, ad, n in zip(row.date, row.adid, row.click_count):
                    added[date[:6]][date, ad] += n
            totals, most = {}, 0
            for month, counts in added.items():
                before = self.totals.getValue((month,))
                held = dict(zip(zip(before[0], before[1]), before[2])) if before else {}
                for ad, n in counts.items():
                    held[ad] = totals[ad] = held.get(ad, 0) + n
                    most = max(most, held[ad])
                dates, ads = zip(*held)
                self.totals.updateValue((month,), (list(dates), list(ads), list(held.values())))
            listed = most > threshold
            if listed:
                self.listed.update((most,))
            for row in allowed:
                yield Row(date=row.date, province=row.province, city=row.city, userid=key[0], adid=row.adid,
                          click_count=row.click_count,
                          total=[totals.pop(ad, None) for ad in zip(row.date, row.adid)], listed=listed)
                listed = False

        def handleInitialState(self, key, row, timers) -> None:
            if row.month is None:
                self.listed.update((0,))
            else:
                self.totals.updateValue((row.month,), (row.dates, row.ads, row.clicks))

        def close(self) -> None:
            pass

    return ListingState()


def _written_by_others(spark: SparkSession, tables: AdTables, checkpoint: str) -> Callable | None:
    """What other streams wrote to a table, for a stream that has no state yet; None where that is nothing,
    and for a stream that has, which never asks."""
    commits = _lines(spark, f"{checkpoint}/commits")
    if commits is not None and not commits.isEmpty():
        return None
    stream = stream_id(spark, checkpoint)

    def others(table: BatchTable) -> DataFrame:
        rows = table.rows(spark)
        return table.fold(rows if stream is None else rows.filter(F.col("stream") != stream))

    rows = tables.changes.rows(spark)
    return None if (rows if stream is None else rows.filter(F.col("stream") != stream)).isEmpty() else others


def known_before(spark: SparkSession, tables: AdTables, checkpoint: str) -> DataFrame:
    """What other streams left in the tables, for a stream that has no state yet: totals, and listed
    users as rows without a month."""
    others = _written_by_others(spark, tables, checkpoint)
    if others is None:
        return spark.createDataFrame([], KNOWN)
    pairs = F.collect_list(F.struct("date", "adid", "click_count"))
    month = F.substring("date", 1, 6).alias("month")
    totals = others(tables.user_clicks).groupBy("userid", month).agg(pairs.alias("pairs")).select(
        "userid", "month", F.col("pairs.date").alias("dates"), F.col("pairs.adid").alias("ads"),
        F.col("pairs.click_count").alias("clicks"))
    return totals.unionByName(others(tables.blacklist).select("userid"), allowMissingColumns=True)


def allowed_clicks(clicks: DataFrame, threshold: int, known: DataFrame | None) -> DataFrame:
    """The clicks of a stream that no listing drops, counted by the finest key, with ``total`` and
    ``listed`` as ``listing_state`` tells them.

    Without ``known`` the state is given nothing to begin with; even an empty frame makes Spark hand every user over
    apart, with the starting rows beside them.
    """
    return unpacked(packed_by_user(finest_counts(clicks)).groupBy("userid").transformWithState(
        listing_state(threshold), PACKED_ALLOWED, "Update", "None",
        initialState=None if known is None else known.groupBy("userid")))


def _lines(spark: SparkSession, path: str) -> DataFrame | None:
    """A text file, if it is there."""
    try:
        return spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def stream_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that the checkpoint keeps for its stream, the same after every restart; None before the first."""
    lines = _lines(spark, f"{checkpoint}/metadata")
    return None if lines is None else lines.select(F.get_json_object("value", "$.id")).first()[0]


def start_ad_stream(lines: DataFrame, tables: AdTables, checkpoint: str,
                    threshold: int = DEFAULT_THRESHOLD,
                    after_batch: Callable[[SparkSession, int], None] | None = None,
                    rejects: str | None = None, **trigger: object) -> StreamingQuery:
    """Count clicks and list users on every micro-batch, by default every five seconds.

    Totals and listing are in Spark's state, which the checkpoint keeps; the tables get what each batch
    changed. A stream with a fresh checkpoint takes over what other streams left in the tables; those must
    not be resumed after that. ``after_batch`` is called when a batch is done, for example to show a table
    on the console. Lines that cannot be read go to the folder ``rejects``, by a stream of their own beside
    this one, which is awaited where this one takes what is there and stops.
    """
    spark = lines.sparkSession
    trigger = trigger or {"processingTime": "5 seconds"}
    ids: list[str] = []

    def run(batch: DataFrame, batch_id: int) -> None:
        ids.extend([] if ids else [stream_id(batch.sparkSession, checkpoint)])
        tables.changes.write(batch, ids[0], batch_id)
        if after_batch:
            after_batch(batch.sparkSession, batch_id)

    if rejects:
        beside = (
            rejected_lines(lines).writeStream.format("text").option("path", rejects)
            .option("checkpointLocation", f"{checkpoint}-rejects").trigger(**trigger).start())
        if trigger.get("availableNow") or trigger.get("once"):
            beside.awaitTermination()
    known = known_before(spark, tables, checkpoint) if _written_by_others(spark, tables, checkpoint) else None
    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        return (
            allowed_clicks(parse_ad_log(lines), threshold, known)
            .writeStream.outputMode("update").foreachBatch(run)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start()
        )
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def listed_users(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The users that the state of an ad stream lists, now or after an earlier batch."""
    return read_state(spark, checkpoint, batch_id, "listed").select(F.col("key.userid").alias("userid"))


def user_totals(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The totals that the state of an ad stream holds, now or after an earlier batch."""
    held = read_state(spark, checkpoint, batch_id, "totals")
    totals = F.arrays_zip("user_map_value.dates", "user_map_value.ads", "user_map_value.clicks")
    return held.select("key.userid", F.explode(totals).alias("held")).select(
        F.col("held.dates").alias("date"), "userid", F.col("held.ads").alias("adid"),
        F.col("held.clicks").alias("click_count"))


# --- running totals with Spark's own state ---------------------------------------------------

def running_place_counts(clicks: DataFrame, watermark: str | None = None) -> DataFrame:
    """Streaming clicks per day, province, city and ad, kept in Spark's state store.

    Without ``watermark`` every key is kept for ever. With one, keys of days that lie further
    back than the delay leave the state, and later clicks for them are not counted.
    """
    if watermark is None:
        return place_click_counts(clicks)
    day = F.window("time", "1 day").alias("day")
    dated = clicks.withWatermark("time", watermark)
    return (
        dated.groupBy(day, *PLACE_KEYS).agg(F.count(F.lit(1)).alias("click_count")).drop("day")
    )


def running_table(path: str) -> BatchTable:
    return BatchTable(path, PLACE_CLICKS, PLACE_KEYS, "adid", "click_count", partitions=("date",))


def start_running_counts(clicks: DataFrame, path: str, checkpoint: str,
                         watermark: str | None = None, **trigger: object) -> StreamingQuery:
    """Write the changed totals of every micro-batch to a table; read it with ``running_table``.

    The totals themselves are in Spark's state store, where ``running_totals`` reads them, so no batch reads
    the table. The state belongs to the checkpoint: a fresh checkpoint counts anew, and wants a table of its own.
    """
    table, ids = running_table(path), []

    def run(batch: DataFrame, batch_id: int) -> None:
        ids.extend([] if ids else [stream_id(batch.sparkSession, checkpoint)])
        table.write(batch, ids[0], batch_id)

    return (
        running_place_counts(clicks, watermark)
        .writeStream.outputMode("update").foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def running_totals(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The totals per day, province, city and ad in the state of a running count, now or after an earlier
    batch. With a watermark, days that lie behind it are no longer there."""
    held = read_state(spark, checkpoint, batch_id)
    keys = held.schema["key"].dataType.fieldNames()[-len(PLACE_KEYS):]
    count = held.schema["value"].dataType.fieldNames()[0]
    return held.select(*(F.col("key")[name].alias(to) for name, to in zip(keys, PLACE_KEYS)),
                       F.col("value")[count].alias("click_count"))


def start_console(df: DataFrame, mode: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Print every micro-batch."""
    return (
        df.writeStream.format("console").outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
