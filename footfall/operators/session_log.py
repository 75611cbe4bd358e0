"""A log laid out by session: reports that need no shuffle of the log.

The log is kept as two catalog tables, both partitioned by date where days are large. Sessions of ordinary size are bucketed by
session, so a roll-up by session and a restriction to kept sessions read each bucket where it lies. A bucket is
one task, which a session with a large part of the log would make as large; such sessions go to a second table
without buckets, whose rows are merged map-side or split by AQE as ever. A session is in one of the two only.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.operators.sessions import aggregate_sessions, filter_sessions, restrict_to_sessions, with_user
from footfall.params import TaskParams
from footfall.sources.tables import scan_actions
from footfall.staging import stage

#: Rows from which a session counts as hot.
HOT_ROWS = 1_000_000


class SessionLog(NamedTuple):
    even: DataFrame
    hot: DataFrame


def write_session_log(actions: DataFrame, name: str, buckets: int, hot_rows: int = HOT_ROWS,
                      path: str | None = None, partition_by: tuple[str, ...] = ("date",)) -> SessionLog:
    """Lay out the whole log as tables ``name`` and ``name_hot``, which must not exist, and read them.

    ``actions`` is read twice. Leave ``partition_by`` empty where days are too small for files of their own. Rows without a session belong together under no id and go to the hot table.
    Rows are rebalanced by date and bucket before the write, so a bucket of a date is few files of the
    advised size, whatever the number of tasks. With ``path`` the tables are external, below that folder.
    """
    hot = stage(actions.filter("session_id is not null").groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") > hot_rows).select("session_id"), "hot-sessions")
    bucket = F.pmod(F.hash("session_id"), F.lit(buckets)).alias("__bucket")  # as bucketBy deals them
    even = actions.filter("session_id is not null").join(hot, "session_id", "left_anti")
    rest = actions.filter("session_id is null").unionByName(
        actions.join(hot, "session_id", "left_semi")).select(actions.columns)
    dealt = even.select(*actions.columns, bucket).hint("rebalance", *partition_by, "__bucket").drop("__bucket")
    writers = {
        name: dealt.write.partitionBy(*partition_by).bucketBy(buckets, "session_id").sortBy("session_id"),
        f"{name}_hot": rest.hint("rebalance", *partition_by).write.partitionBy(*partition_by),
    }
    for table, writer in writers.items():
        if path:
            writer = writer.option("path", f"{path}/{table}")
        writer.format("parquet").saveAsTable(table)
    return read_session_log(actions.sparkSession, name)


def read_session_log(spark: SparkSession, name: str) -> SessionLog:
    return SessionLog(spark.table(name), spark.table(f"{name}_hot"))


def scan_log(log: SessionLog, params: TaskParams) -> SessionLog:
    """The task's dates of both tables; other partitions are not read."""
    return SessionLog(scan_actions(log.even, params), scan_actions(log.hot, params))


def aggregate_log(log: SessionLog, params: TaskParams = TaskParams()) -> DataFrame:
    """One row per session, as ``aggregate_sessions``; only hot sessions' merged rows are shuffled."""
    return aggregate_sessions(log.even, params).unionByName(aggregate_sessions(log.hot, params))


def kept_log_sessions(log: SessionLog, users: DataFrame, params: TaskParams) -> DataFrame:
    """As ``kept_sessions``, from a log laid out by session."""
    return filter_sessions(with_user(aggregate_log(scan_log(log, params), params), users), params)


def restrict_log(log: SessionLog, kept: DataFrame) -> DataFrame:
    """Rows of the kept sessions. Of the two sides of the large join only ``kept`` is shuffled; stage it first."""
    return restrict_to_sessions(log.even, kept).unionByName(restrict_to_sessions(log.hot, kept))
