"""Batch sinks. Each appends a result that is already a DataFrame; none passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_task(result: DataFrame, task_id: str) -> DataFrame:
    """The result with the id of the run that made it as its first column."""
    return result.select(F.lit(task_id).alias("taskid"), "*")


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, **extra: object) -> dict[str, str]:
    """Options of the JDBC writer; ``extra`` takes batchsize, isolationLevel, truncate and such."""
    options = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}
    options.update(extra)
    return {name: str(value) for name, value in options.items() if value is not None}


def append_jdbc(result: DataFrame, options: dict[str, str]) -> None:
    """Append to a database table; every partition writes over its own connection."""
    result.write.format("jdbc").options(**options).mode("append").save()


def append_table(result: DataFrame, name: str, path: str | None = None,
                 partition_by: tuple[str, ...] = ()) -> None:
    """Append to a catalog table, made on first use; with ``path`` an external one."""
    writer = result.write.mode("append").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def append_files(result: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append to a folder of parquet files."""
    result.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_run(result: DataFrame, path: str, run: str = "taskid") -> None:
    """Append to a folder of parquet files filed by run id, which is the column ``run``.

    A run that is saved again, after a failure or on purpose, replaces what it left itself, and nothing else.
    """
    (
        result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(run).parquet(path)
    )


def publish_view(result: DataFrame, name: str) -> None:
    """Let SQL users of this session query the result by name."""
    result.createOrReplaceTempView(name)


def write_keyed_text(df: DataFrame, value: str, partition: str, path: str) -> None:
    """Text lines in one folder per key partition, in files of a target size.

    Rows are rebalanced by key partition first: AQE joins small shares and splits large ones to
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, so the number of files follows the bytes of a key
    partition, not the number of tasks.
    """
    lines = df.select(F.col(value).alias("value"), F.col(partition))
    lines.hint("rebalance", partition).write.partitionBy(partition).text(path)


def export_behaviors(keyed: DataFrame, path: str) -> None:
    """Behaviour rows with their row key, one folder per behaviour."""
    keyed.write.mode("append").partitionBy("behavior").parquet(path)
