"""Tables that a stream adds to: plain Parquet, filed by date, bucket of the key, stream and micro-batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FILED = "bucket INT, stream STRING, batch_id BIGINT"
ADAPTIVE = "spark.sql.adaptive.enabled"


@dataclass(frozen=True)
class BatchTable:
    """Keys, and where there is one a value, of which every batch writes what it changed.

    ``adds`` says whether a batch's values are what it adds, so that the current value of a key is their
    sum, or new totals, which never fall, so that it is the greatest. ``stream`` is the id that a stream's
    checkpoint keeps. A batch that runs again writes the same partitions and so replaces its own; nothing
    else is ever replaced, moved or deleted. ``bucket`` is a hash of the column ``by``: a look-up by it, and
    by date where the table has one, reads the folders of that bucket only.

    Several views can stand on one folder: each with keys of its own, a value from ``column``, and the rows
    that ``where`` chooses.
    """

    path: str
    fields: str
    keys: tuple[str, ...]
    by: str
    value: str | None = None
    adds: bool = False
    partitions: tuple[str, ...] = ()
    column: str | None = None
    where: str | None = None
    buckets: int = 4

    def bucket(self, value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(self.buckets)).cast("int")

    # --- reading ---

    def rows(self, spark: SparkSession) -> DataFrame:
        """Every row of every batch; none before the first batch."""
        schema = f"{self.fields}, {FILED}"
        try:
            rows = spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = spark.createDataFrame([], schema)
        rows = rows.filter(self.where) if self.where else rows
        return rows.withColumn(self.value, F.col(self.column)) if self.column else rows

    def latest(self, spark: SparkSession) -> DataFrame:
        """The current keys and values."""
        return self.fold(self.rows(spark))

    def of_batch(self, spark: SparkSession, stream: str, batch_id: int) -> DataFrame:
        """The rows that one batch wrote."""
        return self.rows(spark).filter((F.col("stream") == stream) & (F.col("batch_id") == batch_id))

    def look_up(self, spark: SparkSession, key: object, **more: object) -> DataFrame:
        """The current rows of one value of ``by`` and, where given, of other columns such as the date.

        Bucket and date are partitions, so only their folders are read.
        """
        column = self.rows(spark).schema[self.by].dataType
        wanted = F.lit(key).cast(column)
        found = self.rows(spark).filter((F.col("bucket") == self.bucket(wanted)) & (F.col(self.by) == wanted))
        for name, value in more.items():
            found = found.filter(F.col(name) == value)
        return self.fold(found)

    def fold(self, rows: DataFrame) -> DataFrame:
        """One row per key."""
        if self.value is None:
            return rows.select(*self.keys).distinct()
        total = F.sum(self.value) if self.adds else F.max(self.value)
        return rows.groupBy(*self.keys).agg(total.alias(self.value))

    # --- writing ---

    def write(self, rows: DataFrame, stream: str, batch_id: int) -> None:
        """File the rows of a batch, in place of those that an unfinished run of it left.

        Rows of one place are brought together first, split and merged by size, which AQE does; in a batch of a
        stateful stream it is off, the hint would go unheard and every task would make a file in every place.
        """
        columns = [field.split(" ")[0] for field in self.fields.split(", ")]
        filed = rows.select(
            *columns, self.bucket(F.col(self.by)).alias("bucket"), F.lit(stream).alias("stream"),
            F.lit(batch_id).cast("bigint").alias("batch_id"))
        places = (*self.partitions, "bucket")
        spark = rows.sparkSession
        adaptive = spark.conf.get(ADAPTIVE)
        spark.conf.set(ADAPTIVE, "true")
        try:
            (
                filed.hint("rebalance", *places).write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*places, "stream", "batch_id").parquet(self.path)
            )
        finally:
            spark.conf.set(ADAPTIVE, adaptive)


def read_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None,
               variable: str | None = None) -> DataFrame:
    """What a stream's state holds: columns ``key`` and ``value``, or those of a named state variable.

    ``batch_id`` asks for the state as it was after that batch, as long as the checkpoint keeps it.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    if variable is not None:
        reader = reader.option("stateVarName", variable)
    return reader.load(checkpoint)
