"""Sources of ad-log lines; each gives one string column named ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(brokers: str, topics: str) -> dict[str, str]:
    """New queries start at the newest offset; afterwards offsets live in the checkpoint."""
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topics,
        "startingOffsets": "latest",
    }


def kafka_lines(spark: SparkSession, brokers: str, topics: str, **options: str) -> DataFrame:
    """Message values of Kafka topics. Needs the Spark Kafka connector on the classpath."""
    reader = spark.readStream.format("kafka").options(**kafka_options(brokers, topics))
    return reader.options(**options).load().selectExpr("CAST(value AS STRING) AS value")


def file_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Lines of text files as they appear in a folder."""
    return spark.readStream.options(**options).text(path)
