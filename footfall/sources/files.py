"""File sources with declared schemas, so that reading never needs an inference pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.schemas import BEHAVIOR, EMPLOYEE, PERSON


def read_people(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV of id, name, age, addr; every column is text."""
    return spark.read.schema(PERSON).csv(path)


def read_employees(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of name and salary."""
    return spark.read.schema(EMPLOYEE).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines in a column named ``value``."""
    return spark.read.text(path)


def read_behaviors(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV of user, item, category, behaviour and time, blanks trimmed."""
    raw = spark.read.schema(BEHAVIOR).csv(path)
    return raw.select(*(F.trim(name).alias(name) for name in raw.columns))
