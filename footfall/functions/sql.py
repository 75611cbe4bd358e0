"""The same functions by name for SQL users.

SQL-language functions are inlined by the optimizer, so queries that call them stay in generated
JVM code.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

STATEMENTS = (
    """CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(v1 BIGINT, v2 STRING, split STRING)
       RETURNS STRING RETURN concat(CAST(v1 AS STRING), split, v2)""",
    """CREATE OR REPLACE TEMPORARY FUNCTION concat_long_str(v1 STRING, v2 BIGINT, split STRING)
       RETURNS STRING RETURN concat(v1, split, CAST(v2 AS STRING))""",
    """CREATE OR REPLACE TEMPORARY FUNCTION get_json_field(json STRING, field STRING)
       RETURNS STRING RETURN get_json_object(json, concat('$.', field))""",
    """CREATE OR REPLACE TEMPORARY FUNCTION plus_one(x BIGINT) RETURNS BIGINT RETURN x + 1""",
    """CREATE OR REPLACE TEMPORARY FUNCTION user_udtf(text STRING) RETURNS TABLE(col1 STRING)
       RETURN SELECT explode(split(text, ''))""",
)


def register_functions(spark: SparkSession) -> None:
    """Define the functions in this session.

    Averages and distinct concatenation need no registration: ``avg`` and
    ``listagg(DISTINCT x, ',')`` are built in and aggregate partially before the shuffle, which a
    registered Python aggregate cannot do.
    """
    for statement in STATEMENTS:
        spark.sql(statement)
