"""General operators: small-side join, explosions, word count, grouped rows, key partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

ROW_ID_LENGTH = 10


def map_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join with a lookup side: every pair of equal keys, duplicates included.

    Whether ``right`` is shipped whole to every task is left to the planner, which knows file sizes
    and what ``staging.stage`` wrote, and to AQE, which knows what a shuffle made.
    """
    return left.join(right, on, how)


def pieces(text: Column, separator: str) -> Column:
    """The parts of a text between separators (a regular expression), without empty ones at the end.

    An empty text is one empty part; a text of separators only has no part.
    """
    parts = F.split(text, separator)
    if separator == "":
        return parts
    # An array of one, so that the text is split once however often the pieces are used.
    return F.transform(F.array(parts), _without_empty_end).getItem(0)


def _without_empty_end(parts: Column) -> Column:
    from_end = F.array_position(F.reverse(F.transform(parts, lambda part: part != "")), True)
    kept = F.when(from_end > 0, F.size(parts) + 1 - from_end).otherwise(0).cast("int")
    return F.when((F.element_at(parts, -1) != "") | (F.size(parts) == 1), parts).otherwise(
        F.slice(parts, F.lit(1), kept))


def explode_delimited(df: DataFrame, column: str, separator: str, alias: str) -> DataFrame:
    """One row per piece of a delimited column; the other columns are repeated.

    ``separator`` is a regular expression. Empty pieces at the end are left out; a row whose column is
    null, or holds separators only, gives no row.
    """
    others = [name for name in df.columns if name != column]
    return df.select(*others, F.explode(pieces(F.col(column), separator)).alias(alias))


def explode_chars(df: DataFrame, column: str, alias: str = "col1") -> DataFrame:
    """One row per character of a text column, line breaks included; "" gives one row of ""."""
    return explode_delimited(df, column, "", alias)


def split_words(lines: DataFrame, separator: str = " ") -> DataFrame:
    """The words of each line as one array per line; separators at the end of a line give no word."""
    return lines.select(pieces(F.col("value"), separator).alias("words"))


def word_count(lines: DataFrame, separator: str = " ") -> DataFrame:
    """Rows (word, n). Two separators in a row, and an empty line, count the empty word; a line of
    separators only counts none."""
    words = split_words(lines, separator).select(F.explode("words").alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def group_rows(df: DataFrame, key: str, columns: list[str], parts: int = 1) -> DataFrame:
    """Rows (key, part, n, rows): the rows of each key as sorted arrays.

    Equal rows are one entry with their number in ``copies``. The rows of every key are dealt into at
    most ``parts`` parts by a hash of their content, whatever the size of the key, and parts are shuffled
    apart; choose as many as the largest key needs. All parts of a key together are the group. One scan.
    """
    entries = df.groupBy(key, *columns).agg(F.count(F.lit(1)).alias("copies"))
    content = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    number = F.conv(F.substring(F.md5(content), 1, 8), 16, 10).cast("bigint")
    dealt = entries.select(key, F.pmod(number, F.lit(int(parts))).alias("part"), "copies",
                           F.struct(*columns, "copies").alias("row"))
    return dealt.groupBy(key, "part").agg(
        F.sum("copies").alias("n"), F.array_sort(F.collect_list("row")).alias("rows")
    )


def group_places(df: DataFrame, key: str, columns: list[str], part_rows: int = 1_000_000) -> DataFrame:
    """Rows (key, part, place, *columns, copies): the rows of each key, in order within its parts.

    The same groups as ``group_rows`` has, as rows, so that no cell grows with a key. A key with more than
    ``part_rows`` different rows has as many parts as its own count asks for, and its rows are dealt
    into them by their content; all other keys have part 0. Parts are put in order apart.
    """
    entries = df.groupBy(key, *columns).agg(F.count(F.lit(1)).alias("copies"))
    large = entries.groupBy(F.col(key).alias("large_key")).agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") > part_rows).select("large_key", F.ceil(F.col("n") / part_rows).alias("parts"))
    dealt = entries.join(large, entries[key].eqNullSafe(large["large_key"]), "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64(*columns), "parts"), F.lit(0)).cast("bigint"))
    order = Window.partitionBy(key, "part").orderBy(*columns)
    return dealt.select(key, "part", F.row_number().over(order).alias("place"), *columns, "copies")


def key_partition(key: str, named: dict[str, int], default: int) -> Column:
    """The partition a key belongs to: as named, else the default."""
    column = F.lit(default)
    for value, partition in named.items():
        column = F.when(F.col(key) == value, partition).otherwise(column)
    return column


def partition_by_key(df: DataFrame, key: str, named: dict[str, int], default: int,
                     spread: int = 1) -> DataFrame:
    """Move rows to the partition of their key.

    With ``spread`` above 1 each key partition is laid out as that many neighbouring Spark
    partitions, so a partition that gets most of the data is still written by many tasks.
    Key partition = ``spark_partition_id() DIV spread``.
    """
    partitions = max([default, *named.values()]) + 1
    home = key_partition(key, named, default) * spread
    if spread > 1:
        home = home + F.pmod(F.xxhash64(*df.columns), F.lit(spread))
    return df.repartitionById(partitions * spread, home.cast("int"))


def tag_partitions(df: DataFrame, alias: str = "partition_id") -> DataFrame:
    """Each row with the number of the partition it is in."""
    return df.withColumn(alias, F.spark_partition_id())


def with_row_key(behaviors: DataFrame) -> DataFrame:
    """Behaviour rows with a key: ten hash characters of the row, ``_``, and its time.

    A hash in front spreads neighbouring times over a key-ordered store, and unlike a random
    number it stays the same when a task is run again.
    """
    fields = ("user_id", "item_id", "category_id", "behavior", "timestamp")
    digest = F.substring(F.md5(F.concat_ws(",", *fields)), 1, ROW_ID_LENGTH)
    return behaviors.withColumn("row_key", F.concat(digest, F.lit("_"), F.col("timestamp")))
