"""What the operators share: inputs, scratch tables, local names for expressions, bit filters."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from footfall.staging import scratch_dir

FILTER_BITS = 1 << 24
WORD_BITS = 63


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as it takes to be no column of ``df``."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage ends here."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    if _made.get() is not None:
        _made.get().append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Stage what ``make`` gives and delete all that was staged on the way to it."""
    token = _made.set([])
    try:
        result = make()
        passed = list(_made.get())
        result = stage(result, label)
    finally:
        _made.reset(token)
    for path in passed:
        _delete(result.sparkSession, path)
    return result


def parts_of(texts: DataFrame, column: str, each: int) -> int:
    """As many parts as hold about ``each`` bytes of a column of texts or bytes, at least the number of
    shuffle partitions that is set. It settles layout only; operators give the same for any number."""
    size = texts.agg(F.sum(F.octet_length(column).cast("bigint"))).first()[0] or 0
    return max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // each))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table that no later step reads."""
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        _delete(df.sparkSession, folder)


def named(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once per row however often ``body`` uses it."""
    return F.transform(F.array(value), body).getItem(0)


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


class Memo(dict):
    """A dictionary that computes what it lacks and starts anew when it is full."""

    def __init__(self, compute: Callable, most: int = 300_000):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def bit_filter(keys: DataFrame, column: str) -> np.ndarray:
    """A bit map of fixed size (2 MB) of the 64-bit keys in ``column``.

    It is merged by Spark and reaches the driver as at most 266 306 words however many keys there
    are. A key that is in always tests true. With more keys than bits everything tests true, and
    only the work that the filter saves is lost.
    """
    slot = F.pmod(F.col(column), F.lit(FILTER_BITS))
    words = (
        keys.select((slot / WORD_BITS).cast("int").alias("word"),
                    F.call_function("shiftleft", F.lit(1).cast("bigint"),
                                    (slot % WORD_BITS).cast("int")).alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits"))
    )
    found = words.toPandas()
    table = np.zeros(FILTER_BITS // WORD_BITS + 1, np.int64)
    table[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return table


def passes(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which signed 64-bit keys the bit map may hold."""
    slot = keys.astype(np.int64) & (FILTER_BITS - 1)
    word = slot // WORD_BITS
    return (table[word] >> (slot - word * WORD_BITS)) & 1 == 1


def texts_of(batch) -> Iterator[bytes]:
    """The UTF-8 bytes of an Arrow column of texts or bytes, null as empty."""
    column = batch.cast(pa.binary())
    for i in range(len(column)):
        yield column[i].as_py() or b""


def smaller(batches: Iterator, rows: int = 1024) -> Iterator:
    """The batches in parts, so that what is made of one at a time stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
