"""The most frequent keys of a table of counts, as many as a bound allows, found without a sort."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

STEPS_PER_DOUBLING = 16


def frequent(counts: DataFrame, count: str, most: int) -> pa.Table:
    """The rows of ``counts`` with the greatest counts, ``most`` at most, on the driver.

    Counts are first put in classes of about 4 %, of which there are some hundred whatever the input; the
    classes from the top that together hold no more than ``most`` rows are taken whole. Rows are only ever
    left out with all that count less, so what is left out is known by its count alone, and callers join it.
    """
    level = F.floor(F.log2(count) * STEPS_PER_DOUBLING).cast("int")
    sizes = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("rows")).collect()
    lowest, taken = None, 0
    for row in sorted(sizes, key=lambda row: -row["level"]):
        taken += row["rows"]
        if taken > most:
            break
        lowest = row["level"]
    wanted = counts.filter(F.lit(False) if lowest is None else level >= lowest)
    return wanted.toArrow()
