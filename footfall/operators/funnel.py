"""Page flow: how many visitors go on from each page of a flow to the next."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F

Split = tuple[int, int]

FLAGS_PER_WORD = 62


def flow_splits(flow: tuple[int, ...]) -> list[Split]:
    """Adjacent page pairs of a flow, in order."""
    return list(zip(flow, flow[1:]))


def split_name(split: Split) -> str:
    return f"{split[0]}_{split[1]}"


class _Flags:
    """Yes-or-no facts about the actions of one moment, packed 62 to a bigint column."""

    def __init__(self) -> None:
        self._bit: dict[tuple[str, ...], int] = {}
        self._test: list[Column] = []

    def _seen(self, key: tuple, test: Column) -> Column:
        if key not in self._bit:
            self._bit[key] = len(self._test)
            self._test.append(test)
        word, bit = divmod(self._bit[key], FLAGS_PER_WORD)
        return F.col(f"flags_{word}").bitwiseAND(F.lit(1 << bit)) != 0

    def page(self, page: int) -> Column:
        """Was the page among the actions?"""
        return self._seen(("is", page), F.col("page_id") == page)

    def between(self, low: int, high: int) -> Column:
        """Was a page between the two among the actions?"""
        if high - low == 1:
            return F.lit(False)
        return self._seen(("in", low, high), (F.col("page_id") > low) & (F.col("page_id") < high))

    def aggregates(self) -> list[Column]:
        words = []
        for start in range(0, len(self._test), FLAGS_PER_WORD):
            tests = self._test[start:start + FLAGS_PER_WORD]
            mask = reduce(add, (F.when(test, F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint")
                                for bit, test in enumerate(tests)))
            words.append(F.bit_or(mask).alias(f"flags_{start // FLAGS_PER_WORD}"))
        return words


def _within_moment(split: Split, flags: _Flags) -> Column:
    """How often the pair occurs among the actions of one session at one time.

    Actions at the same time are taken in page order. So equal pages stand together, and of two
    different pages the lower comes just before the higher if no page between them was visited.
    """
    first, second = split
    if first == second:
        return F.greatest(F.col(f"views_{first}") - 1, F.lit(0))
    if first > second:
        return F.lit(0)
    adjacent = flags.page(first) & flags.page(second) & ~flags.between(first, second)
    return adjacent.cast("bigint")


def count_splits(actions: DataFrame, flow: tuple[int, ...], cell: str = "minute") -> DataFrame:
    """One row: ``start_pv`` and, for the i-th pair of the flow, its count ``split_i``.

    Pairs are adjacent actions of a session by time, then page. The first aggregate merges each
    session's actions of one moment map-side into one narrow row. Moments are put in order within
    one ``cell`` of time of a session, so even a session with a third of the log is spread over as many
    tasks as it has cells. A cell then becomes one row with its sums, its first page and its last, and
    only these rows are put in order by session, for the pairs that cross cells. Everything after
    that is a sum: neither a join with the flow nor a shuffle by page pair is needed.
    """
    splits = flow_splits(flow)
    flags = _Flags()
    within = [_within_moment(split, flags) for split in splits]
    counted = dict.fromkeys([flow[0], *(first for first, second in splits if first == second)])
    moments = actions.groupBy("session_id", "action_time").agg(
        F.min("page_id").alias("first_page"),
        F.max("page_id").alias("last_page"),
        *(F.count_if(F.col("page_id") == page).alias(f"views_{page}") for page in counted),
        *flags.aggregates(),
    ).withColumn("cell", F.date_trunc(cell, "action_time"))
    in_cell = Window.partitionBy("session_id", "cell").orderBy("action_time")
    steps = moments.withColumn("next_page", F.lead("first_page").over(in_cell))

    def crossing(split: Split) -> Column:
        met = (F.col("last_page") == split[0]) & (F.col("next_page") == split[1])
        return F.coalesce(met, F.lit(False)).cast("bigint")

    cells = steps.groupBy("session_id", "cell").agg(
        F.min_by("first_page", "action_time").alias("first_page"),
        F.max_by("last_page", "action_time").alias("last_page"),
        F.sum(f"views_{flow[0]}").alias("start_pv"),
        *(F.sum(within[i] + crossing(split)).alias(f"split_{i}") for i, split in enumerate(splits)),
    )
    in_session = Window.partitionBy("session_id").orderBy("cell")
    joined = cells.withColumn("next_page", F.lead("first_page").over(in_session))
    return joined.agg(
        F.coalesce(F.sum("start_pv"), F.lit(0)).alias("start_pv"),
        *(F.coalesce(F.sum(F.col(f"split_{i}") + crossing(split)), F.lit(0)).alias(f"split_{i}")
          for i, split in enumerate(splits)),
    )


def page_split_counts(actions: DataFrame, flow: tuple[int, ...]) -> DataFrame:
    """Rows (split, n) for the pairs of the flow that occur."""
    named = {split_name(split): f"split_{i}" for i, split in enumerate(flow_splits(flow))}
    if not named:
        raise ValueError("a page flow needs at least two pages")
    rows = [F.struct(F.lit(name).alias("split"), F.col(column).alias("n"))
            for name, column in named.items()]
    return count_splits(actions, flow).select(F.inline(F.array(*rows))).filter("n > 0")


def page_convert_rates(actions: DataFrame, flow: tuple[int, ...]) -> DataFrame:
    """Rows (pos, split, n, prev, rate), one per pair of the flow.

    ``prev`` is the count of the pair before, for the first pair the views of the start page.
    A pair nobody took counts 0; the rate after a 0 is null.
    """
    splits = flow_splits(flow)
    if not splits:
        raise ValueError("a page flow needs at least two pages")
    rows = []
    for i, split in enumerate(splits):
        n, prev = F.col(f"split_{i}"), F.col(f"split_{i - 1}" if i else "start_pv")
        rows.append(F.struct(
            F.lit(i + 1).alias("pos"), F.lit(split_name(split)).alias("split"),
            n.alias("n"), prev.alias("prev"), F.try_divide(n, prev).alias("rate"),
        ))
    return count_splits(actions, flow).select(F.inline(F.array(*rows)))


def convert_rate_text(rates: DataFrame) -> DataFrame:
    """All rates of a flow in one string, ``1_2=0.5|2_3=0.25``; one short row per flow position."""
    part = F.concat(F.col("split"), F.lit("="), F.coalesce(F.col("rate").cast("string"), F.lit("null")))
    ordered = F.array_sort(F.collect_list(F.struct("pos", part.alias("part"))))
    return rates.agg(F.array_join(ordered["part"], "|").alias("convert_rate"))
