"""Removal of byte strings of a given length that occur twice or more, within and across documents.

The strings of ``LENGTH`` bytes are judged by their anchor: of the 32-byte grams in a string, the one
with the least hash. Equal strings have the same anchor at the same place, so only strings around equal
grams need comparing, and neighbouring strings mostly share one anchor. An anchor's context is all
bytes of the strings it stands for. Equal contexts make all their strings repeated. What is left are
contexts that share a gram but differ, at the edges of passages and around edits. They are suffix
sorted in both directions from the gram: each task sends front-coded sorted runs, and a task merges the
runs of a range with a loser tree that never compares a known prefix again. Neighbours in the order
have the longest common reach to the right, or to the left.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import bit_filter, passes, stage
from footfall.llm.prefix_merge import common_prefix, front_code, front_decode, merge

LENGTH, GRAM = 200, 32
BLOCK = 1 << 22
RUN_ENTRIES = 50_000
SAMPLE = 4_000
_LOW = np.uint64((1 << 24) - 1)
_FACTORS = [np.uint64(pow(0x9E3779B97F4A7C15, 1 << i, 1 << 64)) for i in range(5)]
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def gram_hashes(data: bytes) -> np.ndarray:
    """The hash of every 32 neighbouring bytes, by doubling."""
    h = _BYTES[np.frombuffer(data, np.uint8)]
    for i, factor in enumerate(_FACTORS):
        h = h[:-(1 << i)] * factor + h[1 << i:]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


def _least(key: np.ndarray, span: int) -> np.ndarray:
    """The least of every ``span`` neighbours, by doubling."""
    width = 1
    while 2 * width <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    rest = span - width
    return np.minimum(key[:len(key) - rest], key[rest:]) if rest else key


def anchors(data: bytes) -> Iterator[tuple[int, int, int, int]]:
    """``first, strings, middle, hash``: strings start at ``first`` and the following bytes, their
    anchor at ``first + middle``. Of equal hashes in a string the last counts. Long texts go block by
    block; which gram is a string's anchor depends on the string alone."""
    for base in range(0, max(0, len(data) - LENGTH + 1), BLOCK):
        hashes = gram_hashes(data[base:base + BLOCK + LENGTH - 1])
        key = hashes & ~_LOW | _LOW - np.arange(len(hashes), dtype=np.uint64)
        at = (_LOW - (_least(key, LENGTH - GRAM + 1) & _LOW)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        count = np.diff(np.r_[first, len(at)])
        middle = at[first]
        yield from zip((first + base).tolist(), count.tolist(), (middle - first).tolist(),
                       hashes[middle].view(np.int64).tolist())


def anchor_table(texts: DataFrame) -> DataFrame:
    """All anchors of ``row, data``, with a hash of their context and place in it."""
    def run(batches: Iterator) -> Iterator:
        names = ["row", "first", "strings", "middle", "gram", "context"]
        for batch in batches:
            rows = []
            for row, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for first, count, middle, gram in anchors(data):
                    context = xxhash.xxh64_intdigest(data[first:first + count - 1 + LENGTH], middle)
                    rows.append((row, first, count, middle, gram, context - (1 << 63)))
                if len(rows) > 200_000:
                    yield pa.RecordBatch.from_arrays(_typed(rows, "liiill"), names=names)
                    rows = []
            yield pa.RecordBatch.from_arrays(_typed(rows, "liiill"), names=names)

    return texts.mapInArrow(
        run, "row BIGINT, first INT, strings INT, middle INT, gram BIGINT, context BIGINT")


_TYPES = {"l": pa.int64(), "i": pa.int32(), "b": pa.binary()}


def _typed(rows: list[tuple], kinds: str) -> list[pa.Array]:
    columns = zip(*rows) if rows else [[] for _ in kinds]
    return [pa.array(column, _TYPES[kind]) for column, kind in zip(columns, kinds)]


def contexts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes before and from the gram on, for the anchors in ``wanted``, one row each."""
    places = wanted.groupBy("row").agg(F.collect_list(F.struct("first", "strings", "middle")).alias("at"))

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for row, data, at in zip(*(column.to_pylist() for column in batch.columns)):
                for place in at:
                    first, count, middle = place["first"], place["strings"], place["middle"]
                    rows.append((row, first, data[first:first + middle],
                                 data[first + middle:first + count - 1 + LENGTH]))
            yield pa.RecordBatch.from_arrays(_typed(rows, "libb"), names=["row", "first", "left", "right"])

    held = only_rows(texts, wanted).join(places, "row")
    return held.select("row", "data", "at").mapInArrow(
        run, "row BIGINT, first INT, left BINARY, right BINARY")


def only_rows(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``texts`` that ``wanted`` may name, chosen before anything is shuffled."""
    allowed = bit_filter(wanted.select(F.xxhash64("row").alias("key")), "key")

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            kept = passes(allowed, batch.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [column.filter(pa.array(kept)) for column in batch.columns[1:]],
                names=batch.schema.names[1:])

    return texts.select(F.xxhash64("row"), "row", "data").mapInArrow(run, "row BIGINT, data BINARY")


# --- the sort -----------------------------------------------------------------------------------

END = b"\xff"  # in no UTF-8 text


def sort_key(left: bytes, right: bytes, rightward: bool) -> bytes:
    """What lies right of the gram's start and then, backwards, what lies left of it; or the other
    way round."""
    back = left[::-1]
    return right + END + back if rightward else back + END + right


def reach(a: bytes, b: bytes, shared: int, rightward: bool) -> tuple[int, int]:
    """Bytes that two keys share to the right and to the left."""
    i, j = a.index(END), b.index(END)
    main = min(shared, i, j)
    other = common_prefix(a[i + 1:], b[j + 1:])
    return (main, other) if rightward else (other, main)


RUN = "part INT, run BIGINT, shared BINARY, lengths BINARY, rest BINARY, rows BINARY, firsts BINARY"
REACH = "part INT, row BIGINT, first INT, right INT, left INT, edge INT, key BINARY"


def sorted_runs(table: DataFrame, splitters: list[bytes], rightward: bool) -> DataFrame:
    """Sorted and front-coded runs, cut at the splitters."""
    def run(batches: Iterator) -> Iterator:
        entries, number = [], TaskContext.get().partitionId() << 24

        def cut() -> pa.RecordBatch:
            entries.sort()
            rows, at = [], 0
            while at < len(entries):
                part = bisect_right(splitters, entries[at][0])
                end = len(entries) if part == len(splitters) else _first_not_below(
                    entries, splitters[part], at)
                some = entries[at:end]
                rows.append((part, number, *front_code([e[0] for e in some]),
                             np.array([e[1] for e in some], np.int64).tobytes(),
                             np.array([e[2] for e in some], np.int32).tobytes()))
                at = end
            return pa.RecordBatch.from_arrays(
                _typed(rows, "ilbbbbb"),
                names=["part", "run", "shared", "lengths", "rest", "rows", "firsts"])

        for batch in batches:
            for row, first, left, right in zip(*(column.to_pylist() for column in batch.columns)):
                entries.append((sort_key(left, right, rightward), row, first))
                if len(entries) >= RUN_ENTRIES:
                    yield cut()
                    entries, number = [], number + 1
        if entries:
            yield cut()

    return table.select("row", "first", "left", "right").mapInArrow(run, RUN)


def _first_not_below(entries: list[tuple], bound: bytes, low: int) -> int:
    high = len(entries)
    while low < high:
        middle = (low + high) // 2
        if entries[middle][0] < bound:
            low = middle + 1
        else:
            high = middle
    return low


def merge_part(rightward: bool):
    """Merge the runs of a range; tell each entry how far its better neighbour agrees with it."""
    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        runs = table.select(["shared", "lengths", "rest", "rows", "firsts"]).to_pylist()
        ids = [zip(np.frombuffer(r["rows"], np.int64).tolist(), np.frombuffer(r["firsts"], np.int32).tolist())
               for r in runs]
        sources = [front_decode(r["shared"], r["lengths"], r["rest"]) for r in runs]
        rows, last, key, best = [], None, b"", (0, 0)
        for which, shared, text in merge(sources):
            found = reach(key, text, shared, rightward) if last else (0, 0)
            if last:
                rows.append((part, *last, *_better(best, found, rightward), None, None))
                if len(rows) == 1:
                    rows[0] = (*rows[0][:5], 0, key)
            last, key, best = next(ids[which]), text, found
        if last:
            if not rows:
                rows.append((part, *last, *best, 0, key))
            rows.append((part, *last, *best, 1, key))
        return pa.Table.from_arrays(
            _typed(rows, "iliiiib"), names=["part", "row", "first", "right", "left", "edge", "key"])

    return run


def _better(a: tuple[int, int], b: tuple[int, int], rightward: bool) -> tuple[int, int]:
    return max(a, b, key=lambda r: r if rightward else r[::-1])


def neighbours(table: DataFrame, rightward: bool, parts: int) -> DataFrame:
    """For each context the longest agreement, to the right (or left) first, with any other one.

    Ranges come from a sample of at most ``SAMPLE`` keys and change only who merges what. The first and
    the last entry of each range meet their neighbours across its borders on the driver: two rows a
    range.
    """
    spark = table.sparkSession
    sample = table.orderBy(F.xxhash64("row", "first")).limit(SAMPLE).select("left", "right").collect()
    keys = sorted({sort_key(bytes(r["left"]), bytes(r["right"]), rightward) for r in sample})
    splitters = sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []
    merged = stage(sorted_runs(table, splitters, rightward).groupBy("part").applyInArrow(
        merge_part(rightward), REACH), "neighbours")
    edges = merged.filter("edge IS NOT NULL").select("part", "edge", "row", "first", "key").collect()
    edges.sort(key=lambda e: (e["part"], e["edge"]))
    across = []
    for a, b in zip(edges, edges[1:]):
        if a["edge"] == 1 and b["edge"] == 0:
            x, y = bytes(a["key"]), bytes(b["key"])
            right, left = reach(x, y, common_prefix(x, y), rightward)
            across += [(a["row"], a["first"], right, left), (b["row"], b["first"], right, left)]
    found = merged.select("row", "first", "right", "left").unionByName(
        spark.createDataFrame(across, "row BIGINT, first INT, right INT, left INT"))
    order = F.struct("right", "left") if rightward else F.struct("left", "right")
    return found.groupBy("row", "first").agg(F.max(order).alias("best")).select(
        "row", "first", F.col("best.right").alias("right"), F.col("best.left").alias("left"))


# --- what is repeated ---------------------------------------------------------------------------

def repeated_spans(texts: DataFrame, parts: int) -> DataFrame:
    """``row, first, end`` of bytes to remove; the spans of a row may overlap."""
    found = stage(anchor_table(texts), "anchors")
    classes = found.groupBy("gram", "context").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("row", "first")).alias("one"))
    grams = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.sum("copies").alias("n"))
    live = classes.join(grams.filter("n > 1").select("gram", "kinds"), "gram")
    marked = stage(found.join(live, ["gram", "context"]), "marked")
    copied = marked.filter("copies > 1").select(
        "row", "first", (F.col("first") + F.col("strings") - 1 + LENGTH).alias("end"))

    differing = marked.filter((F.col("kinds") > 1) & (F.col("one.row") == F.col("row"))
                              & (F.col("one.first") == F.col("first")))
    held = stage(contexts(texts, differing), "contexts")
    right = neighbours(held, True, parts).select(
        "row", "first", F.col("right").alias("r1"), F.col("left").alias("l1"))
    left = neighbours(held, False, parts).select(
        "row", "first", F.col("right").alias("r2"), F.col("left").alias("l2"))
    low, high = F.col("middle") - F.col("strings") + 1, F.col("middle")
    judged = stage(
        differing.filter("copies = 1").join(right, ["row", "first"]).join(left, ["row", "first"]).select(
            "row", "gram", "first", "middle", low.alias("low"), high.alias("high"), "r1", "l1", "r2", "l2"),
        "judged")

    # A string whose gram starts after l of its bytes is repeated if some other context agrees for l
    # bytes to the left and for the other LENGTH - l to the right.
    def span(reach_right: str, reach_left: str):
        a = F.greatest(F.col("low"), LENGTH - F.col(reach_right))
        b = F.least(F.col("high"), F.col(reach_left))
        start = F.col("first") + F.col("middle")
        return judged.select("row", a.alias("a"), b.alias("b"), start.alias("at")).filter("a <= b").select(
            "row", (F.col("at") - F.col("b")).alias("first"), (F.col("at") - F.col("a") + LENGTH).alias("end"))

    # Between the two extremes another context may agree less to the right but more to the left.
    a = F.greatest("low", F.col("l1") + 1, LENGTH - F.col("r1"))
    b = F.least("high", "l2", LENGTH - F.col("r2") - 1)
    between = stage(judged.select("row", "gram", "first", "middle", a.alias("a"), b.alias("b"))
                    .filter("a <= b"), "between")
    asked = between.select("gram", F.explode(F.sequence("a", "b")).alias("l")).distinct()
    strings = (
        differing.select("row", "first", "gram", "middle", low.alias("low"), high.alias("high"))
        .join(asked, "gram").filter("l BETWEEN low AND high").drop("low", "high")
        .join(held, ["row", "first"]).select(
            "gram", "l", "row", (F.col("first") + F.col("middle") - F.col("l")).alias("first"),
            F.concat(F.expr("substring(left, length(left) - l + 1, l)"),
                     F.expr(f"substring(right, 1, {LENGTH} - l)")).alias("bytes")))
    known = stage(strings, "strings")
    twice = known.groupBy("gram", "l", "bytes").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    rest = known.join(twice, ["gram", "l", "bytes"], "left_semi").select(
        "row", "first", (F.col("first") + LENGTH).alias("end"))
    return copied.unionByName(span("r1", "l1")).unionByName(span("r2", "l2")).unionByName(rest)


def remove_spans(texts: DataFrame, spans: DataFrame, kind: str, keep_text: bool) -> DataFrame:
    """Cut the spans out of each text. Texts without spans stay where they are."""
    allowed = bit_filter(spans.select(F.xxhash64("row").alias("key")), "key")
    fields = (f"row BIGINT, doc_id {kind}, n_bytes BIGINT, kept_sha256 STRING, data BINARY"
              + (", kept BINARY" if keep_text else ""))

    def look(batches: Iterator) -> Iterator:
        for batch in batches:
            touched = passes(allowed, batch.column(0).to_numpy())
            data = batch.column(3).to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column(1), batch.column(2), pa.array([len(d) for d in data], pa.int64()),
                pa.array([None if t else hashlib.sha256(d).hexdigest() for d, t in zip(data, touched)],
                         pa.string()),
                pa.array([d if t else None for d, t in zip(data, touched)], pa.binary()),
                *([pa.array([None if t else d for d, t in zip(data, touched)], pa.binary())]
                  if keep_text else [])],
                names=[field.split()[0] for field in fields.split(", ")])

    def cut(batches: Iterator) -> Iterator:
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in batch.schema.names if name != "doc_id"}
            removed, runs, marks, kept = [], [], [], []
            for i, data in enumerate(columns["data"]):
                spans_of = columns["spans"][i]
                if data is None:
                    removed.append(0), runs.append(0), marks.append(columns["kept_sha256"][i])
                    kept.append(columns["kept"][i] if keep_text else None)
                    continue
                at, out, n = 0, [], 0
                for span in sorted((s["first"], s["end"]) for s in spans_of or ()):
                    if span[0] > at or not n:
                        out.append(data[at:span[0]])
                        n += 1
                        at = span[1]
                    else:
                        at = max(at, span[1])
                out.append(data[at:])
                rest = b"".join(out)
                removed.append(len(data) - len(rest)), runs.append(n)
                marks.append(hashlib.sha256(rest).hexdigest()), kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()),
                 pa.array(runs, pa.int64()), pa.array(marks, pa.string()),
                 *([pa.array(kept, pa.binary())] if keep_text else [])],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
                       *(["kept"] if keep_text else [])])

    looked = texts.select(F.xxhash64("row"), "row", "doc_id", "data").mapInArrow(look, fields)
    of_row = spans.groupBy("row").agg(F.collect_set(F.struct("first", "end")).alias("spans"))
    return looked.join(of_row, "row", "left").mapInArrow(
        cut, f"doc_id {kind}, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING"
             + (", kept BINARY" if keep_text else ""))


def suffix_dedup(documents: DataFrame, parts: int | None = None, keep_text: bool = False,
                 text: str = "text") -> DataFrame:
    """Remove every byte covered by a string of 200 bytes that also starts somewhere else.

    One row per row of ``documents``. A null text is empty; texts under 200 bytes keep all their bytes.
    Overlapping occurrences count, in one document too; rows that repeat lose all of what they share.
    ``keep_text`` adds the remaining bytes. An empty table gives no row; further columns are ignored.
    """
    spark = documents.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = stage(documents.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("data")), "texts")
    spans = stage(repeated_spans(texts.select("row", "data"), parts), "spans")
    return remove_spans(texts, spans, kind, keep_text)
