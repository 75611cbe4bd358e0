"""Similarity join of shingle sets by prefix filters under several token orders.

Two sets can only be similar if they share a token among the first few of each, whatever the order
of tokens, as long as it is one order for all. Three orders are used. All put rare tokens first
and differ in how they settle ties; a pair has to pass under every one before its sets are compared.

Tokens that one document alone has cannot be shared. To know them, tokens are counted: each task
sends its tokens in slices of the token space as packed arrays, a slice counts, and only tokens with
a second document go back to the documents they came from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import bit_filter, drop_staged, parts_of, passes, stage, texts_of
from footfall.llm.components import components
from footfall.llm.shingles import Shingler, signature

SIZE = 4
PERCENT = 85
CHUNK_TOKENS = 1_500_000
CHUNK_ROWS = 60_000
#: Bytes of text whose tokens one slice of the token space is to count.
SLICE_BYTES = 128 << 20
TOKEN_BITS = 48
#: Odd multipliers: each permutes the tokens, which settles ties in its own order.
ORDERS = (1, 0x9E3779B97F4B, 0xC2B2AE3D27D5)
_LOW = np.uint64((1 << TOKEN_BITS) - 1)

DOC, TOKENS, COMMON, COMMON_PLACES = range(4)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """How many first tokens of a set of ``n`` have to hold one of any similar set."""
    return n + (-percent * n // 100) + 1


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte by byte: what compresses lies together."""
    steps = np.diff(values, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _chunk_rows(docs: list[tuple], chunk: int, slices: int, schema: pa.Schema) -> pa.RecordBatch:
    """A chunk's documents, and its tokens packed per slice as ``token << 16 | document``.

    A set that the chunk has twice sends its tokens once. Tokens that more than a sixteenth of the
    chunk's documents have are sent as a count, and the documents that have them stay with the chunk.
    """
    rows, parts, first = [], [], {}
    for index, (doc_id, keys) in enumerate(docs):
        mark = signature(keys)
        fresh = len(keys) > 0 and mark not in first
        first.setdefault(mark, index)
        tokens = np.unique(keys.view(np.uint64) >> np.uint64(64 - TOKEN_BITS))
        rows.append((index % slices, chunk, DOC, doc_id, index, len(keys),
                     len(tokens) if fresh else 0, mark, None, None))
        if fresh:
            parts.append(tokens << np.uint64(16) | np.uint64(index))
    packed = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
    token = packed >> np.uint64(16)
    starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.zeros(0, int)
    sizes = np.diff(np.r_[starts, len(token)])
    common = sizes > max(32, len(docs) // 16)
    places = packed[np.repeat(common, sizes)]
    packed = packed[~np.repeat(common, sizes)]
    shared, counts = token[starts[common]], sizes[common].astype(np.uint64)

    def slice_of(tokens: np.ndarray) -> np.ndarray:
        return (tokens % np.uint64(slices)).astype(np.int64)

    for kind, values, extra in ((TOKENS, packed, None), (COMMON, shared, counts)):
        where = slice_of(values >> np.uint64(16) if kind == TOKENS else values)
        order = np.argsort(where, kind="stable")
        edges = np.searchsorted(where[order], np.arange(slices + 1))
        for s in range(slices):
            mine = order[edges[s]:edges[s + 1]]
            if len(mine):
                rows.append((s, chunk, kind, None, None, None, None, None, pack_sorted(values[mine]),
                             None if extra is None else extra[mine].tobytes()))
    if len(places):
        rows.append((chunk % slices, chunk, COMMON_PLACES, None, None, None, None, None,
                     pack_sorted(np.sort(places)), None))
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def _schema(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("slice", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()),
                      ("doc_id", kind), ("place", pa.int32()), ("n", pa.int32()), ("m", pa.int32()),
                      ("mark", pa.binary()), ("tokens", pa.binary()), ("counts", pa.binary())])


def _fields(kind: str) -> str:
    return (f"slice INT, chunk BIGINT, kind INT, doc_id {kind}, place INT, n INT, m INT, "
            "mark BINARY, tokens BINARY, counts BINARY")


def send_tokens(documents: DataFrame, size: int, slices: int, text: str) -> DataFrame:
    """The documents' sets, in chunks, as rows for the slices that count tokens."""
    def run(batches: Iterator) -> Iterator:
        shingler, schema = Shingler(size), None
        docs, held, chunk = [], 0, TaskContext.get().partitionId() << 24
        for batch in batches:
            schema = schema or _schema(batch.schema.field(0).type)
            for doc_id, value in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                docs.append((doc_id, shingler.of(value)))
                held += len(docs[-1][1])
                if held >= CHUNK_TOKENS or len(docs) >= CHUNK_ROWS:
                    yield _chunk_rows(docs, chunk, slices, schema)
                    docs, held, chunk = [], 0, chunk + 1
        if docs:
            yield _chunk_rows(docs, chunk, slices, schema)

    kind = documents.schema["doc_id"].dataType.simpleString()
    narrow = documents.select("doc_id", F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, _fields(kind))


def _joined(values: list[bytes], read) -> np.ndarray:
    parts = [read(value) for value in values]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def count_slice(table: pa.Table) -> pa.Table:
    """Count the tokens of a slice; keep those with two documents or more, with their counts."""
    kinds = np.array(table["kind"].to_pylist())
    tokens, counts = table["tokens"].to_pylist(), table["counts"].to_pylist()
    plain, common = np.flatnonzero(kinds == TOKENS), np.flatnonzero(kinds == COMMON)
    sent = {i: unpack_sorted(tokens[i]) for i in [*plain, *common]}
    entries = _joined([sent[i] >> np.uint64(16) for i in plain], np.asarray)
    shared = _joined([sent[i] for i in common], np.asarray)
    weights = _joined([counts[i] for i in common], _numbers)
    values, inverse = np.unique(np.concatenate([entries, shared]), return_inverse=True)
    total = np.bincount(inverse[:len(entries)], minlength=len(values)).astype(np.int64)
    np.add.at(total, inverse[len(entries):], weights.astype(np.int64))
    each = np.minimum(total, 0xFFFF).astype(np.uint16)[inverse]
    at = {TOKENS: 0, COMMON: len(entries)}
    for i, mine in sent.items():
        found = each[at[kinds[i]]:at[kinds[i]] + len(mine)]
        at[kinds[i]] += len(mine)
        kept = found > 1
        tokens[i], counts[i] = pack_sorted(mine[kept]), found[kept].tobytes()
    position = table.schema.get_field_index("tokens")
    return (table.set_column(position, "tokens", pa.array(tokens, pa.binary()))
            .set_column(position + 1, "counts", pa.array(counts, pa.binary())))


PREFIX = ("doc_id {}, n INT, mark BINARY, "
          "prefix ARRAY<STRUCT<rank: INT, token: BIGINT, place: INT>>")


def prefixes(percent: int):
    """For one chunk: its documents, each with the first shared tokens of its set under every order."""
    def run(table: pa.Table) -> pa.Table:
        kinds = np.array(table["kind"].to_pylist())
        docs = table.filter(pa.array(kinds == DOC)).sort_by("place")
        n = np.array(docs["n"].to_pylist(), np.int64)
        m = np.array(docs["m"].to_pylist(), np.int64)
        tokens, counts = table["tokens"].to_pylist(), table["counts"].to_pylist()

        def of(kind: int, values: list, read=unpack_sorted) -> np.ndarray:
            return _joined([values[i] for i in np.flatnonzero(kinds == kind)], read)

        def amounts(data: bytes) -> np.ndarray:
            return np.frombuffer(data, np.uint16)

        packed, often = of(TOKENS, tokens), of(TOKENS, counts, amounts)
        shared, shared_counts = of(COMMON, tokens), of(COMMON, counts, amounts)
        places = of(COMMON_PLACES, tokens)
        if len(places):
            order = np.argsort(shared)
            spot = np.searchsorted(shared[order], places >> np.uint64(16))
            packed = np.concatenate([packed, places])
            often = np.concatenate([often, shared_counts[order][spot]])
        doc = (packed & np.uint64(0xFFFF)).astype(np.int64)
        token = packed >> np.uint64(16)
        alone = m - np.bincount(doc, minlength=len(n))
        wanted = prefix_length(n, percent) - alone
        columns = [[], [], [], []]
        level = often.astype(np.uint64) << np.uint64(TOKEN_BITS)
        for rank, factor in enumerate(ORDERS):
            key = level | token * np.uint64(factor) & _LOW
            order = np.lexsort((key, doc))
            owner = doc[order]
            nth = np.arange(len(order)) - np.searchsorted(owner, owner)
            kept = nth < wanted[owner]
            for column, values in zip(columns, (
                    owner[kept], np.full(kept.sum(), rank), token[order][kept].astype(np.int64),
                    alone[owner[kept]] + nth[kept] + 1)):
                column.append(values)
        owner, rank, token, position = (np.concatenate(column) for column in columns)
        order = np.argsort(owner, kind="stable")
        edges = np.searchsorted(owner[order], np.arange(len(n) + 1))
        entries = pa.StructArray.from_arrays(
            [pa.array(rank[order], pa.int32()), pa.array(token[order], pa.int64()),
             pa.array(position[order], pa.int32())], names=["rank", "token", "place"])
        return docs.select(["doc_id", "n", "mark"]).append_column(
            "prefix", pa.ListArray.from_arrays(pa.array(edges, pa.int32()), entries))

    return run


def _may_match(a: str, b: str, percent: int) -> Column:
    """The filters on two rows that share a token: sizes, and what is left behind the token."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    rest = F.least(n - F.col(f"{a}.place"), m - F.col(f"{b}.place")) + 1
    return ((percent * F.greatest(n, m) <= 100 * F.least(n, m))
            & ((100 + percent) * rest >= percent * (n + m)))


def mark_key(mark: Column) -> Column:
    return F.conv(F.hex(F.substring(mark, 1, 7)), 16, 10).cast("bigint")


def token_sets(documents: DataFrame, needed: DataFrame, size: int, text: str) -> DataFrame:
    """``mark`` and ``keys`` of the sets that ``needed`` may hold, each once."""
    allowed = bit_filter(needed.select(mark_key(F.col("mark")).alias("key")), "key")

    def run(batches: Iterator) -> Iterator:
        shingler, sent = Shingler(size), set()
        for batch in batches:
            marks, sets = [], []
            for value in texts_of(batch.column(0)):
                keys = shingler.of(value)
                mark = signature(keys)
                slot = np.array([int.from_bytes(mark[:7], "big")])
                if len(keys) and passes(allowed, slot)[0] and mark not in sent:
                    sent.add(mark)
                    marks.append(mark)
                    sets.append(keys.tobytes())
            if len(sent) > 100_000:
                sent.clear()
            yield pa.RecordBatch.from_arrays([pa.array(marks, pa.binary()), pa.array(sets, pa.binary())],
                                             names=["mark", "keys"])

    found = documents.select(F.col(text).cast("string").alias("text")).mapInArrow(
        run, "mark BINARY, keys BINARY")
    return found.join(needed, "mark", "left_semi").groupBy("mark").agg(F.any_value("keys").alias("keys"))


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar enough."""
    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column(2), batch.column(3)):
                left = np.frombuffer(x.as_buffer(), np.int64)
                right = np.frombuffer(y.as_buffer(), np.int64)
                both = len(left) + len(right)
                common = both - len(np.unique(np.concatenate([left, right])))
                kept.append(100 * common >= percent * (both - common))
            yield pa.RecordBatch.from_arrays(
                [column.filter(pa.array(kept, pa.bool_())) for column in batch.columns[:2]],
                names=["a", "b"])

    left = pairs.join(sets.select(F.col("mark").alias("a"), F.col("keys").alias("x")), "a")
    both = left.join(sets.select(F.col("mark").alias("b"), F.col("keys").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a BINARY, b BINARY")


def jaccard_join(documents: DataFrame, size: int = SIZE, percent: int = PERCENT,
                 slices: int | None = None, text: str = "text") -> DataFrame:
    """Groups of documents that similarity links tie together; one row per row of ``documents``.

    Equal sets are one set from the start. First each set is compared with one set per shared token,
    the one with the fewest tokens of its own: that joins large groups of near copies with a number of
    comparisons that grows as their size. What two sets of different groups can still be similar,
    by the filters of all orders, is then compared pair by pair; none is left out. ``component_id`` is
    the smallest id of a group, nulls aside. Null and empty texts are linked with nothing and are their
    own group, even where repeated. An empty table gives no row; further columns are ignored.
    """
    slices = slices or parts_of(documents.select(F.col(text).cast("string").alias("text")), "text", SLICE_BYTES)
    kind = documents.schema["doc_id"].dataType.simpleString()
    sent = send_tokens(documents, size, slices, text)
    counted = sent.groupBy("slice").applyInArrow(count_slice, _fields(kind))
    known = stage(counted.groupBy("chunk").applyInArrow(prefixes(percent), PREFIX.format(kind)),
                  "prefixes")
    docs = known.select("doc_id", "n", "mark")
    rows = (
        known.filter(F.size("prefix") > 0).groupBy("mark").agg(
            F.any_value("n").alias("n"), F.any_value("prefix").alias("prefix"))
        .select("mark", "n", F.explode("prefix").alias("p")).select("mark", "n", "p.*"))

    buckets = rows.groupBy("rank", "token").agg(
        F.count(F.lit(1)).alias("size"),
        F.min(F.struct((F.col("place") / F.col("n")).alias("own"), "mark", "n", "place")).alias("lead"))
    joined = stage(rows.join(buckets.filter("size > 1"), ["rank", "token"]), "buckets")
    first = stage(
        joined.alias("r").filter("rank = 0").filter(F.col("mark") != F.col("lead.mark"))
        .filter(_may_match("r", "lead", percent))
        .select(F.col("mark").alias("a"), F.col("lead.mark").alias("b")).distinct(), "leads")
    sets = stage(token_sets(documents, joined.select("mark").distinct(), size, text), "sets")
    links = stage(similar(first, sets, percent), "similar")
    groups = stage(components(links), "groups")

    apart = joined.drop("size", "lead").join(
        groups.withColumnRenamed("node", "mark"), "mark", "left").withColumn(
        "root", F.coalesce("root", "mark"))
    mixed = stage(apart, "apart")
    open_buckets = mixed.groupBy("rank", "token").agg(
        F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").drop("low", "high")
    open_rows = mixed.join(open_buckets, ["rank", "token"])
    met = open_rows.alias("a").join(
        open_rows.alias("b"),
        (F.col("a.rank") == F.col("b.rank")) & (F.col("a.token") == F.col("b.token"))
        & (F.col("a.mark") < F.col("b.mark")) & (F.col("a.root") != F.col("b.root"))
        & _may_match("a", "b", percent))
    passed = (
        met.select(F.col("a.mark").alias("a"), F.col("b.mark").alias("b"), F.col("a.rank").alias("rank"))
        .groupBy("a", "b").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("rank"))).alias("orders"))
        .filter(F.col("orders") == (1 << len(ORDERS)) - 1).select("a", "b"))
    seen = first.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a"))
    more = stage(similar(passed.join(seen, ["a", "b"], "left_anti"), sets, percent), "similar")
    roots = components(links.unionByName(more))
    grouped = docs.join(roots.withColumnRenamed("node", "mark"), "mark", "left").withColumn(
        "root", F.coalesce("root", "mark"))
    grouped = stage(grouped, "grouped")
    least = stage(grouped.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("least")), "least")
    return grouped.join(least, "root", "left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))
