"""Binary token files: packed id matrices, cumulative segment lengths and position resets."""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from footfall.llm import files
from footfall.llm.common import stage
from footfall.llm.tokens import ID_BYTES, SEQUENCE_LENGTH, WordCoder, pieces
from footfall.staging import scratch_dir

SHARD_TOKENS = 1 << 22


class CapacityTree:
    """Open sequences by the room they have left, as a segment tree over the sizes of room.

    ``counts[node]`` is the number of open sequences below a node; the leaves are sizes of room.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._change(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The sequence with the least room of at least ``length``, and that room."""
        node = length + self.leaves
        if not self.counts[node]:
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.counts[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._change(room, -1)
        return self.open[room].pop(), room

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.counts[node] += by
            node >>= 1


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[tuple[int, int]], int]:
    """Sequence and offset of each piece, and the number of sequences."""
    tree, places, n = CapacityTree(capacity), [(0, 0)] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[i])
        sequence, room = found or (n, capacity)
        n += found is None
        places[i] = (sequence, capacity - room)
        if room > lengths[i]:
            tree.add(room - lengths[i], sequence)
    return places, n


def _npy(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, array)
    return out.getvalue()


def write_shard(folder: str, rows: list[tuple], capacity: int, id_type: str,
                doc_type: pa.DataType) -> tuple[str, int, int]:
    """Write one shard of ``(doc_id, piece, start, ids)``; return its name, sequences and tokens.

    ``.ids.npy`` is the matrix of ids, one row per sequence, filled up with 0. ``.lengths.npy`` holds
    the cumulative lengths of the segments in the order of the matrix. ``.resets.npy`` has for every
    segment its row, its column and the position that its first id has in its document.
    ``.segments.arrow`` names the documents and has the checksum of every segment's 32-bit ids. An id
    that ``id_type`` cannot hold is an error.
    """
    places, n = best_fit_decreasing([len(row[3]) // ID_BYTES for row in rows], capacity)
    order = sorted(range(len(rows)), key=places.__getitem__)
    matrix = np.zeros((n, capacity), id_type)
    resets, lengths, sums, most = [], [], [], np.iinfo(id_type).max
    for i in order:
        ids = np.frombuffer(rows[i][3], "<u4")
        if len(ids) and ids.max() > most:
            raise ValueError(f"id {ids.max()} does not fit into {id_type}: choose a wider id_type")
        sequence, offset = places[i]
        matrix[sequence, offset:offset + len(ids)] = ids
        resets.append((sequence, offset, rows[i][2]))
        lengths.append(len(ids))
        sums.append(zlib.crc32(rows[i][3]))
    path = files.own_name(folder, "")
    files.write(f"{path}.ids.npy", _npy(matrix))
    files.write(f"{path}.lengths.npy", _npy(np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")))
    files.write(f"{path}.resets.npy", _npy(np.array(resets, "<i8").reshape(-1, 3)))
    table = pa.table({"doc_id": pa.array([rows[i][0] for i in order], doc_type),
                      "piece": pa.array([rows[i][1] for i in order], pa.int32()),
                      "ids_crc32": pa.array(sums, pa.int64())})
    out = io.BytesIO()
    with pa.ipc.new_file(out, table.schema) as target:
        target.write_table(table)
    files.write(f"{path}.segments.arrow", out.getvalue())
    return path, n, sum(lengths)


def write_token_files(documents: DataFrame, tokenizer: str, folder: str,
                      capacity: int = SEQUENCE_LENGTH, shard_tokens: int = SHARD_TOKENS,
                      id_type: str = "<u2", text: str = "text") -> DataFrame:
    """Write all documents as packed token files; return the list of shards.

    Each task packs what it reads, in shards of about ``shard_tokens``, so nothing is shuffled and
    memory is bounded by a shard and one document. So the number of sequences depends on how the input
    is split: 903 190 tokens take 442 sequences of 2048 in one partition, which is the least possible,
    453 in 16 and 517 in 128 (7 056 tokens each). The list is staged: a shard that a failed attempt
    wrote is in no list. A null text has the closing id only; an empty table gives no shard; repeated
    rows and null ids are kept; further columns are ignored.
    """
    def run(batches: Iterator) -> Iterator:
        coder, rows, tokens, shards = WordCoder.of(tokenizer), [], 0, []
        doc_type = None
        for batch in batches:
            doc_type = batch.schema.field(0).type
            for doc_id, value in zip(batch.column(0).to_pylist(), coder.texts(batch.column(1))):
                for number, start, ids in pieces(value, capacity):
                    rows.append((doc_id, number, start, ids))
                    tokens += len(ids) // ID_BYTES
                if tokens >= shard_tokens:
                    shards.append(write_shard(folder, rows, capacity, id_type, doc_type))
                    rows, tokens = [], 0
        if rows:
            shards.append(write_shard(folder, rows, capacity, id_type, doc_type))
        yield pa.RecordBatch.from_arrays(
            [pa.array([s[0] for s in shards], pa.string()), pa.array([s[1] for s in shards], pa.int64()),
             pa.array([s[2] for s in shards], pa.int64())], names=["path", "sequences", "tokens"])

    narrow = documents.select("doc_id", F.col(text).cast("string").alias("text"))
    return stage(narrow.mapInArrow(run, "path STRING, sequences BIGINT, tokens BIGINT"), "shards")


def read_token_files(shards: DataFrame, id_kind: str = "bigint") -> DataFrame:
    """Every segment of the listed shards: its document, place, and the checksum of its ids.

    Ids that are not those which were handed to the writer are an error.
    """
    fields = (f"doc_id {id_kind}, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT, "
              "shard STRING, sequence BIGINT, offset BIGINT")

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                matrix = np.load(io.BytesIO(files.read(f"{path}.ids.npy")))
                ends = np.load(io.BytesIO(files.read(f"{path}.lengths.npy")))
                resets = np.load(io.BytesIO(files.read(f"{path}.resets.npy")))
                named = pa.ipc.open_file(files.read(f"{path}.segments.arrow")).read_all()
                lengths = np.diff(ends)
                sums = [zlib.crc32(matrix[row, at:at + n].astype("<u4").tobytes())
                        for (row, at, _), n in zip(resets, lengths)]
                if sums != named["ids_crc32"].to_pylist():
                    raise ValueError(f"{path}: the ids are not those that were written")
                name = path.rpartition("/")[2]
                yield pa.RecordBatch.from_arrays([
                    named["doc_id"].combine_chunks(), named["piece"].combine_chunks(),
                    pa.array(resets[:, 2]), pa.array(lengths), pa.array(sums, pa.int64()),
                    pa.array([name] * len(sums), pa.string()), pa.array(resets[:, 0]),
                    pa.array(resets[:, 1])],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "shard", "sequence",
                           "offset"])

    return shards.select("path").mapInArrow(run, fields)


def token_files(documents: DataFrame, tokenizer: str, folder: str | None = None,
                **options: object) -> DataFrame:
    """Write the documents as token files under ``folder`` and read all segments back."""
    folder = folder or scratch_dir(documents.sparkSession, "token-files")
    shards = write_token_files(documents, tokenizer, folder, **options)
    return read_token_files(shards, documents.schema["doc_id"].dataType.simpleString())
