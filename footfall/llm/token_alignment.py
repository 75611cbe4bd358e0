"""Alignment of two tokenizers' tokens over the same bytes.

A text's tokens are the places where they end. The shorter list of ends drives the search for each of
its ends in the longer one: from the last place found by doubling steps, then by halving. Ends that both
lists have cut the text into groups, and the difference of the places of two neighbouring ends says which
tokens overlap.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import smaller, stage, texts_of
from footfall.llm.frequent import frequent

#: Id pairs whose counts every task knows, at most; the others are joined.
KNOWN_PAIRS = 262_144
#: Words whose ids a Python worker remembers, at most.
REMEMBERED = 320_000
#: Words that are encoded as one text.
AT_ONCE = 512
PAIR_SHIFT = 32
_BLANK = "▁"
_LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")
_encoders: dict[tuple[str, str], "TwoEncoders"] = {}


# --- the alignment ----------------------------------------------------------------------------

def gallop(short: list[int], long: list[int]) -> list[int]:
    """For every end in ``short`` the place of the first end in ``long`` that is not before it.

    Both lists ascend and have the same last end.
    """
    places, at, last = [], 0, len(long) - 1
    for end in short:
        if long[at] < end:
            at, step = at + 1, 1
            while long[at] < end:
                top = min(at + step, last)
                if long[top] >= end:
                    at = bisect_left(long, end, at + 1, top)
                    break
                at, step = top, 2 * step
        places.append(at)
    return places


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The last token of each group in either list, and all pairs of overlapping tokens.

    The ends ascend strictly and the last ones are equal.
    """
    swap = len(ends_a) > len(ends_b)
    short, long = (ends_b, ends_a) if swap else (ends_a, ends_b)
    place = np.array(gallop(short.tolist(), long.tolist()), np.int64)
    common = long[place] == short
    first = np.concatenate([[0], (place + common)[:-1]])
    number = place - first + 1
    of_short = np.repeat(np.arange(len(short)), number)
    of_long = np.arange(len(of_short)) - np.repeat(np.cumsum(number) - number, number) + np.repeat(first, number)
    in_short, in_long = np.flatnonzero(common), place[common]
    if swap:
        return in_long, in_short, of_long, of_short
    return in_short, in_long, of_short, of_long


def decimals(ids: int) -> np.ndarray:
    """The digits of all numbers below ``ids``, a row each, filled up with 0 bytes, and a last column free."""
    width = len(str(max(ids - 1, 0)))
    return np.array([str(i) for i in range(ids)], f"S{width + 1}").view(np.uint8).reshape(ids, width + 1)


def group_text(ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray,
               digits: np.ndarray) -> bytes:
    """The groups as ``a1,a2|b1;a3|b2,b3``: every id goes to its row of a table of characters."""
    row_a = np.arange(len(ids_a)) + np.repeat(np.append(0, last_b[:-1] + 1), np.diff(last_a, prepend=-1))
    row_b = np.arange(len(ids_b)) + np.repeat(last_a + 1, np.diff(last_b, prepend=-1))
    cells = np.zeros((len(ids_a) + len(ids_b), digits.shape[1]), np.uint8)
    cells[row_a], cells[row_b] = digits[ids_a], digits[ids_b]
    cells[:, -1] = ord(",")
    cells[row_a[last_a], -1], cells[row_b[last_b], -1] = ord("|"), ord(";")
    return cells[cells != 0].tobytes()[:-1]


# --- the tokenizers ---------------------------------------------------------------------------

def byte_level_bytes(tokenizer) -> list[bytes]:
    """The bytes of each entry of a byte-level vocabulary: printable Latin-1 characters stand for
    themselves, the other bytes in order for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}
    entries = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for entry, number in tokenizer.get_vocab(with_added_tokens=True).items():
        entries[number] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
    return entries


def piece_bytes(model) -> list[bytes]:
    """The bytes of each piece."""
    entries = []
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        entries.append(bytes([int(piece[3:5], 16)]) if model.is_byte(number)
                       else piece.replace(_BLANK, " ").encode())
    return entries


class TwoEncoders:
    """The ids of a text by a byte-level tokenizer (A) and a piece model (B).

    Neither joins what stands on the two sides of a lone blank: A's pattern starts a new part there, and no
    piece of B has a blank after another character. So a text is cut at lone blanks, and the ids of each
    part are looked up; parts not seen before are encoded together. Where a model has such a piece, whole
    texts are encoded instead.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = byte_level_bytes(self.a), piece_bytes(self.b)
        self.sizes_a = np.array([len(entry) for entry in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(entry) for entry in self.bytes_b], np.int64)
        self.digits = decimals(max(len(self.bytes_a), len(self.bytes_b)))
        self.by_part = not any(re.search(rb"[^ ] ", entry) for entry in self.bytes_b)
        self.known: dict[str, tuple[bytes, bytes, bool]] = {}

    @classmethod
    def of(cls, path_a: str, path_b: str) -> "TwoEncoders":
        """The encoders of this Python worker; what they know lasts from task to task."""
        key = path_a, path_b
        if key not in _encoders:
            _encoders[key] = cls(path_a, path_b)
        return _encoders[key]

    def _encode(self, parts: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """Ids of each part after a blank, and whether both give back its bytes."""
        found_a = [one.ids for one in self.a.encode_batch([f" {p}" for p in parts], add_special_tokens=False)]
        found_b = self.b.encode(parts, num_threads=1)
        result = []
        for part, a, b in zip(parts, found_a, found_b):
            text = b" " + part.encode()
            good = (b"".join(map(self.bytes_a.__getitem__, a)) == text
                    and b"".join(map(self.bytes_b.__getitem__, b)) == text)
            result.append((np.array(a, "<u4").tobytes(), np.array(b, "<u4").tobytes(), good))
        return result

    def _encode_words(self, words: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """The same for words without white space at either end, which A encodes as one text. Where the
        bytes of one word do not come back, or a token does not end with it, every word is encoded apart."""
        text = " " + " ".join(words)
        a = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        found_b = self.b.encode(words, num_threads=1)
        b = np.fromiter(chain.from_iterable(found_b), "<u4")
        whole = text.encode()
        if any(b"".join(map(table.__getitem__, ids.tolist())) != whole
               for table, ids in ((self.bytes_a, a), (self.bytes_b, b))):
            return self._encode(words)
        ends = np.cumsum([len(word.encode()) + 1 for word in words])
        cuts = []
        for ids, sizes in ((a, self.sizes_a), (b, self.sizes_b)):
            places = np.cumsum(sizes[ids])
            at = np.searchsorted(places, ends)
            if (places[at] != ends).any():
                return self._encode(words)
            cuts.append([0, *(4 * (at + 1)).tolist()])
        bytes_a, bytes_b = a.tobytes(), b.tobytes()
        return [(bytes_a[i:j], bytes_b[k:m], True)
                for (i, j), (k, m) in zip(pairwise(cuts[0]), pairwise(cuts[1]))]

    def parts(self, text: str) -> list[str]:
        return _LONE_BLANK.split(text) if self.by_part else [text]

    def learn(self, texts: list[list[str]]) -> None:
        """Look up all parts of some texts that are not known yet."""
        new = {part for parts in texts for part in parts}
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {part: self.known[part] for part in new & self.known.keys()}
        new -= self.known.keys()
        words = [p for p in new if p and not p[0].isspace() and not p[-1].isspace()] if self.by_part else []
        for at in range(0, len(words), AT_ONCE):
            some = words[at:at + AT_ONCE]
            self.known.update(zip(some, self._encode_words(some)))
        others = list(new.difference(words))
        self.known.update(zip(others, self._encode(others)))

    def ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of the text of learnt ``parts``, or None if either tokenizer changes its bytes."""
        a, b, good = zip(*map(self.known.__getitem__, parts))
        if not all(good):
            (one, two, fits), = self._encode([" ".join(parts)])
            if not fits:
                return None
            a, b = [one], [two]
        return np.frombuffer(b"".join(a), "<u4"), np.frombuffer(b"".join(b), "<u4")

    def texts(self, texts: list[str], at_once: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """The ids of each text, learning those of a few megabytes at a time; None for empty ones too."""
        waiting, size = [], 0
        for number, text in enumerate(texts):
            waiting.append(self.parts(text) if text else [])
            size += len(text)
            if size > at_once or number + 1 == len(texts):
                self.learn(waiting)
                for parts in waiting:
                    yield self.ids(parts) if parts else None
                waiting, size = [], 0


# --- documents --------------------------------------------------------------------------------

def aligned(documents: DataFrame, path_a: str, path_b: str, text: str = "text",
            with_groups: bool = False) -> DataFrame:
    """Every document's alignment, staged: counts of tokens, groups and links, and its id pairs.

    ``pairs`` and ``uses`` are arrays of 64-bit and 32-bit numbers: A's id times 2^32 plus B's, ascending,
    and how often the document links them. ``with_groups`` adds the groups themselves beside their digest.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    extra = ["groups"] if with_groups else []
    fields = (f"row BIGINT, doc_id {kind}, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, "
              "groups_sha256 STRING, pairs BINARY, uses BINARY" + (", groups STRING" if extra else ""))

    def run(batches: Iterator) -> Iterator:
        encoders, row = TwoEncoders.of(path_a, path_b), TaskContext.get().partitionId() << 33
        for batch in smaller(batches):
            rows = []
            for ids in encoders.texts([text.decode() for text in texts_of(batch.column(1))]):
                if ids is None:
                    rows.append((0, 0, 0, 0, "", b"", b"", ""))
                    continue
                a, b = ids
                last_a, last_b, link_a, link_b = align(
                    np.cumsum(encoders.sizes_a[a]), np.cumsum(encoders.sizes_b[b]))
                keys = a[link_a].astype(np.int64) << PAIR_SHIFT | b[link_b]
                pairs, uses = np.unique(keys, return_counts=True)
                groups = group_text(a, b, last_a, last_b, encoders.digits)
                rows.append((len(a), len(b), len(last_a), len(keys),
                             hashlib.sha256(groups).hexdigest(), pairs.astype("<i8").tobytes(),
                             uses.astype("<i4").tobytes(), groups.decode() if with_groups else ""))
            columns = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary(), pa.string()]
            arrays = [pa.array(column, k) for column, k in zip(columns, kinds)][:7 + len(extra)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(row, row + len(rows)), pa.int64()), batch.column(0), *arrays],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs",
                       "uses", *extra])
            row += len(rows)

    narrow = documents.select("doc_id", F.col(text).cast("string").alias("text"))
    return stage(narrow.mapInArrow(run, fields), "aligned")


def _numbers(column: pa.Array, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(value.as_buffer(), kind) for value in column]


def pair_counts(texts: DataFrame, most: int = 1 << 20) -> DataFrame:
    """Rows (pair, n, best) over all documents: how many links hold the pair linked, and whether no pair
    with the same id of B has more. Tasks add up pairs before they are shuffled."""
    def run(batches: Iterator) -> Iterator:
        def rows(pairs: list, uses: list) -> pa.RecordBatch:
            all_pairs = np.concatenate(pairs) if pairs else np.zeros(0, np.int64)
            keys, place = np.unique(all_pairs, return_inverse=True)
            n = np.bincount(place, np.concatenate(uses) if uses else None, len(keys))
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(n.astype(np.int64))], names=["pair", "n"])

        pairs, uses, size = [], [], 0
        for batch in batches:
            pairs += _numbers(batch.column(0), "<i8")
            uses += _numbers(batch.column(1), "<i4")
            size = sum(map(len, pairs))
            if size > most:
                merged = rows(pairs, uses)
                if merged.num_rows > most // 2:
                    yield merged
                    pairs, uses = [], []
                else:
                    pairs, uses = [merged["pair"].to_numpy()], [merged["n"].to_numpy()]
        yield rows(pairs, uses)

    found = texts.select("pairs", "uses").mapInArrow(run, "pair BIGINT, n BIGINT")
    counts = stage(found.groupBy("pair").agg(F.sum("n").alias("n")), "pair-sums")
    b = F.col("pair").bitwiseAND((1 << PAIR_SHIFT) - 1)
    most_of = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return stage(counts.withColumn("b", b).join(most_of, "b").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def token_alignment(documents: DataFrame, path_a: str, path_b: str, known_pairs: int = KNOWN_PAIRS,
                    text: str = "text", with_groups: bool = False) -> DataFrame:
    """How the tokens of two tokenizers lie to each other in every document.

    One row per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (and
    ``groups``). Texts that are null or empty, or that a tokenizer does not give back byte by byte, have no
    tokens: zeros and empty groups. Repeated rows count again; ties are all best; null ids are kept; an
    empty table gives no row; further columns are ignored. The counts of the most frequent pairs are known to
    every task (``known_pairs`` at most), those of the others are joined.
    """
    texts = aligned(documents, path_a, path_b, text, with_groups)
    counts = pair_counts(texts)
    found = frequent(counts, "n", known_pairs)
    order = np.argsort(found["pair"].to_numpy())
    known = found["pair"].to_numpy()[order]
    known_n, known_best = found["n"].to_numpy()[order], found["best"].to_numpy()[order].astype(np.int64)
    kept = [c for c in texts.columns if c not in ("pairs", "uses")]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema if f.name in kept)

    def run(batches: Iterator) -> Iterator:
        for batch in smaller(batches):
            rows = []
            for pairs, uses in zip(_numbers(batch.column("pairs"), "<i8"), _numbers(batch.column("uses"), "<i4")):
                if not len(known):
                    rows.append((0, 0, pairs, uses))
                    continue
                at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
                here = known[at] == pairs
                n = uses[here].astype(np.int64)
                rows.append((int(n @ known_best[at[here]]), int(n @ known_n[at[here]]), pairs[~here], uses[~here]))
            best, total, pairs, uses = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(best, pa.int64()), pa.array(total, pa.int64()),
                 pa.array(pairs, pa.list_(pa.int64())), pa.array(uses, pa.list_(pa.int32()))],
                names=[*kept, "here_best", "here_sum", "pairs", "uses"])

    counted = stage(texts.select(*kept, "pairs", "uses").mapInArrow(
        run, f"{kinds}, here_best BIGINT, here_sum BIGINT, pairs ARRAY<BIGINT>, uses ARRAY<INT>"), "counted")
    more = counted.filter(F.size("pairs") > 0).select(
        "row", F.explode(F.arrays_zip("pairs", "uses")).alias("entry")
    ).select("row", F.col("entry.pairs").alias("pair"), F.col("entry.uses").alias("uses")).join(
        counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("uses")).otherwise(0)).alias("more_best"),
        F.sum(F.col("uses") * F.col("n")).alias("more_sum"))
    return counted.drop("pairs", "uses").join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("here_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("here_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256", *(["groups"] if with_groups else []))
