"""Token ids of whole texts, word by word, and their cut into pieces."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEQUENCE_LENGTH = 2048
ID_BYTES = 4
END_OF_TEXT = 0
#: Letters below U+0100 and signs without the apostrophe, which can begin a token with letters.
_LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha())
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
#: Words that are encoded as one text.
AT_ONCE = 512
_coders: dict[str, "WordCoder"] = {}


class WordCoder:
    """The ids of a text as little-endian 32-bit numbers.

    The vocabulary drops white space and never joins characters across it, so a text's ids are
    those of its words, one after another. Texts are cut at ASCII white space only. A word of letters
    followed by signs splits there in the tokenizer too, and it ignores case, so such a word has
    two parts, its lower-case letters and its signs; any other word is one part. Every part goes
    through the tokenizer itself and is remembered. Words are split, told apart and put together as
    whole Arrow columns; Python sees a part once in each few megabytes of text.
    """

    def __init__(self, path: str, most: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Parts that are remembered; with more, all are forgotten.
        self.most = most
        #: Bytes that each entry stands for, a character per byte and the mark of a word's end left out.
        self.sizes = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
        for entry, number in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.sizes[number] = len(entry.removesuffix("</w>"))
        self._forget()

    @classmethod
    def of(cls, path: str) -> "WordCoder":
        """The coder of this Python worker; the parts that it knows last from task to task."""
        if path not in _coders:
            _coders[path] = cls(path)
        return _coders[path]

    def _forget(self) -> None:
        """Part ``rows[text]`` has ``counts`` ids from ``starts`` on; the empty part has none."""
        self.rows, self.found = {"": 0}, np.empty(0, "<u4")
        self.starts, self.counts = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _encode_each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` and how many each has."""
        every = [one.ids for one in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in every for i in ids], "<u4"), np.array([len(ids) for ids in every], np.int64)

    def _encode_joined(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same of texts that keep their bytes, encoded as one text and cut where their bytes end."""
        words = texts.to_pylist()
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends, places = np.cumsum(pc.binary_length(texts).to_numpy()), np.cumsum(self.sizes[ids])
        at = np.searchsorted(places, ends)
        if not len(places) or places[-1] != ends[-1] or (places[at] != ends).any():
            return self._encode_each(words)
        return ids, np.diff(at, prepend=-1)

    def _learn(self, parts: pa.Array) -> None:
        """Encode parts that are not known yet. Only case changes the bytes of those that are joined."""
        letters = pc.equal(pc.utf8_rtrim(parts, _LETTERS), "")
        joined = pc.or_(letters, pc.string_is_ascii(parts))
        together, others = parts.filter(joined), parts.filter(pc.invert(joined))
        found = [self._encode_joined(together.slice(at, AT_ONCE)) for at in range(0, len(together), AT_ONCE)]
        if len(others):
            found.append(self._encode_each(others.to_pylist()))
        counts = np.concatenate([n for _, n in found])
        self.starts = np.append(self.starts, len(self.found) + np.cumsum(counts) - counts)
        self.counts = np.append(self.counts, counts)
        self.found = np.concatenate([self.found, *(ids for ids, _ in found)])
        names = together.to_pylist() + others.to_pylist()
        self.rows.update(zip(names, range(len(self.rows), len(self.rows) + len(names))))

    def _rows(self, parts: pa.Array) -> np.ndarray:
        """The row of each of some different parts, the new ones learnt."""
        rows = self._known(parts)
        if len(self.rows) + (rows < 0).sum() > self.most:
            self._forget()
            rows = self._known(parts)
        if (rows < 0).any():
            new = parts.filter(pa.array(rows < 0))
            self._learn(new)
            rows[rows < 0] = self._known(new)
        return rows

    def _known(self, parts: pa.Array) -> np.ndarray:
        return np.fromiter(map(self.rows.get, parts.to_pylist(), repeat(-1)), np.int64, len(parts))

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``words`` and how many each has."""
        heads, tails = pc.utf8_rtrim(words, _MARKS), pc.utf8_ltrim(words, _LETTERS)
        whole = pc.not_equal(pc.add(pc.binary_length(heads), pc.binary_length(tails)), pc.binary_length(words))
        parts = pa.concat_arrays([pc.if_else(whole, words, pc.utf8_lower(heads)),
                                  pc.if_else(whole, "", tails)]).dictionary_encode()
        rows = self._rows(parts.dictionary)[parts.indices.to_numpy()].reshape(2, -1).T.ravel()
        counts = self.counts[rows]
        return _laid_out(self.found, self.starts[rows], counts), counts.reshape(-1, 2).sum(axis=1)

    def _ids(self, texts: pa.Array) -> Iterator[bytes]:
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        words = lists.flatten().dictionary_encode()
        ids, counts = self._words(words.dictionary)
        ends = np.cumsum(pc.list_value_length(lists).to_numpy())
        order = np.insert(words.indices.to_numpy(), ends, len(counts))
        starts = np.append(np.cumsum(counts) - counts, len(ids))
        ids, counts = np.append(ids, np.uint32(END_OF_TEXT)), np.append(counts, 1)
        data = _laid_out(ids, starts[order], counts[order]).tobytes()
        cuts = ID_BYTES * np.cumsum(counts[order])[ends + np.arange(len(ends))]
        return (data[i:j] for i, j in pairwise([0, *cuts.tolist()]))

    def texts(self, texts: pa.Array, at_once: int = 1 << 22) -> Iterator[bytes]:
        """The ids of each text and the closing id 0, a few megabytes of texts at a time."""
        ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            passed = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, passed + at_once, side="right")))
            yield from self._ids(texts.slice(at, end - at))
            at = end

    def ids(self, text: str | None) -> bytes:
        """The ids of ``text`` and the closing id 0; a null text has just that."""
        return next(self.texts(pa.array([text], pa.string())))


def _laid_out(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of ``counts`` ids that begin at ``starts``, one after another."""
    ends = np.cumsum(counts)
    return ids[np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)]


def pieces(ids: bytes, longest: int = SEQUENCE_LENGTH) -> Iterator[tuple[int, int, bytes]]:
    """Number, first position and ids of each piece; only what is longer than ``longest`` is cut."""
    step = longest * ID_BYTES
    for number, at in enumerate(range(0, len(ids), step)):
        yield number, at // ID_BYTES, ids[at:at + step]
