"""Hashed word shingles of whole texts."""

from __future__ import annotations

import numpy as np
import xxhash

from footfall.llm.common import Memo, word_hash
from footfall.llm.decontamination import gram_keys


class Shingler:
    """Sets of hashed word runs; a text with fewer words is one run, without words it is empty."""

    def __init__(self, size: int):
        self.size, self.hashes = size, Memo(word_hash)

    def of(self, text: bytes) -> np.ndarray:
        """The sorted distinct 64-bit keys. A-Z count as small; words end at ASCII white space."""
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.int64)
        hashes = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        return np.unique(gram_keys(hashes, min(self.size, len(words))))


def signature(keys: np.ndarray) -> bytes:
    """128 bits that stand for the whole set."""
    return xxhash.xxh128_digest(keys.tobytes())
