"""Sorted runs of byte strings: front coding, and a loser tree that knows what prefixes are shared.

Each string carries a code against the last one that left the tree: the bytes still open after the
shared prefix, and the next byte itself, as one number. The smaller code is the smaller string, and the
larger one's code then holds against the smaller too; only equal codes need a look at the strings, and
that starts behind the shared prefix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LONGEST = 1 << 15
_UNIT = 256
DONE = LONGEST * _UNIT * 2


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """The length of the shared prefix, of which ``start`` bytes are known."""
    end, step = min(len(a), len(b)), 32
    while start < end and a[start:start + step] == b[start:start + step]:
        start += step
    start = min(start, end)
    stop = min(end, start + step)
    if start == stop:
        return start
    x = int.from_bytes(a[start:stop], "big") ^ int.from_bytes(b[start:stop], "big")
    return stop if not x else start + (8 * (stop - start) - x.bit_length()) // 8


def code(text: bytes, shared: int) -> int:
    """The code of ``text`` against a smaller or equal string with which it shares ``shared`` bytes.

    The end of a string sorts below every byte; a string that is shared as a whole has the code of
    its length only.
    """
    return (LONGEST - shared) * _UNIT + (text[shared] if shared < len(text) else 0)


def front_code(strings: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Sorted strings as shared lengths, lengths of what follows, and what follows."""
    shared, last = [], b""
    for text in strings:
        shared.append(common_prefix(last, text))
        last = text
    rest = [text[n:] for text, n in zip(strings, shared)]
    return (np.array(shared, np.uint16).tobytes(), np.array([len(r) for r in rest], np.uint16).tobytes(),
            b"".join(rest))


def front_decode(shared: bytes, lengths: bytes, rest: bytes) -> Iterator[tuple[int, bytes]]:
    """Shared length with the string before, and the string."""
    at, last = 0, b""
    for n, size in zip(np.frombuffer(shared, np.uint16).tolist(),
                       np.frombuffer(lengths, np.uint16).tolist()):
        last = last[:n] + rest[at:at + size]
        at += size
        yield n, last


def merge(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, int, bytes]]:
    """Merge front-coded runs into ``run, shared length with the string before, string``."""
    k = max(1, len(runs))
    texts, codes = [b""] * k, [DONE] * k

    def advance(run: int) -> None:
        found = next(runs[run], None) if runs else None
        if found is None:
            texts[run], codes[run] = b"", DONE
        else:
            texts[run], codes[run] = found[1], code(found[1], found[0])

    def beats(a: int, b: int) -> bool:
        """Whether the head of run a leaves first; the loser's code is then against the winner."""
        x, y = codes[a], codes[b]
        if x != y:
            return x < y
        if x == DONE:
            return a < b
        known = LONGEST - x // _UNIT
        p, q = texts[a], texts[b]
        shared = common_prefix(p, q, min(known, len(p), len(q)))
        first = p[shared:] < q[shared:] or (len(p) == len(q) == shared and a < b)
        loser = b if first else a
        codes[loser] = code(texts[loser], shared)
        return first

    for run in range(k):
        advance(run)
    losers = [0] * k

    def play(node: int) -> int:
        if node >= k:
            return node - k
        left, right = play(2 * node), play(2 * node + 1)
        first = beats(left, right)
        losers[node] = right if first else left
        return left if first else right

    winner = play(1) if k > 1 else 0
    while codes[winner] != DONE:
        yield winner, LONGEST - codes[winner] // _UNIT, texts[winner]
        advance(winner)
        node = (winner + k) // 2
        while node:
            other = losers[node]
            if not beats(winner, other):
                losers[node], winner = winner, other
            node //= 2
