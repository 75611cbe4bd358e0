"""A hidden Markov model over symbol sequences, in numpy: scaled recursions and Baum-Welch counts.

Sequences run side by side, one step of all of them at a time. A sequence longer than ``CHUNK`` symbols
is cut, and its chunks run side by side too: the recursion over a chunk is a product of matrices, so the
products of all chunks are formed first, the state before and after each chunk follows from them, and the
result is that of the uncut sequence.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

CHUNK = 2048
#: Cells (longest row times rows) that run side by side: where every step is kept, and where none is.
SLAB, WIDE = 1 << 19, 1 << 21
#: Steps between two rescalings of a product of matrices; symbols are more likely than 1e-30.
RESCALE = 8


@dataclass
class Counts:
    """Expected uses: of first states, of transitions, and of symbols per state."""

    start: np.ndarray
    follow: np.ndarray
    emit: np.ndarray


@dataclass
class Chunks:
    """Parts of sequences: where they begin in ``codes``, how long they are, whose they are."""

    codes: np.ndarray
    start: np.ndarray
    length: np.ndarray
    owner: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, sequences: Sequence[np.ndarray], size: int) -> "Chunks":
        """Every sequence has at least one symbol."""
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        number = -(-lengths // size)
        owner = np.repeat(np.arange(len(lengths)), number)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        codes = np.concatenate(sequences) if len(sequences) else np.zeros(0, np.uint16)
        return cls(codes, np.repeat(np.cumsum(lengths) - lengths, number) + nth * size,
                   np.minimum(lengths[owner] - nth * size, size), owner, nth == 0)

    def slabs(self, rows: np.ndarray, cells: int) -> Iterator[np.ndarray]:
        """The rows, longest first, in parts whose longest row times their number is at most ``cells``
        (or of one row)."""
        rows = rows[np.argsort(-self.length[rows], kind="stable")]
        at = 0
        while at < len(rows):
            step = max(1, int(cells // self.length[rows[at]]))
            yield rows[at:at + step]
            at += step


@dataclass
class Steps:
    """The symbols of rows that run side by side, longest first: all first ones, all second ones and so
    on. ``alive[t]`` rows have a symbol ``t``."""

    codes: np.ndarray
    alive: np.ndarray
    rows: int

    @classmethod
    def of(cls, chunks: Chunks, rows: np.ndarray) -> "Steps":
        start, length = chunks.start[rows], chunks.length[rows]
        alive = np.searchsorted(-length, -np.arange(int(length[0])), "left")
        places = np.empty(int(alive.sum()), np.int64)
        at = 0
        for t, n in enumerate(alive.tolist()):
            np.add(start[:n], t, out=places[at:at + n])
            at += n
        return cls(chunks.codes[places].astype(np.int64), alive, len(rows))


@dataclass
class HiddenMarkov:
    """``start[k]``, ``follow[j, k]`` and ``emit[symbol, k]``: probabilities of states and symbols."""

    start: np.ndarray
    follow: np.ndarray
    emit: np.ndarray

    @classmethod
    def fresh(cls, share: np.ndarray, states: int, seed: int = 1, stay: float = 0.8) -> "HiddenMarkov":
        """A model near the symbols' shares, with every state leaning to symbols of its own."""
        rng = np.random.default_rng(seed)
        emit = share[:, None] * rng.gamma(0.5, 2.0, (len(share), states)) + 1e-3 * share[:, None]
        follow = np.full((states, states), (1 - stay) / max(1, states - 1))
        np.fill_diagonal(follow, stay if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), follow, emit / emit.sum(0))

    # --- recursions ---

    def _prior(self, n: int) -> np.ndarray:
        return np.broadcast_to(self.start, (n, len(self.start)))

    def _forward(self, steps: Steps, alpha: np.ndarray, given: np.ndarray | None = None,
                 kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The log likelihood of each row from the states expected at its first symbol, and what the
        forward probabilities were multiplied by, a row per rescaling. ``given`` has the probabilities of
        the symbols, ``kept`` takes the forward probabilities; both are laid out as ``steps.codes``."""
        states = len(self.start)
        logs, alpha, ones = np.zeros(steps.rows), alpha.copy(), np.ones(states)
        factors = np.ones((len(steps.alive) // RESCALE + 1, steps.rows))
        at = 0
        for t, n in enumerate(steps.alive.tolist()):
            if t:
                if n < len(alpha):
                    logs[n:len(alpha)] += np.log(alpha[n:] @ ones)
                    alpha = alpha[:n]
                if t % RESCALE == 0:
                    scale = alpha @ ones
                    logs[:n] += np.log(scale)
                    factors[t // RESCALE, :n] = scale = 1 / scale
                    alpha = alpha * scale[:, None]
                alpha = alpha @ self.follow
            alpha *= self.emit.take(steps.codes[at:at + n], 0) if given is None else given[at:at + n]
            if kept is not None:
                kept[at:at + n] = alpha
            at += n
        logs[:len(alpha)] += np.log(alpha @ ones)
        return logs, factors

    def _products(self, chunks: Chunks, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the scaled matrix that takes the states at its first symbol to those at its last
        one, all its symbols included, and the logarithm of the scale."""
        states = len(self.start)
        result, logs = np.zeros((len(chunks.start), states, states)), np.zeros(len(chunks.start))
        for part in chunks.slabs(rows, WIDE):
            start, length = chunks.start[part], chunks.length[part]
            product = np.broadcast_to(np.eye(states), (len(part), states, states))
            for t in range(int(length[0])):
                n = int(np.searchsorted(-length, -t, "left"))
                if n < len(product):
                    result[part[n:len(product)]] = product[n:]
                product = product[:n]
                if t:
                    product = (product.reshape(-1, states) @ self.follow).reshape(product.shape)
                product = product * self.emit.take(chunks.codes[start[:n] + t], 0)[:, None, :]
                if t % RESCALE == 0 or t + 1 == length[n - 1]:
                    scale = product.max((1, 2))
                    logs[part[:n]] += np.log(scale)
                    product *= (1 / scale)[:, None, None]
            result[part[:len(product)]] = product
        return result, logs

    def _split(self, chunks: Chunks) -> np.ndarray:
        """Which chunks belong to a cut sequence."""
        return np.bincount(chunks.owner)[chunks.owner] > 1 if len(chunks.owner) else chunks.first

    def log_likelihoods(self, sequences: Sequence[np.ndarray], size: int = CHUNK) -> np.ndarray:
        """The natural logarithm of each sequence's probability."""
        chunks = Chunks.of(sequences, size)
        result, cut = np.zeros(len(sequences)), self._split(chunks)
        for part in chunks.slabs(np.flatnonzero(~cut), WIDE):
            result[chunks.owner[part]] = self._forward(Steps.of(chunks, part), self._prior(len(part)))[0]
        rows = np.flatnonzero(cut)
        products, logs = self._products(chunks, rows)
        alpha = self.start
        for i in rows:
            alpha = (self.start if chunks.first[i] else alpha @ self.follow) @ products[i]
            scale = alpha.sum()
            alpha = alpha / scale
            result[chunks.owner[i]] += np.log(scale) + logs[i]
        return result

    # --- Baum-Welch ---

    def expected_counts(self, sequences: Sequence[np.ndarray], size: int = CHUNK) -> Counts:
        """What the sequences are expected to use, given this model."""
        states = len(self.start)
        counts = Counts(np.zeros(states), np.zeros((states, states)), np.zeros_like(self.emit))
        chunks = Chunks.of(sequences, size)
        entry = np.array(self._prior(len(chunks.start)))
        leave = np.ones((len(chunks.start), states))
        rows = np.flatnonzero(self._split(chunks))
        products, _ = self._products(chunks, rows)
        for i in rows:
            if not chunks.first[i]:
                before = entry[i - 1] @ products[i - 1]
                entry[i] = before / before.sum() @ self.follow
        for i in rows[::-1]:
            if not chunks.first[i]:
                ahead = products[i] @ leave[i]
                before = entry[i - 1] @ products[i - 1]
                both = before[:, None] * self.follow * ahead
                counts.follow += both / both.sum()
                back = self.follow @ ahead
                leave[i - 1] = back / back.sum()
        for part in chunks.slabs(np.arange(len(chunks.start)), SLAB):
            self._add(chunks, part, entry[part], leave[part], counts)
        return counts

    def _add(self, chunks: Chunks, rows: np.ndarray, entry: np.ndarray, leave: np.ndarray,
             counts: Counts) -> None:
        """Add what the rows use within themselves, from the states before and after them.

        Backward probabilities are multiplied by what the forward ones of the steps behind them were, and
        by what makes the product of both sum up to 1 at a row's end. It then does at every step.
        """
        steps, states = Steps.of(chunks, rows), len(self.start)
        given = self.emit.take(steps.codes, 0)
        kept = np.empty_like(given)
        _, factors = self._forward(steps, entry, given, kept)
        pair, beta, after = np.zeros((states, states)), np.empty((steps.rows, states)), 0
        ones, back = np.ones(states), np.ascontiguousarray(self.follow.T)
        end = len(given)
        for t in range(len(steps.alive) - 1, -1, -1):
            n = int(steps.alive[t])
            alpha = kept[end - n:end]
            if after:
                ahead = given[end:end + after]
                ahead *= beta[:after]
                if (t + 1) % RESCALE == 0:
                    ahead *= factors[(t + 1) // RESCALE, :after, None]
                pair += alpha[:after].T @ ahead
                np.matmul(ahead, back, out=beta[:after])
            if n > after:
                last = leave[after:n]
                beta[after:n] = last * (1 / ((alpha[after:] * last) @ ones))[:, None]
            alpha *= beta[:n]
            after, end = n, end - n
        counts.follow += pair * self.follow
        counts.start += kept[:steps.rows][chunks.first[rows]].sum(0)
        for k in range(states):
            counts.emit[:, k] += np.bincount(steps.codes, kept[:, k], len(self.emit))

    def next(self, counts: Counts, share: np.ndarray, prior: float = 1.0) -> "HiddenMarkov":
        """The model that the counts speak for. Every state and transition counts ``prior`` times more,
        and every state's symbols ``prior`` times per state by their share, so nothing gets probability 0."""
        start, follow = counts.start + prior, counts.follow + prior
        emit = counts.emit + prior * share[:, None]
        return HiddenMarkov(start / start.sum(), follow / follow.sum(1, keepdims=True), emit / emit.sum(0))
