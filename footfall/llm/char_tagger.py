"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PAD, OTHER_LETTER, OTHER = 0, 1, 2
SYMBOLS = 3 + 95
WINDOW = 64


def codes(text: str) -> np.ndarray:
    """A class for every character: printable ASCII by itself, other letters, and all the rest."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    result = np.where(points >= 0xC0, OTHER_LETTER, OTHER)
    plain = (points >= 32) & (points < 127)
    result[plain] = points[plain] - 32 + 3
    return result


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """Parameters by name. ``fx, fh, fb`` and ``bx, bh, bb`` are the two directions' gates."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, tags: int, size: int = 12, embedding: int = 8, seed: int = 1) -> "Tagger":
        rng = np.random.default_rng(seed)

        def normal(*shape: int) -> np.ndarray:
            return rng.normal(0, shape[0] ** -0.5, shape)

        weights = {"embed": rng.normal(0, 0.5, (SYMBOLS, embedding)),
                   "out": normal(2 * size, tags), "bias": np.r_[2.0, np.zeros(tags - 1)],
                   "next": np.zeros((tags, tags)), "start": np.zeros(tags)}
        for way in "fb":
            weights |= {f"{way}x": normal(embedding, 4 * size), f"{way}h": normal(size, 4 * size),
                        f"{way}b": np.r_[np.zeros(size), np.ones(size), np.zeros(2 * size)]}
        return cls(weights)

    def _pass(self, x: np.ndarray, way: str) -> tuple[np.ndarray, list]:
        w = self.weights
        n, steps, size = x.shape[0], x.shape[1], w[f"{way}h"].shape[0]
        h, c = np.zeros((n, size)), np.zeros((n, size))
        out, kept = np.zeros((n, steps, size)), []
        entering = x @ w[f"{way}x"] + w[f"{way}b"]
        for t in (range(steps) if way == "f" else range(steps - 1, -1, -1)):
            gates = entering[:, t] + h @ w[f"{way}h"]
            i, f, o = (_sigmoid(gates[:, k * size:(k + 1) * size]) for k in range(3))
            g = np.tanh(gates[:, 3 * size:])
            before, c = (h, c), f * c + i * g
            spread = np.tanh(c)
            h = o * spread
            out[:, t] = h
            kept.append((t, i, f, o, g, spread, before))
        return out, kept

    def emissions(self, ids: np.ndarray) -> tuple[np.ndarray, tuple]:
        w = self.weights
        x = w["embed"][ids]
        ahead, back = self._pass(x, "f"), self._pass(x, "b")
        hidden = np.concatenate([ahead[0], back[0]], axis=2)
        return hidden @ w["out"] + w["bias"], (x, hidden, ahead[1], back[1])

    def _messages(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        follow = self.weights["next"]
        alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
        alpha[:, 0] = scores[:, 0] + self.weights["start"]
        for t in range(1, scores.shape[1]):
            alpha[:, t] = scores[:, t] + _log_sum(alpha[:, t - 1, :, None] + follow, 1)
        for t in range(scores.shape[1] - 2, -1, -1):
            beta[:, t] = _log_sum(follow + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        return alpha, beta

    def gradient(self, ids: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the gold tags, and its gradient."""
        w, (n, steps) = self.weights, ids.shape
        scores, (x, hidden, ahead, back) = self.emissions(ids)
        alpha, beta = self._messages(scores)
        total = _log_sum(alpha[:, -1], 1)
        marginal = np.exp(alpha + beta - total[:, None, None])
        rows, places = np.arange(n)[:, None], np.arange(steps)
        path = scores[rows, places, gold].sum(1) + w["start"][gold[:, 0]] + w["next"][
            gold[:, :-1], gold[:, 1:]].sum(1)
        d_scores = marginal.copy()
        d_scores[rows, places, gold] -= 1
        d_scores /= n
        pair = np.exp(alpha[:, :-1, :, None] + w["next"] + (scores + beta)[:, 1:, None, :]
                      - total[:, None, None, None]).sum((0, 1))
        np.subtract.at(pair, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
        grads = {"next": pair / n, "start": d_scores[:, 0].sum(0), "bias": d_scores.sum((0, 1)),
                 "out": np.einsum("nti,ntk->ik", hidden, d_scores)}
        d_hidden, size, d_x = d_scores @ w["out"].T, w["fh"].shape[0], np.zeros_like(x)
        for way, kept, d_out in (("f", ahead, d_hidden[:, :, :size]), ("b", back, d_hidden[:, :, size:])):
            d_gates_all = np.zeros((n, steps, 4 * size))
            d_recurrent, d_h, d_c = np.zeros_like(w[f"{way}h"]), np.zeros((n, size)), np.zeros((n, size))
            for t, i, f, o, g, spread, (h_before, c_before) in reversed(kept):
                d_h = d_h + d_out[:, t]
                d_c = d_c + d_h * o * (1 - spread * spread)
                d_gates = np.concatenate([d_c * g * i * (1 - i), d_c * c_before * f * (1 - f),
                                          d_h * spread * o * (1 - o), d_c * i * (1 - g * g)], axis=1)
                d_gates_all[:, t] = d_gates
                d_recurrent += h_before.T @ d_gates
                d_h, d_c = d_gates @ w[f"{way}h"].T, d_c * f
            grads |= {f"{way}h": d_recurrent, f"{way}b": d_gates_all.sum((0, 1)),
                      f"{way}x": np.einsum("nte,ntg->eg", x, d_gates_all)}
            d_x += d_gates_all @ w[f"{way}x"].T
        grads["embed"] = np.zeros_like(w["embed"])
        np.add.at(grads["embed"], ids.ravel(), d_x.reshape(-1, x.shape[2]))
        return float((total - path).mean()), grads

    def fit(self, ids: np.ndarray, gold: np.ndarray, steps: int = 240, batch: int = 64,
            rate: float = 0.03, seed: int = 1) -> "Tagger":
        """``steps`` steps of Adam over shuffled batches; the pace shrinks linearly to a tenth."""
        rng, step = np.random.default_rng(seed), 0
        first = {name: np.zeros_like(value) for name, value in self.weights.items()}
        second = {name: np.zeros_like(value) for name, value in self.weights.items()}
        last = steps
        while step < last:
            order = rng.permutation(len(ids))
            for at in range(0, min(len(order), (last - step) * batch), batch):
                rows = order[at:at + batch]
                _, grads = self.gradient(ids[rows], gold[rows])
                norm = sum((g * g).sum() for g in grads.values()) ** 0.5
                pace, shrink = rate * (1 - 0.9 * step / last), min(1, 5 / max(norm, 1e-9))
                step += 1
                for name, g in grads.items():
                    g = g * shrink
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.999 * second[name] + 0.001 * g * g
                    self.weights[name] = self.weights[name] - pace * (first[name] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tag path of each window (Viterbi), and the marginal share of each tag on it."""
        scores, _ = self.emissions(ids)
        n, steps, tags = scores.shape
        best, back = scores[:, 0] + self.weights["start"], np.zeros((n, steps, tags), np.int8)
        for t in range(1, steps):
            options = best[:, :, None] + self.weights["next"]
            back[:, t] = options.argmax(1)
            best = options.max(1) + scores[:, t]
        path = np.zeros((n, steps), np.int64)
        path[:, -1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            path[:, t - 1] = back[np.arange(n), t, path[:, t]]
        alpha, beta = self._messages(scores)
        total = _log_sum(alpha[:, -1], 1)
        share = np.exp(alpha + beta - total[:, None, None])
        return path, np.take_along_axis(share, path[:, :, None], 2)[:, :, 0]
