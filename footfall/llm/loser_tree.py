"""A loser tree: the least of k sorted runs, with log2(k) comparisons for each element."""

from __future__ import annotations

from collections.abc import Iterable, Iterator


def merge(runs: Iterable[Iterable[tuple]]) -> Iterator[tuple]:
    """Merge sorted runs of comparable tuples. Equal elements come in the order of the runs.

    Inner nodes keep the run that lost there; after an element leaves, its run's next element climbs
    from its leaf to the root and meets the losers on that path only.
    """
    sources = [iter(run) for run in runs]
    k = max(1, len(sources))
    heads: list[tuple | None] = [next(source, None) for source in sources] or [None]

    def before(a: int, b: int) -> bool:
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or (x == y and a < b)

    losers = [-1] * k

    def play(node: int) -> int:
        if node >= k:
            return node - k
        left, right = play(2 * node), play(2 * node + 1)
        if before(left, right):
            losers[node] = right
            return left
        losers[node] = left
        return right

    winner = play(1) if k > 1 else 0
    while heads[winner] is not None:
        yield heads[winner]
        heads[winner] = next(sources[winner], None)
        node = (winner + k) // 2
        while node:
            if before(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2
