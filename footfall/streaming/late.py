"""A record of what watermarks drop."""

from __future__ import annotations

from collections import Counter

from pyspark.sql.streaming.listener import StreamingQueryListener


class LateRows(StreamingQueryListener):
    """Counts, per stream, the rows that came too late for its state.

    Add it with ``spark.streams.addListener``; ``dropped[id]`` is the number since then, and ``batches``
    lists the batches that dropped some as (stream, batch, rows). Rows are counted after Spark has merged
    those of one key within a task, so a key that is late many times in one batch counts once per task.
    """

    def __init__(self):
        self.dropped: Counter = Counter()
        self.batches: list[tuple[str, int, int]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        if late:
            self.dropped[str(progress.id)] += late
            self.batches.append((str(progress.id), progress.batchId, late))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
