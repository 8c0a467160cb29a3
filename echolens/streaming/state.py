"""What a stream remembers per comment.

Apart from the rest: each Python worker of a stream imports this module, and no more.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class Unfinished(StatefulProcessor):
    """Passes on the last row of each comment whose result is not in the state, or of another mode.

    State: mode and ``seq`` of the row that was passed on last. With ``forget_after``
    a state lives that long; a comment that lands again later is labeled again, which
    costs work but changes no result.
    """

    def __init__(self, hybrid: bool, forget_after: timedelta | None = None):
        self.hybrid, self.forget_after = hybrid, forget_after

    def init(self, handle: StatefulProcessorHandle) -> None:
        lives = None if self.forget_after is None else int(self.forget_after.total_seconds() * 1000)
        self.done = handle.getValueState("done", "hybrid boolean, seq bigint", lives)

    def handleInputRows(self, key, rows: Iterator[Row], timer_values) -> Iterator[Row]:
        last = None
        for row in rows:
            if last is None or last.seq is None or (row.seq is not None and row.seq >= last.seq):
                last = row
        done = self.done.get()
        if done is None or done[0] != self.hybrid:
            self.done.update((self.hybrid, last.seq))
            yield last

    def close(self) -> None:
        pass
