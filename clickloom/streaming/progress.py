"""What a running query tells: rows of each micro-batch, and that nothing has come for a while."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

_COUNTS = "counts"


def with_counts(stream: DataFrame, bad_column: str | None = None) -> DataFrame:
    """A stream whose micro-batches report their rows, ``n_rows``, and those that are broken, ``n_bad``."""
    bad = F.col(bad_column).isNotNull() if bad_column else F.lit(False)
    return stream.observe(_COUNTS, F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_bad"))


def batch_counts(query: StreamingQuery) -> list[tuple[int, int, int]]:
    """(step, rows, broken rows) of the micro-batches that the query still knows of, from its progress reports.

    A micro-batch whose rows had to be computed again reports more than it landed.
    """
    out = []
    for report in query.recentProgress:
        counts = (report["observedMetrics"] or {}).get(_COUNTS)
        if counts is not None and report["numInputRows"]:
            out.append((report["batchId"], counts["n_rows"], counts["n_bad"]))
    return out


class IdleStop(StreamingQueryListener):
    """Stops a query when it has had no input for some seconds.

    Spark reports an idle query every ``spark.sql.streaming.noDataProgressEventInterval``
    milliseconds. A query that is stopped goes on from its checkpoint when it is started again,
    so what arrives in between is not lost.
    """

    def __init__(self, query: StreamingQuery, seconds: float):
        self._query, self._seconds = query, seconds
        self._last = time.monotonic()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) == self._query.id and event.progress.numInputRows:
            self._last = time.monotonic()

    def onQueryIdle(self, event) -> None:
        if str(event.id) == self._query.id and time.monotonic() - self._last >= self._seconds:
            # stopping waits for the query's own thread, so it is done beside the listeners'
            threading.Thread(target=self._query.stop, daemon=True).start()

    def onQueryTerminated(self, event) -> None:
        pass


def stop_when_idle(query: StreamingQuery, streams, seconds: float) -> IdleStop:
    """Let ``streams``, a session's query manager, stop the query after ``seconds`` without input."""
    listener = IdleStop(query, seconds)
    streams.addListener(listener)
    return listener
