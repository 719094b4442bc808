"""What each micro-batch saw: watermark, event times, rows, rows dropped as late (W1-W3)."""

from __future__ import annotations

import datetime as dt
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

COLUMNS = ("query_id string, batch_id bigint, watermark_ms bigint, max_event_ms bigint, input_rows bigint, dropped_rows bigint, "
           "state_rows bigint")


def _millis(text: str | None) -> int | None:
    if not text:
        return None
    t = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    return (t - dt.datetime(1970, 1, 1, tzinfo=dt.UTC)) // dt.timedelta(milliseconds=1)


class BatchRecorder(StreamingQueryListener):
    """Records one row for each micro-batch of every query, for as long as it listens.

    ``spark.streams.addListener(recorder)``; ``frame`` gives the rows of a query, ``save`` adds them to a table. The watermark is
    the one the batch ran with; dropped rows are those that Spark's own operators left out as late.
    """

    def __init__(self, keep: int = 10_000):
        self._keep, self._rows, self._lock = keep, [], threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        times = p.eventTime or {}
        row = (str(p.id), p.batchId, _millis(times.get("watermark")), _millis(times.get("max")), p.numInputRows,
               sum(o.numRowsDroppedByWatermark for o in p.stateOperators), sum(o.numRowsTotal for o in p.stateOperators))
        with self._lock:
            self._rows = [*self._rows[-self._keep + 1:], row]

    def rows(self, query: StreamingQuery | None = None) -> list[tuple]:
        """The recorded rows, at most ``keep`` of the latest, in the order of the batches."""
        with self._lock:
            return sorted(r for r in self._rows if query is None or r[0] == str(query.id))

    def frame(self, spark: SparkSession, query: StreamingQuery | None = None) -> DataFrame:
        return spark.createDataFrame(self.rows(query), COLUMNS)

    def save(self, spark: SparkSession, path: str, query: StreamingQuery | None = None) -> None:
        """Append the recorded rows to a parquet table and forget them."""
        rows = self.rows(query)
        if rows:
            spark.createDataFrame(rows, COLUMNS).write.mode("append").parquet(path)
            with self._lock:
                self._rows = [r for r in self._rows if r not in set(rows)]

    def wait(self, query: StreamingQuery, batches: int, seconds: float = 20) -> None:
        """Wait until that many batches of a query are recorded: listeners are called after the batch."""
        until = time.time() + seconds
        while len(self.rows(query)) < batches and time.time() < until:
            time.sleep(0.1)
