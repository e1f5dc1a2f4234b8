"""What each poll of a stream brought: observed counts and state figures.

``observed`` names counts that Spark computes inside the stages a micro-batch
runs anyway (``DataFrame.observe``): no second pass over its rows.  A
``PollListener`` takes them from the progress events together with the rows
read, the rows that the watermark dropped and the rows held in state, one row
per query and epoch.

The listener runs beside the query and gets its events late; ``wait`` returns
once the query's end has been seen.  A replayed epoch has one row, its last
run's.  Rows are metadata of epochs, kept up to ``keep`` of them; ``save``
appends those not saved before to a table.
"""

from __future__ import annotations

import threading
from collections import OrderedDict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

METRICS_DDL = "query string, epoch long, n_input long, n_readings long, first_time long, last_time long, n_dropped long, n_state long"
NAME = "poll"


def observed(readings: DataFrame, name: str = NAME) -> DataFrame:
    """``readings`` with its row count and its first and last time observed."""
    return readings.observe(
        name,
        F.count(F.lit(1)).alias("n_readings"),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
    )


class PollListener(StreamingQueryListener):
    """Collects one row per query and epoch; register it with
    ``spark.streams.addListener`` before the query starts."""

    def __init__(self, name: str = NAME, keep: int = 100_000):
        self.name, self.keep = name, keep
        self._rows: OrderedDict[tuple[str, int], tuple] = OrderedDict()
        self._unsaved: set[tuple[str, int]] = set()
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(self.name)
        key = (str(p.id), int(p.batchId))
        row = (
            *key,
            int(p.numInputRows),
            *((seen[c] for c in ("n_readings", "first_time", "last_time")) if seen is not None else (0, None, None)),
            sum(int(s.numRowsDroppedByWatermark) for s in p.stateOperators),
            sum(int(s.numRowsTotal) for s in p.stateOperators),
        )
        with self._lock:
            self._rows[key] = row
            self._unsaved.add(key)
            while len(self._rows) > self.keep:
                old, _ = self._rows.popitem(last=False)
                self._unsaved.discard(old)

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, query, timeout_s: float = 60.0) -> None:
        """Return when all events of the ended ``query`` have come."""
        if not self._end(str(query.runId)).wait(timeout_s):
            raise TimeoutError(f"no end of query {query.runId} was reported in {timeout_s} s")

    def table(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            rows = list(self._rows.values())
        return spark.createDataFrame(rows, METRICS_DDL)

    def save(self, spark: SparkSession, path: str) -> None:
        """Append the rows that came since the last ``save``."""
        with self._lock:
            rows = [self._rows[k] for k in self._rows if k in self._unsaved]
            self._unsaved.clear()
        if rows:
            spark.createDataFrame(rows, METRICS_DDL).coalesce(1).write.mode("append").parquet(path)
