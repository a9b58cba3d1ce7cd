"""Progress of streaming queries: rates, watermark, late rows and observed counts."""

from __future__ import annotations

import logging
import time
from collections import OrderedDict
from weakref import WeakSet

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tapewright.operators.clean import CLEANING, CLEANING_COUNTS

PROGRESS_SCHEMA = (
    "batch_id bigint, input_rows bigint, rows_per_second double, watermark string, "
    "late_rows_dropped bigint, state_rows bigint"
)

#: Ended runs whose batches are remembered.
KEPT_RUNS = 64

log = logging.getLogger(__name__)


def progress_row(progress) -> tuple:
    states = progress.stateOperators
    return (
        progress.batchId,
        progress.numInputRows,
        float(progress.inputRowsPerSecond or 0.0),
        progress.eventTime.get("watermark"),
        sum(s.numRowsDroppedByWatermark for s in states),
        sum(s.numRowsTotal for s in states),
    )


def progress_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per micro-batch of this run."""
    return spark.createDataFrame(progress_rows(query), PROGRESS_SCHEMA)


def observed_counts(progress) -> dict[str, dict]:
    """What the batch's named observations counted."""
    return {name: row.asDict() for name, row in (progress.observedMetrics or {}).items()}


class _Batches(StreamingQueryListener):
    """Keeps a row and the observations of each batch, of running and recently ended runs."""

    def __init__(self):
        self.rows: OrderedDict[str, dict[int, tuple]] = OrderedDict()
        self.ended: OrderedDict[str, None] = OrderedDict()

    def onQueryStarted(self, event):
        self.rows.setdefault(str(event.runId), {})

    def onQueryProgress(self, event):
        progress = event.progress
        batches = self.rows.setdefault(str(progress.runId), {})
        batches[progress.batchId] = (progress_row(progress), observed_counts(progress))

    def onQueryIdle(self, event):
        """Idle runs read nothing."""

    def onQueryTerminated(self, event):
        self.ended[str(event.runId)] = None
        while len(self.ended) > KEPT_RUNS:
            self.rows.pop(self.ended.popitem(last=False)[0], None)


_BATCHES = _Batches()
_WATCHED: WeakSet = WeakSet()


def watch(spark: SparkSession) -> None:
    """Have all batches of the session's later queries counted; sinks call it before they start."""
    if spark not in _WATCHED:
        spark.streams.addListener(_BATCHES)
        _WATCHED.add(spark)


def _batches(query: StreamingQuery, patience: float) -> list[tuple[tuple, dict]]:
    """Row and observations per batch of this run: from the listener, and from what Spark keeps.

    Listener events come a little later than the batches; after the end they are waited for.
    """
    run, until = str(query.runId), time.monotonic() + patience
    while run in _BATCHES.rows and not query.isActive and run not in _BATCHES.ended and time.monotonic() < until:
        time.sleep(0.05)
    rows = dict(_BATCHES.rows.get(run, {}))
    rows.update({p.batchId: (progress_row(p), observed_counts(p)) for p in query.recentProgress})
    return [rows[k] for k in sorted(rows)]


def progress_rows(query: StreamingQuery, patience: float = 20.0) -> list[tuple]:
    """A row per batch of this run."""
    return [row for row, _ in _batches(query, patience)]


def cleaning_progress(spark: SparkSession, query: StreamingQuery, patience: float = 20.0) -> DataFrame:
    """batch_id and the counts of ``observed_cleaning`` of each batch of this run."""
    found = [
        (row[0], *(seen[CLEANING][c] for c in CLEANING_COUNTS))
        for row, seen in _batches(query, patience) if CLEANING in seen
    ]
    return spark.createDataFrame(found, "batch_id bigint, " + ", ".join(f"{c} bigint" for c in CLEANING_COUNTS))


class ProgressLog(StreamingQueryListener):
    """Logs rows read so far and the current rate after every ``every`` batches."""

    def __init__(self, every: int = 1):
        self.every = max(every, 1)
        self.rows = 0

    def onQueryStarted(self, event):
        log.info("query %s started", event.id)

    def onQueryProgress(self, event):
        progress = event.progress
        self.rows += progress.numInputRows
        if progress.batchId % self.every == 0:
            log.info(
                "batch %d: %d rows so far, %.1f rows/s",
                progress.batchId, self.rows, progress.inputRowsPerSecond or 0.0,
            )
            for name, counts in observed_counts(progress).items():
                log.info("  %s: %s", name, ", ".join(f"{k} {v}" for k, v in counts.items()))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        log.info("query %s ended after %d rows", event.id, self.rows)
