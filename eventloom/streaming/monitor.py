"""Progress, throughput and lag of running streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """Keeps the latest figures of each query, by query name or id.

    ``metrics`` holds the values of ``observe`` on the stream, summed over batches.
    """

    def __init__(self) -> None:
        self.latest: dict[str, dict] = {}
        self.metrics: dict[str, dict[str, int]] = {}
        self.finished: set[str] = set()

    def onQueryStarted(self, event) -> None:
        self.latest.setdefault(event.name or str(event.id), {})

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        key = progress.name or str(progress.id)
        total = self.latest.get(key, {}).get("rows", 0) + progress.numInputRows
        self.latest[key] = {
            "batch_id": progress.batchId,
            "rows": total,
            "rows_per_second": progress.inputRowsPerSecond,
            "processed_per_second": progress.processedRowsPerSecond,
            "watermark": progress.eventTime.get("watermark"),
            "newest_event": progress.eventTime.get("max"),
            "state_rows": sum(operator.numRowsTotal for operator in progress.stateOperators),
            "behind": behind(progress),
        }
        sums = self.metrics.setdefault(key, {})
        for row in progress.observedMetrics.values():
            for name, value in row.asDict().items():
                sums[name] = sums.get(name, 0) + (value or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.finished.add(str(event.id))


def behind(progress) -> int:
    """Messages not read yet, as far as the sources report it (topics do)."""
    return sum(int(float(s.metrics.get("maxOffsetsBehindLatest", 0))) for s in progress.sources if s.metrics)


def counted(df: DataFrame, is_error: Column, name: str = "delivery") -> DataFrame:
    """Observe how many rows pass and how many of them are errors."""
    return df.observe(name, F.count(F.lit(1)).alias("sent"), F.count_if(is_error).alias("failed"))


def totals(query: StreamingQuery) -> dict[str, int]:
    """Rows read and observed figures of a run, summed over the batches it reports (the latest hundred by default)."""
    sums = {"rows_read": 0}
    for progress in query.recentProgress:
        sums["rows_read"] += progress["numInputRows"]
        for observed in progress["observedMetrics"].values():
            for name, value in observed.asDict().items():
                sums[name] = sums.get(name, 0) + (value or 0)
    return sums
