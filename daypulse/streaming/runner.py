"""Replay a record frame into a stream, one arrival window per micro-batch.

All windows are landed first, in order; then the stream starts once with
``trigger(availableNow=True)`` and takes the files of one window per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from daypulse.session import work_path
from daypulse.sources.files import land_windows

StartFn = Callable[[str, int], StreamingQuery]


def run_until_done(q: StreamingQuery) -> list[dict]:
    """Progress of an available-now query once it has read all there is."""
    q.awaitTermination()
    err = q.exception()
    if err is not None:
        raise RuntimeError(f"stream failed: {err}")
    return list(q.recentProgress)


def replay_windows(spark: SparkSession, records: DataFrame, window_ms: int, start: StartFn,
                   landing: str | None = None) -> list[dict]:
    """``start(landing, files)`` must read ``files`` per trigger (``max_files``)."""
    landing = landing or work_path(spark, "landing")
    return run_until_done(start(landing, land_windows(spark, records, landing, window_ms)))


def rows_dropped_by_watermark(progress: list[dict]) -> int:
    n = 0
    for p in progress:
        for op in p.get("stateOperators", []) or []:
            n += int(op.get("numRowsDroppedByWatermark", 0) or 0)
    return n
