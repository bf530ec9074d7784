"""Life cycle of streaming queries."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..session import shared_folder


def checkpoint_for(spark: SparkSession, name: str) -> str:
    """The checkpoint of the query called ``name``, in the shared folder."""
    return f"{shared_folder(spark)}/checkpoints/{name}"


def console_options(rows: int = 20) -> dict[str, str]:
    """Options of a console sink that shows ``rows`` rows, uncut."""
    return {"truncate": "false", "numRows": str(rows)}


def start_query(
    stream: DataFrame,
    name: str,
    mode: str = "append",
    sink: str | Callable[[DataFrame, int], None] = "console",
    checkpoint: str | None = None,
    trigger: Mapping[str, object] | None = None,
    options: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Start ``stream`` into ``sink``: a format name or a per-batch function.

    Every query has a checkpoint of its own, in the shared folder under its name
    unless given, so it restarts where it stopped. ``trigger`` is passed to
    Spark, e.g. ``{"processingTime": "30 seconds"}`` or ``{"availableNow": True}``.
    """
    writer = (
        stream.writeStream.outputMode(mode)
        .queryName(name)
        .option("checkpointLocation", checkpoint or checkpoint_for(stream.sparkSession, name))
        .options(**{key: str(value) for key, value in (options or {}).items()})
    )
    if trigger:
        writer = writer.trigger(**trigger)
    if callable(sink):
        return writer.foreachBatch(sink).start()
    return writer.format(sink).start()


def run_for(queries: Iterable[StreamingQuery], seconds: float, look: float = 0.2) -> None:
    """Let ``queries`` run for at most ``seconds`` (or ``inf``), then stop all of them.

    They are stopped as well when any of them fails, wherever it stands, when all
    have ended, or when the caller is interrupted; a query's own error is raised.
    """
    running = list(queries)
    deadline = time.monotonic() + seconds
    try:
        while any(query.isActive for query in running) and time.monotonic() < deadline:
            for query in running:
                if not query.isActive:
                    query.awaitTermination()  # raises what it failed with
            waiting = next((query for query in running if query.isActive), None)
            if waiting is not None:
                waiting.awaitTermination(max(0.01, min(look, deadline - time.monotonic())))
        for query in running:
            if not query.isActive:
                query.awaitTermination()
    finally:
        stop_all(running)


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


class LateRows(StreamingQueryListener):
    """Counts, over a query's whole life, the late rows its watermark kept out.

    ``watch`` it before the queries start. Counted after partial aggregation: rows
    of one window and key in one task count once, and a row counts once per window
    it came too late for. Progress comes a moment after its batch.
    """

    def __init__(self) -> None:
        self._dropped: Counter[str] = Counter()
        self._ended: set[str] = set()

    @classmethod
    def watch(cls, spark: SparkSession) -> LateRows:
        listener = cls()
        spark.streams.addListener(listener)
        return listener

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for state in event.progress.stateOperators:
            self._dropped[str(event.progress.id)] += state.numRowsDroppedByWatermark

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.add(str(event.id))

    def of(self, query: StreamingQuery, wait: float = 10.0) -> int:
        """Rows dropped so far; waits up to ``wait`` seconds for the report of one that has ended."""
        until = time.monotonic() + wait
        while not query.isActive and query.id not in self._ended and time.monotonic() < until:
            time.sleep(0.05)
        return self._dropped[query.id]
