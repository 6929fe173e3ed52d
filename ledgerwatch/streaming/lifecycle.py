"""Running several streams in one session, and what they report about themselves."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = """name string, batch_id bigint, input_rows bigint, rows_per_second double,
    duration_ms bigint, late_rows bigint"""


def run_until_one_ends(spark: SparkSession, queries: list[StreamingQuery], timeout: int | None = None) -> None:
    """Wait until any query ends or ``timeout`` seconds pass, then stop them all."""
    try:
        if timeout is None:
            spark.streams.awaitAnyTermination()
        else:
            spark.streams.awaitAnyTermination(timeout)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def progress(query: StreamingQuery) -> DataFrame:
    """The last reports of a query: rows, rate, duration and rows dropped as too late."""
    rows = [
        (
            report["name"],
            report["batchId"],
            report["numInputRows"],
            report.get("processedRowsPerSecond"),
            report["durationMs"].get("triggerExecution"),
            sum(op.get("numRowsDroppedByWatermark", 0) for op in report["stateOperators"]),
        )
        for report in query.recentProgress
    ]
    return SparkSession.active().createDataFrame(rows, PROGRESS)


REPORT = """query_id string, name string, run_id string, batch_id bigint, started_at string, input_rows bigint,
    rows_per_second double, duration_ms bigint, durations map<string, bigint>, late_rows bigint, state_rows bigint,
    state_bytes bigint, watermark string, observed map<string, string>"""


class ProgressTable(StreamingQueryListener):
    """Writes what every micro-batch of every query of the session reports into a table: rows, rates, times, rows that
    came too late, size of the state, watermark, and metrics that the query observes.

    A batch that runs again replaces its row. Add it with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        operators = p.stateOperators
        row = (
            str(p.id), p.name, str(p.runId), p.batchId, p.timestamp, p.numInputRows, p.processedRowsPerSecond,
            p.durationMs.get("triggerExecution"), {k: int(v) for k, v in p.durationMs.items()},
            sum(o.numRowsDroppedByWatermark for o in operators), sum(o.numRowsTotal for o in operators),
            sum(o.memoryUsedBytes for o in operators), p.eventTime.get("watermark"),
            {name: json.dumps(metrics.asDict(), default=str) for name, metrics in p.observedMetrics.items()},
        )
        place = f"{self.path}/query_id={p.id}/batch_id={p.batchId}"
        frame = self.spark.createDataFrame([row], REPORT).drop("query_id", "batch_id")
        frame.coalesce(1).write.mode("overwrite").parquet(place)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
