"""What streams say of their batches, kept in the run log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from viewlake.sinks.runlog import StageResult, append_run_metrics, stage_rows


class BatchLog(StreamingQueryListener):
    """Collects a row for each batch that read anything: rows read, rows a stateful
    operator dropped as late, rows of its state, and how long the batch took.

    Register it with ``spark.streams.addListener``; ``write`` puts what has been collected
    into the run log. Events arrive a little after a batch is done.
    """

    def __init__(self) -> None:
        self.batches: list[StageResult] = []
        self.state_rows: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if not progress.numInputRows:
            return
        states = progress.stateOperators
        name = progress.name or str(progress.id)
        late = sum(s.numRowsDroppedByWatermark for s in states)
        self.state_rows[name] = sum(s.numRowsTotal for s in states)
        self.batches.append(
            StageResult(
                stage=f"{name}/{progress.batchId}",
                status="success",
                input_rows=progress.numInputRows,
                output_rows=progress.numInputRows - late,
                duration_ms=int(progress.durationMs.get("triggerExecution", 0)),
            )
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.batches.append(
                StageResult(f"{event.id}/ended", status="failed", error=event.exception)
            )

    def write(self, spark: SparkSession, path: str, run_id: str, run_at: datetime) -> None:
        """Put the batches so far into the run log, replacing what the run wrote."""
        rows = stage_rows(spark, run_id, run_at, self.batches)
        append_run_metrics(rows, path, run_id)
