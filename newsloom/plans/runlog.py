"""Run metrics and log events of a pipeline run, as small driver-side tables."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession

from ..constants import LOG_COLUMNS, RUN_HISTORY_COLUMNS


class RunLog:
    """Metrics by name, stage durations, and events and errors; each is flushed to a table once."""

    def __init__(self, run_id: str, now: str, mode: str = "full"):
        self.run_id, self.now = run_id, now
        self.metrics: dict[str, object] = {"run_id": run_id, "timestamp": now, "run_mode": mode, "errors_total": 0}
        self.entries: list[tuple] = []
        self.flushed = {"event": 0, "error": 0}
        self._began: dict[str, float] = {}
        self._start = time.monotonic()

    def log(self, **values) -> None:
        self.metrics.update(values)

    def event(self, category: str, stage: str, message: str, level: str = "event", **data) -> None:
        self.entries.append((level, (self.run_id, self.now, category, stage, message, _text(data))))
        if level == "error":
            self.metrics["errors_total"] = int(self.metrics["errors_total"]) + 1

    def error(self, category: str, stage: str, message: str, **data) -> None:
        self.event(category, stage, message, "error", **data)

    def start(self, stage: str) -> None:
        self._began[stage] = time.monotonic()

    def end(self, stage: str) -> None:
        self.metrics[f"duration_{stage}"] = round(time.monotonic() - self._began.pop(stage, time.monotonic()), 2)

    def history(self, spark: SparkSession) -> DataFrame:
        self.metrics["duration_total"] = round(time.monotonic() - self._start, 2)
        row = tuple(_text(self.metrics.get(c)) for c in RUN_HISTORY_COLUMNS)
        return spark.createDataFrame([row], ", ".join(f"{c} string" for c in RUN_HISTORY_COLUMNS))

    def flush(self, spark: SparkSession, level: str) -> DataFrame:
        """The level's entries since the last flush."""
        own = [e for lv, e in self.entries if lv == level]
        fresh, self.flushed[level] = own[self.flushed[level] :], len(own)
        return spark.createDataFrame(fresh, ", ".join(f"{c} string" for c in LOG_COLUMNS))


def _text(x: object) -> str:
    if x is None:
        return ""
    return json.dumps(x, ensure_ascii=False, default=str) if isinstance(x, (dict, list, tuple)) else str(x)
