"""Progress of running jobs."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)


def log_items(n: int) -> None:
    log.info("processed %d items", n)


def report_steps(before: int, more: int, step: int, report: Callable[[int], None]) -> None:
    """Report the total where ``more`` takes it past a multiple of ``step``."""
    if before // step != (before + more) // step:
        report(before + more)


def observed(df: DataFrame, name: str, counted: str = "true") -> tuple[DataFrame, Observation]:
    """The frame with a counter of the rows that fulfil a condition; the next action over it fills it in."""
    seen = Observation(name)
    return df.observe(seen, F.count_if(F.expr(counted)).alias("rows")), seen


def counted(df: DataFrame, name: str = "progress") -> DataFrame:
    """Streaming form: the count of each micro-batch reaches the listener under ``name``."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


class ProgressListener(StreamingQueryListener):
    """Adds up a stream's row counts and reports every ``step`` rows."""

    def __init__(self, name: str = "progress", step: int = 100,
                 report: Callable[[int], None] = log_items):
        self.name, self.step, self.report = name, step, report
        self.total = 0

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        row = event.progress.observedMetrics.get(self.name)
        if row is None or not row.rows:
            return
        before, self.total = self.total, self.total + row.rows
        report_steps(before, row.rows, self.step, self.report)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
