"""Stopping a batch run: its thread tags its jobs, another one watches the log and cancels them."""

from __future__ import annotations

import contextlib
import threading

from pyspark.sql import SparkSession

from .run_log import stop_is_requested


class RunStopped(Exception):
    """Ends a run that was asked to stop, or has done as much as it was to do."""


class StopWatch:
    """Within the block all jobs of this thread carry the run's tag; a request in the log cancels them.

    The log is read every ``poll_seconds``; with None nobody looks. ``requested`` tells whether a
    request was seen, so that the failure of a cancelled job can be told from others.
    """

    def __init__(self, spark: SparkSession, output: str, run_id: str, poll_seconds: float | None):
        self._spark, self._output, self._run_id, self._poll = spark, output, run_id, poll_seconds
        self._over = threading.Event()
        self._seen = threading.Event()
        self._thread = threading.Thread(target=self._watch, name=f"stop-watch-{run_id}", daemon=True)

    def __enter__(self) -> "StopWatch":
        self._spark.sparkContext.addJobTag(self._run_id)
        if self._poll is not None:
            self._thread.start()
        return self

    def __exit__(self, *_) -> None:
        self._over.set()
        if self._poll is not None:
            self._thread.join()
        self._spark.sparkContext.removeJobTag(self._run_id)

    @property
    def requested(self) -> bool:
        return self._seen.is_set()

    def check(self) -> None:
        """Raises between two jobs, where there is none to cancel."""
        if self.requested:
            raise RunStopped(f"run {self._run_id} was asked to stop")

    def _watch(self) -> None:
        while not self._over.wait(self._poll):
            with contextlib.suppress(Exception):  # the log is being written; the next look will do
                if stop_is_requested(self._spark, self._output, self._run_id):
                    self._seen.set()
            if self.requested:
                # Again and again, since the run may be between two jobs.
                self._spark.sparkContext.cancelJobsWithTag(self._run_id)
