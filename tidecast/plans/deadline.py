"""Ending Spark work that runs past its time."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


class OutOfTime(Exception):
    """Raised where work was ended because its deadline had passed."""


class Deadline:
    """A point in time after which jobs begun within ``enforced`` are cancelled.

    Jobs carry a tag of their own, so nothing else in the session is touched. The watcher goes on
    cancelling until the block ends, since a fit begins one job after another. Only Spark's work can
    be ended; Python code between jobs runs on to its next one.
    """

    TICK = 0.2

    def __init__(self, spark: SparkSession, seconds: float | None, started: float | None = None):
        self.context = spark.sparkContext
        self.at = None if seconds is None else (time.monotonic() if started is None else started) + seconds

    @property
    def passed(self) -> bool:
        return self.at is not None and time.monotonic() > self.at

    @contextmanager
    def enforced(self) -> Iterator[None]:
        if self.at is None:
            yield
            return
        if self.passed:
            raise OutOfTime
        tag, ended, cancelled = f"tidecast-{uuid.uuid4().hex}", threading.Event(), threading.Event()

        def watch() -> None:
            if ended.wait(max(0.0, self.at - time.monotonic())):
                return
            while not ended.wait(self.TICK):
                cancelled.set()
                self.context.cancelJobsWithTag(tag)

        watcher = threading.Thread(target=watch, daemon=True)
        self.context.addJobTag(tag)
        watcher.start()
        try:
            yield
        except Exception as error:
            if cancelled.is_set():
                raise OutOfTime from error
            raise
        finally:
            ended.set()
            watcher.join()
            self.context.removeJobTag(tag)
