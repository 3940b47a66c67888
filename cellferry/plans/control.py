"""Jobs that run side by side: pools, stops and time limits."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession

Result = TypeVar("Result")
POOL = "spark.scheduler.pool"


class JobStopped(RuntimeError):
    """A job was ended by a stop or a time limit."""


class JobControl:
    """Ends Spark jobs by their tag: one tag and one scheduler pool for each job of a run.

    A watcher looks every ``every`` seconds for jobs that are over their limit or were told to stop, and
    cancels what they run, again and again until they are gone, so that a job which starts the
    next step is ended in that one. What a job does on the driver between two Spark jobs is not
    interrupted. Events of the log and moves of the cursor are outside of the tag and not ended.
    """

    def __init__(self, spark: SparkSession, time_limit: float | None = None, every: float = 0.2) -> None:
        self.context, self.time_limit, self.every = spark.sparkContext, time_limit, every
        self._lock = threading.Lock()
        self._running: dict[str, tuple[str, float]] = {}
        self._told: set[str] = set()
        self._why: dict[str, str] = {}
        self._over = threading.Event()
        self._watcher: threading.Thread | None = None

    def __enter__(self) -> JobControl:
        self._over.clear()
        self._watcher = threading.Thread(target=self._watch, daemon=True)
        self._watcher.start()
        return self

    def __exit__(self, *_: object) -> None:
        self._over.set()
        if self._watcher is not None:
            self._watcher.join()

    def stop(self, config_id: str) -> None:
        """End the job of a config if it runs, and refuse those that have not begun."""
        with self._lock:
            self._told.add(config_id)

    def running(self) -> list[str]:
        """Configs whose jobs run now."""
        with self._lock:
            return [config for config, _ in self._running.values()]

    def _watch(self) -> None:
        while not self._over.wait(self.every):
            now = time.monotonic()
            with self._lock:
                for tag, (config, begun) in self._running.items():
                    if config in self._told:
                        self._why.setdefault(tag, "it was told to stop")
                    elif self.time_limit is not None and now - begun > self.time_limit:
                        self._why.setdefault(tag, f"it ran longer than {self.time_limit:g} s")
                ended = [tag for tag in self._why if tag in self._running]
            for tag in ended:
                self.context.cancelJobsWithTag(tag)

    def watched(self, config_id: str, run: Callable[[], Result]) -> Result:
        """Run a job of this thread under a tag and in a pool of its own."""
        tag = f"cellferry-{uuid.uuid4().hex}"
        with self._lock:
            if config_id in self._told:
                raise JobStopped(f"job {config_id} was told to stop before it began")
            self._running[tag] = (config_id, time.monotonic())
        before = self.context.getLocalProperty(POOL)
        self.context.addJobTag(tag)
        self.context.setLocalProperty(POOL, tag)
        try:
            return run()
        except Exception as error:
            with self._lock:
                why = self._why.get(tag)
            if why:
                raise JobStopped(f"job {config_id} was ended: {why}") from error
            raise
        finally:
            with self._lock:
                del self._running[tag]
                self._why.pop(tag, None)
            self.context.removeJobTag(tag)
            self.context.setLocalProperty(POOL, before)
