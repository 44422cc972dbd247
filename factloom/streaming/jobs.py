"""Named jobs: submit, status, result and kill over Spark job tags. Results are tables on shared storage, never driver memory."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from concurrent.futures import CancelledError, Future, ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


class Jobs:
    """Jobs of one session; each writes the DataFrame of its plan below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, workers: int = 4):
        self._spark, self._folder = spark, folder
        self._pool = ThreadPoolExecutor(workers)
        self._lock = threading.Lock()
        self._jobs: dict[str, Future] = {}
        self._killed: set[str] = set()

    def submit(self, plan: Callable[[SparkSession], DataFrame]) -> str:
        key = uuid.uuid4().hex
        with self._lock:
            self._jobs[key] = self._pool.submit(self._run, key, plan)
        return key

    def _run(self, key: str, plan: Callable[[SparkSession], DataFrame]) -> str:
        path = f"{self._folder}/{key}"
        self._spark.addTag(key)
        try:
            plan(self._spark).write.mode("overwrite").parquet(path)
        finally:
            self._spark.removeTag(key)
        return path

    def status(self, key: str) -> str:
        """unknown, killed, running, failed or done."""
        job = self._jobs.get(key)
        if job is None:
            return "unknown"
        if key in self._killed:
            return "killed"
        if not job.done():
            return "running"
        return "failed" if job.exception() else "done"

    def result(self, key: str, timeout: float | None = None) -> DataFrame:
        if key in self._killed:
            raise CancelledError(key)
        return self._spark.read.parquet(self._jobs[key].result(timeout))

    def kill(self, key: str) -> None:
        """Stop a job that has not ended; later calls of status say killed."""
        job = self._jobs[key]
        if job.done():
            return
        self._killed.add(key)
        if not job.cancel():
            self._spark.interruptTag(key)
