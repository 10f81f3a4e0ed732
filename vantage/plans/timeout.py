"""Advisory timeout for running a query (the SQL call's ``timeout``).

DataFrames are lazy, so a timeout belongs to the action that runs them. The action's jobs run in
their own job group; once time is up, a watcher cancels that group, and keeps cancelling it until
the action returns, so a job submitted just after the deadline is caught as well. Cancelling
interrupts the running tasks on the executors and frees the cluster; the caller gets
``TimeoutError``. Spark Connect sessions, which have no SparkContext, use operation tags instead.
"""

from __future__ import annotations

import threading
import uuid
from typing import Callable, TypeVar

from pyspark.sql import DataFrame

T = TypeVar("T")

_RECANCEL_SECONDS = 0.5


def _watch(timeout: float, cancel: Callable[[], None], done: threading.Event, fired: threading.Event) -> None:
    if done.wait(timeout):
        return
    fired.set()
    while not done.is_set():
        cancel()
        done.wait(_RECANCEL_SECONDS)


def _run(action: Callable[[DataFrame], T], df: DataFrame, timeout: float, cancel: Callable[[], None],
         description: str) -> T:
    done, fired = threading.Event(), threading.Event()
    watcher = threading.Thread(target=_watch, args=(timeout, cancel, done, fired), daemon=True)
    watcher.start()
    try:
        result = action(df)
    except Exception as exc:
        if fired.is_set():
            raise TimeoutError(f"{description} exceeded {timeout} s and was cancelled") from exc
        raise
    finally:
        done.set()
        watcher.join()
    return result   # finished before a cancellation reached it: the result is complete


def run_with_timeout(df: DataFrame, action: Callable[[DataFrame], T], timeout: float,
                     description: str = "vantage query") -> T:
    """Run ``action(df)`` (e.g. ``DataFrame.collect`` or a write) and cancel its jobs after
    ``timeout`` seconds."""
    if timeout <= 0:
        raise ValueError("timeout must be positive")
    spark = df.sparkSession
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return _run_with_tag(spark, df, action, timeout, description)
    group = f"vantage-{uuid.uuid4().hex}"
    sc.setJobGroup(group, description, interruptOnCancel=True)
    try:
        return _run(action, df, timeout, lambda: sc.cancelJobGroup(group), description)
    finally:
        for prop in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            sc.setLocalProperty(prop, None)


def _run_with_tag(spark, df: DataFrame, action: Callable[[DataFrame], T], timeout: float,
                  description: str) -> T:
    """Spark Connect: tag the operations of this thread and interrupt the tag when time is up."""
    tag = f"vantage-{uuid.uuid4().hex}"
    spark.addTag(tag)
    try:
        return _run(action, df, timeout, lambda: spark.interruptTag(tag), description)
    finally:
        spark.removeTag(tag)
