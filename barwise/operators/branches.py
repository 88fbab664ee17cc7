"""C7 — independent branches of a job side by side.

Each branch is a function that starts Spark jobs; a thread per branch submits
them in a scheduler pool of its own (FAIR mode shares the executors), so the
stages of several branches run at once.  A branch that fails ends alone: the
others go on, and the caller gets every branch's outcome before it decides.
"""

from __future__ import annotations

import contextvars
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession


@dataclass
class Outcome:
    """What became of a branch: its result, or the error that ended it, and when it ran."""

    name: str
    result: Any = None
    error: Exception | None = None
    started: float = 0.0
    ended: float = 0.0

    @property
    def ok(self) -> bool:
        return self.error is None


def run_branches(spark: SparkSession, branches: dict[str, Callable[[], Any]], at_once: int = 8) -> dict[str, Outcome]:
    """Run all branches and wait for all of them, whether they succeed or not."""
    def run(name: str, work: Callable[[], Any]) -> Outcome:
        out = Outcome(name, started=time.time())
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            out.result = work()
        except Exception as e:
            out.error = e
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        out.ended = time.time()
        return out

    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(branches)))) as pool:
        waiting = {n: pool.submit(contextvars.copy_context().run, run, n, f) for n, f in branches.items()}
        return {n: w.result() for n, w in waiting.items()}
