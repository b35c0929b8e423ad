"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")


def in_parallel(
    spark: SparkSession, task: Callable[[Item], Result], items: Iterable[Item], at_once: int = 4
) -> list[Result]:
    """Results of ``task`` per item, in order, with ``at_once`` jobs submitted at a time.

    A job's tail of few tasks then leaves the cluster to the next job. Threads see the caller's
    Spark properties and context, such as an open staging scope.
    """
    target = inheritable_thread_target(spark)(task)
    with ThreadPoolExecutor(at_once) as pool:
        waiting = [pool.submit(copy_context().run, target, item) for item in items]
        return [job.result() for job in waiting]
