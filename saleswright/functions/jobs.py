"""Running independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: Jobs that run at the same time.
CONCURRENT_JOBS = 4


def side_by_side(spark: SparkSession, work: Callable, items: Iterable) -> list:
    """``work`` on every item, a few at a time, results in order.

    The tail of one job's last stage leaves executors free for the next one.
    """
    with ThreadPoolExecutor(max_workers=CONCURRENT_JOBS) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))
