"""Independent writes of one stage as concurrent Spark jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(spark: SparkSession, writes: Iterable[Callable[[], None]]) -> None:
    """Run all writes and wait for them, so that small tables use the cores a large one leaves.

    The first error is raised after every write has ended.
    """
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor() as pool:
        running = [pool.submit(inherit(write)) for write in writes]
    for write in running:
        write.result()
