"""A few Spark jobs side by side."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

AT_ONCE = 4  # jobs that share the cluster; each has its own stages, so idle cores of one serve another


def side_by_side(spark: SparkSession, tasks: Sequence[Callable], at_once: int = AT_ONCE) -> list:
    """Results of ``tasks`` (functions that run Spark jobs), in order.

    If one fails, those that have not begun never begin, the jobs of the others are cancelled, and its error is raised.
    """
    group = f"panelwise-{uuid.uuid4().hex}"
    context = spark.sparkContext

    def run(task: Callable):
        context.setJobGroup(group, "side by side", interruptOnCancel=False)
        return task()

    with ThreadPoolExecutor(max(1, min(at_once, len(tasks)))) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(run), t) for t in tasks]
        done, waiting = wait(futures, return_when=FIRST_EXCEPTION)
        failed = next((f for f in futures if f in done and f.exception()), None)
        if failed:
            for f in waiting:
                f.cancel()
            context.cancelJobGroup(group)
            raise failed.exception()
    return [f.result() for f in futures]
