"""Independent jobs submitted together, so that small ones fill idle executors."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")


def side_by_side(
    spark: SparkSession, step: Callable[[Item], Result], items: Iterable[Item]
) -> list[Result]:
    """Run ``step`` on every item, each in its own thread; results keep the given order."""
    items = list(items)
    if not items:
        return []
    with ThreadPoolExecutor(max_workers=len(items)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(step), items))
