"""Smaller exchanges with Python workers, for steps whose rows hold whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

BATCH_BYTES = 8 * 1024 * 1024
SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def use_small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """From now on jobs of the session hand Python workers batches of at most so many bytes, or one row.

    A batch is held by the executor and by the worker, on the way in and back, so its size counts several times
    in an executor's memory. For plans that run later, when the caller writes them.
    """
    spark.conf.set(SETTING, _least(spark.conf.get(SETTING), most))


def _least(before: str, most: int) -> str:
    number = before.rstrip("bB")
    return str(min(most, int(number)) if number.isdigit() and int(number) > 0 else most)


@contextmanager
def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> Iterator[None]:
    """The same only for jobs run inside."""
    before = spark.conf.get(SETTING)
    use_small_batches(spark, most)
    try:
        yield
    finally:
        spark.conf.set(SETTING, before)
