"""Giving memory back when a task ends. Spark keeps Python workers for later tasks, so what one task's largest moment took would stay theirs."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession


ROWS_AT_ONCE = 512
BATCH_ROWS = 1_000
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Send whole texts to workers at most ``BATCH_ROWS`` at a time. The buffers of a batch are kept for the next one, in the executor and in each
    worker, so the largest batch stays theirs. A smaller number that the session sets is left as it is."""
    if not 0 < int(spark.conf.get(BATCH)) <= BATCH_ROWS:
        spark.conf.set(BATCH, str(BATCH_ROWS))


@contextmanager
def texts_in_small_batches(spark: SparkSession) -> Iterator[None]:
    """``small_batches`` for the steps that run inside, so that narrow rows go in larger ones before and after."""
    before = spark.conf.get(BATCH)
    small_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def few_rows(batches):
    """Slices of batches, so that few rows at a time become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def trim() -> None:
    """Hand free pages of Arrow and of the C library back to the system, where it can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)


def trimmed(build):
    """For functions of ``mapInArrow``: the same rows, and a trim after the last of them."""
    @functools.wraps(build)
    def run(batches):
        try:
            yield from build(batches)
        finally:
            trim()

    return run
