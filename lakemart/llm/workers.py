"""Memory of the Python workers, and of what Spark hands them, over a run of many steps."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows of a batch between Spark and a worker. Both sides hold whole batches, the writer in a buffer that doubles as it grows.
BATCH_ROWS = 1_000
_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def small_batches(spark: SparkSession) -> None:
    """Hand workers at most BATCH_ROWS rows at once; a smaller setting stays.

    The setting remains, because the frames of a step run after the step has returned. No result depends on it.
    """
    if not 0 < int(spark.conf.get(_ROWS_KEY)) <= BATCH_ROWS:
        spark.conf.set(_ROWS_KEY, str(BATCH_ROWS))


def give_back() -> None:
    """Return what this process has freed to the system: it stays a worker, of other steps too."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim is not None:
        trim(0)


def giving_back(run: Run) -> Run:
    """The same function of a task; its process returns the memory that it has freed when the task ends."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
