"""State that tasks of one worker process share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from types import ModuleType
from typing import Any

import pyarrow as pa
from pyspark.sql import SparkSession

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_HOLDER = "vintagemart_worker_state"


def per_worker(name: str, make: Callable[[], Any]) -> Any:
    """The object of this name in this process, made if there is none yet.

    Functions travel to workers by value, so their modules' globals last for one
    task only; what is costly to learn and the same for all tasks is kept here. A
    worker keeps one object: asking for another one lets go of the last.
    """
    holder = sys.modules.setdefault(_HOLDER, ModuleType(_HOLDER))
    if getattr(holder, "name", None) != name:
        holder.name = holder.value = None
        holder.name, holder.value = name, make()
    return holder.value


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """What is run inside hands at most so many rows at once to a worker: whole texts of
    a default batch are held several times over, by the JVM and by the worker."""
    before = spark.conf.get(BATCH_ROWS)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what is worked out per batch stays
    small however many rows the reader hands over at once."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.slice(start, rows)
