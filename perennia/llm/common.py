"""Helpers that several operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import SparkSession

from perennia.session import ship_package

#: Bytes of a batch that goes to a Python worker: long texts make large rows, and a worker holds several copies.
BATCH_BYTES = "4m"


def prepare(spark: SparkSession) -> None:
    """What the operators need of a session: the package on the workers, and small batches."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def temporary(name: str) -> str:
    """A column name that no input has, for a column that does not leave the operator."""
    return f"_{name}_{uuid.uuid4().hex[:12]}"


def batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def give_back() -> None:
    """What was freed goes back to the machine, of which an executor has a share only."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


_KEPT: dict[str, Callable[[], None]] = {}


def begin(operator: str, forget: Callable[[], None] | None = None) -> None:
    """Called in a worker where an operator's code starts; ``forget`` empties what it keeps from task to task.

    Workers are used again by later operators, beside which nothing of an earlier one is kept.
    """
    others = [name for name in _KEPT if name != operator]
    for other in others:
        _KEPT.pop(other)()
    if others:
        give_back()
    if forget:
        _KEPT[operator] = forget
