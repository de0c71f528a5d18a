"""Intermediate tables in the shared folder."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tickloom.session import stored

#: Shuffle files go with the query that made them; Arrow batches are bounded by bytes as well as by rows.
_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def staged(df: DataFrame, label: str, more: Iterable[DataFrame] = ()) -> DataFrame:
    """``df``, and the rows of ``more``, written once as a table of the shared folder.

    The table outlives executors, so the shuffle files that led to it are freed
    as soon as it is written; those of a part before the next one is asked for.
    """
    conf = df.sparkSession.conf
    before = {key: conf.get(key, None) for key in _SETTINGS}
    for key, value in _SETTINGS.items():
        conf.set(key, value)
    try:
        return stored(df, f"llm-{label}", more=more)
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def staged_parts(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """All parts as one table."""
    rest = iter(parts)
    return staged(next(rest), label, rest)


def release() -> None:
    """Give memory that is free in this process back to the machine: a Python worker outlives its tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that leaves no memory behind in its worker."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def to_arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema, prefers_large_types=False)
