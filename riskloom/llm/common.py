"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Words are runs of anything but a space and the control characters tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_array(text: Column) -> Column:
    """Words of a text as an array; no word gives an empty array."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words, counted by pattern so that no array is built."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def without(columns: Iterable[str], taken: Iterable[str]) -> list[str]:
    """Columns whose names (in any letter case) do not clash with ``taken``."""
    low = {c.lower() for c in taken}
    return [c for c in columns if c.lower() not in low]


def give_back() -> None:
    """Return freed memory of the worker process to the machine, where its allocators can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` as a task that leaves no memory behind, since an idle worker keeps what it holds beside the next stage."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def numbered_names(docs: DataFrame, *columns: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with its columns named c0, c1, ..., and the new names of ``columns``.

    Names that an operator adds then meet none of the caller's; ``toDF(*docs.columns)``
    gives the old names back.
    """
    low = [c.lower() for c in docs.columns]
    return docs.toDF(*(f"c{k}" for k in range(len(low)))), [f"c{low.index(c.lower())}" for c in columns]
