"""Helpers for the operators that work on Arrow batches inside Spark's tasks."""

import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The code points that separate words: space and U+0009 to U+000D. bytes.split() without
# an argument splits on exactly these.
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library to the executors, once an application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent.parent
        folder = tempfile.mkdtemp(prefix="library-")
        context.addPyFile(shutil.make_archive(f"{folder}/{root.name}", "zip", root.parent, root.name))
        _shipped.add(context.applicationId)


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow, with this library sent to the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(work, schema)


def texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null becomes empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def small_batches(batches: Iterable[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` text bytes (one row at least).

    A batch of Spark's holds 10,000 rows whatever their length; this bounds the memory
    that a task needs besides the batch.
    """
    for batch in batches:
        lengths = np.asarray(pa.compute.binary_length(batch.column(column)).fill_null(0))
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_key(id_column: str, text_column: str):
    """A 64-bit digest of a row's id and text, which tells apart rows that share an id."""
    return F.xxhash64(F.col(id_column), F.col(text_column))
