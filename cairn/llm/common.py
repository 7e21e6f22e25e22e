"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.session import checkpoint_dir

#: A word is a run of anything but ASCII white space (space, \t, \n, \v, \f,
#: \r). ``bytes.split()`` cuts UTF-8 text at the same places.
WORD_GAP = "[\\x20\\x09-\\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the cluster's shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to a Parquet table in the shared folder and read it back:
    lineage ends there, a lost executor costs no earlier stage, and joins see
    a plain scan, so that AQE may split their skewed partitions."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Rows go to Python in Arrow batches of at most ``size`` bytes from now on
    in this session. With Spark's default (64 MB) a task that sends whole texts
    holds several such buffers outside the heap, and again in Python."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def ddl(df: DataFrame) -> str:
    """The columns of ``df`` as a schema string."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def words(text: Column) -> Column:
    """The words of a text; none for NULL or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose ``column`` holds about ``size`` bytes (or one
    row), to bound what a task holds as Python objects."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(batch):
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(at, stop - at)
            at = stop
