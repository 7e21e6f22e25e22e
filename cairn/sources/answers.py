"""Answers of a text function, kept so that no text is sent to it twice.

Texts are known by a 128-bit digest. Every run adds one folder with the answers
it had to ask for: the texts that no earlier folder answers. A run that is lost
leaves a folder without a success mark, which is not read and is replaced by
the next run; a run that is repeated finds its texts answered. One writer per
cache. The cache grows with the distinct texts, so it is joined, never
collected or broadcast by hint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.sources import files

RUN = "run"
PART_ROWS, PART_BYTES = 1000, 1 << 20  # fixed values: what one call of a text function gets at most (or one text)


def digest(text: Column) -> Column:
    """128 bits that stand for a text; NULL for NULL."""
    return F.unhex(F.md5(text.cast("binary")))


def parts(batch: pa.RecordBatch, rows: int = PART_ROWS, size: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch (digest, text) in slices of some rows and bytes of text, each of
    one row at least: a batch is cut by its rows alone, and texts have any length."""
    first = held = 0
    for i, n in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
        if i > first and (i - first == rows or held + (n or 0) > size):
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += n or 0
    if batch.num_rows > first:
        yield batch.slice(first)


def answered(texts: DataFrame, fn: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """(digest, answer) of texts (digest, text; one row each). ``fn`` gets and
    returns a slice at a time, so that a task holds one Arrow batch of texts
    and no copies of it, however long the texts are."""

    def ask(batches):
        for batch in batches:
            for part in parts(batch):
                answer = pa.Array.from_pandas(fn(part.column(1).to_pandas()), type=pa.string())
                if len(answer) != part.num_rows:
                    raise ValueError("text function returned a different number of rows")
                yield pa.RecordBatch.from_arrays([part.column(0), answer], names=["digest", "answer"])

    return texts.select("digest", "text").mapInArrow(ask, "digest binary, answer string")


@dataclass(frozen=True)
class AnswerCache:
    root: str

    def folder(self, run: int) -> str:
        return f"{self.root}/{RUN}={run}"

    def runs(self, spark: SparkSession) -> list[int]:
        found = (int(n.split("=")[1]) for n in files.names(spark, self.root) if n.startswith(f"{RUN}="))
        return sorted(r for r in found if files.exists(spark, f"{self.folder(r)}/_SUCCESS"))

    def read(self, spark: SparkSession) -> DataFrame:
        """(digest, answer, run) of every text answered so far."""
        paths = [self.folder(r) for r in self.runs(spark)]
        kinds = f"digest binary, answer string, {RUN} int"
        return spark.read.schema(kinds).option("basePath", self.root).parquet(*paths) if paths else spark.createDataFrame([], kinds)

    def learn(self, texts: DataFrame, fn: Callable[[pd.Series], pd.Series]) -> DataFrame:
        """Ask ``fn`` for the texts (digest, text; one row each) that have no
        answer yet, and return all answers."""
        spark = texts.sparkSession
        new = texts.join(self.read(spark).select("digest"), "digest", "left_anti")
        run = max(self.runs(spark), default=0) + 1
        answered(new, fn).write.mode("overwrite").parquet(self.folder(run))
        return self.read(spark)
