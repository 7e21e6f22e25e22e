"""Token ids in ORC files, and reading them back.

Documents are range-partitioned by id before they are encoded, so that the
sampling for the ranges never runs the tokenizer, and each file holds one
ascending range of ids. ORC stores the ids with integer run-length encoding
(and no further compression, which token ids hardly take) in stripes that
tasks read independently; row indexes every ``ROW_INDEX`` rows and
Bloom filters on the id let a reader skip stripes and row groups by metadata.
``uint32`` ids are kept as int, which holds every id below 2^31.

Defined cases: NULL or empty text is its end id alone; NULL ids sort first;
rows of equal id are ordered by their text; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.llm.common import bounded_batches, shared_path, slices, staged
from cairn.llm.tokens import encoder, read_vocabulary

END = 2
ROW_INDEX = 1000
#: Chunks a worker remembers, and characters it encodes together: it does nothing else, so more than by default.
CACHE, CHARS = 500_000, 2_000_000
STRIPE_BYTES = 64 << 20


def write_ids(df: DataFrame, path: str, vocabulary_path: str, key: str = "doc_id", text: str = "text", end: int = END) -> None:
    """Write key, part (the file's place in the order), before (ids of the
    part's earlier documents), n_tokens and ids, ascending by key."""
    bounded_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    last = np.array([end], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode_all, part, before = encoder(sent.value, CACHE, CHARS), TaskContext.get().partitionId(), 0
        for batch in slices(batches, size=CHARS):
            ids = [np.frombuffer(x + last, "<u4").astype(np.int32) for x in encode_all(batch.column("text"))]
            sizes = np.array([len(x) for x in ids], np.int64)
            starts = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([part] * len(ids), pa.int64()), pa.array(starts), pa.array(sizes), lists],
                                             names=[key, "part", "before", "n_tokens", "ids"])

    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    ordered = docs.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", "text")
    (ordered.mapInArrow(encode, f"`{key}` long, part long, before long, n_tokens long, ids array<int>")
     .write.option("orc.compress", "NONE").option("orc.stripe.size", STRIPE_BYTES).option("orc.row.index.stride", ROW_INDEX)
     .option("orc.bloom.filter.columns", key).option("orc.bloom.filter.fpp", 0.01).orc(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The files; a filter on the key prunes stripes and row groups."""
    return spark.read.orc(path)


def with_starts(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """``rows`` (from ``stored``) without their part columns, with start: ids
    of all earlier documents. The sums read two columns of ``stored`` alone."""
    sums = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = staged(sums.select("part", F.coalesce(before, F.lit(0)).alias("base")), "bases")  # a row a file
    return rows.join(parts, "part").withColumn("start", F.col("base") + F.col("before")).drop("part", "before", "base")


def checksums(stored: DataFrame) -> DataFrame:
    """``stored`` with ids replaced by the crc32 of their little-endian 32-bit form."""
    others = [c for c in stored.columns if c != "ids"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat, cuts = ids.values.to_numpy(), ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:b].astype("<u4").tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(crc, pa.int64())], names=[*others, "ids_crc32"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema if f.name != "ids")
    return stored.select(*others, "ids").mapInArrow(sums, f"{kinds}, ids_crc32 long")


def round_trip(df: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """Write all documents and return, from the files: key, start, n_tokens, ids_crc32."""
    spark = df.sparkSession
    path = shared_path(spark, "token-orc")
    write_ids(df, path, vocabulary_path, key, text, end)
    stored = read_ids(spark, path)
    return with_starts(checksums(stored), stored).select(key, "start", "n_tokens", "ids_crc32")
