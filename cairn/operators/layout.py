"""Data-layout audits and rewrites.

A "partition" is a storage unit (a file, or any grouping column). Each is the
closed interval [min, max] of the audited column. For a stored table the
intervals come from the files' footers (``stored_intervals``): the files are
listed by Spark, footers are read in its tasks, and rows only where a footer
does not tell.

* overlaps(p) = partitions other than p whose interval meets p's;
* depth(p)    = the largest number of partitions (p included) covering one
                point of p.

Endpoints are aggregated to their distinct values. Sums of the minima and
maxima at smaller values (``ordered.with_sums_before``) give, at any value v,
coverage(v) = #mins up to v - #maxes before v, and then

* overlaps(p) = (#mins <= p.max) - 1 - (#maxes < p.min);
* depth(p) = the maximum coverage over the endpoints inside p: the maximum to
  the end of p.min's bucket, of the whole buckets between (a bounded array),
  and from the start of p.max's bucket.

No pair of partitions is ever formed, so a badly clustered table (every
partition overlapping every other) costs no more than a good one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cairn.operators.ordered import with_sums_before
from cairn.sources import files

#: Types whose footer statistics are exact and order values as Spark does
#: (strings may be cut there, and NaN is left out).
IN_FOOTER = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampNTZType)


def partition_intervals(df: DataFrame, part: str, column: str) -> DataFrame:
    """(part, lo, hi) per partition; map-side partial min / max."""
    return (df.groupBy(part).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
              .filter(F.col("lo").isNotNull()))


def _footer(file: str, column: str) -> tuple[int | None, bool, object, object]:
    """(rows, known, least, greatest) from one file's footer. Not known: a file
    system that Arrow has no reader for, or a row group without statistics."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    try:
        system, path = fs.FileSystem.from_uri(file)
    except pa.ArrowInvalid:
        return None, False, None, None
    with system.open_input_file(path) as stream:
        meta = pq.read_metadata(stream)
    at = next((i for i in range(meta.num_columns) if meta.schema.column(i).path == column), None)
    bounds = []
    for group in range(meta.num_row_groups if at is not None else 0):
        found = meta.row_group(group).column(at).statistics
        if found is not None and found.has_min_max:
            bounds += [found.min, found.max]
        elif found is None or not found.has_null_count or found.null_count < meta.row_group(group).num_rows:
            return meta.num_rows, False, None, None
    return meta.num_rows, True, min(bounds, default=None), max(bounds, default=None)


def footer_bounds(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(file, rows, known, lo, hi) for every file of a Parquet table, from the
    footers alone. ``known`` is false where a footer cannot tell the bounds;
    a file without a value (empty, all NULL, or written before the column was
    added) is known and has none."""
    kind = spark.read.parquet(path).schema[column].dataType
    arrow, usable = to_arrow_type(kind), isinstance(kind, IN_FOOTER)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, known, lo, hi = zip(*(_footer(f, column) for f in batch.column("file").to_pylist()), strict=True)
            if not usable:
                known, lo, hi = ([x] * len(rows) for x in (False, None, None))
            yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(rows, pa.int64()), pa.array(known, pa.bool_()),
                                              pa.array(lo, arrow), pa.array(hi, arrow)], names=["file", "rows", "known", "lo", "hi"])

    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
              .load(path).select(F.col("_metadata.file_path").alias("file")))
    bounds = T.StructType().add("file", "string").add("rows", "long").add("known", "boolean").add("lo", kind).add("hi", kind)
    return listed.mapInArrow(read, bounds)


def file_intervals(df: DataFrame, column: str) -> DataFrame:
    """Intervals per data file of a parquet table (``_metadata.file_path``),
    from its rows."""
    with_file = df.select(F.col("_metadata.file_path").alias("file"), column)
    return partition_intervals(with_file, "file", column)


def stored_intervals(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(part, lo, hi) per file of a stored table that holds a value of
    ``column``: from its footer, from its rows where the footer cannot tell."""
    found = files.staged(footer_bounds(spark, path, column), "footers")
    told = found.filter("known AND lo IS NOT NULL").select("file", "lo", "hi")
    table = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("of"), column)
    rest = table.join(found.filter("NOT known"), F.col("of") == F.col("file"), "left_semi")
    return told.union(partition_intervals(rest, "of", column)).withColumnRenamed("file", "part")


def partition_stats(intervals: DataFrame) -> DataFrame:
    """(part, overlaps, depth) for every partition of ``intervals``; a NULL
    partition key is a partition like any other."""
    one, none = F.lit(1).alias, F.lit(0).alias
    ends = (intervals.select(F.col("lo").alias("v"), one("mins"), none("maxes"))
            .union(intervals.select(F.col("hi").alias("v"), none("mins"), one("maxes")))
            .groupBy("v").agg(F.sum("mins").alias("mins"), F.sum("maxes").alias("maxes")))
    swept = with_sums_before(ends, "v", ["mins", "maxes"])
    cover = (F.col("before_mins") + F.col("mins") - F.col("before_maxes")).alias("cover")
    swept = swept.select("v", "_bucket", cover, (F.col("before_mins") + F.col("mins")).alias("min_upto"), F.col("before_maxes").alias("max_before"))
    swept = files.staged(swept, "endpoints")
    here = Window.partitionBy("_bucket").orderBy("v")
    edges = swept.withColumns({"to_end": F.max("cover").over(here.rowsBetween(0, Window.unboundedFollowing)),
                               "from_start": F.max("cover").over(here.rowsBetween(Window.unboundedPreceding, 0))})
    tops = swept.groupBy("_bucket").agg(F.max("cover").alias("top")).agg(F.collect_list(F.struct("_bucket", "top"))).scalar()
    first = edges.select(F.col("v").alias("lo"), F.col("_bucket").alias("b1"), "max_before", "to_end")
    last = edges.select(F.col("v").alias("hi"), F.col("_bucket").alias("b2"), "min_upto", "from_start")
    spans = intervals.join(first, "lo").join(last, "hi").withColumn("tops", tops)
    inner = spans.filter("b1 = b2").select("lo", "hi", "b1").distinct()
    inside = (inner.join(swept, (F.col("b1") == F.col("_bucket")) & F.col("v").between(F.col("lo"), F.col("hi")))
              .groupBy(F.col("lo").alias("in_lo"), F.col("hi").alias("in_hi")).agg(F.max("cover").alias("inside")))
    between = F.array_max(F.transform(F.filter("tops", lambda t: (t["_bucket"] > F.col("b1")) & (t["_bucket"] < F.col("b2"))), lambda t: t["top"]))
    depth = F.coalesce("inside", F.greatest("to_end", "from_start", between))
    return (spans.join(inside, (F.col("lo") == F.col("in_lo")) & (F.col("hi") == F.col("in_hi")), "left")
            .select("part", (F.col("min_upto") - 1 - F.col("max_before")).cast("bigint").alias("overlaps"), depth.cast("bigint").alias("depth")))


def information(intervals: DataFrame) -> DataFrame:
    """L1: one row: total_partition_count, average_overlaps, average_depth."""
    return partition_stats(intervals).agg(F.count(F.lit(1)).alias("total_partition_count"),
                                          F.round(F.avg("overlaps"), 6).alias("average_overlaps"),
                                          F.round(F.avg("depth"), 6).alias("average_depth"))


def histogram(intervals: DataFrame) -> DataFrame:
    """L1: partition count per depth."""
    return partition_stats(intervals).groupBy("depth").agg(F.count(F.lit(1)).alias("partitions"))


def clustering_information(df: DataFrame, part: str, column: str) -> DataFrame:
    """L1 over the partitions that ``part`` names."""
    return information(partition_intervals(df, part, column).withColumnRenamed(part, "part"))


def depth_histogram(df: DataFrame, part: str, column: str) -> DataFrame:
    """L1: partition count per depth, over the partitions that ``part`` names."""
    return histogram(partition_intervals(df, part, column).withColumnRenamed(part, "part"))


def clustering_depth(df: DataFrame, part: str, column: str) -> DataFrame:
    """L2: average depth only."""
    return clustering_information(df, part, column).select("average_depth")


def write_clustered(df: DataFrame, path: str, column: str, n_files: int | None = None,
                    mode: str = "errorifexists") -> None:
    """L3: rewrite a table range-partitioned and sorted by ``column`` so file
    ranges stop overlapping (depth ~ 1; only equal boundary values shared)."""
    n = n_files or df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    (df.repartitionByRange(int(n), column).sortWithinPartitions(column)
       .write.mode(mode).parquet(path))


def write_with_bloom(df: DataFrame, path: str, column: str, expected_items: int = 1_000_000,
                     mode: str = "errorifexists") -> None:
    """An equality-lookup access path for a scattered key: parquet Bloom
    filters on ``column``, used by the reader to skip row groups on
    ``column = value``."""
    (df.write.mode(mode)
       .option(f"parquet.bloom.filter.enabled#{column}", "true")
       .option(f"parquet.bloom.filter.expected.ndv#{column}", str(expected_items))
       .parquet(path))
