"""Batch loads that know what they loaded.

The ledger is a table with a row per file and load: path, size, modification
time, rows parsed, loaded and rejected, status. A load lists the files, takes
out those that the ledger has with the same size and time, and reads the rest:
a file that was changed since is loaded again, all others are not opened.

The rows are parsed once. They are written in a folder of the load, split by
whether they parsed, and the report is counted from what was written, so
nothing is cached and no file is read a second time. The ledger rows are
appended last: a load that is lost before leaves none, and its folder, named by
the files it was to load, is written again by the next one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.sources import files
from cairn.sources.readers import CORRUPT, list_files

LEDGER = ("path string, size bigint, last_modified timestamp, rows_parsed bigint, rows_loaded bigint, errors_seen bigint, "
          "status string, load_id string, loaded_at timestamp")


def statuses(df: DataFrame) -> DataFrame:
    """Append the status of a file with rows_parsed, rows_loaded and errors_seen."""
    return df.withColumn("status", F.when(F.col("errors_seen") == 0, "LOADED").when(F.col("rows_loaded") > 0, "PARTIALLY_LOADED").otherwise("LOAD_FAILED"))


def parsed(spark: SparkSession, paths: list[str] | str, schema: T.StructType, fmt: str = "csv", **options) -> DataFrame:
    """The rows of files with their path and, where malformed, the raw record."""
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if fmt == "csv":
        reader = reader.option("header", True).option("quote", '"').option("escape", '"')
    return reader.options(**options).format(fmt).load(paths).select("*", F.col("_metadata.file_path").alias("_path"))


@dataclass(frozen=True)
class LoadedTable:
    """A table that is filled from files below ``source``, and its ledger."""
    root: str
    source: str
    schema: T.StructType
    fmt: str = "csv"

    def ledger(self, spark: SparkSession) -> DataFrame:
        path = f"{self.root}/ledger"
        return spark.read.schema(LEDGER).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], LEDGER)

    def current(self, spark: SparkSession) -> DataFrame:
        """The last load of every file."""
        rows = self.ledger(spark)
        latest = F.max_by(F.struct(*[c for c in rows.columns if c != "path"]), F.struct("loaded_at", "load_id"))
        return rows.groupBy("path").agg(latest.alias("last")).select("path", "last.*")

    def pending(self, spark: SparkSession, pattern: str | None = None) -> DataFrame:
        """Files that are new, or changed since their last load."""
        seen = self.current(spark).select("path", "size", "last_modified")
        return list_files(spark, self.source, pattern).join(seen, ["path", "size", "last_modified"], "left_anti")

    def load(self, spark: SparkSession, pattern: str | None = None, abort: bool = False) -> DataFrame:
        """Load what is pending; the report of this load, a row per file.
        ``abort`` (S6) raises at the first malformed record and loads nothing."""
        new = files.staged(self.pending(spark, pattern), "pending")
        paths = sorted(r["path"] for r in new.select("path").collect())  # file names, as many as Spark lists for a scan
        if not paths:
            return spark.createDataFrame([], LEDGER)
        marks = new.select(F.concat_ws("|", "path", "size", F.col("last_modified").cast("string")).alias("m")).agg(F.sort_array(F.collect_list("m"))).first()[0]
        load_id = hashlib.sha256("\n".join(marks).encode()).hexdigest()[:24]
        folder = f"{self.root}/rows/load={load_id}"
        rows = parsed(spark, paths, self.schema, self.fmt, **({"mode": "FAILFAST"} if abort else {}))
        kept = rows.withColumn("parsed", F.when(F.col(CORRUPT).isNull(), 1).otherwise(0))
        kept.write.mode("overwrite").partitionBy("parsed").parquet(folder)
        written = spark.read.schema(kept.schema).parquet(folder).groupBy(F.col("_path").alias("path")).agg(
            F.count(F.lit(1)).alias("rows_parsed"), F.count(F.when(F.col("parsed") == 1, 1)).alias("rows_loaded"),
            F.count(F.when(F.col("parsed") == 0, 1)).alias("errors_seen"))
        # a listed path may be written otherwise than the scan's: compare what follows the scheme
        plain = lambda c: F.regexp_replace(F.url_decode(F.col(c)), "^[a-z0-9]+:/*", "/")
        counted = new.withColumn("_p", plain("path")).join(written.select(plain("path").alias("_p"), "rows_parsed", "rows_loaded", "errors_seen"), "_p", "left")
        counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("rows_parsed", "rows_loaded", "errors_seen")]  # a file may be empty
        report = statuses(counted.select("path", "size", "last_modified", *counts))
        report = report.withColumn("load_id", F.lit(load_id)).withColumn("loaded_at", F.current_timestamp())
        report.write.mode("append").parquet(f"{self.root}/ledger")
        return self.ledger(spark).filter(F.col("load_id") == load_id)

    def read(self, spark: SparkSession, rejected: bool = False) -> DataFrame:
        """The rows of every file's last load: those that parsed, or the
        malformed ones with their raw record."""
        last = self.current(spark).select(F.regexp_replace(F.url_decode("path"), "^[a-z0-9]+:/*", "/").alias("_p"), F.col("load_id").alias("_load"))
        rows = spark.read.parquet(f"{self.root}/rows").filter(F.col("parsed") == (0 if rejected else 1))
        rows = rows.withColumn("_p", F.regexp_replace(F.url_decode("_path"), "^[a-z0-9]+:/*", "/")).join(last.withColumnRenamed("_load", "load"), ["_p", "load"], "left_semi")
        return rows.select(*self.schema.fieldNames(), *([CORRUPT] if rejected else []), F.col("_path").alias("source_file"))
