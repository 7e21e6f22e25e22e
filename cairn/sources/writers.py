"""Sinks and table writes.

Parquet tables have no in-place MERGE / UPDATE / DELETE, and overwriting a
path a plan is still reading destroys its input. Tables that are rewritten
are therefore *versioned*: each write goes to a new ``v=<stamp>`` folder
under the table root, the Hadoop output committer marks it complete with
``_SUCCESS``, and readers take the newest complete version. A reader never
sees a half-written version, a failed job leaves the previous version
current, and a job may read the current version while writing the next.
Single writer per table; old versions are removed by ``vacuum``.

All paths go through the Hadoop FileSystem API, so they work on HDFS,
object stores and local disks alike.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

VERSION_PREFIX = "v="


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, root: str) -> list[str]:
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    jvm = spark.sparkContext._jvm
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(VERSION_PREFIX):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(name)
    return sorted(out)


def current_version(spark: SparkSession, root: str) -> str | None:
    v = _versions(spark, root)
    return f"{root.rstrip('/')}/{v[-1]}" if v else None


def current_batch_id(spark: SparkSession, root: str) -> int | None:
    """The micro-batch id recorded with the current version, if any."""
    v = _versions(spark, root)
    if not v or "-b" not in v[-1]:
        return None
    return int(v[-1].rsplit("-b", 1)[1])


def exists(spark: SparkSession, root: str) -> bool:
    return current_version(spark, root) is not None


def read_current(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    path = current_version(spark, root)
    if path is None:
        raise FileNotFoundError(f"no committed version under {root}")
    return spark.read.format(fmt).load(path)


def write_version(df: DataFrame, root: str, fmt: str = "parquet",
                  options: dict | None = None, sort_within: list[str] | None = None,
                  batch_id: int | None = None) -> str:
    """K3 (overwrite all rows, keep table): write ``df`` as the next version.
    Safe when ``df`` reads the current version of the same table.
    ``batch_id`` is recorded in the version name, so a streaming writer can
    tell whether a replayed micro-batch was already applied."""
    tag = f"-b{batch_id:012d}" if batch_id is not None else ""
    stamp = f"{VERSION_PREFIX}{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}{tag}"
    path = f"{root.rstrip('/')}/{stamp}"
    w = df.sortWithinPartitions(*sort_within) if sort_within else df
    writer = w.write.mode("errorifexists").format(fmt)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save(path)
    return path


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove all but the newest ``keep`` committed versions. A reader that
    is still on an older one fails: keep as many as the longest read lasts."""
    fs, _ = _fs(spark, root)
    jvm = spark.sparkContext._jvm
    old = _versions(spark, root)[:-keep] if keep else _versions(spark, root)
    for name in old:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}"), True)
    return len(old)


# --------------------------------------------------------------- plain sinks


def create_table_as(df: DataFrame, root: str, fmt: str = "parquet") -> str:
    """K1: create or replace a table from a query."""
    return write_version(df, root, fmt)


def overwrite(df: DataFrame, root: str, fmt: str = "parquet") -> str:
    """K3: replace all rows, keep the table (same mechanics as K1)."""
    return write_version(df, root, fmt)


def append(df: DataFrame, root: str, fmt: str = "parquet") -> str:
    """K2: append rows: new files are added to the current version, whose
    files stay as they are (a reader that listed them before is unaffected).
    Nothing stored is read or written again."""
    spark = df.sparkSession
    path = current_version(spark, root)
    if path is None:
        return write_version(df, root, fmt)
    append_files(df.select(*spark.read.format(fmt).load(path).columns), path, fmt)
    return path


def append_files(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K2 for append-only folders (change logs, audit rows, streaming sinks):
    Spark's ``append`` mode adds new files next to the old ones."""
    df.write.mode("append").format(fmt).save(path)


def refresh_materialized(df: DataFrame, root: str) -> str:
    """Recompute the stored aggregate and publish it as a new version."""
    path = write_version(df, root)
    vacuum(df.sparkSession, root, keep=2)
    return path


def unload_csv(df: DataFrame, path: str, header: bool = True, compression: str = "gzip") -> int:
    """K4: unload a query to compressed CSV with a header, overwriting the
    target; returns the number of rows unloaded (counted by an observation
    during the write, no second pass)."""
    obs = Observation("unload")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows_unloaded"))
    (observed.write.mode("overwrite").option("header", header)
             .option("compression", compression).csv(path))
    return int(obs.get["rows_unloaded"])


def empty_like(df: DataFrame) -> DataFrame:
    """K8: an empty table with the schema of another."""
    return df.sparkSession.createDataFrame([], df.schema)


def with_default(df: DataFrame, column: str, value: Column) -> DataFrame:
    """K9: fill a column with its default (e.g. the load time) when the
    source does not carry it."""
    if column in df.columns:
        return df.withColumn(column, F.coalesce(F.col(column), value))
    return df.withColumn(column, value)
