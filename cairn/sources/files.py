"""Names, marks and sizes of files through the Hadoop FileSystem API, so that
they work on HDFS, object stores and local disks alike."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cairn.session import checkpoint_dir

STORED = "zstd"  # fixed value: how tables and logs that hold whole rows are compressed


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where it is missing."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, made anew."""
    fs, p = _at(spark, path)
    fs.create(p, True).close()


def modified(spark: SparkSession, path: str) -> float:
    fs, p = _at(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path; 0 where it is missing."""
    fs, p = _at(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the cluster's shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` written to a table in the shared folder and read back: computed
    once however often it is used, and a lost executor costs no earlier stage."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", STORED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
