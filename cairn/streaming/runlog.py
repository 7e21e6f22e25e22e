"""Run history (C10): one row per refresh / task run, appended to a log
folder (plain appends of new files; the log is never rewritten)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("state", T.StringType()),          # SUCCEEDED, FAILED, SKIPPED
    T.StructField("action", T.StringType()),         # INCREMENTAL, FULL, NO_DATA
    T.StructField("rows", T.LongType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("data_timestamp", T.TimestampNTZType()),
    T.StructField("message", T.StringType()),
])


def log_run(spark: SparkSession, path: str, name: str, state: str, action: str,
            rows: int | None = None, batch_id: int | None = None, message: str | None = None) -> None:
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = [(name, state, action, rows, batch_id, now, (message or "")[:200])]
    spark.createDataFrame(row, RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path)
