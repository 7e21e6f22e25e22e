"""A change log with full states under it (C11).

The log lies in a folder per day. A snapshot is the state after a day: the last
change of every key that is not a delete. An as-of read starts from the latest
snapshot of an earlier day and replays only the days after it, which partition
pruning selects; without one it replays the log from its start. Snapshots are
made from the one before in the same way.

A change that arrives late, for a day that a snapshot already covers, removes
the snapshots of that day and later before it is appended, so no read can miss
it. One writer per log. Changes without a time are kept and never replayed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import changes as ch
from cairn.sources import files

DAY = "log_day"


@dataclass(frozen=True)
class SnapshotLog:
    root: str
    keys: tuple[str, ...]
    ts_col: str
    op_col: str | None = None
    delete_values: tuple[str, ...] = (ch.DELETE,)
    tiebreak: tuple[str, ...] = ()

    @property
    def log(self) -> str:
        return f"{self.root}/log"

    def snapshot_path(self, day: str) -> str:
        return f"{self.root}/snapshots/{day}"

    def snapshots(self, spark: SparkSession) -> list[str]:
        """Days (yyyy-mm-dd) with a complete snapshot."""
        return [d for d in files.names(spark, f"{self.root}/snapshots") if files.exists(spark, f"{self.snapshot_path(d)}/_SUCCESS")]

    def append(self, changes: DataFrame) -> None:
        """Add changes to the log."""
        spark, day = changes.sparkSession, F.to_date(self.ts_col)
        covered = self.snapshots(spark)
        first = changes.agg(F.min(day)).first()[0] if covered else None
        for done in covered:
            if first is not None and done >= first.isoformat():
                files.delete(spark, self.snapshot_path(done))
        changes.withColumn(DAY, day).repartition(DAY, F.xxhash64(*self.keys) % 8).write.mode("append").partitionBy(DAY).parquet(self.log)

    def _replayed(self, spark: SparkSession, as_of: str, before: bool) -> DataFrame:
        day = as_of[:10]
        base = max((d for d in self.snapshots(spark) if d < day), default=None)
        rows = spark.read.parquet(self.log).filter(F.col(DAY) <= F.lit(day).cast("date"))
        if base is not None:
            rows = rows.filter(F.col(DAY) > F.lit(base).cast("date"))
        rows = rows.drop(DAY)
        if base is not None:
            rows = spark.read.schema(rows.schema).parquet(self.snapshot_path(base)).unionByName(rows)
        return ch.state_as_of(rows, list(self.keys), self.ts_col, as_of, before, self.op_col, self.delete_values, self.tiebreak)

    def state_as_of(self, spark: SparkSession, as_of: str, before: bool = False) -> DataFrame:
        """The table at ``as_of`` ('yyyy-mm-dd hh:mm:ss'), or just before it."""
        return self._replayed(spark, as_of, before)

    def snapshot(self, spark: SparkSession, days: Sequence[str]) -> None:
        """Store the states after these days, each from the one before."""
        for day in sorted(days):
            after = (date.fromisoformat(day) + timedelta(days=1)).isoformat()
            self._replayed(spark, f"{after} 00:00:00", True).write.mode("overwrite").parquet(self.snapshot_path(day))
