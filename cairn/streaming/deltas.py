"""A COUNT / SUM aggregate kept as a base and deltas.

A batch of changes adds one small folder, its signed sums per key: it writes as
much as it changes, whatever the size of the state. Readers sum base and
deltas; when the deltas outgrow a share of the base, they are folded into a
new base, which replaces the old one as a whole. The base's batch id says which
deltas it holds, so a reader or a replay never counts one twice: a replayed
batch writes its own folder again, or is already in the base.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cairn.operators import changes as ch
from cairn.sources import files, writers

BATCH = "batch"


@dataclass(frozen=True)
class DeltaAggregate:
    root: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    count_col: str = "row_count"

    @property
    def base(self) -> str:
        return f"{self.root}/base"

    @property
    def deltas(self) -> str:
        return f"{self.root}/deltas"

    def start(self, rows: DataFrame, batch_id: int = 0) -> None:
        """The base, from the rows of the table itself."""
        writers.write_version(ch.aggregate_state(rows, self.keys, self.measures, self.count_col), self.base, batch_id=batch_id)
        self.mark(rows.sparkSession, batch_id)

    def folded(self, spark: SparkSession) -> int:
        """The last batch that the base holds (-1: none)."""
        done = writers.current_batch_id(spark, self.base)
        return -1 if done is None else done

    def batches(self, spark: SparkSession) -> list[int]:
        """Complete deltas that the base does not hold."""
        found = (int(n.split("=")[1]) for n in files.names(spark, self.deltas) if n.startswith(f"{BATCH}="))
        base = self.folded(spark)
        return sorted(b for b in found if b > base and files.exists(spark, f"{self.deltas}/{BATCH}={b}/_SUCCESS"))

    def applied(self, spark: SparkSession) -> int | None:
        """The last batch id that was marked."""
        return max((int(n) for n in files.names(spark, f"{self.root}/applied")), default=None)

    def mark(self, spark: SparkSession, batch_id: int) -> None:
        files.touch(spark, f"{self.root}/applied/{batch_id}")

    def refreshed_at(self, spark: SparkSession) -> float | None:
        last = self.applied(spark)
        return None if last is None else files.modified(spark, f"{self.root}/applied/{last}")

    def add(self, feed: DataFrame, batch_id: int) -> bool:
        """The signed sums of a feed as one delta; False where the base holds it."""
        spark = feed.sparkSession
        if batch_id <= self.folded(spark):
            return False
        delta = ch.signed_sums(feed, self.keys, self.measures, self.count_col)
        delta.write.mode("overwrite").parquet(f"{self.deltas}/{BATCH}={batch_id}")
        self.mark(spark, batch_id)
        return True

    def delta_rows(self, spark: SparkSession, batch_id: int) -> int:
        path = f"{self.deltas}/{BATCH}={batch_id}"
        return spark.read.parquet(path).count() if files.exists(spark, path) else 0

    def read(self, spark: SparkSession) -> DataFrame:
        """The aggregate now: base and open deltas, summed per key."""
        state = writers.read_current(spark, self.base)
        paths = [f"{self.deltas}/{BATCH}={b}" for b in self.batches(spark)]
        if not paths:
            return state
        return ch.fold(state, spark.read.parquet(*paths), self.keys, self.measures, self.count_col)

    def compact(self, spark: SparkSession, share: float = 0.5) -> bool:
        """Fold the deltas into a new base once they exceed a share of it."""
        open_batches = self.batches(spark)
        size = sum(files.size(spark, f"{self.deltas}/{BATCH}={b}") for b in open_batches)
        if not open_batches or size <= share * files.size(spark, writers.current_version(spark, self.base)):
            return False
        held = self.folded(spark)
        writers.write_version(self.read(spark), self.base, batch_id=open_batches[-1])
        writers.vacuum(spark, self.base, keep=2)
        for name in files.names(spark, self.deltas):  # those of the base before this one: no reader needs them now
            if name.startswith(f"{BATCH}=") and int(name.split("=")[1]) <= held:
                files.delete(spark, f"{self.deltas}/{name}")
        return True

    def maintain(self, share: float = 0.5):
        """C8 body for ``incremental.consume``: add each batch, compact when due."""

        def fn(batch: DataFrame, batch_id: int) -> None:
            self.add(batch, batch_id + 1)  # the base holds batch 0
            self.compact(batch.sparkSession, share)

        return fn
