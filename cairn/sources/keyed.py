"""Keyed tables in bucket folders: a change rewrites only what it touches (T9,
K6, K7).

Rows lie in folders by a hash of their key. A change list is joined with the
folders of its own keys only (a partition filter, so the others are not even
listed for reading), and Spark's dynamic partition overwrite replaces just
those folders; all other files keep their names and bytes.

A change is applied once per batch id. The new folders are first written aside
under that id. Replacing a folder is not atomic, so a run that is lost midway
is repeated from that copy, never from half-replaced folders; the id is marked
as applied at the end, and a batch id at or below it changes nothing. One
writer per table.

A folder whose last row is deleted must be replaced too, so every touched
folder gets a marker row, which readers filter out.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import changes as ch
from cairn.sources import files

BUCKET, LIVE = "_bucket", "_live"


@dataclass(frozen=True)
class KeyedTable:
    """``buckets`` is fixed for the life of the table: about its size over
    the 100 MB or so that a folder should hold."""
    root: str
    keys: tuple[str, ...]
    buckets: int = 64

    @property
    def data(self) -> str:
        return f"{self.root.rstrip('/')}/by-{self.buckets}"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def exists(self, spark: SparkSession) -> bool:
        return files.exists(spark, f"{self.data}/_SUCCESS")

    def create(self, df: DataFrame, batch_id: int = 0) -> None:
        """The first rows of the table, as batch ``batch_id``."""
        self._write(self._marked(df, [0]).repartition(BUCKET), self.data, "static")
        self.mark(df.sparkSession, batch_id)

    def _marked(self, df: DataFrame, folders: list[int]) -> DataFrame:
        """``df`` as it is stored, with marker rows for these folders."""
        markers = df.sparkSession.createDataFrame([(b, False) for b in folders], f"{BUCKET} int, {LIVE} boolean")
        return df.withColumn(BUCKET, self.bucket()).withColumn(LIVE, F.lit(True)).unionByName(markers, allowMissingColumns=True)

    def _write(self, rows: DataFrame, path: str, mode: str) -> None:
        """Rows as they lie, into their folders."""
        (rows.write.mode("overwrite").option("partitionOverwriteMode", mode).option("compression", files.STORED).partitionBy(BUCKET).parquet(path))

    def stored(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.data).filter(LIVE).drop(LIVE)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.stored(spark).drop(BUCKET)

    def applied(self, spark: SparkSession) -> int | None:
        """The last batch id applied."""
        ids = [int(name) for name in files.names(spark, f"{self.root}/applied")]
        return max(ids, default=None)

    def mark(self, spark: SparkSession, batch_id: int) -> None:
        files.touch(spark, f"{self.root}/applied/{batch_id}")

    def refreshed_at(self, spark: SparkSession) -> float | None:
        """When the last batch was marked, in seconds since 1970."""
        last = self.applied(spark)
        return None if last is None else files.modified(spark, f"{self.root}/applied/{last}")

    def touched(self, keys: DataFrame) -> list[int]:
        """The folders of these keys: at most ``buckets`` numbers."""
        return sorted(r[0] for r in keys.select(self.bucket().alias("b")).distinct().collect())

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """The stored rows with one of these keys, read from their folders alone."""
        wanted = keys.select(*(F.col(k).alias(f"_w_{k}") for k in self.keys)).distinct()
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in self.keys))
        near = self.stored(keys.sparkSession).filter(F.col(BUCKET).isin(self.touched(keys))).drop(BUCKET)
        return near.join(wanted, same, "left_semi")

    def apply(self, last: DataFrame, new: DataFrame, batch_id: int) -> bool:
        """Take the keys of ``last`` out and the rows of ``new`` in; False
        where the batch was applied before."""
        spark = last.sparkSession
        done = self.applied(spark)
        if done is not None and done >= batch_id:
            return False
        aside = f"{self.root}/aside/{batch_id}"
        if not files.exists(spark, f"{aside}/_SUCCESS"):
            folders = self.touched(last)
            if not folders:
                self.mark(spark, batch_id)
                return True
            current = self.stored(spark).filter(F.col(BUCKET).isin(folders)).drop(BUCKET)
            self._write(self._marked(ch.apply_changes(current, last, new, self.keys), folders).repartition(BUCKET), aside, "static")
        self._write(spark.read.parquet(aside), self.data, "dynamic")  # a file there holds one folder's rows: no shuffle
        self.mark(spark, batch_id)
        files.delete(spark, aside)
        return True

    def update_where(self, spark: SparkSession, predicate: Column, assignments: Mapping[str, Column], batch_id: int) -> bool:
        """K6: rows where the predicate is TRUE take the new values (not of a key column)."""
        hit = self.read(spark).filter(predicate)
        return self.apply(hit, hit.withColumns(dict(assignments)), batch_id)

    def delete_where(self, spark: SparkSession, predicate: Column, batch_id: int) -> bool:
        """K7: rows where the predicate is TRUE go."""
        hit = self.read(spark).filter(predicate)
        return self.apply(hit, hit.limit(0), batch_id)
