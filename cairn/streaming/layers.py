"""A chain of stored layers that is refreshed on demand from changes.

Every layer keeps three things: its rows (a keyed table, or an aggregate as
base and deltas), a log of its own net changes with a folder per version, and
the upstream version it has applied. A refresh starts at the layer that is asked
for. If that is within its target lag, nothing happens at all. Otherwise its
upstream is refreshed first, in the same way, and only upstream versions past
the stored one are read, by partition pruning. Where there are none, or none
that matter, the layer is skipped and its files stay as they are. A layer that
has nothing yet is made from its whole upstream table.

Versions make the chain exactly-once: a layer's version is the upstream
version it was made from. Its change log is written first, and its rows are
replaced from that log; a run that is lost in between goes on from there.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import changes as ch
from cairn.sources import files
from cairn.sources.keyed import KeyedTable
from cairn.streaming import runlog
from cairn.streaming.deltas import DeltaAggregate

VERSION = "version"
FEED_COLUMNS = (ch.ACTION, ch.IS_UPDATE, ch.ROW_ID, VERSION)


@dataclass(frozen=True)
class ChangeLog:
    """Net change feeds of one table, a folder per version."""
    root: str

    def folder(self, version: int) -> str:
        return f"{self.root}/{VERSION}={version}"

    def has(self, spark: SparkSession, version: int) -> bool:
        return files.exists(spark, f"{self.folder(version)}/_SUCCESS")

    def versions(self, spark: SparkSession) -> list[int]:
        found = (int(n.split("=")[1]) for n in files.names(spark, self.root) if n.startswith(f"{VERSION}="))
        return sorted(v for v in found if self.has(spark, v))

    def latest(self, spark: SparkSession) -> int | None:
        return max(self.versions(spark), default=None)

    def publish(self, feed: DataFrame, version: int | None = None) -> int:
        """Write a feed as the next version (or the one given, replacing it)."""
        spark = feed.sparkSession
        if version is None:
            last = self.latest(spark)
            version = 1 if last is None else last + 1
        feed.write.mode("overwrite").option("compression", files.STORED).parquet(self.folder(version))
        return version

    def read(self, spark: SparkSession, after: int | None, upto: int) -> DataFrame:
        rows = spark.read.parquet(self.root).filter(F.col(VERSION) <= upto)
        return rows if after is None else rows.filter(F.col(VERSION) > after)


@dataclass(frozen=True)
class Source:
    """The head of a chain: a table known by its change log alone."""
    root: str
    keys: tuple[str, ...]

    @cached_property
    def log(self) -> ChangeLog:
        return ChangeLog(f"{self.root}/changes")

    def version(self, spark: SparkSession) -> int | None:
        return self.log.latest(spark)

    def refresh(self, spark: SparkSession, run_log: str | None = None, now: float | None = None) -> str:
        return "SOURCE"


@dataclass(frozen=True)
class Layer:
    """``transform`` turns upstream rows into rows of the layer, one or none
    for each key; ``lag`` seconds may pass before a refresh looks upstream
    (None: whenever a layer below asks)."""
    name: str
    root: str
    upstream: Source | Layer
    transform: Callable[[DataFrame], DataFrame]
    lag: float | None = None
    buckets: int = 64
    keys: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        if not self.keys:
            object.__setattr__(self, "keys", self.upstream.keys)

    @cached_property
    def table(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/{self.name}", self.keys, self.buckets)

    @cached_property
    def log(self) -> ChangeLog:
        return ChangeLog(f"{self.root}/{self.name}/changes")

    def read(self, spark: SparkSession) -> DataFrame:
        return self.table.read(spark)

    def version(self, spark: SparkSession) -> int | None:
        return self.table.applied(spark)

    def refreshed_at(self, spark: SparkSession) -> float | None:
        return self.table.refreshed_at(spark)

    def mark(self, spark: SparkSession, version: int) -> None:
        self.table.mark(spark, version)

    def refresh(self, spark: SparkSession, run_log: str | None = None, now: float | None = None) -> str:
        return _refresh(self, spark, run_log, now)

    def start(self, spark: SparkSession, upto: int) -> int:
        """All rows, from the upstream table. They need no log: a layer below
        that has none yet starts from this table in turn."""
        self.table.create(self.transform(_state(self.upstream, spark, upto)), upto)
        return self.read(spark).count()

    def advance(self, spark: SparkSession, feed: DataFrame, upto: int) -> int:
        """Rows of the keys that changed upstream, made anew. Returns how
        many changes of its own that came to."""
        if not self.log.has(spark, upto):
            last = files.staged(ch.last_changes(feed, self.keys, VERSION), f"{self.name}-last")
            made = self.transform(last.filter(F.col(ch.ACTION) == ch.INSERT).drop(*FEED_COLUMNS))
            self.log.publish(ch.change_feed(self.table.rows_of(last), made, self.keys), upto)
        own = self.log.read(spark, upto - 1, upto)
        n = own.count()
        if n:
            last = ch.last_changes(own, self.keys, VERSION)
            self.table.apply(last, last.filter(F.col(ch.ACTION) == ch.INSERT).drop(*FEED_COLUMNS), upto)
        else:
            self.table.mark(spark, upto)
        return n


@dataclass(frozen=True)
class AggregateLayer:
    """COUNT and SUM per ``keys`` over the layer above, from its signed changes."""
    name: str
    root: str
    upstream: Source | Layer
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    lag: float | None = None

    @cached_property
    def state(self) -> DeltaAggregate:
        return DeltaAggregate(f"{self.root}/{self.name}", self.keys, self.measures)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.state.read(spark)

    def version(self, spark: SparkSession) -> int | None:
        return self.state.applied(spark)

    def refreshed_at(self, spark: SparkSession) -> float | None:
        return self.state.refreshed_at(spark)

    def mark(self, spark: SparkSession, version: int) -> None:
        self.state.mark(spark, version)

    def refresh(self, spark: SparkSession, run_log: str | None = None, now: float | None = None) -> str:
        return _refresh(self, spark, run_log, now)

    def start(self, spark: SparkSession, upto: int) -> int:
        rows = _state(self.upstream, spark, upto)
        self.state.start(rows, upto)
        return self.state.read(spark).count()

    def advance(self, spark: SparkSession, feed: DataFrame, upto: int) -> int:
        self.state.add(feed, upto)
        self.state.compact(spark)
        return self.state.delta_rows(spark, upto)


def _state(upstream: Source | Layer, spark: SparkSession, upto: int) -> DataFrame:
    """The rows of an upstream table at a version."""
    if isinstance(upstream, Layer):
        return upstream.read(spark)
    rows = upstream.log.read(spark, None, upto)
    if not rows.groupBy(*upstream.keys).count().filter("count > 1").isEmpty():  # else whole rows need no shuffle
        rows = ch.last_changes(rows, upstream.keys, VERSION)
    return rows.filter(F.col(ch.ACTION) == ch.INSERT).drop(*FEED_COLUMNS)


def _refresh(layer: Layer | AggregateLayer, spark: SparkSession, run_log: str | None, now: float | None) -> str:
    now = time.time() if now is None else now

    def logged(state: str, action: str, rows: int | None = None, version: int | None = None, message: str | None = None) -> str:
        if run_log:
            runlog.log_run(spark, run_log, layer.name, state, action, rows, version, message)
        return action

    try:
        last_time = layer.refreshed_at(spark)
        if layer.lag is not None and last_time is not None and now - last_time < layer.lag:
            return logged("SKIPPED", "WITHIN_LAG")
        layer.upstream.refresh(spark, run_log, now)
        seen, latest = layer.version(spark), layer.upstream.version(spark)
        if latest is None or (seen is not None and latest <= seen):
            return logged("SKIPPED", "NO_DATA")
        if seen is None:
            return logged("SUCCEEDED", "FULL", layer.start(spark, latest), latest)
        log = layer.upstream.log
        feed = log.read(spark, seen, latest) if any(seen < v <= latest for v in log.versions(spark)) else None
        if feed is None or feed.isEmpty():  # versions without a change: nothing to do but to remember them
            layer.mark(spark, latest)
            return logged("SKIPPED", "NO_DATA", 0, latest)
        return logged("SUCCEEDED", "INCREMENTAL", layer.advance(spark, feed, latest), latest)
    except Exception as exc:
        logged("FAILED", "ERROR", message=str(exc))
        raise


def actions(spark: SparkSession, run_log: str, names: Sequence[str]) -> list[str]:
    """The actions of the latest run of each layer, in this order."""
    runs = runlog.read_runs(spark, run_log).groupBy("name").agg(F.max_by("action", "data_timestamp").alias("action"))
    found = {r["name"]: r["action"] for r in runs.collect()}  # a row per layer
    return [found.get(n) for n in names]
