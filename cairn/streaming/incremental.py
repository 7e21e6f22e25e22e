"""Incremental pipelines: consume a change log once (C3), skip empty runs
(C6), keep an aggregate current from a change stream (C8) and an enriched
table from a change feed (T9). Chains of stored layers (C9): ``layers``.

A change log is an append-only folder of change rows (the output of
``cairn.operators.changes.change_feed`` plus a change time). Consumers read
it as a file stream: the stream checkpoint is the consumer's offset, so each
change is processed once per consumer and a plain batch read of the folder
leaves every consumer's offset alone (a SELECT does not drain a stream).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cairn.operators import changes as ch
from cairn.sources import files
from cairn.sources.keyed import KeyedTable
from cairn.streaming import runlog
from cairn.streaming.deltas import DeltaAggregate

BatchFn = Callable[[DataFrame, int], None]


SEQUENCE = "sequence"


def publish_changes(feed: DataFrame, log_path: str, sequence: int | None = None) -> None:
    """Append a change feed, with its change time, to the change log.
    ``sequence`` numbers the feeds of a log whose writers may stamp two of
    them alike: a key's last change is then the one of the later feed."""
    if sequence is not None:
        feed = feed.withColumn(SEQUENCE, F.lit(sequence).cast("bigint"))
    feed.withColumn("changed_at", F.localtimestamp()).write.mode("append").parquet(log_path)


def consume(spark: SparkSession, log_path: str, schema: T.StructType, checkpoint: str, fn: BatchFn,
            available_now: bool = True, interval: str | None = None,
            run_log: str | None = None, name: str = "consume", max_files: int | None = None) -> StreamingQuery:
    """Apply ``fn(batch, batch_id)`` to changes not yet consumed,
    then advance the offset (the checkpoint commits after ``fn`` returns).
    No new changes means no micro-batch, so ``fn`` does not run at all.
    ``fn`` must be idempotent per ``batch_id``: a batch whose commit was
    lost is replayed with the same id. The run log gets its row inside the
    batch, so it is complete however many batches a run has."""
    stream = spark.readStream.schema(schema)
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    ran = []

    def logged(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            fn(batch, batch_id)
            if run_log:
                runlog.log_run(spark, run_log, name, "SUCCEEDED", "INCREMENTAL", batch.count(), batch_id)
            ran.append(batch_id)
        finally:
            batch.unpersist()

    w = stream.parquet(log_path).writeStream.foreachBatch(logged).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval or "1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
        if run_log and not ran:
            runlog.log_run(spark, run_log, name, "SKIPPED", "NO_DATA")
    return q


def append_history(history_path: str) -> BatchFn:
    """C3 body: label the changes (C4) and append them to a history table,
    once per batch id (files are written under ``batch=<id>``; a replay
    overwrites its own folder, so it never duplicates rows)."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        labelled = ch.label_changes(batch).drop(ch.ACTION, ch.IS_UPDATE, ch.ROW_ID)
        labelled.write.mode("overwrite").parquet(f"{history_path}/batch={batch_id}")

    return fn


def maintain_aggregate(state_root: str, keys: Sequence[str], measures: Sequence[str], share: float = 0.5) -> BatchFn:
    """C8 body: each batch adds its signed sums to the stored aggregate of
    ``deltas.DeltaAggregate`` (read it there), which writes no more than the
    batch changes; a replayed batch id changes nothing."""
    return DeltaAggregate(state_root, tuple(keys), tuple(measures)).maintain(share)


def maintain_enriched(target_root: str, keys: Sequence[str], enrich: Callable[[DataFrame], DataFrame], buckets: int = 64) -> BatchFn:
    """T9 body: keep an enriched table current from a change feed, scoring
    only what changed and rewriting only the folders of the keys it touches
    (``keyed.KeyedTable``; read it there). A batch may hold several changes of
    a key: it is reduced to the last one of each, by publication (sequence,
    where the log has it) before time. Keys whose last change is an INSERT (or
    the new half of an update) are enriched and replace the stored row, keys
    whose last change is a DELETE leave, and all other rows keep their stored
    scores. A replayed batch id changes nothing."""
    table = KeyedTable(target_root, tuple(keys), buckets)

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = table.applied(spark)
        if done is not None and done >= batch_id:
            return
        stamps = [c for c in (SEQUENCE, "changed_at") if c in batch.columns]
        ordered = batch.withColumn("_order", F.struct(*stamps))
        last = ch.last_changes(ordered, keys, "_order").drop("_order")
        data_cols = [c for c in batch.columns if c not in (ch.ACTION, ch.IS_UPDATE, ch.ROW_ID, *stamps)]
        out = files.staged(enrich(last.filter(F.col(ch.ACTION) == ch.INSERT).select(*data_cols)), "enriched-batch")
        if table.exists(spark):
            table.apply(last, out, batch_id)
        else:
            table.create(out, batch_id)

    return fn
