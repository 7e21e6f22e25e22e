"""Stored layers, keyed tables and delta aggregates."""

import os

import pytest
from pyspark.sql import functions as F

from cairn.operators import changes as ch
from cairn.sources import files
from cairn.sources.keyed import KeyedTable
from cairn.streaming import runlog
from cairn.streaming.deltas import DeltaAggregate
from cairn.streaming.layers import AggregateLayer, Layer, Source, actions

ROWS = "id int, name string, amount int"


def data_files(folder):
    return {os.path.join(d, n) for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet")}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table_of(spark, tmp_dir, made):
    table = KeyedTable(f"{tmp_dir}/t", ("id",), 8)
    table.create(spark.createDataFrame(made, ROWS))
    return table


def test_a_change_rewrites_only_its_folders(spark, tmp_dir):
    made = [(i, f"n{i}", i) for i in range(200)] + [(None, "no id", 1)]
    table = table_of(spark, tmp_dir, made)
    before = data_files(table.data)
    last = spark.createDataFrame([(7, None, None)], ROWS)
    assert table.apply(last, spark.createDataFrame([(7, "seven", 70)], ROWS), 1)
    after = data_files(table.data)
    assert {os.path.dirname(f) for f in before - after} == {os.path.dirname(f) for f in after - before}
    assert len({os.path.dirname(f) for f in after - before}) == 1
    want = [(7, "seven", 70) if r[0] == 7 else r for r in made]
    assert rows(table.read(spark)) == sorted(want, key=str)
    assert not table.apply(last, last.limit(0), 1) and data_files(table.data) == after  # a replay


def test_null_keys_and_emptied_folders(spark, tmp_dir):
    table = table_of(spark, tmp_dir, [(i, "x", 1) for i in range(40)] + [(None, "no id", 1)])
    assert table.update_where(spark, F.col("id").isNull(), {"name": F.lit("still none")}, 1)
    assert rows(table.read(spark).filter("id is null")) == [(None, "still none", 1)]
    assert table.delete_where(spark, F.lit(True), 2) and table.read(spark).count() == 0
    assert table.apply(spark.createDataFrame([], ROWS), spark.createDataFrame([], ROWS), 3) and table.applied(spark) == 3
    assert table.apply(spark.createDataFrame([(1, "a", 1)], ROWS), spark.createDataFrame([(1, "a", 1)], ROWS), 4)
    assert rows(table.read(spark)) == [(1, "a", 1)]


def test_a_lost_run_goes_on_from_its_copy(spark, tmp_dir, monkeypatch):
    """The folders are half replaced, then the run is lost: the replay ends it."""
    table = table_of(spark, tmp_dir, [(i, "x", i) for i in range(50)])
    change = spark.createDataFrame([(i, "y", -i) for i in range(0, 50, 2)], ROWS)
    write = KeyedTable._write

    def fails(self, df, path, mode):
        if mode == "dynamic":
            os.remove(next(iter(data_files(f"{self.data}/_bucket=3"))))  # replaced by nothing
            raise OSError("lost")
        write(self, df, path, mode)

    monkeypatch.setattr(KeyedTable, "_write", fails)
    with pytest.raises(OSError):
        table.apply(change, change, 1)
    monkeypatch.setattr(KeyedTable, "_write", write)
    spark.catalog.clearCache()
    assert table.applied(spark) == 0 and table.apply(change, change, 1)
    assert rows(table.read(spark)) == sorted(((i, "y", -i) if i % 2 == 0 else (i, "x", i) for i in range(50)), key=str)


def chain(tmp_dir, lag=None):
    source = Source(f"{tmp_dir}/source", ("id",))
    clean = Layer("clean", tmp_dir, source, lambda df: df.filter("amount >= 0").withColumn("name", F.upper("name")), buckets=8)
    served = Layer("served", tmp_dir, clean, lambda df: df.select("id", "name"), lag=lag, buckets=8)
    totals = AggregateLayer("totals", tmp_dir, clean, ("name",), ("amount",))
    return source, clean, served, totals


def test_chain_refreshes_from_changes_on_demand(spark, tmp_dir):
    source, clean, served, totals = chain(tmp_dir)
    log = f"{tmp_dir}/runs"
    names = ["clean", "served", "totals"]
    assert served.refresh(spark, log) == "NO_DATA"  # nothing published yet
    v1 = spark.createDataFrame([(i, f"n{i % 5}", i) for i in range(60)], ROWS)
    source.log.publish(ch.as_inserts(v1, ["id"]))
    served.refresh(spark, log)
    totals.refresh(spark, log)
    assert actions(spark, log, ["served", "totals"]) == ["FULL", "FULL"]

    # one name changes, one row leaves by the clean layer's filter, one is deleted, one is new
    v2 = (v1.filter("id <> 5").withColumn("name", F.when(F.col("id") == 7, F.lit("zeta")).otherwise(F.col("name")))
            .withColumn("amount", F.when(F.col("id") == 9, -1).otherwise(F.col("amount"))).union(spark.createDataFrame([(99, "new", 4)], ROWS)))
    source.log.publish(ch.change_feed(v1, v2, ["id"]))
    old = data_files(served.table.data)
    assert served.refresh(spark, log) == "INCREMENTAL" and totals.refresh(spark, log) == "INCREMENTAL"
    want = v2.filter("amount >= 0").withColumn("name", F.upper("name"))
    assert rows(clean.read(spark).select("id", "name", "amount")) == rows(want)
    assert rows(served.read(spark)) == rows(want.select("id", "name"))
    sums = want.groupBy("name").agg(F.count("*").alias("n"), F.sum("amount").alias("s"))
    assert rows(totals.read(spark).select("name", "row_count", "sum_amount")) == rows(sums)
    assert old & data_files(served.table.data)  # untouched folders keep their files

    # a change that the clean layer drops: the layers below are skipped and keep every file
    v3 = v2.union(spark.createDataFrame([(100, "bad", -5)], ROWS))
    source.log.publish(ch.change_feed(v2, v3, ["id"]))
    kept = data_files(served.table.data) | data_files(clean.table.data) | data_files(totals.state.deltas)
    assert served.refresh(spark, log) == "NO_DATA" and totals.refresh(spark, log) == "NO_DATA"
    assert kept == data_files(served.table.data) | data_files(clean.table.data) | data_files(totals.state.deltas)
    assert served.refresh(spark, log) == "NO_DATA"
    assert set(actions(spark, log, names)) == {"NO_DATA"}
    states = {(r["name"], r["state"], r["action"]) for r in runlog.read_runs(spark, log).collect()}
    assert ("served", "SUCCEEDED", "INCREMENTAL") in states and ("served", "SKIPPED", "NO_DATA") in states


def test_lag_holds_the_whole_chain_back(spark, tmp_dir):
    source, clean, served, _ = chain(tmp_dir, lag=3600)
    v1 = spark.createDataFrame([(1, "a", 1)], ROWS)
    source.log.publish(ch.as_inserts(v1, ["id"]))
    assert served.refresh(spark) == "FULL"
    source.log.publish(ch.as_inserts(spark.createDataFrame([(2, "b", 1)], ROWS), ["id"]))
    assert served.refresh(spark) == "WITHIN_LAG" and clean.version(spark) == 1
    later = files.modified(spark, f"{tmp_dir}/served/applied/1") + 3601
    assert served.refresh(spark, now=later) == "INCREMENTAL" and rows(served.read(spark)) == [(1, "A"), (2, "B")]


def test_several_versions_in_one_refresh(spark, tmp_dir):
    """A key inserted, changed and deleted in versions that are read together."""
    source, clean, served, totals = chain(tmp_dir)
    states = [[(1, "a", 1)], [(1, "b", 2), (2, "c", 1)], [(2, "c", 5)], [(1, "d", 7)]]
    frames = [spark.createDataFrame(s, ROWS) for s in states]
    source.log.publish(ch.as_inserts(frames[0], ["id"]))
    totals.refresh(spark)
    for old, new in zip(frames, frames[1:]):
        source.log.publish(ch.change_feed(old, new, ["id"]))
    totals.refresh(spark)
    served.refresh(spark)
    assert rows(clean.read(spark).select("id", "name", "amount")) == [(1, "D", 7)] and rows(served.read(spark)) == [(1, "D")]
    assert rows(totals.read(spark).select("name", "row_count", "sum_amount")) == [("D", 1, 7)]


def test_a_failing_layer_is_logged_and_keeps_its_rows(spark, tmp_dir):
    source, clean, _, _ = chain(tmp_dir)
    source.log.publish(ch.as_inserts(spark.createDataFrame([(1, "a", 1)], ROWS), ["id"]))
    clean.refresh(spark)
    broken = Layer("clean", tmp_dir, source, lambda df: df.select("no_such_column"), buckets=8)
    source.log.publish(ch.as_inserts(spark.createDataFrame([(2, "b", 1)], ROWS), ["id"]))
    with pytest.raises(Exception):
        broken.refresh(spark, f"{tmp_dir}/runs")
    assert runlog.read_runs(spark, f"{tmp_dir}/runs").first()["state"] == "FAILED"
    assert clean.refresh(spark) == "INCREMENTAL" and clean.read(spark).count() == 2


def test_fifty_deltas_and_compaction(spark, tmp_dir):
    state = DeltaAggregate(f"{tmp_dir}/agg", ("name",), ("amount",))
    base = spark.range(4000).selectExpr("cast(id as int) id", "concat('n', id % 1500) name", "cast(id % 9 as int) amount")
    state.start(base)
    maintain = state.maintain(share=1.0)
    held, sizes, compacted = base, [], 0
    for b in range(50):
        fresh = spark.createDataFrame([(10_000 + b, "n1", b), (20_000 + b, None if b % 2 else f"m{b}", None)], ROWS)
        gone = held.filter(F.col("id") == b) if b % 3 == 0 else held.limit(0)
        feed = ch.as_inserts(fresh, ["id"]).unionByName(gone.select("*", F.lit(ch.DELETE).alias(ch.ACTION), F.lit(False).alias(ch.IS_UPDATE), ch.row_id(["id"]).alias(ch.ROW_ID)))
        folded = state.folded(spark)
        maintain(feed.coalesce(1), b)
        if b % 10 == 0:
            maintain(feed.coalesce(1), b)  # a replay
        compacted += state.folded(spark) > folded
        sizes.append(files.size(spark, f"{state.deltas}/batch={b + 1}"))
    ids = [b for b in range(50) if b % 3 == 0]
    made = [(10_000 + b, "n1", b) for b in range(50)] + [(20_000 + b, None if b % 2 else f"m{b}", None) for b in range(50)]
    now = base.filter(~F.col("id").isin(ids)).union(spark.createDataFrame(made, ROWS))
    want = now.groupBy("name").agg(F.count("*").alias("n"), F.sum("amount").alias("s"))
    assert rows(state.read(spark).select("name", "row_count", "sum_amount")) == rows(want)
    assert 0 < compacted < 10 and max(sizes) < files.size(spark, state.base) / 2


def test_whole_rows_move_no_more_than_they_must(spark, tmp_dir, monkeypatch):
    """The copy aside is put in place without a shuffle, and a source that says
    each key once is not dealt out to find each key's last change."""
    table = table_of(spark, tmp_dir, [(i, "x", i) for i in range(40)])
    change = spark.createDataFrame([(i, "y", -i) for i in range(0, 40, 3)], ROWS)
    dealt, deal, kind = [], type(change).repartition, type(change)
    monkeypatch.setattr(kind, "repartition", lambda self, *a: dealt.append(a) or deal(self, *a))
    assert table.apply(change, change, 1) and len(dealt) == 1
    monkeypatch.undo()
    assert rows(table.read(spark)) == sorted(((i, "y", -i) if i % 3 == 0 else (i, "x", i) for i in range(40)), key=str)
    assert all(".zstd." in f for f in data_files(table.data))

    called, last = [], ch.last_changes
    monkeypatch.setattr(ch, "last_changes", lambda *a: called.append(a) or last(*a))
    for name, made, calls, left in (("a", [(1, "n", 1), (None, "m", 2)], 0, 2), ("b", [(1, "n", 1), (1, "n", 1), (2, "k", 1)], 1, 2)):
        source, _, served, _ = chain(f"{tmp_dir}/{name}")
        source.log.publish(ch.as_inserts(spark.createDataFrame(made, ROWS), ["id"]))
        served.refresh(spark)
        assert len(called) == calls and served.read(spark).count() == left
