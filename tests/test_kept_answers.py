"""Kept answers (T5, T8) and snapshots under a change log (C11)."""

import datetime as dt
import random

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from cairn.operators import changes as ch
from cairn.operators import text as tx
from cairn.sources.answers import PART_BYTES, PART_ROWS, AnswerCache, parts
from cairn.streaming.snapshots import SnapshotLog


def test_no_text_is_sent_twice(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def ask(s: pd.Series) -> pd.Series:
        with open(calls, "a") as f:
            f.writelines(f"{x}\n" for x in s)
        return "[en] " + s

    def sent():
        with open(calls) as f:
            return sorted(f.read().split())

    cache = AnswerCache(str(tmp_path / "answers"))
    run = lambda rows: sorted(map(tuple, tx.translate_route(
        spark.createDataFrame(rows, "id int, t string, lang string"), "t", "lang", ask, out_col="en", cache=cache).select("id", "en").collect()))
    rows = [(1, "bonjour", "fr"), (2, "bonjour", "fr"), (3, "bonjour", "en"), (4, None, "fr"), (5, "hallo", "de"), (6, "x", None)]
    want = [(1, "[en] bonjour"), (2, "[en] bonjour"), (3, "bonjour"), (4, None), (5, "[en] hallo"), (6, "x")]
    assert run(rows) == want and sent() == ["bonjour", "hallo"]
    assert run(rows) == want and sent() == ["bonjour", "hallo"]  # the second run makes no call
    assert run([*rows, (7, "hola", "es")]) == [*want, (7, "[en] hola")] and sent() == ["bonjour", "hallo", "hola"]
    assert run([]) == []
    # a run that was lost has no success mark: its folder is not read, and replaced
    (tmp_path / "answers" / f"run={cache.runs(spark)[-1]}" / "_SUCCESS").unlink()
    assert cache.runs(spark) == [1, 2, 3] and cache.read(spark).count() == 3


def test_no_text_among_shuffle_keys(spark):
    df = spark.createDataFrame([(1, "a", "fr")], "id int, t string, lang string")
    plan = tx.translate_route(df, "t", "lang", tx.stand_in_translator)._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    assert exchanged and not any("hashpartitioning(t#" in line or "hashpartitioning(text#" in line for line in exchanged)


def test_a_text_function_gets_parts_of_bounded_size(spark):
    """Long texts and many texts in one Arrow batch: no call holds more than a part."""

    def ask(s: pd.Series) -> pd.Series:
        return s.str[:1] + f" {len(s)} {s.str.len().sum()}"

    rows = [(i, chr(97 + i % 26) + str(i).rjust(PART_BYTES // 5, "x"), "fr") for i in range(30)]
    rows += [(100 + i, f"s{i}", "fr") for i in range(3 * PART_ROWS)] + [(9000, "z" * (2 * PART_BYTES), "fr"), (9001, None, "fr"), (9002, "", "fr")]
    df = spark.createDataFrame(rows, "id int, t string, lang string").coalesce(1)
    got = {r["id"]: r["en"] for r in tx.translate_route(df, "t", "lang", ask, out_col="en").collect()}
    assert len(got) == len(rows) and got[9001] is None and all(got[i][0] == t[0] for i, t, _ in rows if t)
    sizes = [tuple(map(int, a.split()[-2:])) for a in got.values() if a]
    assert max(n for n, _ in sizes) <= PART_ROWS and all(size <= PART_BYTES or n == 1 for n, size in sizes)
    assert got[9000] == f"z 1 {2 * PART_BYTES}"


def test_parts_cover_a_batch_in_order():
    texts = ["aa", None, "", "bbbb", "é", "c" * 9, None]
    batch = pa.RecordBatch.from_arrays([pa.array([bytes([i]) for i in range(7)], pa.binary()), pa.array(texts, pa.string())], names=["digest", "text"])
    cut = [p.column(1).to_pylist() for p in parts(batch, 3, 4)]
    assert cut == [["aa", None, ""], ["bbbb"], ["é"], ["c" * 9], [None]]
    assert [*parts(batch.slice(0, 0))] == [] and sum(p.num_rows for p in parts(batch.slice(2), 2, 99)) == 5


def test_snapshots_equal_a_full_replay(spark, tmp_path):
    rnd = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(k, rnd.randrange(15), start + dt.timedelta(hours=rnd.randrange(24 * 12)), rnd.choice(["set", "set", "set", "gone"])) for k in range(400)]
    rows += [(900, 3, None, "set"), (901, None, dt.datetime(2024, 1, 3), "set")]
    kinds = "n int, user int, ts timestamp_ntz, op string"
    log = SnapshotLog(str(tmp_path), ("user",), "ts", "op", ("gone",), ("n",))
    changes = spark.createDataFrame(rows, kinds)
    log.append(changes)
    log.snapshot(spark, ["2024-01-08", "2024-01-04"])

    def same(as_of, before=False):
        want = ch.state_as_of(changes, ["user"], "ts", as_of, before, "op", ["gone"], ["n"])
        return sorted(map(str, log.state_as_of(spark, as_of, before).select(want.columns).collect())) == sorted(map(str, want.collect()))

    times = ["2023-12-31 00:00:00", "2024-01-03 10:00:00", "2024-01-04 23:00:00", "2024-01-05 00:00:00", "2024-01-08 12:00:00",
             "2024-01-09 00:00:00", "2024-01-09 05:00:00", "2024-01-30 00:00:00"]
    assert all(same(t) for t in times) and same("2024-01-05 00:00:00", True) and same("2024-01-09 00:00:00", True)
    state = log.state_as_of(spark, "2024-01-10 00:00:00")
    plan = state._jdf.queryExecution().executedPlan().toString()
    pruned = next(part for part in plan.split("PartitionFilters: ")[1:] if "log_day" in part.split("]")[0]).split("]")[0]
    assert "<= 2024-01-10" in pruned and "> 2024-01-08" in pruned
    assert {p.split("snapshots/")[1][:10] for p in state.inputFiles() if "snapshots/" in p} == {"2024-01-08"}

    late = spark.createDataFrame([(950, 3, dt.datetime(2024, 1, 6, 23), "set"), (951, 77, dt.datetime(2024, 1, 6), "set")], kinds)
    log.append(late)
    changes = changes.union(late)
    assert log.snapshots(spark) == ["2024-01-04"] and all(same(t) for t in times[4:])
    assert log.state_as_of(spark, "2024-01-07 00:00:00").filter(F.col("user") == 77).count() == 1
