"""Load ledger (S6, S7, S8): new and changed files only, reported as rows."""

import os
import time

import pytest

from cairn.sources.ledger import LoadedTable
from tests.test_sources_sinks import ORDERS_SCHEMA

HEAD = "order_id,customer_name,country,order_ts,status,amount\n"


def _put(folder, name, *lines, age=0):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(HEAD + "".join(f"{x}\n" for x in lines))
    os.utime(f"{folder}/{name}", (time.time() - age, time.time() - age))


def _report(df):
    return sorted((os.path.basename(r["path"]), r["rows_parsed"], r["rows_loaded"], r["errors_seen"], r["status"]) for r in df.collect())


def test_only_new_and_changed_files_are_loaded(spark, tmp_dir):
    src = f"{tmp_dir}/in put"  # a path that is escaped in URLs
    table = LoadedTable(f"{tmp_dir}/t", src, ORDERS_SCHEMA)
    _put(src, "a.csv", "1,Lena,IE,2026-01-01 00:00:00,PAID,5.00", age=50)
    _put(src, "b.csv", "2,Olaf,NO,2026-01-01 00:00:00,PAID,6.00", "3,bad,NO,some day,PAID,x", age=50)
    _put(src, "empty.csv", age=50)
    assert _report(table.load(spark)) == [("a.csv", 1, 1, 0, "LOADED"), ("b.csv", 2, 1, 1, "PARTIALLY_LOADED"), ("empty.csv", 0, 0, 0, "LOADED")]
    assert table.load(spark).count() == 0
    _put(src, "c.csv", "4,Juri,EE,2026-01-02 00:00:00,PAID,7.00", age=20)
    _put(src, "b.csv", "2,Olaf,NO,2026-01-01 00:00:00,PAID,6.50", "3,good,NO,2026-01-01 00:00:00,PAID,1.00", age=10)
    assert _report(table.load(spark)) == [("b.csv", 2, 2, 0, "LOADED"), ("c.csv", 1, 1, 0, "LOADED")]
    rows = {r["order_id"]: str(r["amount"]) for r in table.read(spark).collect()}
    assert rows == {1: "5.00", 2: "6.50", 3: "1.00", 4: "7.00"}  # the changed file's old rows are not read any more
    assert table.ledger(spark).count() == 5 and table.read(spark, rejected=True).count() == 0


def test_a_load_that_aborts_leaves_no_trace(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    table = LoadedTable(f"{tmp_dir}/t", src, ORDERS_SCHEMA)
    _put(src, "a.csv", "1,Lena,IE,2026-01-01 00:00:00,PAID,5.00", "2,bad,IE,some day,PAID,x")
    with pytest.raises(Exception):
        table.load(spark, abort=True)
    assert table.ledger(spark).count() == 0
    assert _report(table.load(spark)) == [("a.csv", 2, 1, 1, "PARTIALLY_LOADED")]
    assert [r["_corrupt_record"] for r in table.read(spark, rejected=True).collect()] == ["2,bad,IE,some day,PAID,x"]
