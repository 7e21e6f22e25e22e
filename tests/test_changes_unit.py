"""Change feeds, upsert, incremental aggregates, as-of state: goldens from
the source labs (retyped as small rows) and property checks."""

import datetime as dt

from pyspark.sql import functions as F

from cairn.operators import changes as ch

RAW = "order_id int, customer string, amount decimal(10,2), status string"


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_stream_cdc_shape_and_history(spark):
    before = spark.createDataFrame([(1, "Ava", 100, "NEW"), (2, "Liam", 200, "NEW"), (3, "Mia", 300, "NEW")],
                                   "order_id int, customer string, amount int, status string")
    after = spark.createDataFrame([(1, "Ava", 100, "SHIPPED"), (3, "Mia", 300, "NEW"), (4, "Noah", 400, "NEW")],
                                  "order_id int, customer string, amount int, status string")
    feed = ch.change_feed(before, after, ["order_id"])
    assert _rows(feed, "order_id", "status", "action", "is_update") == [
        (1, "NEW", "DELETE", True), (1, "SHIPPED", "INSERT", True),
        (2, "NEW", "DELETE", False), (4, "NEW", "INSERT", False)]
    assert ch.has_changes(feed)
    assert not ch.has_changes(ch.change_feed(after, after, ["order_id"]))
    hist = ch.label_changes(feed)
    assert _rows(hist, "order_id", "customer", "amount", "status", "change_type") == [
        (1, "Ava", 100, "NEW", "DELETE"), (1, "Ava", 100, "SHIPPED", "UPDATE"),
        (2, "Liam", 200, "NEW", "DELETE"), (4, "Noah", 400, "NEW", "INSERT")]
    # the next task run: two inserts land, then the summary is rebuilt from
    # the whole history (both halves of the update count, trap 2)
    after2 = after.unionByName(spark.createDataFrame([(5, "Zoe", 500, "NEW"), (6, "Kai", 600, "NEW")],
                                                     after.schema))
    hist2 = hist.unionByName(ch.label_changes(ch.change_feed(after, after2, ["order_id"])))
    summary = ch.rebuild_summary(hist2, "customer", "amount")
    assert _rows(summary, "customer", "total_amount") == [
        ("Ava", 200), ("Kai", 600), ("Liam", 200), ("Noah", 400), ("Zoe", 500)]


def test_row_id_stable_and_null_safe_compare(spark):
    before = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    after = spark.createDataFrame([(1, None), (2, None)], "k int, v string")
    feed = ch.change_feed(before, after, ["k"])
    assert _rows(feed, "k", "action") == [(2, "DELETE"), (2, "INSERT")]
    ids = {r["row_id"] for r in feed.collect()}
    assert len(ids) == 1


def test_change_feed_applied_to_before_gives_after(spark):
    before = spark.range(0, 200).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    after = (before.filter(F.col("k") % 5 != 0)
                   .withColumn("v", F.when(F.col("k") % 3 == 0, F.col("v") + 1).otherwise(F.col("v")))
                   .unionByName(spark.range(1000, 1010).select(F.col("id").alias("k"), F.lit(9).alias("v"))))
    feed = ch.change_feed(before, after, ["k"])
    dels = feed.filter(F.col("action") == "DELETE").select("k")
    ins = feed.filter(F.col("action") == "INSERT").select("k", "v")
    rebuilt = before.join(dels, "k", "left_anti").unionByName(ins)
    assert sorted(rebuilt.collect()) == sorted(after.collect())


def test_dynamic_aggregate_golden(spark):
    table = spark.createDataFrame(
        [(1, "Ava", 100), (3, "Mia", 300), (4, "Noah", 400), (5, "Zoe", 500), (6, "Kai", 600)],
        "order_id int, customer string, amount int")
    state = ch.aggregate_state(table, ["customer"], ["amount"])
    assert _rows(state, "customer", "row_count", "sum_amount") == [
        ("Ava", 1, 100), ("Kai", 1, 600), ("Mia", 1, 300), ("Noah", 1, 400), ("Zoe", 1, 500)]
    new = table.unionByName(spark.createDataFrame([(7, "Ava", 150), (8, "Ivy", 700)], table.schema))
    feed = ch.change_feed(table, new, ["order_id"])
    out = ch.refresh_aggregate(state, feed, ["customer"], ["amount"])
    assert ("Ava", 2, 250) in _rows(out, "customer", "row_count", "sum_amount")
    assert ("Ivy", 1, 700) in _rows(out, "customer", "row_count", "sum_amount")
    # equals a recompute on the new state, also after deletes empty a key
    gone = new.filter(F.col("customer") != "Mia")
    out2 = ch.refresh_aggregate(out, ch.change_feed(new, gone, ["order_id"]), ["customer"], ["amount"])
    assert sorted(out2.collect()) == sorted(ch.aggregate_state(gone, ["customer"], ["amount"]).collect())


def test_pipeline_clean_and_revenue(spark):
    empty = spark.createDataFrame([], "order_id int, customer string, amount int, status string")
    landed = spark.createDataFrame([(1, "Ava", 100, "new"), (2, "Liam", 200, "new"), (3, "Ava", 50, "new")],
                                   empty.schema)
    clean = ch.clean_increment(ch.change_feed(empty, landed, ["order_id"]),
                               ["order_id", "customer", "amount", "status"], ["status"])
    assert {r["status"] for r in clean.collect()} == {"NEW"}
    rev = ch.aggregate_state(clean, ["customer"], ["amount"])
    assert ("Ava", 2, 150) in _rows(rev, "customer", "row_count", "sum_amount")


def test_upsert_semantics_and_idempotence(spark):
    target = spark.createDataFrame([("EU", "A", 1, 10.0), ("US", "A", 2, 20.0)],
                                   "region string, seg string, n int, v double")
    source = spark.createDataFrame([("US", "A", 5, 50.0), ("ASIA", "B", 7, 70.0)], target.schema)
    once = ch.upsert(target, source, ["region", "seg"], ["n", "v"])
    assert _rows(once, "region", "seg", "n", "v") == [
        ("ASIA", "B", 7, 70.0), ("EU", "A", 1, 10.0), ("US", "A", 5, 50.0)]
    twice = ch.upsert(once, source, ["region", "seg"], ["n", "v"])
    assert sorted(twice.collect()) == sorted(once.collect())


def test_upsert_rejects_duplicate_source_keys(spark):
    import pytest
    t = spark.createDataFrame([(1, 1)], "k int, v int")
    s = spark.createDataFrame([(1, 2), (1, 3)], "k int, v int")
    with pytest.raises(ValueError):
        ch.upsert(t, s, ["k"])


def test_update_delete_null_predicate(spark):
    amounts = [49.99, 219.00, 19.50, 1299.00, 89.00]  # fixed values: their sum is the golden one
    lake = spark.createDataFrame([(i, f"buyer {i}", f"thing {i}", a) for i, a in enumerate(amounts, 1)],
                                 "order_id int, customer string, product string, amount double")
    agg = lake.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast("decimal(10,2)")).alias("s")).first()
    assert agg["n"] == 5 and float(agg["s"]) == 1676.49
    upd = ch.update_rows(lake, F.col("order_id") == 4, {"amount": F.lit(999.00)})
    assert upd.filter("order_id = 4").first()["amount"] == 999.00
    nul = spark.createDataFrame([(1, None), (2, "x")], "k int, s string")
    assert ch.delete_rows(nul, F.col("s") == "x").count() == 1      # NULL predicate keeps row 1
    assert ch.update_rows(nul, F.col("s") == "x", {"k": F.lit(0)}).filter("k = 1").count() == 1


def test_time_travel_restore(spark):
    from tests.fixtures import retail_orders
    orders = retail_orders(spark)
    assert orders.count() == 12
    current = ch.delete_rows(orders, F.col("status") == "CANCELLED")
    assert current.count() == 9
    restored = ch.restore_missing(current, orders, "order_id", F.col("status") == "CANCELLED")
    assert restored.count() == 12
    clone = ch.delete_rows(restored, F.col("status") == "PENDING")
    assert (clone.count(), restored.count()) == (10, 12)


def test_state_as_of_and_before(spark):
    log = spark.createDataFrame([
        (1, dt.datetime(2026, 1, 1, 10), "INSERT", 10), (1, dt.datetime(2026, 1, 1, 12), "UPDATE", 11),
        (2, dt.datetime(2026, 1, 1, 11), "INSERT", 20), (2, dt.datetime(2026, 1, 1, 13), "DELETE", 20)],
        "k int, ts timestamp_ntz, op string, v int")
    at = ch.state_as_of(log, ["k"], "ts", "2026-01-01 12:00:00", op_col="op")
    assert _rows(at, "k", "v") == [(1, 11), (2, 20)]
    before = ch.state_as_of(log, ["k"], "ts", "2026-01-01 12:00:00", before=True, op_col="op")
    assert _rows(before, "k", "v") == [(1, 10), (2, 20)]
    now = ch.state_as_of(log, ["k"], "ts", "2026-01-02 00:00:00", op_col="op")
    assert _rows(now, "k", "v") == [(1, 11)]


def test_run_if_changed(spark):
    s = "k int, v int"
    a = spark.createDataFrame([(1, 1)], s)
    b = spark.createDataFrame([(1, 2)], s)
    ran = []
    assert ch.run_if_changed(ch.change_feed(a, a, ["k"]), lambda f: ran.append(1)) is None
    ch.run_if_changed(ch.change_feed(a, b, ["k"]), lambda f: ran.append(f.count()))
    assert ran == [2]


def test_feed_and_aggregate_with_null_keys(spark):
    """A NULL key is a value like any other, and a sum over NULLs
    alone is NULL."""
    s = "k int, id int, amount int"
    a = spark.createDataFrame([(None, 1, 10), (1, 2, 5), (2, 3, None)], s)
    b = spark.createDataFrame([(None, 1, 10), (None, 4, 7), (1, 5, None), (2, 3, None)], s)
    same = ch.change_feed(a.select("k", "amount"), a.select("k", "amount"), ["k"])
    assert same.count() == 0
    state = ch.aggregate_state(a, ["k"], ["amount"])
    new = ch.refresh_aggregate(state, ch.change_feed(a, b, ["id"]), ["k"], ["amount"])
    want = ch.aggregate_state(b, ["k"], ["amount"])
    key = lambda r: (r["k"] is not None, r["k"] or 0)
    assert sorted(new.collect(), key=key) == sorted(want.select(*new.columns).collect(), key=key)


def test_last_change_of_each_key(spark):
    """Several changes of a key in one batch leave its last one."""
    rows = [(1, "a", "INSERT", 1), (1, "a", "DELETE", 2), (1, "aa", "INSERT", 2), (1, "aa", "DELETE", 3), (1, "aaa", "INSERT", 3),
            (2, "b", "INSERT", 1), (3, "c", "INSERT", 1), (3, "c", "DELETE", 2), (None, "n", "INSERT", 1)]
    feed = spark.createDataFrame(rows, "k int, v string, action string, changed_at int")
    last = ch.last_changes(feed, ["k"])
    assert sorted(((r["k"] or 0), r["v"], r["action"]) for r in last.collect()) == [
        (0, "n", "INSERT"), (1, "aaa", "INSERT"), (2, "b", "INSERT"), (3, "c", "DELETE")]
    current = spark.createDataFrame([(3, "c"), (4, "d"), (None, "old")], "k int, v string")
    out = ch.apply_changes(current, last, last.filter("action = 'INSERT'").select("k", "v"), ["k"])
    assert sorted(((r["k"] or 0), r["v"]) for r in out.collect()) == [(0, "n"), (1, "aaa"), (2, "b"), (4, "d")]
