"""Registered change-feed and table-change queries (K5-K7, C1, C2, C4, C5,
C7, C8, C11, C12).

Two states of ``orders`` stand for a table before and after a batch of DML:
pending orders (status P) are deleted, urgent orders are set to status F,
and orders from 2001 on land again under new keys (key + 10^9) with their
status in lower case, as raw rows arrive.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.functions import money
from cairn.operators import changes as ch
from cairn.plans.registry import register
from cairn.session import read_table
from cairn.sources import files
from cairn.sources.keyed import KeyedTable
from cairn.streaming.deltas import DeltaAggregate
from cairn.streaming.snapshots import SnapshotLog

NEW_KEY_OFFSET = 1_000_000_000


def order_states(spark, root):
    before = read_table(spark, root, "orders")
    kept = ch.delete_rows(before, F.col("o_orderstatus") == "P")
    updated = ch.update_rows(kept, F.col("o_orderpriority") == "1-URGENT", {"o_orderstatus": F.lit("F")})
    landed = (before.filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
                    .withColumn("o_orderkey", F.col("o_orderkey") + NEW_KEY_OFFSET)
                    .withColumn("o_orderstatus", F.lower("o_orderstatus")))
    return before, updated.unionByName(landed)


def order_feed(spark, root):
    before, after = order_states(spark, root)
    return ch.change_feed(before, after, ["o_orderkey"])


_COLS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_DIFF = " OR ".join(f"b.{c} IS DISTINCT FROM a.{c}" for c in _COLS)

_FEED = f"""
WITH before AS (SELECT * FROM orders),
after AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE NOT coalesce(o_orderstatus = 'P', false)
  UNION ALL
  SELECT o_orderkey + {NEW_KEY_OFFSET}, o_custkey, lower(o_orderstatus), o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'),
feed AS (
  SELECT b.*, 'DELETE' AS action, a.o_orderkey IS NOT NULL AS is_update
  FROM before b LEFT JOIN after a ON b.o_orderkey = a.o_orderkey
  WHERE a.o_orderkey IS NULL OR {_DIFF}
  UNION ALL
  SELECT a.*, 'INSERT' AS action, b.o_orderkey IS NOT NULL AS is_update
  FROM after a LEFT JOIN before b ON b.o_orderkey = a.o_orderkey
  WHERE b.o_orderkey IS NULL OR {_DIFF})
"""

_MONEY = "CAST(CAST(sum(CAST({c} AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS DOUBLE)"


@register("change_feed", oracle=_FEED + "SELECT *, sha256(CAST(o_orderkey AS VARCHAR)) AS row_id FROM feed")
def change_feed(spark, root):
    """Net change feed between two table states."""
    return order_feed(spark, root)


@register("has_changes", oracle=_FEED + "SELECT count(*) > 0 AS has_changes FROM feed")
def has_changes(spark, root):
    """Does the feed hold any row."""
    return ch.has_changes_frame(order_feed(spark, root))


@register("change_labels", oracle=_FEED + """
SELECT o_orderkey, o_orderstatus, o_totalprice,
       CASE WHEN action = 'INSERT' AND is_update THEN 'UPDATE'
            WHEN action = 'INSERT' THEN 'INSERT' ELSE 'DELETE' END AS change_type
FROM feed""")
def change_labels(spark, root):
    """C4: UPDATE / INSERT / DELETE labels (old half of an update is DELETE)."""
    return ch.label_changes(order_feed(spark, root)).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "change_type")


@register("clean_increment", oracle=_FEED + """
SELECT o_orderkey, o_custkey, upper(o_orderstatus) AS o_orderstatus, o_totalprice, o_orderdate
FROM feed WHERE action = 'INSERT'""")
def clean_increment(spark, root):
    """Insert-only increment with UPPER(status)."""
    return ch.clean_increment(order_feed(spark, root),
                              ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"],
                              upper_cols=["o_orderstatus"])


@register("history_summary", oracle=_FEED + f"""
SELECT o_custkey, {_MONEY.format(c='o_totalprice')} AS total_amount FROM feed GROUP BY o_custkey""")
def history_summary(spark, root):
    """Summary rebuilt from the labelled history (sums every history
    row, whatever its change type, as the source job does)."""
    hist = ch.label_changes(order_feed(spark, root)).withColumn("amount", money.price("o_totalprice"))
    return (ch.rebuild_summary(hist, "o_custkey", "amount")
              .select("o_custkey", money.to_money(F.col("total_amount")).alias("total_amount")))


@register("incremental_aggregate", oracle=_FEED + f"""
SELECT o_custkey, CAST(count(*) AS BIGINT) AS row_count, {_MONEY.format(c='o_totalprice')} AS sum_amount
FROM after GROUP BY o_custkey""")
def incremental_aggregate(spark, root):
    """COUNT / SUM per customer kept up to date by folding the change
    feed into the stored aggregate; equals a recompute on the new state."""
    before, after = order_states(spark, root)
    amt = money.price("o_totalprice")
    state = ch.aggregate_state(before.withColumn("amount", amt), ["o_custkey"], ["amount"])
    feed = ch.change_feed(before, after, ["o_orderkey"]).withColumn("amount", amt)
    new = ch.refresh_aggregate(state, feed, ["o_custkey"], ["amount"])
    return new.select("o_custkey", "row_count", money.to_money(F.col("sum_amount")).alias("sum_amount"))


_TWO_STATES = """
WITH before AS (SELECT CASE WHEN o_custkey % 10 <> 3 THEN o_custkey END AS custkey, o_orderkey,
    CASE WHEN o_orderkey % 4 <> 1 THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS amount FROM orders WHERE o_orderkey % 7 <> 0),
after AS (SELECT CASE WHEN o_custkey % 10 <> 3 THEN o_custkey END AS custkey, o_orderkey,
    CASE WHEN o_orderkey % 4 <> 1 THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS amount FROM orders WHERE o_orderkey % 5 <> 0)"""


def _null_key_states(spark, root):
    o = read_table(spark, root, "orders")
    rows = o.select(F.when(F.col("o_custkey") % 10 != 3, F.col("o_custkey")).alias("custkey"), "o_orderkey",
                    F.when(F.col("o_orderkey") % 4 != 1, money.price("o_totalprice")).alias("amount"))
    return rows.filter(F.col("o_orderkey") % 7 != 0), rows.filter(F.col("o_orderkey") % 5 != 0)


@register("change_feed_null_keys", oracle=_TWO_STATES + """
, b AS (SELECT custkey, CAST(sum(amount) AS DOUBLE) AS total FROM before GROUP BY custkey),
a AS (SELECT custkey, CAST(sum(amount) AS DOUBLE) AS total FROM after GROUP BY custkey)
SELECT b.custkey, b.total, 'DELETE' AS action, a.total IS NOT NULL OR EXISTS (SELECT 1 FROM a x WHERE x.custkey IS NOT DISTINCT FROM b.custkey) AS is_update
FROM b LEFT JOIN a ON a.custkey IS NOT DISTINCT FROM b.custkey
WHERE a.total IS DISTINCT FROM b.total OR NOT EXISTS (SELECT 1 FROM a x WHERE x.custkey IS NOT DISTINCT FROM b.custkey)
UNION ALL
SELECT a.custkey, a.total, 'INSERT', EXISTS (SELECT 1 FROM b x WHERE x.custkey IS NOT DISTINCT FROM a.custkey)
FROM a LEFT JOIN b ON a.custkey IS NOT DISTINCT FROM b.custkey
WHERE a.total IS DISTINCT FROM b.total OR NOT EXISTS (SELECT 1 FROM b x WHERE x.custkey IS NOT DISTINCT FROM a.custkey)""")
def change_feed_null_keys(spark, root):
    """C1 on a table whose key may be NULL (totals per customer)."""
    total = lambda df: df.groupBy("custkey").agg(F.sum("amount").cast("double").alias("total"))
    before, after = _null_key_states(spark, root)
    return ch.change_feed(total(before), total(after), ["custkey"]).select("custkey", "total", "action", "is_update")


@register("incremental_aggregate_nulls", oracle=_TWO_STATES + """
SELECT custkey, CAST(count(*) AS BIGINT) AS row_count, CAST(sum(amount) AS DOUBLE) AS sum_amount FROM after GROUP BY custkey""")
def incremental_aggregate_nulls(spark, root):
    """C8 with a NULL group key and sums over NULLs."""
    before, after = _null_key_states(spark, root)
    state = ch.aggregate_state(before, ["custkey"], ["amount"])
    new = ch.refresh_aggregate(state, ch.change_feed(before, after, ["o_orderkey"]), ["custkey"], ["amount"])
    return new.select("custkey", "row_count", F.col("sum_amount").cast("double").alias("sum_amount"))


@register("aggregate_of_deltas", oracle=_FEED + f"""
SELECT o_custkey, CAST(count(*) AS BIGINT) AS row_count, {_MONEY.format(c='o_totalprice')} AS sum_amount
FROM after GROUP BY o_custkey""")
def aggregate_of_deltas(spark, root):
    """C8 / C3 stored: the aggregate as a base and one delta per batch of
    changes (by key, so an order's two halves meet in one), folded into a new base after
    the second. Equals a recompute; the state lies in a folder of its own."""
    before, after = order_states(spark, root)
    amt = money.price("o_totalprice")
    state = DeltaAggregate(files.shared_folder(spark, "aggregate"), ("o_custkey",), ("amount",))
    state.start(before.withColumn("amount", amt))
    feed = files.staged(ch.change_feed(before, after, ["o_orderkey"]).withColumn("amount", amt), "order-changes")
    for batch, pick in enumerate((F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") % 3 == 1, F.col("o_orderkey") % 3 == 2), start=1):
        state.add(feed.filter(pick), batch)
        if batch == 2:
            state.compact(spark, share=0.0)
    return state.read(spark).select("o_custkey", "row_count", money.to_money(F.col("sum_amount")).alias("sum_amount"))


@register("update_touched_folders", oracle="""
SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 7 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
FROM orders WHERE NOT coalesce(o_orderkey % 100 = 13, false)""")
def update_touched_folders(spark, root):
    """K6 / K7 on a stored keyed table: an update and a delete that rewrite
    the folders of their keys only."""
    table = KeyedTable(files.shared_folder(spark, "orders-by-key"), ("o_orderkey",), 16)
    table.create(read_table(spark, root, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"))
    table.update_where(spark, F.col("o_orderkey") % 100 == 7, {"o_orderstatus": F.lit("X")}, 1)
    table.delete_where(spark, F.col("o_orderkey") % 100 == 13, 2)
    return table.read(spark)


_AS_OF = """
WITH live AS (SELECT * FROM events WHERE ts {op} TIMESTAMP '2024-01-15 00:00:00'),
latest AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM live)
SELECT user_id, event_id, ts, event_type, value, props FROM latest WHERE rn = 1 AND event_type <> 'error'"""


@register("state_as_of", oracle=_AS_OF.format(op="<="))
def state_as_of(spark, root):
    """C11: state per user as of a time, replayed from the event log
    (an ``error`` event deletes the user's row)."""
    ev = read_table(spark, root, "events")
    return ch.state_as_of(ev, ["user_id"], "ts", "2024-01-15 00:00:00", before=False,
                          op_col="event_type", delete_values=["error"], tiebreak=["event_id"]).select(
        "user_id", "event_id", "ts", "event_type", "value", "props")


@register("state_before", oracle=_AS_OF.format(op="<"))
def state_before(spark, root):
    """C11 with BEFORE semantics (strictly earlier changes)."""
    ev = read_table(spark, root, "events")
    return ch.state_as_of(ev, ["user_id"], "ts", "2024-01-15 00:00:00", before=True,
                          op_col="event_type", delete_values=["error"], tiebreak=["event_id"]).select(
        "user_id", "event_id", "ts", "event_type", "value", "props")


@register("state_from_snapshots", oracle=_AS_OF.format(op="<="))
def state_from_snapshots(spark, root):
    """C11 on a stored log with the states after two days under it: the read
    starts from the later one and replays the days since. The log lies in a
    folder of its own."""
    log = SnapshotLog(files.shared_folder(spark, "event-log"), ("user_id",), "ts", "event_type", ("error",), ("event_id",))
    log.append(read_table(spark, root, "events"))
    log.snapshot(spark, ["2024-01-07", "2024-01-12"])
    return log.state_as_of(spark, "2024-01-15 00:00:00").select("user_id", "event_id", "ts", "event_type", "value", "props")


@register("restore_missing", oracle="SELECT * FROM orders")
def restore_missing(spark, root):
    """After deleting every finished order by mistake, restore the
    rows from the earlier state whose key is now missing."""
    before = read_table(spark, root, "orders")
    current = ch.delete_rows(before, F.col("o_orderstatus") == "F")
    return ch.restore_missing(current, before, "o_orderkey", F.col("o_orderstatus") == "F")


@register("update_rows", oracle="""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def update_rows(spark, root):
    """K6: UPDATE ... SET status = 'X' WHERE priority = '1-URGENT'."""
    o = read_table(spark, root, "orders")
    return ch.update_rows(o, F.col("o_orderpriority") == "1-URGENT", {"o_orderstatus": F.lit("X")})


@register("delete_rows", oracle="SELECT * FROM orders WHERE NOT coalesce(o_totalprice > 400000, false)")
def delete_rows(spark, root):
    """K7: DELETE ... WHERE (NULL predicate keeps the row)."""
    return ch.delete_rows(read_table(spark, root, "orders"), F.col("o_totalprice") > 400000)


_REV = ("SELECT o_custkey, " + _MONEY.format(c="o_totalprice") +
        " AS revenue, CAST(count(*) AS BIGINT) AS order_count FROM orders WHERE {w} GROUP BY o_custkey")


@register("merge_upsert", oracle=f"""
WITH t AS ({_REV.format(w="o_orderdate < TIMESTAMP '1998-01-01'")}),
     s AS ({_REV.format(w="o_orderdate >= TIMESTAMP '1998-01-01'")})
SELECT * FROM s UNION ALL SELECT * FROM t WHERE o_custkey NOT IN (SELECT o_custkey FROM s)""")
def merge_upsert(spark, root):
    """MERGE per-customer revenue since 1998 into the table built
    from earlier orders: matched rows updated, new customers inserted."""
    o = read_table(spark, root, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")

    def rev(df):
        return df.groupBy("o_custkey").agg(money.to_money(F.sum(money.price("o_totalprice"))).alias("revenue"),
                                           F.count(F.lit(1)).alias("order_count"))

    target = rev(o.filter(F.col("o_orderdate") < cut))
    source = rev(o.filter(F.col("o_orderdate") >= cut))
    return ch.upsert(target, source, ["o_custkey"], ["revenue", "order_count"], check_unique=False)
