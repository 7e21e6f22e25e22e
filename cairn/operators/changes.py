"""Table changes and change feeds as DataFrame rewrites (K5-K7, C1, C2, C4,
C5, C7, C8, C11, C12).

Parquet tables cannot be updated in place, so every change is a new
DataFrame that a versioned writer publishes (``cairn.sources.writers``).
All operators are joins / aggregates on key columns: they shuffle once on
the key and nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.predicates import delete_predicate, not_in_subquery

ACTION, IS_UPDATE, ROW_ID = "action", "is_update", "row_id"
INSERT, DELETE, UPDATE = "INSERT", "DELETE", "UPDATE"


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "source") -> None:
    """Raise when some key occurs twice (one aggregate job, partial-
    aggregated map-side; only the existence of a duplicate is fetched)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1)
    if not dup.isEmpty():
        raise ValueError(f"{what} keys {list(keys)} are not unique")


def outer_by_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on ``keys`` where NULL key parts equal each other."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys))
    joined = left.withColumn("_in_left", F.lit(True)).join(renamed, same, "full_outer")
    key = lambda k: F.when(F.col("_in_left"), F.col(k)).otherwise(F.col(f"_r_{k}"))
    return joined.withColumns({k: key(k) for k in keys}).drop("_in_left", *(f"_r_{k}" for k in keys))


# ------------------------------------------------------------- K5 - K7


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, check_unique: bool = True) -> DataFrame:
    """K5 MERGE: matched target rows take ``update_cols`` from the source,
    unmatched source rows are inserted, other target rows stay.

    One full outer join on the keys. Each side carries a ``lit(True)``
    marker, so a row's origin is known even when key or value columns are
    NULL. Source keys must be unique, as MERGE requires (checked)."""
    if check_unique:
        assert_unique(source, keys, "merge source")
    cols = [c for c in target.columns if c not in keys]
    update_cols = list(update_cols) if update_cols is not None else cols
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t"))
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols if c in source.columns],
                      F.lit(True).alias("_s"))
    j = outer_by_key(t, s, keys)
    out = []
    for c in cols:
        if c in update_cols and c in source.columns:
            out.append(F.when(F.col("_s").isNotNull(), F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        elif c in source.columns:  # not updated on match, but inserted when new
            out.append(F.when(F.col("_t").isNotNull(), F.col(f"_t_{c}")).otherwise(F.col(f"_s_{c}")).alias(c))
        else:
            out.append(F.col(f"_t_{c}").alias(c))
    return j.select(*keys, *out).select(*target.columns)


def update_rows(df: DataFrame, predicate: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """K6 UPDATE ... SET ... WHERE: rows where the predicate is TRUE take the
    new values (NULL predicate leaves the row)."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.withColumns({c: F.when(hit, e).otherwise(F.col(c)) for c, e in assignments.items()})


def delete_rows(df: DataFrame, predicate: Column) -> DataFrame:
    """K7 DELETE ... WHERE (NULL predicate keeps the row)."""
    return df.filter(delete_predicate(predicate))


# ------------------------------------------------------------- C1 - C7


def row_id(keys: Sequence[str]) -> Column:
    """A stable id per key: SHA-256 of the key values as text."""
    if len(keys) == 1:
        return F.sha2(F.coalesce(F.col(keys[0]).cast("string"), F.lit("\u0000")), 256)
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(F.col(k).cast("string"), F.lit("\u0000"))
                                          for k in keys]), 256)


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The net change between two states of a table.

    Rows get ``action`` INSERT / DELETE and ``is_update``: an update is a
    DELETE of the old row plus an INSERT of the new one, both with
    ``is_update`` TRUE; pure inserts and deletes have FALSE; unchanged rows
    and rows inserted then deleted in between do not appear. Keys must be
    unique in each state; a NULL key part is a value like any other.

    Plan: one full outer join on the keys (both sides shuffled once), a
    null-safe comparison of the non-key columns packed in a struct, and a
    generator that emits the old and / or new image."""
    cols = [c for c in before.columns if c not in keys]
    b = before.select(*keys, F.struct(*cols).alias("_old"), F.lit(True).alias("_b"))
    a = after.select(*keys, F.struct(*cols).alias("_new"), F.lit(True).alias("_a"))
    j = outer_by_key(b, a, keys)
    both = F.col("_b").isNotNull() & F.col("_a").isNotNull()
    changed = j.filter(~both | ~F.col("_old").eqNullSafe(F.col("_new")))
    images = F.array(
        F.when(F.col("_b").isNotNull(), F.struct(F.lit(DELETE).alias("a"), F.col("_old").alias("r"))),
        F.when(F.col("_a").isNotNull(), F.struct(F.lit(INSERT).alias("a"), F.col("_new").alias("r"))))
    rows = changed.select(*keys, both.alias(IS_UPDATE),
                          F.explode(F.filter(images, lambda x: x.isNotNull())).alias("_img"))
    return rows.select(*keys, *[F.col(f"_img.r.{c}").alias(c) for c in cols],
                       F.col("_img.a").alias(ACTION), F.col(IS_UPDATE), row_id(keys).alias(ROW_ID))


def as_inserts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """C1 for the first rows of a table: all of them are new (no join)."""
    return df.select("*", F.lit(INSERT).alias(ACTION), F.lit(False).alias(IS_UPDATE), row_id(keys).alias(ROW_ID))


def has_changes(feed: DataFrame) -> bool:
    """Does the feed hold any row? (stops at the first row found)."""
    return not feed.isEmpty()


def has_changes_frame(feed: DataFrame) -> DataFrame:
    """C2 as a one-row frame (the feed's join runs; one row of it is kept)."""
    return feed.select(F.lit(1).alias("_x")).limit(1).agg((F.count("_x") > 0).alias("has_changes"))


def label_changes(feed: DataFrame, out: str = "change_type") -> DataFrame:
    """C4: UPDATE for the new half of an update, INSERT, and DELETE for all
    else, so the old half of an update is labelled DELETE."""
    return feed.withColumn(out, F.when((F.col(ACTION) == INSERT) & F.col(IS_UPDATE), UPDATE)
                                 .when(F.col(ACTION) == INSERT, INSERT).otherwise(DELETE))


def clean_increment(feed: DataFrame, columns: Sequence[str], upper_cols: Sequence[str] = ()) -> DataFrame:
    """New rows only (action INSERT), normalised."""
    return feed.filter(F.col(ACTION) == INSERT).select(
        *[F.upper(F.col(c)).alias(c) if c in upper_cols else F.col(c) for c in columns])


def rebuild_summary(history: DataFrame, key: str, amount: str, out: str = "total_amount") -> DataFrame:
    """Summary rebuilt from the history table. As in the source job it
    sums every history row regardless of change type (both halves of an
    update and deleted rows count)."""
    return history.groupBy(key).agg(F.sum(amount).alias(out))


def run_if_changed(feed: DataFrame, fn):
    """Run ``fn(feed)`` only when the feed has data; else skip (None)."""
    return fn(feed) if has_changes(feed) else None


# ------------------------------------------------------------- C8


def aggregate_state(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
                    count_col: str = "row_count") -> DataFrame:
    """Initial state of a maintained COUNT / SUM aggregate: the rows of each
    key, and for each measure its sum and how many values it has (a sum over
    NULLs alone is NULL)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col),
                                 *[F.sum(m).alias(f"sum_{m}") for m in measures],
                                 *[F.count(m).alias(f"count_{m}") for m in measures])


def signed_sums(feed: DataFrame, keys: Sequence[str], measures: Sequence[str], count_col: str = "row_count") -> DataFrame:
    """A feed as one row per key: what it adds to the key's count and sums.
    Each feed row is a signed delta (+1 for INSERT, -1 for DELETE; an update
    is its two halves)."""
    sign = F.when(F.col(ACTION) == INSERT, 1).otherwise(-1)
    rows = feed.select(*keys, sign.alias(count_col), *[(sign * F.col(m)).alias(f"sum_{m}") for m in measures],
                       *[F.when(F.col(m).isNotNull(), sign).otherwise(0).alias(f"count_{m}") for m in measures])
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _parts(measures, count_col)])


def _parts(measures: Sequence[str], count_col: str) -> list[str]:
    return [count_col, *[f"sum_{m}" for m in measures], *[f"count_{m}" for m in measures]]


def fold(state: DataFrame, deltas: DataFrame, keys: Sequence[str], measures: Sequence[str], count_col: str = "row_count") -> DataFrame:
    """A stored COUNT / SUM aggregate and signed sums, as the new aggregate.
    State and deltas are one union, aggregated once per key: no join, and NULL
    keys group like any other. Keys whose count drops to 0 disappear."""
    parts = _parts(measures, count_col)
    total = lambda c: F.sum(c).cast(state.schema[c].dataType).alias(c)
    both = state.select(*keys, *parts).unionByName(deltas.select(*keys, *parts)).groupBy(*keys).agg(*map(total, parts)).filter(F.col(count_col) > 0)
    return both.withColumns({f"sum_{m}": F.when(F.col(f"count_{m}") > 0, F.col(f"sum_{m}")) for m in measures})


def refresh_aggregate(state: DataFrame, feed: DataFrame, keys: Sequence[str],
                      measures: Sequence[str], count_col: str = "row_count") -> DataFrame:
    """Fold a change feed into a stored COUNT / SUM aggregate. Partial
    aggregation leaves one row of a hot key per task. The result equals a
    recompute over the new table state."""
    return fold(state, signed_sums(feed, keys, measures, count_col), keys, measures, count_col)


def last_changes(feed: DataFrame, keys: Sequence[str], time_col: str = "changed_at") -> DataFrame:
    """The last change of every key in a feed that may hold several. Both
    halves of an update share a time; the new row is the later one. Feeds that
    may share a time are told apart by a number: pass their version (as
    ``streaming.layers`` does) or a struct of time and sequence."""
    others = [c for c in feed.columns if c not in keys]
    order = F.struct(F.col(time_col), (F.col(ACTION) == INSERT).alias("new"))
    last = feed.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in others])


def apply_changes(current: DataFrame, last: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``current`` without the keys of ``last``, plus the rows of ``new``."""
    touched = last.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys))
    return current.join(touched, same, "left_anti").unionByName(new.select(*current.columns))


# ------------------------------------------------------------- C11, C12


def state_as_of(changes: DataFrame, keys: Sequence[str], ts_col: str, as_of,
                before: bool = False, op_col: str | None = None,
                delete_values: Sequence[str] = (DELETE,), tiebreak: Sequence[str] = ()) -> DataFrame:
    """C11: the table as it was at ``as_of`` (AT, ``ts <= T``) or just
    before it (BEFORE, ``ts < T``), replayed from a change log: the latest
    change per key wins, and keys whose latest change is a delete are gone.

    Latest-per-key is a ``max_by`` aggregate, not a window: partial
    aggregation keeps one row per key per map task, so a key holding a third
    of the log is reduced before the shuffle."""
    t = F.lit(as_of).cast(changes.schema[ts_col].dataType)
    live = changes.filter(F.col(ts_col) < t if before else F.col(ts_col) <= t)
    cols = [c for c in changes.columns if c not in keys]
    order = F.struct(F.col(ts_col), *[F.col(c) for c in tiebreak])
    latest = live.groupBy(*keys).agg(F.max_by(F.struct(*cols), order).alias("_r"))
    out = latest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])
    if op_col is not None:
        out = out.filter(~F.coalesce(F.col(op_col).isin(*delete_values), F.lit(False)))
    return out


def restore_missing(current: DataFrame, before: DataFrame, key: str, predicate: Column) -> DataFrame:
    """Put back rows of an earlier state that match ``predicate`` and
    whose key is no longer present (``NOT IN`` semantics), appended to the
    current rows."""
    missing = not_in_subquery(before.filter(predicate), key, current, key)
    return current.unionByName(missing)
