"""Registered clustering audits (L1, L2) on stored copies of ``orders``.

Two copies of the table are written into the shared folder and audited on
``o_orderdate`` through the footers of their files: one in load order (a file
for 1,000 order keys; dates are random, so every file spans nearly the whole
date range) and one by date (a file for a month). The folder that a row lies
in is a rule on the row, so the oracle knows the files; it computes overlaps
and depth with plain self-joins.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.operators import layout
from cairn.plans.registry import register
from cairn.session import read_table
from cairn.sources import files


def _copy(spark, root, natural: bool) -> str:
    """The path of a copy of ``orders``, one file in each folder."""
    o = read_table(spark, root, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    folder = F.floor(F.col("o_orderkey") / 1000) if natural else F.date_format("o_orderdate", "yyyyMM")
    path = files.shared_folder(spark, "orders-copy")
    o.withColumn("folder", folder.cast("bigint")).repartition("folder").write.partitionBy("folder").parquet(path)
    return path


def _intervals(spark, root, natural: bool):
    return layout.stored_intervals(spark, _copy(spark, root, natural), "o_orderdate")


def _oracle(part_sql: str, final: str) -> str:
    return f"""
WITH iv AS (SELECT {part_sql} AS p, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY 1),
ov AS (SELECT a.p, count(*) - 1 AS ovl FROM iv a JOIN iv b ON b.lo <= a.hi AND b.hi >= a.lo GROUP BY a.p),
pts AS (SELECT DISTINCT a.p, b.lo AS x FROM iv a JOIN iv b ON b.lo BETWEEN a.lo AND a.hi),
cov AS (SELECT pts.p, pts.x, count(*) AS c FROM pts JOIN iv c ON c.lo <= pts.x AND c.hi >= pts.x
        GROUP BY pts.p, pts.x),
dp AS (SELECT p, max(c) AS depth FROM cov GROUP BY p),
per AS (SELECT ov.p, ovl, depth FROM ov JOIN dp ON ov.p = dp.p)
{final}"""


_INFO = """SELECT CAST(count(*) AS BIGINT) AS total_partition_count, round(avg(ovl), 6) AS average_overlaps,
       round(avg(depth), 6) AS average_depth FROM per"""
_HIST = "SELECT CAST(depth AS BIGINT) AS depth, CAST(count(*) AS BIGINT) AS partitions FROM per GROUP BY depth"
_NATURAL = "o_orderkey // 1000"
_SORTED = "CAST(strftime(o_orderdate, '%Y%m') AS INTEGER)"


@register("clustering_information", oracle=_oracle(_NATURAL, _INFO))
def clustering_information(spark, root):
    """L1 on the load order: high overlap and depth."""
    return layout.information(_intervals(spark, root, True))


@register("clustering_information_sorted", oracle=_oracle(_SORTED, _INFO))
def clustering_information_sorted(spark, root):
    """L1 on the copy by date: no overlap, depth 1."""
    return layout.information(_intervals(spark, root, False))


@register("clustering_histogram", oracle=_oracle(_NATURAL, _HIST))
def clustering_histogram(spark, root):
    """L1: depth histogram of the files in load order."""
    return layout.histogram(_intervals(spark, root, True))


@register("clustering_depth", oracle=_oracle(_NATURAL, "SELECT round(avg(depth), 6) AS average_depth FROM per"))
def clustering_depth(spark, root):
    """L2: the single depth number."""
    return layout.information(_intervals(spark, root, True)).select("average_depth")


@register("file_bounds", oracle=f"""
SELECT CAST(count(*) AS BIGINT) AS rows, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY {_NATURAL}""")
def file_bounds(spark, root):
    """L1: rows and bounds of every file, as its footer tells them."""
    return layout.footer_bounds(spark, _copy(spark, root, True), "o_orderdate").select("rows", "lo", "hi")
