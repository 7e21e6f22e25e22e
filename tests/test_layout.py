"""Clustering audits of stored tables from the footers of their files."""

import datetime as dt

from pyspark.sql import functions as F

from cairn.operators import layout
from tests.conftest import SF_SMALL


def _intervals(df):
    return sorted((r["lo"], r["hi"]) for r in df.collect())


def test_footers_agree_with_the_rows(spark, tmp_dir):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    o.repartition(7).write.parquet(f"{tmp_dir}/t")
    stored = spark.read.parquet(f"{tmp_dir}/t")
    for column in ("o_orderdate", "o_orderkey", "o_totalprice", "o_orderstatus"):  # the last two are read from rows
        rows = layout.file_intervals(stored, column).withColumnRenamed("file", "part")
        got = layout.stored_intervals(spark, f"{tmp_dir}/t", column)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))
    bounds = layout.footer_bounds(spark, f"{tmp_dir}/t", "o_orderdate").collect()
    assert all(b["known"] for b in bounds) and sum(b["rows"] for b in bounds) == o.count()
    assert not any(b["known"] for b in layout.footer_bounds(spark, f"{tmp_dir}/t", "o_orderstatus").collect())


def test_files_without_values_and_added_columns(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.range(5).select(F.col("id").alias("k"), F.lit(None).cast("date").alias("d")).coalesce(1).write.parquet(path)
    spark.range(3).select(F.col("id").alias("k")).coalesce(1).write.mode("append").parquet(path)
    days = [(9, dt.date(2024, 2, 3)), (8, None), (7, dt.date(2023, 1, 1))]
    spark.createDataFrame(days, "k long, d date").coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([], "k long, d date").coalesce(1).write.mode("append").parquet(path)
    spark.conf.set("spark.sql.parquet.mergeSchema", "true")
    try:
        found = layout.footer_bounds(spark, path, "d").collect()
        assert sorted((r["rows"], r["known"], r["lo"], r["hi"]) for r in found if r["lo"]) == [(3, True, dt.date(2023, 1, 1), dt.date(2024, 2, 3))]
        assert sorted(r["rows"] for r in found if not r["lo"] and r["known"] and r["rows"]) == [3, 5]
        assert _intervals(layout.stored_intervals(spark, path, "d")) == [(dt.date(2023, 1, 1), dt.date(2024, 2, 3))]
    finally:
        spark.conf.unset("spark.sql.parquet.mergeSchema")


def test_files_without_statistics_are_read(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    import pyarrow as pa
    import pyarrow.parquet as pq

    spark.range(0, 50).select(F.col("id").alias("k")).coalesce(1).write.parquet(path)
    pq.write_table(pa.table({"k": pa.array([70, None, 60], pa.int64())}), f"{path}/plain.parquet", write_statistics=False)
    assert sorted(r["known"] for r in layout.footer_bounds(spark, path, "k").collect()) == [False, True]
    assert _intervals(layout.stored_intervals(spark, path, "k")) == [(0, 49), (60, 70)]


def test_paths_with_odd_characters(spark, tmp_dir):
    path = f"{tmp_dir}/a b%20c"
    df = spark.range(40).select(F.col("id").alias("k"), F.concat(F.lit("x/ %é"), F.col("id") % 2).alias("folder"))
    df.repartition("folder").write.partitionBy("folder").parquet(path)
    assert _intervals(layout.stored_intervals(spark, path, "k")) == [(0, 38), (1, 39)]


def test_sorted_copy_has_depth_one(spark, tmp_dir):
    df = spark.range(4000).select((F.col("id") * 7919 % 4000).alias("k"))
    df.repartition(8).write.parquet(f"{tmp_dir}/n")
    layout.write_clustered(df, f"{tmp_dir}/s", "k", n_files=8)
    info = [layout.information(layout.stored_intervals(spark, f"{tmp_dir}/{p}", "k")).first() for p in "ns"]
    assert info[0]["average_depth"] == info[0]["total_partition_count"] == 8
    assert (info[1]["total_partition_count"], info[1]["average_overlaps"], info[1]["average_depth"]) == (8, 0.0, 1.0)
