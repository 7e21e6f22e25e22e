"""D3 sales refresh job and the ML path (M2-M6)."""

import pytest
from pyspark.sql import functions as F

from cairn.plans import model as ml
from cairn.plans.sales_job import refresh_sales_analytics
from cairn.sources import writers
from tests.conftest import SF_SMALL


def test_sales_refresh_idempotent_and_audited(spark, tmp_dir):
    msg = refresh_sales_analytics(spark, SF_SMALL, tmp_dir, "BUILDING", "1997-01-01", 5)
    assert msg.startswith("5 segments and ")
    summary = writers.read_current(spark, f"{tmp_dir}/sales_summary")
    assert summary.count() == 5
    assert {r["market_segment"] for r in summary.collect()} == {"BUILDING"}
    refresh_sales_analytics(spark, SF_SMALL, tmp_dir, "BUILDING", "1997-01-01", 5)
    assert writers.read_current(spark, f"{tmp_dir}/sales_summary").count() == 5     # MERGE, no duplicates
    refresh_sales_analytics(spark, SF_SMALL, tmp_dir, "ALL", "1997-01-01", 5)
    assert writers.read_current(spark, f"{tmp_dir}/sales_summary").count() == 25    # new segments inserted
    top = writers.read_current(spark, f"{tmp_dir}/top_customers")
    per_group = top.groupBy("region", "market_segment").agg(F.max("revenue_rank").alias("m")).collect()
    assert all(r["m"] <= 5 for r in per_group)
    audit = spark.read.parquet(f"{tmp_dir}/refresh_audit").collect()
    assert len(audit) == 3 and {r["status"] for r in audit} == {"SUCCESS"}


def test_sales_refresh_failure_writes_failed_audit(spark, tmp_dir):
    with pytest.raises(Exception):
        refresh_sales_analytics(spark, f"{tmp_dir}/no_such_dir", tmp_dir, "ALL", "1997-01-01", 5)
    audit = spark.read.parquet(f"{tmp_dir}/refresh_audit").collect()
    assert len(audit) == 1 and audit[0]["status"].startswith("FAILED")
    assert audit[0]["segment_rows"] == 0


def _delivery_data(spark, n=600):
    """Rows from a known signal plus noise (a Spark expression), so a fitted
    model must find real structure."""
    base = spark.range(n).select(
        F.col("id").alias("order_id"),
        (F.rand(42) * 50 + 1).alias("distance_km"),
        (F.rand(43) * 20 + 0.5).alias("package_weight_kg"),
        F.floor(F.rand(44) * 3).cast("int").alias("priority_code"),
        F.floor(F.rand(45) * 4).cast("int").alias("handoffs"),
        F.floor(F.rand(46) * 5).cast("int").alias("prior_delays"))
    y = (F.col("distance_km") * 1.5 + F.col("package_weight_kg") * 0.8 + F.col("handoffs") * 6
         + F.col("prior_delays") * 4 - F.col("priority_code") * 5 + F.randn(47) * 3)
    return base.withColumn("delivery_delay_minutes", y)


FEATS = ["distance_km", "package_weight_kg", "priority_code", "handoffs", "prior_delays"]




def test_train_register_score(spark, tmp_dir):
    data = _delivery_data(spark).cache()
    train, test = ml.stable_split(data, "order_id")
    train2, _ = ml.stable_split(data.repartition(7), "order_id")
    assert sorted(r["order_id"] for r in train.collect()) == sorted(r["order_id"] for r in train2.collect())
    n_train, n = train.count(), data.count()
    assert 0.7 < n_train / n < 0.9
    model = ml.train_regressor(train, FEATS, "delivery_delay_minutes")        # depth 6, 200 trees
    metrics = ml.evaluate(model, test, "delivery_delay_minutes")
    assert metrics["r2"] > 0.5 and metrics["mae"] > 0
    ml.register_model(spark, model, tmp_dir, "DELIVERY_DELAY_MODEL", "V1", "boosted trees", metrics)
    ml.register_model(spark, model, tmp_dir, "DELIVERY_DELAY_MODEL", "V1", "re-registered", metrics)
    reg = ml.show_models(spark, tmp_dir).collect()
    assert len(reg) == 1 and reg[0]["comment"] == "re-registered"
    out = ml.score_batch(spark, tmp_dir, "DELIVERY_DELAY_MODEL", "V1", data.select("order_id", *FEATS),
                         "order_id", f"{tmp_dir}/predictions")
    pred = spark.read.parquet(out)
    assert pred.count() == n and pred.filter(F.col("prediction").isNull()).count() == 0
