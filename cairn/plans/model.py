"""Model training, registry and batch scoring with MLlib (M2-M6).

Training and scoring run on the executors next to the data. The boosted
regressor is MLlib's GBTRegressor (the source uses XGBoost, which is not
installed here, so numbers differ from the source's).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.operators import changes as ch
from cairn.plans.features import regression_metrics
from cairn.sources import writers

REGISTRY_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("version", T.StringType()),
    T.StructField("comment", T.StringType()), T.StructField("mae", T.DoubleType()),
    T.StructField("r2", T.DoubleType()), T.StructField("path", T.StringType()),
    T.StructField("registered_at", T.TimestampNTZType())])


def stable_split(df: DataFrame, key: str, seed: int = 42, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """M2: an 80/20 split that depends only on the row key and the seed (a
    hash bucket), so it does not change with partitioning or re-execution,
    unlike ``randomSplit``."""
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(100))
    return df.filter(bucket < train_pct), df.filter(bucket >= train_pct)


def train_regressor(train: DataFrame, features: Sequence[str], label: str, max_depth: int = 6,
                    n_trees: int = 200, seed: int = 42, prediction: str = "prediction") -> PipelineModel:
    """M3: assemble features and fit a boosted-tree regressor (depth 6, 200
    trees by default, as in the source)."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="_features", labelCol=label, predictionCol=prediction,
                       maxDepth=max_depth, maxIter=n_trees, seed=seed)
    return Pipeline(stages=[assembler, gbt]).fit(train)


def evaluate(model: PipelineModel, test: DataFrame, label: str, prediction: str = "prediction") -> dict:
    """M4: predict and score (MAE, R^2)."""
    pred = model.transform(test)
    row = regression_metrics(pred, label, prediction).first()
    return {"mae": row["mae"], "r2": row["r2"]}


def register_model(spark: SparkSession, model: PipelineModel, registry_root: str, name: str,
                   version: str, comment: str, metrics: dict) -> str:
    """M5: save the model under ``name/version`` and upsert its row in the
    registry table (re-registering the same version replaces it)."""
    path = f"{registry_root}/models/{name}/{version}"
    model.write().overwrite().save(path)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = spark.createDataFrame([(name, version, comment, float(metrics.get("mae") or 0.0),
                                  float(metrics.get("r2") or 0.0), path, now)], REGISTRY_SCHEMA)
    table = f"{registry_root}/registry"
    if writers.exists(spark, table):
        row = ch.upsert(writers.read_current(spark, table), row, ["name", "version"], check_unique=False)
    writers.write_version(row, table)
    return path


def show_models(spark: SparkSession, registry_root: str) -> DataFrame:
    return writers.read_current(spark, f"{registry_root}/registry")


def score_batch(spark: SparkSession, registry_root: str, name: str, version: str, rows: DataFrame,
                key: str, dst: str, prediction: str = "prediction") -> str:
    """M6: load a registered model and score a table in batch, writing
    (key, prediction) as a new version of ``dst``."""
    path = f"{registry_root}/models/{name}/{version}"
    model = PipelineModel.load(path)
    scored = model.transform(rows).select(key, prediction)
    return writers.write_version(scored, dst)
