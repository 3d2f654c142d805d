"""Writers and readers of results, splits and fitted models."""

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLITS = ("train", "val", "test")


def save_splits(train, val, test, path):
    """The three splits as Parquet, their date columns as dates (bad text is null)."""
    for name, df in zip(SPLITS, (train, val, test)):
        for c in ("first_donation_date", "last_donation_date"):
            if c in df.columns:
                df = df.withColumn(c, F.col(c).try_cast("date"))
        df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")


def load_splits(spark: SparkSession, path):
    return tuple(spark.read.parquet(f"{path}/{name}.parquet") for name in SPLITS)


def write_csv(df: DataFrame, path):
    """CSV part files with a header, written by all tasks."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path):
    """One JSON object per row; struct, map and array columns stay nested."""
    df.write.mode("overwrite").json(path)


def save_model(model: PipelineModel, metrics: DataFrame, path, **facts):
    """A fitted pipeline, its metrics and some facts about it (feature names and so on)."""
    spark = metrics.sparkSession
    model.write().overwrite().save(f"{path}/model")
    metrics.write.mode("overwrite").parquet(f"{path}/metrics")
    spark.createDataFrame([(json.dumps(facts),)], "facts string").write.mode("overwrite").json(
        f"{path}/facts"
    )


def load_model(spark: SparkSession, path):
    """(model, metrics, facts) as saved."""
    facts = json.loads(spark.read.schema("facts string").json(f"{path}/facts").first()["facts"])
    return PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/metrics"), facts
