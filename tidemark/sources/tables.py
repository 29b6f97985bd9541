"""Parquet, CSV and model storage."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def save_series(series: DataFrame, path: str, keys: list[str] = ()) -> None:
    """Write series of several granularities, one directory each, clustered by day and series.

    Readers that filter on `granularity` open only that directory, and sorting by `ts`
    inside files lets time filters skip row groups.
    """
    series.repartition("granularity", F.to_date("ts"), *keys).sortWithinPartitions("granularity", *keys, "ts") \
        .write.mode("overwrite").partitionBy("granularity").parquet(path)


def load_series(spark: SparkSession, path: str, granularity: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Read saved series; a string or date `ts` is converted to a wall-clock timestamp."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    if granularity is not None:
        df = df.where(F.col("granularity") == granularity)
    if not isinstance(df.schema["ts"].dataType, T.TimestampNTZType):
        df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return df


def save_split(features: DataFrame, path: str) -> None:
    """Write a feature table with its `split` column as partition."""
    features.write.mode("overwrite").partitionBy("split").parquet(path)


def load_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("split") == split)


def save_report(df: DataFrame, path: str) -> None:
    """Write a report as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def load_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_coefficients(models: DataFrame, path: str) -> None:
    """Write per-series regression models; they are plain rows."""
    models.write.mode("overwrite").parquet(path)


def load_coefficients(spark: SparkSession, path: str) -> DataFrame:
    """Per-series regression models as they were saved."""
    return spark.read.parquet(path)
