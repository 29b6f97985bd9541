"""Binary files written and read by Spark, so that any store it can reach will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here, and a lost executor costs nothing."""
    path = f"{scratch_dir(df.sparkSession, purpose)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_blobs(df: DataFrame, column: str, folder: str, end: str) -> None:
    """Each value of a binary column as one file, followed by `end`."""
    df.select(F.col(column).cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("lineSep", end).text(folder)


def read_blobs(spark: SparkSession, folder: str) -> DataFrame:
    """Path and content of each file."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
