"""Log store and series kept by day: new logs touch only the days they bring records of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.series import all_granularities, fill_grid, mark_outages
from tidemark.schemas import GRANULARITIES, OUTAGE, SAVED_GRANULARITIES


def add_batch(logs: DataFrame, store: str, batch: str, ts: str = "timestamp") -> DataFrame:
    """Write a batch of log records by day and return its days, `(day)`.

    A batch is written whole under its name, so writing it again leaves the store as it was; a batch never changes.
    Records without a time belong to no day and are left out. Days that hold much of a batch are split over several files.
    """
    timed = logs.where(F.col(ts).isNotNull()).withColumn("day", F.to_date(ts))
    place = f"{store.rstrip('/')}/batch={batch}"
    timed.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(place)
    spark = logs.sparkSession
    return spark.read.schema(timed.schema).parquet(place).select("day").distinct()


def refresh_days(
    spark: SparkSession, store: str, days: DataFrame, path: str, granularities=SAVED_GRANULARITIES, keys: list[str] = (), ts: str = "timestamp",
) -> None:
    """Aggregate the given days of the log store again and put them in place of what the saved series has for them.

    Only the folders of these days are read and written; files of other days stay. Bins are no wider than a day, so no
    bin lies in two days. The list of days has one row a calendar day.
    """
    wanted = [r["day"] for r in days.collect()]
    if not wanted:
        return
    records = spark.read.parquet(store).where(F.col("day").isin(wanted)).drop("day", "batch")
    bins = all_granularities(records, granularities, list(keys), ts, fill_gaps=False, outages=None)
    bins.withColumn("day", F.to_date("ts")).hint("rebalance", "granularity", "day").sortWithinPartitions("granularity", "day", *keys, "ts") \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("granularity", "day").parquet(path)


def ingest_batch(logs: DataFrame, batch: str, store: str, path: str, granularities=SAVED_GRANULARITIES, keys: list[str] = (), ts: str = "timestamp") -> None:
    """Add a batch of log records and bring the saved series up to date; the same batch again changes nothing."""
    refresh_days(logs.sparkSession, store, add_batch(logs, store, batch, ts), path, granularities, keys, ts)


def load_days(spark: SparkSession, path: str, granularity: str, keys: list[str] = (), fill_gaps: bool = True, outages=(OUTAGE,)) -> DataFrame:
    """The saved series of one granularity, regular over all its days like one built at once."""
    bins = spark.read.parquet(path).where(F.col("granularity") == granularity).drop("granularity", "day")
    if fill_gaps:
        bins = fill_grid(bins, GRANULARITIES[granularity], list(keys))
    return mark_outages(bins, outages) if outages is not None else bins
