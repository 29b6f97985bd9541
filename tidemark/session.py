"""Session defaults for tests and benches, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "tidemark", shared_dir: str | None = None) -> SparkSession:
    """A local session, with `shared_dir` as its shared folder; on a cluster pass your own session to the operators instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    )
    if shared_dir:
        builder = builder.config("spark.checkpoint.dir", shared_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that all executors share, removed when the application ends.

    It lies in `spark.checkpoint.dir`, or where `setCheckpointDir` points; where neither is set, in the session's
    warehouse, which is shared as well.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    base = base or spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    path = f"{base.rstrip('/')}/tidemark-{purpose}-{uuid.uuid4().hex}"
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def settled(df: DataFrame, purpose: str, by: list[str] = ()) -> DataFrame:
    """The rows written to the shared folder and read back, for rows that are read more than once: the input is computed once, and lineage ends here.

    With `by`, a reader of one value of these columns reads its files only.
    """
    path = f"{scratch_dir(df.sparkSession, purpose)}/rows"
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])
