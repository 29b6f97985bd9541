"""Structured Streaming forms of the traffic series and the log parse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import columns as C
from tidemark.sources import clf

_DURATIONS = {"1min": "1 minute", "5min": "5 minutes", "15min": "15 minutes", "1h": "1 hour"}


def _require_utc(df: DataFrame) -> None:
    # Watermarks need a zoned timestamp; only UTC maps wall-clock time one to one.
    if df.sparkSession.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "GMT", "Z"):
        raise ValueError("streaming operators on wall-clock time need spark.sql.session.timeZone=UTC")


def traffic_stream(
    logs: DataFrame, freq: str = "15min", keys: list[str] = (), ts: str = "timestamp", watermark: str = "1 hour", exact: bool = True,
) -> DataFrame:
    """Closed tumbling bins of a streaming log; rows later than the watermark are dropped.

    Hosts are counted exactly by two chained windowed aggregations, first per host, then
    per bin. State then holds one row per open bin and host; `exact=False` keeps one
    sketch per open bin instead and counts hosts approximately.
    """
    _require_utc(logs)
    keys, width = list(keys), _DURATIONS[freq]
    timed = logs.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", watermark)
    b, code = F.col("bytes"), F.col("status_code")
    sums = {
        "request_count": F.count("host"), "bytes_total": F.sum(b), "_sq": F.sum(b.cast("decimal(19,0)") * b.cast("decimal(19,0)")),
        "success_count": F.count_if(C.is_success(code)), "error_count": F.count_if(C.is_error(code)),
        "server_error_count": F.count_if(C.is_server_error(code)),
    }
    if exact:
        per_host = timed.groupBy(*keys, "host", F.window("_at", width).alias("_w")).agg(*[c.alias(n) for n, c in sums.items()])
        binned = per_host.groupBy(*keys, F.window(F.window_time("_w"), width).alias("_bin")).agg(
            *[F.sum(n).alias(n) for n in sums], F.count("host").alias("unique_hosts"))
    else:
        binned = timed.groupBy(*keys, F.window("_at", width).alias("_bin")).agg(
            *[c.alias(n) for n, c in sums.items()], F.approx_count_distinct("host").alias("unique_hosts"))
    n, total = F.col("request_count"), F.col("bytes_total")
    # n * sum(x^2) - sum(x)^2 in exact decimals, so large byte counts do not cancel.
    spread = n.cast("decimal(38,0)") * F.col("_sq").cast("decimal(38,0)") - total.cast("decimal(19,0)") * total.cast("decimal(19,0)")
    variance = F.when(n > 1, spread.cast("double") / (n * (n - 1)).cast("double")).otherwise(F.lit(0.0))
    return binned.select(
        *keys, F.col("_bin.start").cast("timestamp_ntz").alias("ts"), n, total, (total / n).alias("bytes_mean"),
        F.sqrt(F.greatest(variance, F.lit(0.0))).alias("bytes_std"), "success_count", "error_count", "server_error_count",
        "unique_hosts", C.ratio_or_zero(F.col("error_count"), n).alias("error_rate"), C.ratio_or_zero(total, n).alias("avg_request_size"))


def parse_stream(lines: DataFrame, good_path: str, reject_path: str, checkpoint: str, line: str = "line", keep: tuple[str, ...] = ()) -> StreamingQuery:
    """Parse a stream of lines into records and rejects, each a directory per micro-batch.

    A replayed batch overwrites its own directory, so retries leave no duplicates.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = clf.parse(batch, line).persist()
        try:
            clf.records(parsed, *keep).write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
            clf.rejects(parsed, *keep, line=line).write.mode("overwrite").parquet(f"{reject_path}/batch={batch_id}")
        finally:
            parsed.unpersist()

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is available now into a parquet directory."""
    stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start(path).awaitTermination()
