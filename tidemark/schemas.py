"""Table schemas and the fixed parameter values shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType([
    T.StructField("host", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("bytes", T.LongType()),
])

SERIES_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("request_count", T.LongType()),
    T.StructField("bytes_total", T.LongType()),
    T.StructField("bytes_mean", T.DoubleType()),
    T.StructField("bytes_std", T.DoubleType()),
    T.StructField("success_count", T.LongType()),
    T.StructField("error_count", T.LongType()),
    T.StructField("server_error_count", T.LongType()),
    T.StructField("unique_hosts", T.LongType()),
    T.StructField("error_rate", T.DoubleType()),
    T.StructField("avg_request_size", T.DoubleType()),
    T.StructField("is_storm_period", T.IntegerType()),
])

REPLAY_SCHEMA_TAIL = (
    "ts timestamp_ntz, actual_requests double, actual_bytes double, servers int, "
    "action string, trigger string, reason string, utilization double, capacity double, "
    "is_overloaded boolean, dropped_requests double, changed boolean, old_servers int"
)

# ---------------------------------------------------------------------------
# These must equal the reference's for results to agree.
# ---------------------------------------------------------------------------

# Bin widths in seconds.
GRANULARITIES = {"1min": 60, "5min": 300, "15min": 900, "1h": 3600}

# Granularities saved by the ingestion job.
SAVED_GRANULARITIES = ("1min", "5min", "15min")

# Default outage interval (server offline), wall-clock time.
OUTAGE = ("1995-08-01 14:52:01", "1995-08-03 04:36:13")

# Default first day of the test split.
TEST_START = "1995-08-23"

# Feature windows per granularity, in rows.
FEATURE_CONFIGS = {
    "1min": {
        "lags": [1, 2, 3, 5, 10, 15, 30, 60, 1440],
        "windows": [5, 15, 30, 60, 1440],
        "diff_periods": [1, 60, 1440],
        "ewm_spans": [5, 15, 60, 1440],
    },
    "5min": {
        "lags": [1, 2, 3, 6, 12, 288],
        "windows": [3, 6, 12, 288],
        "diff_periods": [1, 12, 288],
        "ewm_spans": [3, 12, 288],
    },
    "15min": {
        "lags": [1, 2, 4, 8, 96],
        "windows": [4, 8, 96],
        "diff_periods": [1, 4, 96],
        "ewm_spans": [4, 96],
    },
}

# Feature windows when no granularity is configured.
FEATURE_DEFAULTS = {
    "lags": [1, 2, 3, 5, 10, 15, 30, 60],
    "windows": [5, 15, 30, 60],
    "diff_periods": [1, 60],
    "ewm_spans": [5, 15, 60],
}

# Columns never used as model features.
TARGET_COLUMNS = (
    "request_count", "bytes_total", "bytes_mean", "bytes_std", "success_count",
    "error_count", "server_error_count", "error_rate", "avg_request_size", "unique_hosts",
)
OUTAGE_COLUMN = "is_storm_period"
LABEL_COLUMNS = ("time_of_day", "day_name", "date")

# Bytes assumed per predicted request when no byte forecast is given.
BYTES_PER_PREDICTED_REQUEST = 5000


@dataclass(frozen=True)
class ServerConfig:
    """Capacity and price of one server."""

    max_requests_per_min: float = 1000
    max_bytes_per_min: float = 50_000_000
    min_servers: int = 1
    max_servers: int = 100
    cost_per_server_hour: float = 0.10


def require_columns(df: DataFrame, *names: str) -> None:
    """Raise when an operator's input lacks a column."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def require_timestamp(df: DataFrame, name: str) -> None:
    """Raise unless `name` is a wall-clock (NTZ) or zoned timestamp column."""
    require_columns(df, name)
    if not isinstance(df.schema[name].dataType, (T.TimestampNTZType, T.TimestampType)):
        raise ValueError(f"column {name!r} must be a timestamp")
