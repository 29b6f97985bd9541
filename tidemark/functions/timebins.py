"""Wall-clock bin arithmetic on TIMESTAMP_NTZ, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import GRANULARITIES


# Seconds from 0001-01-01 to 1970-01-01.
_YEAR_ONE = 62135596800


def width_seconds(width: str | int) -> int:
    """Seconds of a bin width given as a granularity name or a number of seconds."""
    return GRANULARITIES[width] if isinstance(width, str) else int(width)


def epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def seconds_of(ts: Column | str) -> Column:
    """Whole seconds from 1970-01-01 to a wall-clock timestamp, rounded down.

    Long arithmetic only, as every log row passes here. Counting from the year 1 keeps the
    interval positive, so that its truncating cast rounds down.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    since = (ts - F.expr("TIMESTAMP_NTZ'0001-01-01 00:00:00'")).cast("interval second").cast("bigint")
    return since - F.lit(_YEAR_ONE).cast("bigint")


def from_seconds(sec: Column) -> Column:
    """Inverse of `seconds_of`."""
    return epoch() + F.expr("INTERVAL '1' SECOND") * sec.cast("bigint")


def bin_start(ts: Column | str, width: str | int | Column) -> Column:
    """Start of the bin holding `ts`; bins are aligned to midnight, `width` may be a column."""
    w = width if isinstance(width, Column) else F.lit(width_seconds(width)).cast("bigint")
    sec = seconds_of(ts)
    return from_seconds(sec - F.pmod(sec, w))


def with_bin(df: DataFrame, ts: str, width: str | int, name: str) -> DataFrame:
    """Add the bin start for one fixed width with Spark's tumbling window, the fastest form.

    Rows without a timestamp belong to no bin and are left out.
    """
    return df.withColumn(name, F.window(ts, f"{width_seconds(width)} seconds")["start"])


def bin_index(ts: Column | str, width: str | int) -> Column:
    """Number of the bin holding `ts`, counted from 1970-01-01."""
    return F.floor(seconds_of(ts) / F.lit(width_seconds(width))).cast("bigint")


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal from a string or datetime."""
    return F.lit(str(value)).cast("timestamp_ntz")


def interval_seconds(sec: int) -> Column:
    return F.make_dt_interval(secs=F.lit(sec).cast("decimal(18,6)"))
