"""Scalar column expressions: status classes, URL parts, calendar parts, safe ratios."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.timebins import ntz


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def status_category(code: Column | str) -> Column:
    """`1xx` .. `5xx` by upper bounds 199/299/399/499/599; NULL outside 0..599."""
    code = _col(code)
    return (
        F.when(code < 0, F.lit(None).cast("string"))
        .when(code <= 199, "1xx").when(code <= 299, "2xx").when(code <= 399, "3xx")
        .when(code <= 499, "4xx").when(code <= 599, "5xx")
    )


def is_success(code: Column | str) -> Column:
    return (_col(code) >= 200) & (_col(code) < 400)


def is_error(code: Column | str) -> Column:
    return _col(code) >= 400


def is_server_error(code: Column | str) -> Column:
    return _col(code) >= 500


def url_path(url: Column | str) -> Column:
    return F.substring_index(_col(url), "?", 1)


def url_extension(path: Column | str) -> Column:
    """Word characters after the last dot at the end of the path, or `none`."""
    found = F.regexp_extract(_col(path), r"(?U)\.(\w+)$", 1)
    return F.when(F.length(found) > 0, found).otherwise("none")


def ratio_or_zero(num: Column, den: Column) -> Column:
    """num / den, 0.0 where the denominator is not positive."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as double, NULL where the denominator is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def in_any_interval(ts: Column | str, intervals) -> Column:
    """True when `ts` lies inside one of the given closed intervals (a short literal list)."""
    ts = _col(ts)
    hit = F.lit(False)
    for start, end in intervals:
        hit = hit | ts.between(ntz(start), ntz(end))
    return hit


def calendar_columns(ts: Column | str) -> dict[str, Column]:
    """The eleven calendar features, in order."""
    ts = _col(ts)
    hour, dow = F.hour(ts), F.weekday(ts)
    return {
        "hour": hour,
        "day_of_week": dow,
        "day_of_month": F.dayofmonth(ts),
        "week_of_year": F.weekofyear(ts),
        "month": F.month(ts),
        "is_weekend": (dow >= 5).cast("int"),
        "is_business_hour": (hour.between(9, 17) & (dow < 5)).cast("int"),
        "hour_sin": F.sin(2 * math.pi * hour / F.lit(24)),
        "hour_cos": F.cos(2 * math.pi * hour / F.lit(24)),
        "dow_sin": F.sin(2 * math.pi * dow / F.lit(7)),
        "dow_cos": F.cos(2 * math.pi * dow / F.lit(7)),
    }
