"""Registered queries: each reads the given tables and, where SQL can say it, has an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    # Adding 0.0 turns a negative zero into zero.
    return df.withColumns({c: F.round(F.col(c).cast("double"), d) + F.lit(0.0) for c, d in digits.items()})


def query(name: str, sql: str | None = None, round_to: dict[str, int] | None = None, doubles: str = ""):
    """Register a query. `doubles` names floating columns compared to 6 decimals on both sides."""
    digits = {c: 6 for c in doubles.split()} | (round_to or {})

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(spark, sf_dir)
            return _rounded(out, digits) if digits else out

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql if not digits else (
                "SELECT * REPLACE (" + ", ".join(
                    f"round(CAST({c} AS DOUBLE), {d}) + 0.0 AS {c}" for c, d in digits.items())
                + f") FROM ({sql}) AS q")
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
