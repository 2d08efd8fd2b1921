"""Registration of named queries with their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """df in the types that both engines share: long, double, string, boolean."""
    kinds = {"int": "bigint", "smallint": "bigint", "tinyint": "bigint", "float": "double"}
    return df.select(*[F.col(f"`{c}`").cast(kinds.get(t, "double" if t.startswith("decimal") else t)).alias(c) for c, t in df.dtypes])


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: plain(f(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add
