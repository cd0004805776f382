"""Queries of this subpackage and the SQL that checks them; shared table access."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Whole jobs beside the ten numbered queries; their results have more than the SQL of those.
EXTRA: dict[str, Query] = {}


def extra(fn: Query) -> Query:
    """Register a job beside the numbered queries under its function name."""
    EXTRA[fn.__name__] = fn
    return fn


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must agree with it."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(df: DataFrame) -> int:
    """Partitions a shuffle of this session has; they follow the size of the cluster's work."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
