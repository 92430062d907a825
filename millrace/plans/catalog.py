"""The named queries over the driver tables, each next to the SQL that states its result."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame and, where SQL can say it, its oracle."""
    def register(function: Query) -> Query:
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = function
        if sql is not None:
            SQL[key] = sql
        return function
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(column: str) -> Column:
    return F.to_date(column)


def cents(column: str | Column) -> Column:
    """Doubles with two decimals as whole cents, so that sums compare exactly."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column * 100).cast("bigint")


def decimal(column: str, scale: int = 2) -> Column:
    return F.col(column).cast(f"decimal(18,{scale})")
