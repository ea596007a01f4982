"""Registered queries and, where SQL can say the same, their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docvec.cluster import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL it must agree with."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table; with columns named, only those, spread over all cores for costly work per row."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows.select(*columns)) if columns else rows
