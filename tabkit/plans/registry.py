"""Query registry: a name, a function (spark, folder) -> DataFrame and the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def select_sql(columns: list[str], source: str) -> str:
    """The same column expressions that ``selectExpr`` takes, as a SQL query."""
    return f"SELECT {', '.join(columns)} FROM {source}"


def query(name: str, sql: str | None = None, doubles: str = "", scale: int = 6):
    """Register under ``name``. Columns listed in ``doubles`` are rounded alike on both sides,
    since sums of doubles depend on the order of addition in the last digits."""
    rounded = doubles.split()

    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = fn(spark, folder)
            return df.withColumns({c: F.round(F.col(c).cast("double"), scale) + F.lit(0.0) for c in rounded}) if rounded else df
        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            fixed = ", ".join(f"round(CAST({c} AS DOUBLE), {scale}) + 0.0 AS {c}" for c in rounded)
            ORACLES[name] = f"SELECT * REPLACE ({fixed}) FROM ({sql})" if rounded else sql
        return fn
    return add
