"""Registry of the named queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.sources.views import cte, load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
AS_OF = "2025-01-01"


class Tables:
    """The views of one data directory, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)


def query(name: str, sql: str | None = None, views: Sequence[str] = ()):
    """Register ``fn(tables) -> DataFrame`` under ``name``; ``sql`` follows ``WITH <views>`` when views are given."""

    def wrap(fn):
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        call.__doc__ = fn.__doc__
        QUERIES[name] = call
        if sql is not None:
            ORACLES[name] = f"WITH {cte(*views)} {sql}" if views else sql
        return fn

    return wrap


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})
