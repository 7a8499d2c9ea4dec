"""Registry and table access for the query catalogue."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aislewatch.session import allow_repeated_keys

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """The tables of one data folder, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        allow_repeated_keys(spark)
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def feed(self, sql: str) -> DataFrame:
        """Run a feed: a SELECT over the tables that means the same in Spark and in the oracle."""
        for name in TABLE_NAMES:
            if re.search(rf"\b{name}\b", sql):
                getattr(self, name).createOrReplaceTempView(name)
        return self.spark.sql(sql)


def register(name: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its oracle SQL, if there is one."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


def with_feed(feed: str, body: str) -> str:
    """Oracle text: ``body`` over the CTE ``feed``, whose one Spark-only word is rewritten."""
    feed = feed.replace("explode(sequence(0, 8))", "unnest(range(9))")
    return f"WITH feed AS ({feed}) {body}"
