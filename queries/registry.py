"""Registry of queries and oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.session import pin_utc, shared_root

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            shared_root(spark)
            return build(spark, sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Fixed digits, as the last bits of a float sum depend on the order of its rows."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def with_ctes(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select
