"""Where queries over the driver tables are kept: a function of (spark, sf_dir) and, beside it, SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
