"""The query catalog: each query with, where SQL can say it, the same result in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a SQL text whose {placeholders} name test tables."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def plain(sql: str) -> str:
    """The same SQL text with bare table names."""
    return sql.format(**{t: t for t in TABLES})
