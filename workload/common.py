"""Shared pieces of the registered queries."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_view(name: str) -> str:
    """Name that no other run of the query uses."""
    return f"{name}_{uuid.uuid4().hex}"


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the given tables have them."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}) if times else df


def cents(column: str) -> Column:
    """Exact whole cents of a money column."""
    return (F.col(column).cast("decimal(18,2)") * 100).cast("bigint")


def money_sum(column: str) -> Column:
    """Sum that does not depend on the order of the rows."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def registry():
    """Two dicts and a decorator that files a query and its SQL under a name (the query's own by default)."""
    queries: dict = {}
    oracles: dict = {}

    def register(oracle: str | None, name: str | None = None):
        def add(query):
            key = name or query.__name__
            queries[key] = query
            if oracle is not None:
                oracles[key] = oracle
            return query

        return add

    return queries, oracles, register
