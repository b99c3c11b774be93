"""Registry of runnable queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from crmweave.session import configure
from crmweave.testbed.roles import check_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, so that both engines report the same type."""
    return df.select(
        *(
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )


def query(name: str, sql: str | None = None, *roles: str) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the named roles as tables."""

    def add(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(function(configure(spark), sf_dir))
        if sql is not None:
            CHECKS[name] = check_sql(sql, *roles) if roles else sql
        return function

    return add
