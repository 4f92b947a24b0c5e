"""Named checks: a Spark query and, where SQL can say it, the oracle statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates as ISO text, so that both engines hand out the same values."""
    return df.select(
        *[
            F.col(field.name).cast("string").alias(field.name)
            if isinstance(field.dataType, DateType)
            else F.col(field.name)
            for field in df.schema.fields
        ]
    )


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(query(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register
