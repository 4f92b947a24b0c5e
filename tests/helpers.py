"""Small tables for tests."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession


def day(text: str | None) -> datetime.date | None:
    return datetime.date.fromisoformat(text) if text else None


def table(spark: SparkSession, schema: str, text: str) -> DataFrame:
    """Table from lines of blank-separated values; ``-`` is null."""
    fields = [part.split() for part in schema.split(",")]
    convert = {"string": str, "date": day, "int": int, "double": float, "bigint": int}
    rows = []
    for line in text.strip().splitlines():
        cells = line.split()
        assert len(cells) == len(fields), line
        rows.append(
            tuple(
                None if cell == "-" else convert[kind](cell)
                for cell, (_, kind) in zip(cells, fields, strict=True)
            )
        )
    return spark.createDataFrame(rows, schema)


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)


def scores(df: DataFrame) -> dict[str, tuple[int, int]]:
    """member → (numerator, denominator) of a result with one measure."""
    return {
        row["member_id"]: (row["comp_quality_numerator"], row["comp_quality_denominator"])
        for row in df.collect()
    }
