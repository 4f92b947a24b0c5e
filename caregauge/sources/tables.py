"""Input tables by name and measure results on disk."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names under which callers hand in the same table.
ALIASES = {
    "claims": ("claims", "outclaims", "med_claims"),
    "rx_claims": ("rx_claims", "outpharmacy"),
    "member": ("member",),
    "member_time": ("member_time",),
    "reference": ("reference",),
    "ndc": ("ndc",),
}


def table(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """Table ``name`` under whichever of its aliases the caller used."""
    for alias in ALIASES.get(name, (name,)):
        if alias in tables:
            return tables[alias]
    raise KeyError(f"input table {name!r} is missing; got {sorted(tables)}")


def load_tables(spark: SparkSession, paths: Mapping[str, str]) -> Mapping[str, DataFrame]:
    """Parquet tables by name."""
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def save_result(result: DataFrame, folder: str, name: str) -> str:
    """Write a measure result as ``results_<name>.parquet``; returns the path."""
    path = f"{folder}/results_{name}.parquet"
    result.write.mode("overwrite").parquet(path)
    return path


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files of a folder, and of its folders that hold files.

    Spark's own listing, so it works wherever Spark reads, with or without a JVM beside Python.
    """
    folder = folder.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.regexp_extract("path", re.escape(folder) + "/([^/]+)", 1)
    return sorted(row[0] for row in files.select(name).distinct().collect())


def load_results(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Every ``*results*`` parquet table of a folder."""
    return [spark.read.parquet(f"{folder}/{name}") for name in names_in(spark, folder) if "results" in name]


def stack(results: list[DataFrame]) -> DataFrame:
    """Union by column name."""
    return reduce(lambda a, b: a.unionByName(b), results)
