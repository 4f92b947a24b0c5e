"""Reference tables kept as CSV next to a schema CSV, and their compiled parquet form."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caregauge.sources.schemas import reference_schema, struct_of
from caregauge.sources.tables import names_in


def schema_from_csv(spark: SparkSession, path: str) -> StructType:
    """Schema described by a CSV with the columns name, datatype, nullable.

    The file is metadata: one line per column of the table it describes.
    """
    rows = spark.read.csv(
        path,
        schema="name string, datatype string, nullable string",
        header=True,
        mode="FAILFAST",
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
    ).collect()
    return struct_of(rows)


def read_reference_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header, read with a declared schema; malformed lines fail."""
    return spark.read.csv(
        path,
        schema=schema,
        sep=",",
        mode="FAILFAST",
        header=True,
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
    )


def _data_names(spark: SparkSession, folder: str) -> dict[str, str]:
    """Lower-cased stem → path of every ``*.csv`` (file or folder) in a folder."""
    names = names_in(spark, folder)
    return {name[:-4].lower(): f"{folder}/{name}" for name in names if name.endswith(".csv")}


def _schema_of(spark: SparkSession, name: str, schema_folder: str | None) -> StructType:
    """Schema file of the folder, or without one the built-in schema of that name."""
    if schema_folder is None:
        return reference_schema(name)
    return schema_from_csv(spark, f"{schema_folder}/{name}.csv")


def import_references(
    spark: SparkSession, data_folder: str, schema_folder: str | None = None
) -> Mapping[str, DataFrame]:
    """Every CSV of ``data_folder`` with the schema file of the same name, or the built-in schema."""
    return {
        name: read_reference_csv(spark, path, _schema_of(spark, name, schema_folder))
        for name, path in sorted(_data_names(spark, data_folder).items())
    }


def compile_references(references: Mapping[str, DataFrame], folder: str) -> None:
    """Write every reference table as ``<name>.parquet``."""
    for name, table in references.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def load_reference(
    spark: SparkSession,
    name: str,
    compiled_folder: str,
    data_folder: str,
    schema_folder: str | None = None,
) -> DataFrame:
    """The compiled table if there is one, else the CSV (without schema folder: built-in schema)."""
    try:
        return spark.read.parquet(f"{compiled_folder}/{name}.parquet")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return read_reference_csv(
        spark,
        f"{data_folder}/{name}.csv",
        _schema_of(spark, name, schema_folder),
    )


def with_numeric_target(catalogue: DataFrame) -> DataFrame:
    """Measure catalogue with its target as a labelled double."""
    name = "comp_quality_target_value"
    target = F.col(name).cast("double").alias(name, metadata={"label": "Target"})
    return catalogue.select(
        *[target if column == name else F.col(column) for column in catalogue.columns]
    )
