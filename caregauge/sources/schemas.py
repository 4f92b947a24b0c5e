"""Schemas of the reference tables, so that their CSV files load without schema files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "integer": IntegerType(),
    "int": IntegerType(),
    "long": LongType(),
    "bigint": LongType(),
    "float": FloatType(),
    "double": DoubleType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "boolean": BooleanType(),
}

# Columns of the reference tables (name, datatype, nullable), as their files have them.
REFERENCE_SCHEMAS: Mapping[str, list[tuple[str, str, str]]] = {
    "codes": [
        ("value_set_name", "string", "false"),
        ("value_set_oid", "string", "false"),
        ("value_set_version", "string", "false"),
        ("code", "string", "false"),
        ("definition", "string", "true"),
        ("code_system", "string", "false"),
        ("code_system_oid", "string", "true"),
        ("code_system_version", "string", "false"),
    ],
    "ndc_codes": [
        ("medication_list", "string", "false"),
        ("ndc_code", "string", "false"),
        ("brand_name", "string", "false"),
        ("generic_product_name", "string", "false"),
        ("route", "string", "false"),
        ("description", "string", "false"),
        ("drug_id", "string", "false"),
        ("drug_name", "string", "true"),
        ("package_size", "string", "true"),
        ("unit", "string", "true"),
        ("dose", "string", "true"),
        ("form", "string", "true"),
        ("med_conversion_factor", "string", "true"),
    ],
    "ref_quality_measures": [
        ("comp_quality_dual", "integer", "false"),
        ("comp_quality_short", "string", "false"),
        ("comp_quality", "string", "false"),
        ("comp_quality_category", "string", "false"),
        ("comp_quality_direction", "string", "false"),
        ("comp_quality_target_value", "string", "false"),
        ("comp_quality_format_code", "string", "false"),
        ("comp_quality_calculation_type", "string", "false"),
    ],
    "reference_awv": [
        ("value_set_name", "string", "false"),
        ("code", "string", "false"),
        ("definition", "string", "true"),
        ("code_system", "string", "false"),
        ("code_system_oid", "string", "true"),
    ],
}


def struct_of(columns: Iterable[Sequence[str]]) -> StructType:
    """Schema of columns given as (name, datatype, nullable), all text."""
    return StructType(
        [
            StructField(name.strip(), _TYPES[datatype.strip().lower()], nullable.strip().lower() == "true")
            for name, datatype, nullable in columns
        ]
    )


def known_name(name: str) -> str:
    """Reference table that a file of this name holds; files may carry a prefix (``2018_codes``)."""
    name = name.lower()
    fitting = [known for known in REFERENCE_SCHEMAS if name == known or name.endswith("_" + known)]
    if not fitting:
        raise KeyError(f"no schema for reference table {name!r}; there are {sorted(REFERENCE_SCHEMAS)}")
    return max(fitting, key=len)


def reference_schema(name: str) -> StructType:
    """Schema of a reference table by the name of its file."""
    return struct_of(REFERENCE_SCHEMAS[known_name(name)])


def write_schemas(spark: SparkSession, folder: str, names: list[str] | None = None) -> None:
    """A schema CSV for each of the tables, to be changed and handed to ``import_references``."""
    for name in names or list(REFERENCE_SCHEMAS):
        rows = spark.createDataFrame(
            REFERENCE_SCHEMAS[known_name(name)], "name string, datatype string, nullable string"
        )
        rows.coalesce(1).write.mode("overwrite").csv(f"{folder}/{name}.csv", header=True)
