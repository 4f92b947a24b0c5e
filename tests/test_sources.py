"""Schema files, reference tables, tables and results on disk."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType

from caregauge.sources.reference import (
    compile_references,
    import_references,
    load_reference,
    read_reference_csv,
    schema_from_csv,
)
from caregauge.sources.catalogue import measure_catalogue, medicare_wellness_codes
from caregauge.sources.schemas import REFERENCE_SCHEMAS, reference_schema, write_schemas
from caregauge.sources.scratch import scratch_folder
from caregauge.sources.tables import load_results, load_tables, save_result, stack, table


@pytest.fixture
def folders(tmp_path):
    data, schemas = tmp_path / "data", tmp_path / "schemas"
    data.mkdir()
    schemas.mkdir()
    (schemas / "codes.csv").write_text(
        "name,datatype,nullable\ncode,string,false \nfrom,date,TRUE\nn,integer,true\nx,double,true\n"
    )
    (data / "Codes.csv").write_text('code,from,n,x\n A1 ,2018-01-31, 4 ,1.5\n"B,2",,,\n')
    return tmp_path, str(data), str(schemas)


def test_schema_from_csv(spark, folders):
    _, _, schemas = folders
    schema = schema_from_csv(spark, f"{schemas}/codes.csv")
    assert [(f.name, f.dataType, f.nullable) for f in schema.fields] == [
        ("code", StringType(), False),
        ("from", DateType(), True),
        ("n", IntegerType(), True),
        ("x", DoubleType(), True),
    ]


def test_reference_is_trimmed_and_typed(spark, folders):
    _, data, schemas = folders
    loaded = import_references(spark, data, schemas)
    assert list(loaded) == ["codes"]
    found = sorted(tuple(row) for row in loaded["codes"].select("code", "n", "x").collect())
    assert found == [("A1", 4, 1.5), ("B,2", None, None)]


def test_impossible_date_fails(spark, folders):
    root, _, schemas = folders
    bad = root / "bad.csv"
    bad.write_text("code,from,n,x\nA,2018-02-30,1,1\n")
    table_ = read_reference_csv(spark, str(bad), schema_from_csv(spark, f"{schemas}/codes.csv"))
    with pytest.raises(Exception, match="MALFORMED|2018-02-30|FEBRUARY"):
        table_.collect()


def test_compiled_reference_is_preferred(spark, folders):
    root, data, schemas = folders
    compiled = str(root / "compiled")
    (root / "data" / "codes.csv").write_text("code,from,n,x\nraw,,,\n")
    raw = load_reference(spark, "codes", compiled, data, schemas)
    assert {row["code"] for row in raw.collect()} == {"raw"}
    compile_references({"codes": raw.withColumn("code", F.lit("compiled"))}, compiled)
    again = load_reference(spark, "codes", compiled, data, schemas)
    assert {row["code"] for row in again.collect()} == {"compiled"}


def test_results_round_trip(spark, tmp_path):
    folder = str(tmp_path / "out")
    for name in ("one", "two"):
        rows = spark.createDataFrame([(name, 1)], "member_id string, comp_quality_n int")
        save_result(rows, folder, name)
    spark.range(1).write.parquet(f"{folder}/something_else.parquet")
    found = stack(load_results(spark, folder))
    assert sorted(row["member_id"] for row in found.collect()) == ["one", "two"]


def test_tables_by_alias(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "c.parquet"))
    loaded = load_tables(spark, {"outclaims": str(tmp_path / "c.parquet")})
    assert table(loaded, "claims").count() == 3
    with pytest.raises(KeyError, match="member"):
        table(loaded, "member")


def test_scratch_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first.startswith(base) and first != second


def test_builtin_schemas_without_schema_files(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    names = [name for name, _, _ in REFERENCE_SCHEMAS["codes"]]
    (data / "own_codes.csv").write_text(",".join(names) + "\nED,1,2018,99281,,CPT,,\n")
    (data / "own_ndc_codes.csv").write_text(",".join(name for name, _, _ in REFERENCE_SCHEMAS["ndc_codes"]) + "\n")
    loaded = import_references(spark, str(data))
    assert {name: table_.columns[:2] for name, table_ in loaded.items()} == {
        "own_codes": ["value_set_name", "value_set_oid"], "own_ndc_codes": ["medication_list", "ndc_code"],
    }
    assert loaded["own_codes"].select("value_set_name", "code", "definition").collect() == [("ED", "99281", None)]
    again = load_reference(spark, "own_codes", str(tmp_path / "none"), str(data))
    assert again.collect() == loaded["own_codes"].collect()
    with pytest.raises(KeyError, match="prices"):
        reference_schema("prices")


def test_builtin_schemas_as_files(spark, tmp_path):
    write_schemas(spark, str(tmp_path))
    for name in REFERENCE_SCHEMAS:
        assert schema_from_csv(spark, f"{tmp_path}/{name}.csv") == reference_schema(name)
    for rows, name in ((measure_catalogue, "ref_quality_measures"), (medicare_wellness_codes, "reference_awv")):
        assert [(f.name, f.dataType) for f in rows(spark).schema] == [(f.name, f.dataType) for f in reference_schema(name)]
