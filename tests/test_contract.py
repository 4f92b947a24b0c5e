"""Result contract, stacking and rates."""

import datetime

import pytest
from pyspark.sql import functions as F

from caregauge.operators.output import (
    check_result,
    combine_results,
    measure_rates,
    measure_rows,
    overall_rate,
    rates_against_target,
)
from caregauge.plans import MPM3, SPD, QualityMeasure
from caregauge.sources.catalogue import measure_catalogue
from caregauge.sources.reference import with_numeric_target
from tests.helpers import table


class Good(QualityMeasure):
    def _calc_measure(self, dfs_input, performance_yearstart):
        return dfs_input["any"].select(
            "member_id",
            F.lit("x").alias("comp_quality_short"),
            F.lit(1).alias("comp_quality_numerator"),
        )


class Bad(QualityMeasure):
    def _calc_measure(self, dfs_input, performance_yearstart):
        return dfs_input["any"].select("member_id", F.lit("x").alias("short"))


class Incomplete(QualityMeasure):
    pass


@pytest.fixture
def any_table(spark):
    return {"any": spark.createDataFrame([("a",)], "member_id string")}


def test_good_result_passes(any_table):
    assert Good().calc_measure(any_table, datetime.date(2018, 1, 1)).count() == 1


def test_misnamed_column_is_rejected(any_table):
    with pytest.raises(ValueError, match="short"):
        Bad().calc_measure(any_table, datetime.date(2018, 1, 1))


def test_missing_key_is_rejected(any_table):
    with pytest.raises(ValueError, match="member_id"):
        check_result(any_table["any"].withColumnRenamed("member_id", "comp_quality_id"))


def test_not_a_dataframe_is_rejected():
    with pytest.raises(TypeError):
        check_result([("a", 1)])


def test_measure_without_calculation_cannot_be_made():
    with pytest.raises(TypeError):
        Incomplete()


def test_unknown_fix_is_rejected():
    assert SPD(fixes=["pdc_clamp"]).fixes == {"pdc_clamp"}
    with pytest.raises(ValueError, match="nonsense"):
        SPD(fixes=["nonsense"])
    with pytest.raises(ValueError):
        MPM3(fixes=["pdc_clamp"])


def test_combine_aligns_columns_and_drops_empty_denominators(spark):
    members = spark.createDataFrame([("a", True), ("b", None)], "member_id string, hit boolean")
    one = measure_rows(members, [("One", F.col("hit"), F.lit(True))])
    two = measure_rows(members, [("Two", F.lit(False), F.col("hit"))], date_type="date")
    both = combine_results([one, two.select(*reversed(two.columns))])
    assert dict(both.dtypes)["comp_quality_date_last"] == "date"
    found = {
        (r["member_id"], r["comp_quality_short"], r["comp_quality_numerator"])
        for r in both.collect()
    }
    assert found == {("a", "One", 1), ("b", "One", 0), ("a", "Two", 0)}


def test_rates_and_targets(spark):
    results = table(
        spark,
        "member_id string, comp_quality_short string, comp_quality_numerator int, "
        "comp_quality_denominator int",
        """
        a PBH 1 1
        b PBH 0 1
        a PCR 1 20
        """,
    )
    catalogue = with_numeric_target(measure_catalogue(spark))
    assert catalogue.count() == 32
    assert catalogue.schema["comp_quality_target_value"].metadata == {"label": "Target"}
    rated = rates_against_target(measure_rates(results), catalogue)
    found = {
        r["comp_quality_short"]: (r["comp_quality_rate"], r["comp_quality_target_met"])
        for r in rated.collect()
    }
    assert found == {"PBH": (0.5, False), "PCR": (0.05, True)}


def test_rate_of_nothing_is_null(spark):
    empty = table(
        spark,
        "comp_quality_numerator int, comp_quality_denominator int",
        "1 1",
    ).where("false")
    assert overall_rate(empty).collect()[0]["comp_quality_rate"] is None
