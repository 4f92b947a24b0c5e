"""One check per measure over the claim model."""

from __future__ import annotations

from pyspark.sql import functions as F

from caregauge import plans
from caregauge.operators import output
from caregauge.plans.run import measure_results, of_each
from caregauge.sources import catalogue, reference, tables
from caregauge.sources.scratch import scratch_folder
from checks import claim_model as model
from checks.oracle_measures import measure_sql
from checks.registry import check

SQL = measure_sql()
ANNUAL = {
    "measure_mpm3": plans.MPM3,
    "measure_pbh": plans.PBH,
    "measure_pcr": plans.PCR,
    "measure_aab": plans.AAB,
    "measure_spd": plans.SPD,
    "measure_spc": plans.SPC,
    "measure_cdc": plans.CDC,
    "measure_mma": plans.MMA,
    "measure_cis": plans.CIS,
}


def _annual(name: str, measure: type[plans.QualityMeasure]) -> None:
    @check(name, SQL[name])
    def run(spark, sf_dir):
        return measure().calc_measure(model.tables(spark, sf_dir), model.PY)


for _name, _measure in ANNUAL.items():
    _annual(_name, _measure)


@check("measure_pcp_7", SQL["measure_pcp_7"])
def measure_pcp_7(spark, sf_dir):
    return plans.PCPFollowup().calc_measure(model.tables(spark, sf_dir), model.PY, cutoff=7)


@check("measure_pcp_14", SQL["measure_pcp_14"])
def measure_pcp_14(spark, sf_dir):
    return plans.PCPFollowup().calc_measure(model.tables(spark, sf_dir), model.PY, cutoff=14)


@check("measure_awv", SQL["measure_awv"])
def measure_awv(spark, sf_dir):
    return plans.wellness_results(model.tables(spark, sf_dir), model.PY, model.LATEST_PAID)


# What the stacked result keeps: rows with a denominator, of the wellness variants those that the
# measure reports.
STACKED = " UNION ALL ".join(
    "SELECT member_id, comp_quality_short, CAST(comp_quality_numerator AS BIGINT) AS comp_quality_numerator, "
    "CAST(comp_quality_denominator AS BIGINT) AS comp_quality_denominator, CAST(comp_quality_date_last AS VARCHAR) AS comp_quality_date_last, "
    "CAST(comp_quality_date_actionable AS VARCHAR) AS comp_quality_date_actionable, CAST(comp_quality_comments AS VARCHAR) AS comp_quality_comments "
    f"FROM ({SQL[name]})"
    for name in (*ANNUAL, "measure_pcp_7", "measure_pcp_14", "measure_awv")
)


@check("run_all", f"SELECT * FROM ({STACKED}) WHERE comp_quality_denominator <> 0")
def run_all(spark, sf_dir):
    """Every measure over one set of tables, stacked."""
    return plans.run_all(model.tables(spark, sf_dir), model.PY, model.LATEST_PAID)


@check("combine_all_results", f"SELECT * FROM ({STACKED}) WHERE comp_quality_denominator <> 0")
def combine_all_results(spark, sf_dir):
    """Every measure's result written, found again by its name and stacked."""
    folder = scratch_folder(spark, "all-results")
    results = measure_results(model.tables(spark, sf_dir), model.PY, model.LATEST_PAID)
    of_each(results, lambda name, result: tables.save_result(result, folder, name))
    return output.combine_results(tables.load_results(spark, folder))


TARGETS = ", ".join(
    f"({n}, '{short}', '{'Lower_Better' if short in catalogue.LOWER_IS_BETTER else 'Higher_Better'}', {float(target)}::DOUBLE)"
    for n, (short, _, _, target) in enumerate(catalogue.MEASURES, 1)
)


@check(
    "catalogue_rates",
    f"""SELECT comp_quality_dual, comp_quality_short, comp_quality_direction, comp_quality_target_value, n AS comp_quality_numerator,
  d AS comp_quality_denominator, round(n / d, 6) AS comp_quality_rate,
  CASE WHEN comp_quality_direction = 'Lower_Better' THEN n / d <= comp_quality_target_value ELSE n / d >= comp_quality_target_value END AS comp_quality_target_met
FROM (VALUES {TARGETS}) AS c(comp_quality_dual, comp_quality_short, comp_quality_direction, comp_quality_target_value)
LEFT JOIN (SELECT comp_quality_short, CAST(sum(comp_quality_numerator) AS BIGINT) AS n, CAST(sum(comp_quality_denominator) AS BIGINT) AS d
  FROM ({STACKED}) WHERE comp_quality_denominator <> 0 GROUP BY comp_quality_short) USING (comp_quality_short)""",
)
def catalogue_rates(spark, sf_dir):
    """All rows of the catalogue with the rates of all measures."""
    measures = reference.with_numeric_target(catalogue.measure_catalogue(spark))
    rates = output.measure_rates(plans.run_all(model.tables(spark, sf_dir), model.PY, model.LATEST_PAID))
    met = output.rates_against_target(rates, measures).select(
        "comp_quality_short", "comp_quality_numerator", "comp_quality_denominator", "comp_quality_rate", "comp_quality_target_met"
    )
    return (
        measures.select("comp_quality_dual", "comp_quality_short", "comp_quality_direction", "comp_quality_target_value")
        .join(met, "comp_quality_short", "left")
        .withColumn("comp_quality_rate", F.round("comp_quality_rate", 6))
    )
