"""Statin therapy for members with diabetes."""

from __future__ import annotations

from pyspark.sql import functions as F

from caregauge.functions import age_on, year_end
from caregauge.operators.intervals import continuously_enrolled
from caregauge.operators.output import measure_rows
from caregauge.plans.base import QualityMeasure
from caregauge.plans.common import attach, flag, marked
from caregauge.plans.statins import (
    HIGH_MODERATE,
    LOW,
    cardiovascular,
    claim_facts,
    claims_needed,
    drug_facts,
    excluded_by_claims,
    fills_needed,
    statin_adherence,
    two_year_spans,
)
from caregauge.sources.tables import table


class SPD(QualityMeasure):
    """Rate One: any statin in the year. Rate Two: more than 80% of days covered.

    Fixes: ``acute_setting`` enforces the acute inpatient setting of diagnoses;
    ``pdc_clamp`` stops windows beyond the year end from counting negative days.
    """

    FIXES = frozenset({"acute_setting", "pdc_clamp"})

    STATINS = (HIGH_MODERATE, LOW)

    def claims_needed(self, dfs_input, performance_yearstart):
        return claims_needed(dfs_input, performance_yearstart)

    def fills_needed(self, performance_yearstart):
        return fills_needed(performance_yearstart, self.STATINS)

    def _calc_measure(self, dfs_input, performance_yearstart):
        statins = self.STATINS
        members = table(dfs_input, "member").select(
            "member_id",
            F.col("gender").alias("member_gender"),
            age_on(year_end(performance_yearstart)).between(40, 75).alias("of_age"),
        )
        facts = attach(
            members,
            marked(
                continuously_enrolled(two_year_spans(dfs_input, performance_yearstart)),
                "enrolled",
            ),
            claim_facts(dfs_input, performance_yearstart, "acute_setting" in self.fixes),
            drug_facts(dfs_input, performance_yearstart, statins),
            statin_adherence(
                dfs_input, performance_yearstart, statins, "pdc_clamp" in self.fixes
            ),
        )
        diabetic = flag("diabetes_acute") | flag("diabetes_visits") | flag("diabetes_drug")
        excluded = cardiovascular() | excluded_by_claims(dfs_input) | flag("drug_excluded")
        denominator = flag("of_age") & flag("enrolled") & diabetic & ~excluded
        treated = denominator & flag("statin")
        return measure_rows(
            facts,
            [
                ("SPD: Rate One", treated, denominator),
                ("SPD: Rate Two", treated & (F.col("pdc") > 0.8), treated),
            ],
        )
