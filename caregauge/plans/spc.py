"""Statin therapy for members with cardiovascular disease."""

from __future__ import annotations

from pyspark.sql import functions as F

from caregauge.functions import age_on, year_end
from caregauge.operators.intervals import continuously_enrolled
from caregauge.operators.output import measure_rows
from caregauge.plans.base import QualityMeasure
from caregauge.plans.common import attach, flag, marked
from caregauge.plans.statins import (
    HIGH_MODERATE,
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

MALES, FEMALES = "Males 21-75", "Females 40-75"


class SPC(QualityMeasure):
    """Rate One: a high or moderate statin. Rate Two: at least 80% of days covered.

    Both rates are reported by gender and in total. A member who is neither ``M``
    nor ``F`` falls under females in Rate One and under males in Rate Two.

    Fixes: as in the diabetes measure.
    """

    FIXES = frozenset({"acute_setting", "pdc_clamp"})

    STATINS = (HIGH_MODERATE,)

    def claims_needed(self, dfs_input, performance_yearstart):
        return claims_needed(dfs_input, performance_yearstart)

    def fills_needed(self, performance_yearstart):
        return fills_needed(performance_yearstart, self.STATINS)

    def _calc_measure(self, dfs_input, performance_yearstart):
        statins = self.STATINS
        age = age_on(year_end(performance_yearstart))
        gender = F.col("gender")
        members = table(dfs_input, "member").select(
            "member_id",
            gender.alias("member_gender"),
            (
                ((gender == "M") & age.between(21, 75))
                | ((gender == "F") & age.between(40, 75))
            ).alias("of_age"),
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
        excluded = excluded_by_claims(dfs_input) | flag("drug_excluded")
        denominator = flag("of_age") & flag("enrolled") & cardiovascular() & ~excluded
        treated = denominator & flag("statin")
        adherent = treated & (F.col("pdc") >= 0.8)
        one = F.when(F.col("member_gender") == "M", MALES).otherwise(FEMALES)
        two = F.when(F.col("member_gender") == "F", FEMALES).otherwise(MALES)

        def named(rate: str, stratum):
            return F.concat(F.lit(f"SPC: {rate} ("), stratum, F.lit(")"))

        return measure_rows(
            facts,
            [
                (named("Rate One", one), treated, denominator),
                (named("Rate Two", two), adherent, treated),
                (named("Rate One", F.lit("Total")), treated, denominator),
                (named("Rate Two", F.lit("Total")), adherent, treated),
            ],
        )
