"""Annual monitoring for members on diuretics."""

from __future__ import annotations

from pyspark.sql import functions as F

from caregauge.functions import age_on, year_end
from caregauge.operators.intervals import continuously_enrolled
from caregauge.operators.output import measure_rows
from caregauge.operators.supply import treatment_days
from caregauge.operators.valuesets import ClaimNeed, CodeBook, CodeRule
from caregauge.plans.base import QualityMeasure
from caregauge.plans.common import (
    FillNeed,
    attach,
    drug_fills,
    flag,
    marked,
    member_flags,
    on_list,
    tagged_claims,
)
from caregauge.sources.tables import table

MONITORING = CodeBook(
    CodeRule("panel", "hcpcs", ("Lab Panel",), ("CPT",)),
    CodeRule("potassium", "hcpcs", ("Serum Potassium",), ("CPT",)),
    CodeRule("creatinine", "hcpcs", ("Serum Creatinine",), ("CPT",)),
)


class MPM3(QualityMeasure):
    """Denominator: adults with half a year of diuretics and continuous cover.

    Numerator: a lab panel, or both a potassium and a creatinine test, in the year.
    """

    def claims_needed(self, dfs_input, performance_yearstart):
        this_year = F.col("fromdate").between(
            F.lit(performance_yearstart), F.lit(year_end(performance_yearstart))
        )
        return ClaimNeed(
            MONITORING, table(dfs_input, "reference"), ("member_id", "fromdate"), this_year
        )

    def fills_needed(self, performance_yearstart):
        this_year = F.col("fromdate").between(
            F.lit(performance_yearstart), F.lit(year_end(performance_yearstart))
        )
        return [FillNeed(on_list("Diuretic Medications"), this_year)]

    def _calc_measure(self, dfs_input, performance_yearstart):
        final = year_end(performance_yearstart)
        member = table(dfs_input, "member")
        diuretics = drug_fills(dfs_input, self.fills_needed(performance_yearstart)[0])
        treated = treatment_days(diuretics, final).where("treatment_days >= 180")
        spans = table(dfs_input, "member_time").where(
            (F.col("date_start") >= F.lit(performance_yearstart))
            & (F.col("date_end") <= F.lit(final))
            & (F.col("cover_medical") == "Y")
            & (F.col("cover_rx") == "Y")
        )
        tests = member_flags(
            tagged_claims(dfs_input, self.claims_needed(dfs_input, performance_yearstart)),
            {tag: MONITORING.has(tag) for tag in ("panel", "potassium", "creatinine")},
        )
        people = member.groupBy("member_id").agg(
            F.bool_or(age_on(final) >= 18).alias("adult")
        )
        facts = attach(
            people,
            marked(treated, "treated"),
            marked(continuously_enrolled(spans), "enrolled"),
            tests,
        )
        denominator = flag("treated") & flag("enrolled") & flag("adult")
        monitored = flag("panel") | (flag("potassium") & flag("creatinine"))
        return measure_rows(facts, [("MPM3", denominator & monitored, denominator)])
