"""Annual wellness visits."""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caregauge.functions import year_end
from caregauge.operators.intervals import enrollment_gaps_of
from caregauge.operators.output import RESULT_COLUMNS, check_result
from caregauge.operators.valuesets import ClaimNeed, CodeBook, CodeRule
from caregauge.plans.base import QualityMeasure
from caregauge.plans.common import HCPCS, tagged_claims
from caregauge.sources.catalogue import medicare_wellness_codes
from caregauge.sources.tables import table

WELL_CARE = "Well-Care"
MEDICARE = "Well-Care-Custom"

# Rules of each reference filter.
FILTERS = {
    "refs_well_care_core": ("core",),
    "refs_well_care_whole": ("core", "medicare"),
    "reference_awv": ("medicare",),
}
ICD = ("ICD9CM", "ICD10CM")
VISIT_BOOK = CodeBook(
    CodeRule("core", "hcpcs", (WELL_CARE,), HCPCS),
    CodeRule("core", "icddiag", (WELL_CARE,), ICD),
    CodeRule("medicare", "hcpcs", (MEDICARE,), HCPCS),
    CodeRule("medicare", "icddiag", (MEDICARE,), ICD),
    version="padded",
)


@dataclass(frozen=True)
class Variant:
    """One reported rate: which codes, from when to when, and the gap rule."""

    codes: str
    first: datetime.date
    last: datetime.date
    known_until: datetime.date
    max_gaps: int = 1
    max_gap_length: int = 45

    @property
    def period(self) -> tuple[datetime.date, datetime.date]:
        """Days for which enrollment is required."""
        return self.first, min(self.last, self.known_until)


def visits_needed(dfs_input, variants: Mapping[str, Variant]) -> ClaimNeed:
    """The claim rows of several variants.

    The table ``reference_awv`` is optional; without it the built-in Medicare codes
    are used.
    """
    columns = ["value_set_name", "code", "code_system"]
    core = table(dfs_input, "reference").select(*columns)
    medicare = dfs_input.get("reference_awv")
    if medicare is None:
        medicare = medicare_wellness_codes(core.sparkSession)
    codes = core.where(F.col("value_set_name") == WELL_CARE).unionByName(
        medicare.select(*columns)
    )
    period = F.col("fromdate").between(
        F.lit(min(v.first for v in variants.values())),
        F.lit(max(v.last for v in variants.values())),
    )
    return ClaimNeed(VISIT_BOOK, codes, ("member_id", "fromdate"), period)


def wellness(dfs_input, variants: Mapping[str, Variant]) -> DataFrame:
    """Result rows of several variants from one pass over the claims and one over the spans."""
    covered = table(dfs_input, "member_time").where(F.col("cover_medical") == "Y")
    last_visits = {
        f"last_{i}": F.max(
            F.expr(
                f"CASE WHEN fromdate BETWEEN DATE'{v.first}' AND DATE'{v.last}' AND "
                f"({' OR '.join(VISIT_BOOK.sql(tag) for tag in FILTERS[v.codes])}) "
                "THEN fromdate END"
            )
        )
        for i, v in enumerate(variants.values())
    }
    visits = (
        tagged_claims(dfs_input, visits_needed(dfs_input, variants))
        .groupBy("member_id")
        .agg(*[value.alias(name) for name, value in last_visits.items()])
    )
    rules = dict.fromkeys((v.period, v.max_gaps, v.max_gap_length) for v in variants.values())
    periods = list(dict.fromkeys(period for period, _, _ in rules))
    gapped = [
        f"CASE WHEN largest_gap_{periods.index(period)} > {length} "
        f"OR gap_count_{periods.index(period)} > {gaps} THEN 'Y' ELSE 'N' END AS gap_{number}"
        for number, (period, gaps, length) in enumerate(rules)
    ]
    flags = enrollment_gaps_of(covered, periods).selectExpr("member_id", *gapped)
    members = table(dfs_input, "member").select("member_id").join(flags, "member_id")
    numbers = {rule: i for i, rule in enumerate(rules)}
    rows = ", ".join(
        f"named_struct('comp_quality_short', '{name}', "
        f"'excluded', gap_{numbers[v.period, v.max_gaps, v.max_gap_length]} = 'Y', "
        # An excluded member's visits are not looked at.
        f"'last', CASE WHEN gap_{numbers[v.period, v.max_gaps, v.max_gap_length]} = 'N' "
        f"THEN last_{i} END, 'period_end', DATE'{v.last}', 'since', '{v.first:%m/%d/%Y}')"
        for i, (name, v) in enumerate(variants.items())
    )
    return (
        members.join(visits, "member_id", "left")
        .selectExpr("member_id", f"inline(array({rows}))")
        .selectExpr(
            "member_id",
            "comp_quality_short",
            "int(last IS NOT NULL) AS comp_quality_numerator",
            "CASE WHEN excluded THEN 0 ELSE 1 END AS comp_quality_denominator",
            "last AS comp_quality_date_last",
            "CASE WHEN NOT excluded AND last IS NULL THEN period_end END "
            "AS comp_quality_date_actionable",
            "CASE WHEN excluded THEN 'Member is excluded due to gaps in eligibility' "
            "WHEN last IS NOT NULL THEN "
            "concat('Most Recent Service: ', date_format(last, 'MM/dd/yyyy')) "
            "ELSE concat('No related services observed since: ', since) END "
            "AS comp_quality_comments",
        )
    )


class AWV(QualityMeasure):
    """Members with continuous medical cover and at least one wellness visit.

    ``filter_reference`` picks the codes: the core set (``refs_well_care_core``), the
    Medicare set (``reference_awv``) or both (``refs_well_care_whole``, the default).
    """

    def _calc_measure(
        self,
        dfs_input,
        performance_yearstart,
        *,
        datetime_end: datetime.date | None = None,
        filter_reference: str | None = None,
        allowable_gaps: int = 1,
        allowable_gap_length: int = 45,
        date_latestpaid: datetime.date | None = None,
    ) -> DataFrame:
        variant = Variant(
            filter_reference or "refs_well_care_whole",
            performance_yearstart,
            datetime_end or year_end(performance_yearstart),
            date_latestpaid or year_end(performance_yearstart),
            allowable_gaps,
            allowable_gap_length,
        )
        return wellness(dfs_input, {"AWV": variant}).drop("comp_quality_short")


def reported_variants(
    performance_yearstart: datetime.date, date_latestpaid: datetime.date
) -> Mapping[str, Variant]:
    """The four reported variants: both code sets by calendar year and by rolling year."""
    year = (performance_yearstart, year_end(performance_yearstart))
    leap_day = (date_latestpaid.month, date_latestpaid.day) == (2, 29)
    year_before = date_latestpaid.replace(
        year=date_latestpaid.year - 1, day=28 if leap_day else date_latestpaid.day
    )
    rolling = (year_before, date_latestpaid)
    whole, medicare = "refs_well_care_whole", "reference_awv"
    return {
        "AWV: Combined": Variant(whole, *year, year_end(performance_yearstart)),
        "AWV: Combined Rolling": Variant(whole, *rolling, date_latestpaid),
        "AWV: Medicare": Variant(medicare, *year, date_latestpaid),
        "AWV: Medicare Rolling": Variant(medicare, *rolling, date_latestpaid),
    }


def wellness_results(
    dfs_input, performance_yearstart: datetime.date, date_latestpaid: datetime.date
) -> DataFrame:
    """Result rows of the four reported variants."""
    variants = reported_variants(performance_yearstart, date_latestpaid)
    return check_result(wellness(dfs_input, variants)).select(*RESULT_COLUMNS)
