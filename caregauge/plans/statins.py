"""What the two statin measures share: cardiovascular history, exclusions, rates."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caregauge.functions import in_year, in_years, inside_years, year_end
from caregauge.operators.supply import proportion_days_covered
from caregauge.operators.valuesets import ClaimNeed, CodeBook, CodeRule
from caregauge.plans.common import (
    FillNeed,
    HCPCS,
    drug_fills,
    flag,
    member_flags,
    on_list,
    tagged_claims,
    two_or_more,
    visit_rules,
)
from caregauge.sources.tables import table

HIGH_MODERATE = "High and Moderate-Intensity Statin Medications"
LOW = "Low-Intensity Statin Medications"

STATIN_BOOK = CodeBook(
    *visit_rules(
        "visit", ("Outpatient", "Observation", "ED", "Nonacute Inpatient"), ("Outpatient",)
    ),
    *visit_rules("outpatient", ("Outpatient",), ("Outpatient",)),
    *visit_rules("acute", ("Acute Inpatient",), ("Acute Inpatient",), ("CPT",)),
    CodeRule("stay", "revcode", ("Inpatient Stay",)),
    CodeRule("diabetes", "icddiag", ("Diabetes",)),
    CodeRule("ivd", "icddiag", ("IVD",)),
    CodeRule("mi", "icddiag", ("MI",)),
    CodeRule("revascularized", "hcpcs", ("CABG", "PCI"), HCPCS),
    CodeRule("revascularized", "hcpcs", ("Other Revascularization",)),
    CodeRule("revascularized", "icdproc", ("CABG", "PCI")),
    CodeRule("pregnancy", "icddiag", ("Pregnancy",)),
    CodeRule("excluded", "hcpcs", ("IVF",)),
    CodeRule("excluded", "icddiag", ("Cirrhosis", "Muscular Pain and Disease")),
    CodeRule("excluded", "hcpcs", ("ESRD",), HCPCS),
    CodeRule("excluded", "revcode", ("ESRD",), ("UBREV",)),
    CodeRule("excluded", "pos", ("ESRD",), ("POS",)),
    CodeRule("excluded", "icddiag", ("ESRD",), ("ICD10CM", "ICD9CM")),
    CodeRule("excluded", "icdproc", ("ESRD",), ("ICD10PCS", "ICD9PCS")),
)


def claims_needed(dfs_input, performance_yearstart: datetime.date) -> ClaimNeed:
    """The claim rows of both measures."""
    gender = ("gender",) if "gender" in table(dfs_input, "claims").columns else ()
    return ClaimNeed(
        STATIN_BOOK,
        table(dfs_input, "reference"),
        ("member_id", *gender, "fromdate", "todate"),
        in_years("fromdate", performance_yearstart),
    )


def fills_needed(performance_yearstart: datetime.date, statins: tuple[str, ...]) -> list[FillNeed]:
    """Fills of two years for the flags, statins of the year for the days covered."""
    lists = on_list("Diabetes Medications", "Estrogen Agonists Medications", *statins)
    return [
        FillNeed(lists, in_years("fromdate", performance_yearstart)),
        FillNeed(on_list(*statins), in_year("fromdate", performance_yearstart)),
    ]


def claim_facts(
    dfs_input, performance_yearstart: datetime.date, acute_setting: bool
) -> DataFrame:
    """Member-level flags of both measures from one pass over the claims.

    ``acute_setting``: require an acute inpatient code next to a diagnosis that
    counts for acute stays; as published, the setting is not enforced.
    """
    py = performance_yearstart
    has = STATIN_BOOK.has
    need = claims_needed(dfs_input, py)
    rows = tagged_claims(dfs_input, need)
    pregnancy = has("pregnancy")
    if "gender" in need.columns:
        pregnancy = pregnancy & (F.col("gender") == "F")
    in_both = inside_years("fromdate", "todate", py)
    this_year = inside_years("fromdate", "todate", py, 0, 0)
    last_year = inside_years("fromdate", "todate", py, -1, -1)
    acute = has("acute") if acute_setting else F.lit(True)
    visit = in_both & has("visit") & has("diabetes")
    ivd = has("ivd") & (has("outpatient") | acute)
    event = (has("stay") & has("mi")) | has("revascularized")
    return rows.groupBy("member_id").agg(
        F.bool_or(in_both & acute & has("diabetes")).alias("diabetes_acute"),
        two_or_more(
            F.when(visit, F.col("fromdate")), F.when(visit, F.col("todate"))
        ).alias("diabetes_visits"),
        F.bool_or(this_year & ivd).alias("ivd_this_year"),
        F.bool_or(last_year & ivd).alias("ivd_last_year"),
        F.bool_or(last_year & event).alias("event_last_year"),
        F.bool_or(has("excluded")).alias("excluded_by_code"),
        F.bool_or(pregnancy).alias("pregnancy"),
    )


def drug_facts(dfs_input, performance_yearstart: datetime.date, statins: tuple[str, ...]) -> DataFrame:
    """Member-level drug flags from one pass over two years of fills."""
    py = performance_yearstart
    fills = drug_fills(dfs_input, fills_needed(py, statins)[0])
    return member_flags(
        fills,
        {
            "diabetes_drug": on_list("Diabetes Medications"),
            "drug_excluded": on_list("Estrogen Agonists Medications"),
            "statin": on_list(*statins) & in_year("fromdate", py),
        },
    )


def statin_adherence(
    dfs_input, performance_yearstart: datetime.date, statins: tuple[str, ...], clamp: bool
) -> DataFrame:
    """Proportion of days covered by statins in the year."""
    fills = drug_fills(dfs_input, fills_needed(performance_yearstart, statins)[1])
    return proportion_days_covered(
        fills, year_end(performance_yearstart), clamp=clamp
    ).select("member_id", "pdc")


def cardiovascular() -> Column:
    """Ischemic vascular disease in both years, or an event in the first."""
    return (flag("ivd_this_year") & flag("ivd_last_year")) | flag("event_last_year")


def excluded_by_claims(dfs_input) -> Column:
    """Excluding codes, or a pregnancy of a female member.

    The gender stands on the claim; where it does not, the member's gender
    (``member_gender``) decides.
    """
    pregnant = flag("pregnancy")
    if "gender" not in table(dfs_input, "claims").columns:
        pregnant = pregnant & (F.col("member_gender") == "F")
    return flag("excluded_by_code") | pregnant


def two_year_spans(dfs_input, performance_yearstart: datetime.date) -> DataFrame:
    """Enrollment spans inside the two years with medical and pharmacy cover."""
    return table(dfs_input, "member_time").where(
        inside_years("date_start", "date_end", performance_yearstart)
        & (F.col("cover_medical") == "Y")
        & (F.col("cover_rx") == "Y")
    )
