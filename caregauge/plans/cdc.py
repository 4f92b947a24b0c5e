"""Comprehensive diabetes care: HbA1c test, nephropathy attention, eye exam."""

from __future__ import annotations

from pyspark.sql import functions as F

from caregauge.functions import age_on, in_year, in_years, inside_years, year_end
from caregauge.operators.intervals import continuously_enrolled
from caregauge.operators.output import measure_rows
from caregauge.operators.valuesets import ClaimNeed, CodeBook, CodeRule
from caregauge.plans.base import QualityMeasure
from caregauge.plans.common import (
    FillNeed,
    attach,
    drug_fills,
    flag,
    member_flags,
    on_list,
    tagged_claims,
    two_or_more,
    visit_rules,
)
from caregauge.sources.tables import table

NONACUTE = ("Outpatient", "ED", "Nonacute Inpatient")
RETINAL = "Diabetic Retinal Screening"
DIABETES_BOOK = CodeBook(
    *visit_rules("acute", ("Acute Inpatient",), ("Acute Inpatient",), ("CPT",)),
    *visit_rules("nonacute", NONACUTE, NONACUTE),
    CodeRule("diabetes", "icddiag", ("Diabetes",)),
    CodeRule("a1c", "hcpcs", ("HbA1c Tests",), ("CPT", "CPT-CAT-II")),
    CodeRule(
        "kidney",
        "hcpcs",
        ("Urine Protein Tests", "Nephropathy Treatment", "ESRD", "Kidney Transplant"),
        ("CPT", "CPT-CAT-II", "HCPCS"),
    ),
    # Type-of-bill codes are compared with the revenue code, as published.
    CodeRule("kidney", "revcode", ("ESRD", "Kidney Transplant"), ("UBREV", "UBTOB")),
    CodeRule("kidney", "pos", ("ESRD",), ("POS",)),
    CodeRule(
        "kidney",
        "icddiag",
        ("Nephropathy Treatment", "CKD Stage 4", "ESRD", "Kidney Transplant"),
        ("ICD10CM", "ICD9CM"),
    ),
    CodeRule("kidney", "icdproc", ("ESRD", "Kidney Transplant"), ("ICD10PCS", "ICD9PCS")),
    CodeRule("retinal", "hcpcs", (RETINAL,)),
    CodeRule("uncomplicated", "icddiag", ("Diabetes Mellitus Without Complications",)),
    CodeRule(
        "eye",
        "hcpcs",
        (f"{RETINAL} With Eye Care Professional", f"{RETINAL} Negative"),
    ),
    CodeRule("enucleation", "hcpcs", ("Unilateral Eye Enucleation",)),
    CodeRule("left_eye", "icdproc", ("Unilateral Eye Enucleation Left",)),
    CodeRule("right_eye", "icdproc", ("Unilateral Eye Enucleation Right",)),
)
# Specialty codes.
EYE_SPECIALTIES = ("18", "41")
NEPHROLOGY = "39"
DAYS_BETWEEN_ENUCLEATIONS = 14


class CDC(QualityMeasure):
    """Three rates over members aged 18–75 with diabetes and continuous cover."""

    def claims_needed(self, dfs_input, performance_yearstart):
        py = performance_yearstart
        return ClaimNeed(
            DIABETES_BOOK,
            table(dfs_input, "reference"),
            ("member_id", "fromdate", "specialty", "modifier", "modifier2"),
            in_years("fromdate", py),
            also=in_year("fromdate", py) & (F.col("specialty") == NEPHROLOGY),
        )

    def fills_needed(self, performance_yearstart):
        lists = on_list("Diabetes Medications", "ACE Inhibitor/ARB Medications")
        return [FillNeed(lists, in_years("fromdate", performance_yearstart))]

    def _calc_measure(self, dfs_input, performance_yearstart):
        py = performance_yearstart
        has = DIABETES_BOOK.has
        this_year = in_year("fromdate", py)
        need = self.claims_needed(dfs_input, py)
        nephrologist = need.also
        rows = tagged_claims(dfs_input, need)
        nonacute_date = F.when(has("nonacute") & has("diabetes"), F.col("fromdate"))
        seen_by_eye_doctor = has("retinal") & F.col("specialty").isin(*EYE_SPECIALTIES)
        both_eyes = has("enucleation") & (
            (F.col("modifier") == "50")
            | F.coalesce(F.col("modifier2") == "50", F.lit(False))
        )
        left_date = F.when(this_year & has("left_eye"), F.col("fromdate"))
        exam = (
            (this_year & seen_by_eye_doctor)
            | (in_year("fromdate", py, -1) & seen_by_eye_doctor & has("uncomplicated"))
            | (this_year & (has("eye") | both_eyes))
        )
        left = F.bool_or(this_year & has("left_eye"))
        right = F.bool_or(this_year & has("right_eye"))
        apart = F.datediff(F.max(left_date), F.min(left_date)) >= DAYS_BETWEEN_ENUCLEATIONS
        from_claims = rows.groupBy("member_id").agg(
            F.bool_or(has("acute") & has("diabetes")).alias("acute_diabetes"),
            two_or_more(nonacute_date).alias("nonacute_diabetes"),
            F.bool_or(this_year & has("a1c")).alias("tested"),
            F.bool_or((this_year & has("kidney")) | nephrologist).alias("kidney_care"),
            (
                F.coalesce(F.bool_or(exam), F.lit(False))
                | F.coalesce(apart, F.lit(False))
                | (left & right)
            ).alias("eye_exam"),
        )
        drugs = member_flags(
            drug_fills(dfs_input, self.fills_needed(py)[0]),
            {
                "diabetes_drug": on_list("Diabetes Medications"),
                "kidney_drug": on_list("ACE Inhibitor/ARB Medications") & this_year,
            },
        )
        spans = table(dfs_input, "member_time").where(
            inside_years("date_start", "date_end", py, 0, 0) & (F.col("cover_medical") == "Y")
        )
        members = table(dfs_input, "member").where(
            age_on(year_end(py)).between(18, 75)
        ).select("member_id")
        diabetic = flag("acute_diabetes") | flag("nonacute_diabetes") | flag("diabetes_drug")
        facts = attach(
            members.join(continuously_enrolled(spans), "member_id", "left_semi"),
            from_claims,
            drugs,
        ).where(diabetic)
        everyone = F.lit(True)
        nephropathy = flag("kidney_care") | flag("kidney_drug")
        return measure_rows(
            facts,
            [
                ("CDC: HBA1C", flag("tested"), everyone),
                ("CDC: EYE", flag("eye_exam"), everyone),
                ("CDC: NEP", nephropathy, everyone),
            ],
            date_type="date",
        )
