"""Golden cases of the measures that have them."""

from __future__ import annotations

import datetime

import pytest

from caregauge.plans import AWV, MMA, PBH, PCPFollowup
from caregauge.plans.pcp import COLUMNS
from tests.helpers import rows, scores, table

PCP_ROWS = """
I12 C1 A1 Y Y 0
I12 C1 A1 Y Y 0
I12 C2 A2 Y Y 1
I11b C3 A3 Y Y 2
I11a C4 A3 Y Y 2
I11a C5 A3 Y Y 2
I11a C6 A3 N Y 2
I11a C7 A3 N N 2
I11a C8 A3 Y Y 8
I11a C9 A3 Y Y 15
I11a C10 A3 N N 31
I11a C11 A4 N Y 3
I11a C12 A4 N Y 3
I11a C13 A4 N Y 3
I11a C14 A4 N Y 3
I11a C15 A4 Y Y 14
I11a C16 A5 N Y 4
I11a C17 A6 N Y 5
I13a C18 A7 Y Y 6
I14a C19 A8 Y Y 7
I14b C20 A9 Y Y 8
I12 C21 A10 N Y 9
I12 C23 A11 N N 11
I13b C25 A12 Y Y 13
I11a C26 A13 Y Y 14
I11a C29 A14 Y Y 17
I11a C30 A15 N N 18
I11a C31 A16 N Y 19
"""
# member: numerator within 7 days, within 14 days, denominator
PCP_EXPECTED = {
    "A1": (1, 1, 1), "A2": (1, 1, 1), "A3": (2, 3, 5), "A4": (0, 1, 5), "A5": (0, 0, 1),
    "A6": (0, 0, 1), "A7": (1, 1, 1), "A8": (1, 1, 1), "A9": (0, 1, 1), "A10": (0, 0, 1),
    "A11": (0, 0, 0), "A12": (0, 1, 1), "A13": (0, 1, 1), "A14": (0, 0, 1), "A15": (0, 0, 0),
    "A16": (0, 0, 1),
}


@pytest.mark.parametrize("prefix", ["", "src_"])
@pytest.mark.parametrize(("cutoff", "column"), [(7, 0), (14, 1)])
def test_pcp_followup(spark, cutoff, column, prefix):
    claims = table(
        spark,
        f"{prefix}service_line string, claimid string, member_id string, "
        f"{prefix}pcp_followup_success_yn string, {prefix}pcp_followup_potential_yn string, "
        f"{prefix}pcp_followup_days_since int",
        PCP_ROWS,
    )
    # Another table with a similar name and further columns of the same endings don't matter.
    claims = claims.selectExpr("*", "'O10' AS other_line")
    named = {name: prefix + usual for name, usual in COLUMNS.items()}
    result = PCPFollowup().calc_measure(
        {"outclaims": claims.select("claimid", "member_id"), "outclaims_prm": claims},
        datetime.date(2018, 1, 1), cutoff=cutoff, source="outclaims_prm", columns=named,
    )
    assert scores(result) == {m: (e[column], e[2]) for m, e in PCP_EXPECTED.items()}
    assert {r["comp_quality_short"] for r in result.collect()} == {f"PCP Followup: {cutoff}-Day"}


# member, claim, revenue code, diagnosis, span start, span end, drug list, fill day, supply, born
PBH_ROWS = """
MrNoAMI claim_1 0123 0000 2018-01-01 2018-06-01 Other 2018-01-02 30 1980-01-01
MrAMIBigGap claim_2 0123 1111 2018-02-01 2018-02-03 Other 2018-01-02 30 1980-01-01
MrAMIBigGap claim_3 0123 1111 2018-04-03 2018-04-04 Other 2018-01-02 30 1980-01-01
MsAMITwoGaps claim_4 0123 1111 2018-01-01 2018-01-15 Other 2018-01-02 30 1980-01-01
MsAMITwoGaps claim_5 0123 1111 2018-01-17 2018-03-02 Other 2018-01-02 30 1980-01-01
MsAMITwoGaps claim_6 0123 1111 2018-03-04 2018-03-30 Other 2018-01-02 30 1980-01-01
MissAMINumerator claim_7 0123 1111 2018-01-01 2018-06-01 Beta 2018-02-02 135 1970-01-01
MrsAMINoNumerator claim_8 0123 1111 2018-01-01 2018-06-01 Beta 2018-02-02 125 1970-01-01
"""


def pbh_tables(spark, text: str):
    wide = table(
        spark,
        "member_id string, claimid string, revcode string, icddiag1 string, date_start date, "
        "date_end date, medication_list string, fromdate date, dayssupply double, dob date",
        text,
    ).selectExpr(
        "*",
        "CASE medication_list WHEN 'Beta' THEN 'Beta-Blocker Medications' ELSE 'Other' END AS list",
        "concat('ndc-', medication_list) AS ndc",
        "date'2018-01-01' AS admitdate",
        "date'2018-01-02' AS dischdate",
        "'10' AS icdversion",
        "CAST(NULL AS STRING) AS icddiag2",
        "'Y' AS cover_medical",
        "'Y' AS cover_rx",
    )
    return {
        "reference": table(
            spark,
            "value_set_name string, code string, code_system string",
            """
            NotAMI 0000 A10
            AMI 1111 Q10
            Inpatient_Stay 0123 revcode
            """,
        ).selectExpr("replace(value_set_name, '_', ' ') AS value_set_name", "code", "code_system"),
        "claims": wide.select(
            "member_id", "claimid", "admitdate", "dischdate", "icdversion", "icddiag1",
            "icddiag2", "revcode", "fromdate",
        ),
        "member": wide.select("member_id", "dob").distinct(),
        "member_time": wide.select(
            "member_id", "date_start", "date_end", "cover_medical", "cover_rx"
        ),
        "rx_claims": wide.select("member_id", "claimid", "fromdate", "dayssupply", "ndc"),
        "ndc": wide.selectExpr("ndc AS ndc_code", "list AS medication_list").distinct(),
    }


def test_pbh(spark):
    result = PBH().calc_measure(pbh_tables(spark, PBH_ROWS), datetime.date(2018, 1, 1))
    assert scores(result) == {
        "MrNoAMI": (0, 0),
        "MrAMIBigGap": (0, 0),
        "MsAMITwoGaps": (0, 0),
        "MissAMINumerator": (1, 1),
        "MrsAMINoNumerator": (0, 1),
    }


def test_pbh_needs_an_adult(spark):
    text = "child c1 0123 1111 2018-01-01 2018-06-01 Beta 2018-02-02 140 2010-01-01"
    result = PBH().calc_measure(pbh_tables(spark, text), datetime.date(2018, 1, 1))
    assert scores(result) == {"child": (0, 0)}


def test_pbh_overlapping_fills_count_once(spark):
    # Two fills of 80 days, 40 of them shared: 120 covered days are not enough.
    text = """
    twice c1 0123 1111 2018-01-01 2018-08-01 Beta 2018-01-10 80 1970-01-01
    twice c1 0123 1111 2018-01-01 2018-08-01 Beta 2018-02-19 80 1970-01-01
    """
    result = PBH().calc_measure(pbh_tables(spark, text), datetime.date(2018, 1, 1))
    assert scores(result) == {"twice": (0, 1)}


# Wellness visits: calendar year 2019, known up to 2019-03-31.
AWV_CLAIMS = """
has_core_visit_icd icd_core_wellcare 2019-01-31 XXXXX Z0000
has_core_visit_hcpcs hcpcs_core_wellcare 2019-01-31 99394 XXXX
has_medicare_visit medicare_awv 2019-01-31 G0402 XXXX
has_both_measure_types earlier_core_visit 2019-01-31 99394 XXXX
has_both_measure_types later_awv_visit 2019-02-15 G0402 XXXX
rolling_12_only prior_year_medicare_awv 2018-12-01 99392 XXXX
has_elig_gap elig_gap_wellcare 2019-03-20 99392 XXXX
"""
AWV_MEMBERS = (
    "has_core_visit_icd", "has_core_visit_hcpcs", "has_medicare_visit",
    "has_both_measure_types", "has_no_claims", "rolling_12_only",
)
PAID = datetime.date(2019, 3, 31)
YEAR = (datetime.date(2019, 1, 1), datetime.date(2019, 12, 31))
ROLLING = (datetime.date(2018, 4, 1), PAID)
JAN_31, FEB_15 = datetime.date(2019, 1, 31), datetime.date(2019, 2, 15)


def awv_tables(spark):
    covered = "\n".join(f"{m} 2018-01-01 2019-03-31 Y" for m in AWV_MEMBERS)
    covered += "\nhas_elig_gap 2018-01-01 2019-01-31 Y\nhas_elig_gap 2019-03-20 2019-03-31 Y"
    return {
        "med_claims": table(
            spark,
            "member_id string, claimid string, fromdate date, hcpcs string, icddiag2 string",
            AWV_CLAIMS,
        ).selectExpr(
            "*", "'XXXX' AS revcode", "'10' AS icdversion", "'XXXX' AS icddiag1",
            "CAST(NULL AS STRING) AS icddiag3",
        ),
        "member": spark.createDataFrame(
            [(m,) for m in (*AWV_MEMBERS, "has_elig_gap")], "member_id string"
        ),
        "member_time": table(
            spark,
            "member_id string, date_start date, date_end date, cover_medical string",
            covered,
        ),
        "reference": table(
            spark,
            "value_set_name string, code string, code_system string",
            """
            Well-Care 99392 CPT
            Well-Care 99394 CPT
            Well-Care Z00.00 ICD10CM
            Unrelated G0402 HCPCS
            """,
        ),
    }


@pytest.mark.parametrize(
    ("codes", "period", "visits"),
    [
        (
            "refs_well_care_core",
            YEAR,
            {
                "has_core_visit_icd": JAN_31,
                "has_core_visit_hcpcs": JAN_31,
                "has_both_measure_types": JAN_31,
            },
        ),
        ("reference_awv", YEAR, {"has_medicare_visit": JAN_31, "has_both_measure_types": FEB_15}),
        (
            None,
            YEAR,
            {
                "has_core_visit_icd": JAN_31,
                "has_core_visit_hcpcs": JAN_31,
                "has_medicare_visit": JAN_31,
                "has_both_measure_types": FEB_15,
            },
        ),
        (
            "refs_well_care_core",
            ROLLING,
            {
                "has_core_visit_icd": JAN_31,
                "has_core_visit_hcpcs": JAN_31,
                "has_both_measure_types": JAN_31,
                "rolling_12_only": datetime.date(2018, 12, 1),
            },
        ),
    ],
)
def test_awv(spark, codes, period, visits):
    first, last = period
    result = AWV().calc_measure(
        awv_tables(spark),
        first,
        datetime_end=last,
        filter_reference=codes,
        date_latestpaid=PAID,
    )
    expected = [
        ("has_elig_gap", 0, 0, None, None, "Member is excluded due to gaps in eligibility")
    ]
    for member in AWV_MEMBERS:
        if member in visits:
            text = f"Most Recent Service: {visits[member]:%m/%d/%Y}"
            expected.append((member, 1, 1, visits[member], None, text))
        else:
            text = f"No related services observed since: {first:%m/%d/%Y}"
            expected.append((member, 0, 1, None, last, text))
    assert rows(
        result,
        "member_id",
        "comp_quality_numerator",
        "comp_quality_denominator",
        "comp_quality_date_last",
        "comp_quality_date_actionable",
        "comp_quality_comments",
    ) == sorted(expected, key=repr)


ASTHMA_REFERENCE = """
ED 0450 UBREV
Outpatient 0510 UBREV
Acute_Inpatient 0110 UBREV
Asthma J45.901 ICD10CM
COPD J44.9 ICD10CM
"""
ASTHMA_DRUGS = """
pill oral Leukotriene_modifiers d1
anti subcutaneous Antibody_inhibitor d2
puff inhalation Inhaled_corticosteroids d3
help inhalation Short-acting_inhaled_beta-2_agonists d4
mist inhalation Inhaled_corticosteroids d1
shot subcutaneous Antibody_inhibitor d1
"""


def mma_result(spark, claims: str, fills: str, born: str = "1980-01-01", fixes=(), claimid: str = "uuid()"):
    """Result over one-span members; claims: member day revcode diagnosis; fills: member day ndc supply."""
    reference = table(
        spark, "value_set_name string, code string, code_system string", ASTHMA_REFERENCE
    ).selectExpr("replace(value_set_name, '_', ' ') AS value_set_name", "code", "code_system")
    ndc = table(
        spark, "ndc_code string, route string, description string, drug_id string", ASTHMA_DRUGS
    ).selectExpr("ndc_code", "route", "replace(description, '_', ' ') AS description", "drug_id")
    med = table(
        spark,
        "member_id string, fromdate date, revcode string, icddiag1 string",
        claims,
    ).selectExpr("*", "'10' AS icdversion", "CAST(NULL AS STRING) AS icddiag2", "'c' AS claimid")
    rx = table(
        spark, "member_id string, fromdate date, ndc string, dayssupply double", fills
    ).selectExpr("*", f"{claimid} AS claimid")
    people = med.select("member_id").union(rx.select("member_id")).distinct()
    tables = {
        "reference": reference,
        "ndc": ndc,
        "claims": med,
        "rx_claims": rx,
        "member": people.selectExpr("member_id", f"date'{born}' AS dob"),
        "member_time": people.selectExpr(
            "member_id", "date'2018-01-01' AS date_start", "date'2018-12-31' AS date_end",
            "'Y' AS cover_medical", "'Y' AS cover_rx",
        ),
    }
    return scores(MMA(fixes).calc_measure(tables, datetime.date(2018, 1, 1)))


def test_mma_positive_and_negative_cases(spark):
    claims = """
    ed_covered 2018-01-05 0450 J45901
    ed_uncovered 2018-01-05 0450 J45901
    copd 2018-01-05 0450 J45901
    copd 2018-02-05 0510 J449
    reliever_only 2018-01-05 0450 J45901
    other_diagnosis 2018-01-05 0450 J06
    one_visit 2018-01-05 0510 J45901
    four_visits 2018-01-05 0510 J45901
    four_visits 2018-02-05 0510 J45901
    four_visits 2018-03-05 0510 J45901
    four_visits 2018-04-05 0510 J45901
    """
    fills = """
    ed_covered 2018-01-10 puff 300
    ed_uncovered 2018-01-10 puff 30
    copd 2018-01-10 puff 300
    reliever_only 2018-01-10 help 300
    other_diagnosis 2018-01-10 puff 300
    one_visit 2018-01-10 puff 300
    four_visits 2018-01-10 puff 30
    four_visits 2018-02-10 puff 30
    """
    assert mma_result(spark, claims, fills) == {
        "ed_covered": (1, 1),
        "ed_uncovered": (0, 1),
        "four_visits": (0, 1),
    }


def test_mma_age_limits(spark):
    claims, fills = "m 2018-01-05 0450 J45901", "m 2018-01-10 puff 300"
    assert mma_result(spark, claims, fills, born="2015-10-30") == {}
    assert mma_result(spark, claims, fills, born="2013-10-30") == {"m": (1, 1)}


def test_mma_long_oral_fill_counts_per_month(spark):
    claims, fills = "m 2018-01-05 0450 J45901", "m 2018-01-10 pill 150"
    # As published, five copies of the fill stand in the table and cover the year.
    assert mma_result(spark, claims, fills, fixes=["pdc_clamp"]) == {"m": (1, 1)}
    assert mma_result(spark, claims, fills, fixes=["pdc_clamp", "duplicate_fills"]) == {
        "m": (0, 1)
    }
    # A fill of 15 days or less rounds to no event at all, so nothing was dispensed.
    assert mma_result(spark, claims, "m 2018-01-10 pill 15") == {}


def test_mma_oral_events_repeat_all_fills_of_their_claim(spark):
    """An oral and an inhaled fill of one drug and claim stand for two event rows each: 120 of 159 days."""
    claims, fills = "m 2018-01-05 0450 J45901", "m 2018-07-25 pill 30\n m 2018-07-25 mist 30"
    assert mma_result(spark, claims, fills, claimid="'r'") == {"m": (1, 1)}
    assert mma_result(spark, claims, fills, claimid="ndc") == {"m": (0, 1)}  # apart: one row of the pill, two of the day
    # 90 days oral and injected: three events on both, one more for the injection.
    assert mma_result(spark, claims, "m 2018-07-25 pill 30\n m 2018-07-25 shot 30", claimid="'r'") == {"m": (0, 1)}


def test_mma_identical_injected_fills_are_one_event(spark):
    claims, fills = "m 2018-01-05 0450 J45901", "m 2018-07-25 anti 30\n m 2018-07-25 anti 30"
    # One event row, joined to two fills: 60 of 159 days.
    assert mma_result(spark, claims, fills, claimid="'r'") == {"m": (0, 1)}
    assert mma_result(spark, claims, fills.replace("30", "38"), claimid="'r'") == {"m": (0, 1)}
    assert mma_result(spark, claims, fills, claimid="CAST(monotonically_increasing_id() AS STRING)") == {"m": (1, 1)}


def test_mma_fills_only_member_has_no_denominator(spark):
    claims = "other 2018-01-05 0510 J06"
    fills = """
    m 2018-01-02 puff 90
    m 2018-04-02 puff 90
    m 2018-07-02 puff 90
    m 2018-10-02 puff 90
    """
    assert mma_result(spark, claims, fills) == {"m": (1, 0)}
