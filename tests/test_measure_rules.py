"""One member per include or exclude reason, for the measures without golden files."""

from __future__ import annotations

import datetime

import pytest

from caregauge.plans import AAB, CDC, CIS, MPM3, PCR, SPC, SPD, run_all
from checks.claim_rows import ANTIBIOTICS
from tests.helpers import scores, table

PY = datetime.date(2018, 1, 1)
CLAIM_COLUMNS = {
    "hcpcs": "-", "revcode": "-", "billtype": "-", "pos": "-", "specialty": "-",
    "modifier": "-", "modifier2": "-", "dischargestatus": "-", "icdversion": "10",
    "icddiag1": "-", "icddiag2": "-", "icdproc1": "-", "gender": "F",
}
# value set, code, code system
REFERENCE = """
Outpatient OUT CPT
Observation OBS CPT
ED ED1 CPT
Nonacute_Inpatient NON CPT
Acute_Inpatient ACU CPT
Inpatient_Stay 0110 UBREV
Nonacute_Inpatient_Stay 0190 UBREV
Diabetes E11 ICD10CM
IVD I25 ICD10CM
MI I21 ICD10CM
CABG 33533 CPT
PCI 92920 CPT
Other_Revascularization 37220 CPT
Pregnancy O80 ICD10CM
IVF 58970 CPT
Cirrhosis K74 ICD10CM
Muscular_Pain_and_Disease M60 ICD10CM
ESRD N186 ICD10CM
Lab_Panel 80047 CPT
Serum_Potassium 84132 CPT
Serum_Creatinine 82565 CPT
HbA1c_Tests 83036 CPT
Urine_Protein_Tests 81000 CPT
Unilateral_Eye_Enucleation_Left 08T1 ICD10PCS
Unilateral_Eye_Enucleation_Right 08T0 ICD10PCS
Diabetic_Retinal_Screening 92002 CPT
Diabetes_Mellitus_Without_Complications E119 ICD10CM
Perinatal_Conditions P07 ICD10CM
Chemotherapy Z51 ICD10CM
Rehabilitation Z50 ICD10CM
Kidney_Transplant Z94 ICD10CM
Bone_Marrow_Transplant 38240 CPT
Organ_Transplant_Other_Than_Kidney Z941 ICD10CM
Potentially_Planned_Procedures 0DT ICD10PCS
Acute_Condition J18 ICD10CM
Acute_Bronchitis J20 ICD10CM
HIV B20 ICD10CM
HIV_Type_2 B97 ICD10CM
Malignant_Neoplasms C80 ICD10CM
Emphysema J43 ICD10CM
COPD J44 ICD10CM
Cystic_Fibrosis E84 ICD10CM
Comorbid_Conditions D57 ICD10CM
Disorders_of_the_Immune_System D80 ICD10CM
Pharyngitis J02 ICD10CM
Competing_Diagnosis H66 ICD10CM
DTaP_Vaccine_Administered DTAP CPT
Hepatitis_B_Vaccine_Administered HEPB CPT
Newborn_Hepatitis_B_Vaccine_Administered 3E02 ICD10PCS
Measles,_Mumps_and_Rubella_(MMR)_Vaccine_Administered MMR CPT
Measles/Rubella_Vaccine_Administered MR CPT
Mumps B26 ICD10CM
Varicella_Zoster B01 ICD10CM
Rotavirus_Vaccine_(2_Dose_Schedule)_Administered ROT2 CPT
Rotavirus_Vaccine_(3_Dose_Schedule)_Administered ROT3 CPT
"""
DRUGS = """
Diabetes_Medications insulin d1
Diuretic_Medications water d2
Estrogen_Agonists_Medications clomid d3
High_and_Moderate-Intensity_Statin_Medications statin d4
Low-Intensity_Statin_Medications weak d5
ACE_Inhibitor/ARB_Medications ace d6
"""


def spaced(df, *columns):
    return df.selectExpr(
        *[
            f"replace({name}, '_', ' ') AS {name}" if name in columns else name
            for name in df.columns
        ]
    )


class World:
    """Input tables from short texts.

    Claims: ``member from to key=value …``; fills: ``member day drug supply``; spans:
    ``member start end medical rx`` (a full two years when a member has none).
    """

    def __init__(self, spark, claims="", fills="", spans="", born="1960-01-01", gender="F"):
        names, rows = list(CLAIM_COLUMNS), []
        members = set()
        for number, line in enumerate(filter(str.strip, claims.splitlines())):
            member, first, last, *pairs = line.split()
            members.add(member)
            values = {"id": f"c{number:03}", **CLAIM_COLUMNS, **dict(p.split("=") for p in pairs)}
            rows.append(
                " ".join([member, values["id"], first, last, *[values[n] for n in names]])
            )
        rows = rows or ["nobody c 2018-01-01 2018-01-01 " + " ".join(CLAIM_COLUMNS.values())]
        schema = "member_id string, claimid string, fromdate date, todate date, " + ", ".join(
            f"{n} string" for n in names
        )
        claim_table = table(spark, schema, "\n".join(rows)).selectExpr(
            "*", "fromdate AS admitdate", "todate AS dischdate"
        )
        fills = fills or "nobody 2010-01-01 none 1"
        rx = table(spark, "member_id string, fromdate date, ndc string, dayssupply double", fills)
        members |= {line.split()[0] for line in fills.splitlines() if line.strip()}
        covered = {line.split()[0] for line in spans.splitlines() if line.strip()}
        lines = [line for line in spans.splitlines() if line.strip()]
        for member in members - covered:
            lines += [
                f"{member} {year}-01-01 {year}-12-31 Y Y" for year in (2016, 2017, 2018, 2019)
            ]
        self.tables = {
            "claims": claim_table,
            "rx_claims": rx.selectExpr("*", "'x' AS claimid"),
            "member": spark.createDataFrame(
                [(m,) for m in sorted(members | covered)], "member_id string"
            ).selectExpr("*", f"date'{born}' AS dob", f"'{gender}' AS gender"),
            "member_time": table(
                spark,
                "member_id string, date_start date, date_end date, cover_medical string, "
                "cover_rx string",
                "\n".join(lines),
            ),
            "reference": spaced(
                table(
                    spark, "value_set_name string, code string, code_system string", REFERENCE
                ),
                "value_set_name",
            ),
            "ndc": spaced(
                table(spark, "medication_list string, ndc_code string, drug_id string", DRUGS),
                "medication_list",
            )
            .selectExpr("*", "'oral' AS route", "'none' AS description")
            .unionByName(
                spark.createDataFrame(
                    [("AAB Antibiotic Medications", f"anti{i}", f"a{i}", "oral", name)
                     for i, name in enumerate(ANTIBIOTICS)],
                    "medication_list string, ndc_code string, drug_id string, route string, "
                    "description string",
                )
            ),
        }

    def score(self, measure, name=None):
        result = measure.calc_measure(self.tables, PY)
        if name:
            result = result.where(result["comp_quality_short"] == name)
        return {m: s for m, s in scores(result).items() if m != "nobody"}


def test_mpm(spark):
    world = World(
        spark,
        claims="""
        panel 2018-02-01 2018-02-01 hcpcs=80047
        both_tests 2018-02-01 2018-02-01 hcpcs=84132
        both_tests 2018-05-01 2018-05-01 hcpcs=82565
        one_test 2018-02-01 2018-02-01 hcpcs=84132
        last_year 2017-02-01 2017-02-01 hcpcs=80047
        short_supply 2018-02-01 2018-02-01 hcpcs=80047
        no_drug_cover 2018-02-01 2018-02-01 hcpcs=80047
        """,
        fills="""
        panel 2018-01-10 water 180
        both_tests 2018-01-10 water 90
        both_tests 2018-01-10 water 90
        one_test 2018-01-10 water 200
        last_year 2018-01-10 water 200
        short_supply 2018-07-10 water 300
        no_drug_cover 2018-01-10 water 200
        """,
        spans="no_drug_cover 2018-01-01 2018-12-31 Y N",
    )
    # short_supply: only 174 days up to the year end count.
    assert world.score(MPM3()) == {
        "panel": (1, 1), "both_tests": (1, 1), "one_test": (0, 1), "last_year": (0, 1),
        "short_supply": (0, 0), "no_drug_cover": (0, 0),
    }


SPD_CLAIMS = """
any_diagnosis 2018-02-01 2018-02-01 icddiag1=E11
pregnant 2018-02-01 2018-02-01 icddiag1=E11
pregnant 2018-03-01 2018-03-01 icddiag2=O80
heart_last_year 2017-02-01 2017-02-01 icddiag1=I21 revcode=0110
heart_no_stay 2017-02-01 2017-02-01 icddiag1=I21
ivd_both 2017-02-01 2017-02-01 icddiag1=I25 hcpcs=OUT
ivd_both 2018-02-01 2018-02-01 icddiag1=I25 hcpcs=OUT
ivd_once 2018-02-01 2018-02-01 icddiag1=I25 hcpcs=OUT
kidney 2017-02-01 2017-02-01 icddiag1=N186
clomid 2018-02-01 2018-02-01 icddiag1=E11
nothing 2018-02-01 2018-02-01 icddiag1=Z00
"""
SPD_FILLS = """
any_diagnosis 2018-01-01 statin 360
pregnant 2018-01-01 statin 360
heart_last_year 2018-01-01 insulin 30
heart_no_stay 2018-01-01 insulin 30
heart_no_stay 2018-01-10 weak 30
ivd_both 2018-01-01 insulin 30
ivd_once 2017-01-01 insulin 30
kidney 2018-01-01 insulin 30
clomid 2018-01-01 clomid 30
"""


def test_spd(spark):
    world = World(spark, SPD_CLAIMS, SPD_FILLS)
    one = world.score(SPD(), "SPD: Rate One")
    assert {m for m, (_, d) in one.items() if d} == {"any_diagnosis", "heart_no_stay", "ivd_once"}
    assert {m for m, (n, _) in one.items() if n} == {"any_diagnosis", "heart_no_stay"}
    two = world.score(SPD(), "SPD: Rate Two")
    assert {m: s for m, s in two.items() if s[1]} == {
        "any_diagnosis": (1, 1), "heart_no_stay": (0, 1)
    }


def test_spd_acute_setting_fix(spark):
    world = World(
        spark,
        """
        once 2018-02-01 2018-02-01 icddiag1=E11
        acute 2018-02-01 2018-02-01 icddiag1=E11 hcpcs=ACU
        visits 2018-02-01 2018-02-01 icddiag1=E11 hcpcs=OUT
        visits 2018-03-01 2018-03-01 icddiag1=E11 hcpcs=ED1
        same_day 2018-03-01 2018-03-01 icddiag1=E11 hcpcs=OUT
        same_day 2018-03-01 2018-03-01 icddiag1=E11 hcpcs=ED1
        """,
    )
    as_published = world.score(SPD(), "SPD: Rate One")
    assert {m for m, (_, d) in as_published.items() if d} == {"once", "acute", "visits", "same_day"}
    repaired = world.score(SPD(["acute_setting"]), "SPD: Rate One")
    assert {m for m, (_, d) in repaired.items() if d} == {"acute", "visits"}


def test_pdc_clamp_fix(spark):
    # Stock pushed far beyond the year end takes covered days away, as published.
    world = World(
        spark,
        "m 2018-02-01 2018-02-01 icddiag1=E11",
        """
        m 2018-01-01 statin 350
        m 2018-12-01 statin 90
        m 2018-12-02 statin 90
        """,
    )
    assert world.score(SPD(), "SPD: Rate Two") == {"m": (0, 1)}
    assert world.score(SPD(["pdc_clamp"]), "SPD: Rate Two") == {"m": (1, 1)}


def test_spc_strata(spark):
    world = World(
        spark,
        "event 2017-02-01 2017-02-01 hcpcs=33533\nnone 2017-02-01 2017-02-01 hcpcs=OUT",
        "event 2018-01-05 statin 330",
        gender="M",
    )
    rows = {
        (r["member_id"], r["comp_quality_short"]): (
            r["comp_quality_numerator"], r["comp_quality_denominator"]
        )
        for r in SPC().calc_measure(world.tables, PY).collect()
    }
    assert rows == {
        (m, f"SPC: Rate {rate} ({group})"): (1, 1) if m == "event" else (0, 0)
        for m in ("event", "none")
        for rate in ("One", "Two")
        for group in ("Males 21-75", "Total")
    }


def test_cdc(spark):
    world = World(
        spark,
        """
        tested 2018-02-01 2018-02-01 hcpcs=83036
        acute 2018-02-01 2018-02-01 hcpcs=ACU icddiag1=E11
        one_visit 2018-02-01 2018-02-01 hcpcs=OUT icddiag1=E11
        two_visits 2018-02-01 2018-02-01 hcpcs=OUT icddiag1=E11
        two_visits 2018-02-02 2018-02-02 hcpcs=ED1 icddiag1=E11
        kidney_doctor 2018-02-01 2018-02-01 specialty=39
        left_twice 2018-02-01 2018-02-01 icdproc1=08T1
        left_twice 2018-02-15 2018-02-15 icdproc1=08T1
        left_soon 2018-02-01 2018-02-01 icdproc1=08T1
        left_soon 2018-02-14 2018-02-14 icdproc1=08T1
        left_right 2018-02-01 2018-02-01 icdproc1=08T1
        left_right 2018-02-02 2018-02-02 icdproc1=08T0
        retina_prior 2017-02-01 2017-02-01 hcpcs=92002 specialty=18 icddiag1=E119
        retina_complicated 2017-02-01 2017-02-01 hcpcs=92002 specialty=18 icddiag1=E11
        retina_now 2018-02-01 2018-02-01 hcpcs=92002 specialty=41
        retina_other_doctor 2018-02-01 2018-02-01 hcpcs=92002 specialty=11
        """,
        "\n".join(
            f"{m} 2018-01-01 insulin 30"
            for m in (
                "tested kidney_doctor left_twice left_soon left_right retina_prior "
                "retina_complicated retina_now retina_other_doctor drug_only"
            ).split()
        )
        + "\ndrug_only 2018-01-01 ace 30",
    )
    met = {
        name: {m for m, (n, _) in world.score(CDC(), name).items() if n}
        for name in ("CDC: HBA1C", "CDC: NEP", "CDC: EYE")
    }
    assert met == {
        "CDC: HBA1C": {"tested"},
        "CDC: NEP": {"kidney_doctor", "drug_only"},
        "CDC: EYE": {"left_twice", "left_right", "retina_prior", "retina_now"},
    }
    eligible = set(world.score(CDC(), "CDC: HBA1C"))
    assert "one_visit" not in eligible and {"acute", "two_visits", "drug_only"} <= eligible


def test_aab(spark):
    visit = "2018-06-01 2018-06-01 hcpcs=OUT icddiag1=J20"
    world = World(
        spark,
        f"""
        clean {visit}
        treated {visit}
        treated_late {visit}
        admitted {visit}
        admitted 2018-06-02 2018-06-05 revcode=0110
        hiv {visit}
        hiv 2017-06-01 2017-06-01 icddiag1=B20
        hiv_long_ago {visit}
        hiv_long_ago 2017-05-31 2017-05-31 icddiag1=B20
        competing {visit}
        competing 2018-06-08 2018-06-08 icddiag1=J02
        recent {visit}
        active {visit}
        second_visit {visit}
        second_visit 2018-08-01 2018-08-01 revcode=OUT hcpcs=OBS icddiag2=J20
        gap {visit}
        no_diagnosis 2018-06-01 2018-06-01 hcpcs=OUT icddiag1=Z00
        """,
        """
        treated 2018-06-04 anti0 5
        treated_late 2018-06-05 anti0 5
        recent 2018-05-31 anti1 1
        active 2018-03-01 anti2 100
        second_visit 2018-05-20 anti3 3
        """,
        """
        gap 2016-01-01 2018-01-31 Y Y
        gap 2018-03-20 2018-12-31 Y Y
        """,
        born="1980-01-01",
    )
    assert world.score(AAB()) == {
        "clean": (1, 1), "treated": (0, 1), "treated_late": (1, 1), "hiv": (0, 0),
        "hiv_long_ago": (1, 1), "competing": (0, 0), "recent": (0, 0), "active": (0, 0),
        "second_visit": (1, 1), "gap": (0, 0),
    }


def test_aab_refuses_incomplete_references(spark):
    world = World(spark, "m 2018-06-01 2018-06-01 hcpcs=OUT")
    reference = world.tables["reference"]
    world.tables["reference"] = reference.where("value_set_name <> 'COPD'")
    with pytest.raises(ValueError, match="COPD"):
        AAB().calc_measure(world.tables, PY)
    world.tables["reference"] = reference.where("code <> 'J20'").unionByName(
        reference.where("code = 'J20'").replace("ICD10CM", "SNOMED")
    ).replace("ICD10CM", "SNOMED", ["code_system"])
    with pytest.raises(ValueError, match="SNOMED"):
        AAB().calc_measure(world.tables, PY)


def test_pcr(spark):
    def stay(member, first, last, **extra):
        codes = {"revcode": "0110", **extra}
        return f"{member} {first} {last} " + " ".join(f"{k}={v}" for k, v in codes.items())

    world = World(
        spark,
        "\n".join(
            [
                stay("alone", "2018-03-01", "2018-03-05"),
                stay("back", "2018-03-01", "2018-03-05"),
                stay("back", "2018-04-04", "2018-04-08"),
                stay("back_late", "2018-03-01", "2018-03-05"),
                stay("back_late", "2018-04-05", "2018-04-08"),
                stay("transfer", "2018-03-01", "2018-03-05"),
                stay("transfer", "2018-03-06", "2018-03-09"),
                stay("planned", "2018-03-01", "2018-03-05"),
                stay("planned", "2018-03-20", "2018-03-25", icddiag1="Z51"),
                stay("planned_second", "2018-03-01", "2018-03-05"),
                stay("planned_second", "2018-03-20", "2018-03-25", icddiag2="Z51"),
                stay("kidney_second", "2018-03-01", "2018-03-05"),
                stay("kidney_second", "2018-03-20", "2018-03-25", icddiag2="Z94"),
                stay("died", "2018-03-01", "2018-03-05", dischargestatus="20"),
                stay("nonacute", "2018-03-01", "2018-03-05", revcode="0190"),
                stay("same_day", "2018-03-01", "2018-03-01"),
                stay("december", "2018-12-01", "2018-12-05"),
                stay("uncovered_after", "2018-03-01", "2018-03-05"),
                stay("uncovered_before", "2018-03-01", "2018-03-05"),
            ]
        ),
        spans="""
        uncovered_after 2016-01-01 2018-03-10 Y Y
        uncovered_after 2018-03-20 2018-12-31 Y Y
        uncovered_before 2016-01-01 2017-06-30 Y Y
        uncovered_before 2017-09-01 2018-12-31 Y Y
        """,
    )
    assert world.score(PCR()) == {
        "alone": (0, 1),
        "back": (1, 2),
        "back_late": (0, 2),
        "transfer": (0, 1),
        "planned": (0, 1),
        "planned_second": (1, 2),
        "kidney_second": (1, 2),
    }
    repaired = world.score(PCR(["value_set_names"]))
    # The transplant stay now counts as planned, so the stay before it is no index stay.
    assert repaired["kidney_second"] == (0, 1)
    assert repaired["planned_second"] == (1, 2)


def test_cis(spark):
    # Born 2016-03-01: the second birthday is 2018-03-01.
    claims = """
    gaps 2016-05-01 2016-05-01 hcpcs=DTAP
    gaps 2016-07-01 2016-07-01 hcpcs=DTAP
    gaps 2016-09-01 2016-09-01 hcpcs=DTAP
    gaps 2018-03-01 2018-03-01 hcpcs=DTAP
    gaps 2016-05-01 2016-05-01 hcpcs=HEPB
    gaps 2016-07-01 2016-07-01 hcpcs=HEPB
    gaps 2017-05-01 2017-05-01 hcpcs=MR
    gaps 2017-05-02 2017-05-02 icddiag1=B26
    gaps 2016-05-01 2016-05-01 hcpcs=ROT2
    gaps 2016-06-01 2016-06-01 hcpcs=ROT3
    gaps 2016-07-02 2016-07-02 hcpcs=ROT3
    whole 2016-04-01 2016-04-01 hcpcs=DTAP
    whole 2016-05-01 2016-05-01 hcpcs=DTAP
    whole 2016-07-01 2016-07-01 hcpcs=DTAP
    whole 2018-03-02 2018-03-02 hcpcs=DTAP
    whole 2016-05-01 2016-05-01 hcpcs=HEPB
    whole 2016-06-01 2016-06-01 hcpcs=HEPB
    whole 2016-03-05 2016-03-05 icdproc1=3E02
    whole 2017-05-02 2017-05-02 icddiag1=B01
    """
    spans = """
    gaps 2016-03-01 2016-12-31 Y Y
    gaps 2017-01-05 2017-06-30 Y Y
    gaps 2017-07-05 2018-12-31 Y Y
    whole 2016-03-01 2018-12-31 Y Y
    """
    world = World(spark, claims, spans=spans, born="2016-03-01")

    def met(measure):
        rows = measure.calc_measure(world.tables, PY).collect()
        assert len(rows) == 10 * world.tables["member"].count()
        rows = [r for r in rows if r["member_id"] != "nobody"]
        return {
            (r["member_id"], r["comp_quality_short"].removeprefix("CIS - "))
            for r in rows
            if r["comp_quality_numerator"]
        }, {r["member_id"] for r in rows if r["comp_quality_denominator"]}

    numerator, denominator = met(CIS())
    # As published, the children with gaps are the ones kept, and two doses of
    # hepatitis B are enough.
    assert denominator == {"gaps"}
    assert numerator == {
        ("gaps", "DTaP"), ("gaps", "Hepatitis B"), ("gaps", "MMR"), ("gaps", "Rotavirus")
    }
    numerator, denominator = met(CIS(["cis_exclusion", "newborn_hep_b"]))
    assert denominator == {"whole"}
    # The first DTaP shot came before day 42, the last after the second birthday.
    assert numerator == {("whole", "Hepatitis B"), ("whole", "VZV")}


def test_run_all_stacks_every_measure(spark):
    world = World(spark, SPD_CLAIMS, SPD_FILLS)
    world.tables["followup_claims"] = table(
        spark,
        "member_id string, claimid string, service_line string, pcp_followup_success_yn string, "
        "pcp_followup_potential_yn string, pcp_followup_days_since int",
        "kidney c1 i12 Y Y 9",
    )
    stacked = run_all(world.tables, PY, datetime.date(2018, 9, 30))
    assert dict(stacked.dtypes)["comp_quality_date_last"] == "date"
    found = {
        (r["member_id"], r["comp_quality_short"]): r["comp_quality_numerator"]
        for r in stacked.collect()
    }
    assert found["any_diagnosis", "SPD: Rate Two"] == 1
    assert found["kidney", "PCP Followup: 7-Day"] == 0
    assert found["kidney", "PCP Followup: 14-Day"] == 1
    assert found["kidney", "AWV: Medicare"] == 0
    assert ("kidney", "SPD: Rate One") not in found
