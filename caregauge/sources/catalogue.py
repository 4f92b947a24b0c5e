"""Built-in reference rows: the measure catalogue and the Medicare wellness codes."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Name, title, category, target of every reported measure.
MEASURES = [
    ("SPD: Rate One", "Statin Therapy for Patients With Diabetes: Received Statin Therapy", "At Risk Population - Diabetes", ".6"),
    ("SPD: Rate Two", "Statin Therapy for Patients With Diabetes: Statin Adherence 80%", "At Risk Population - Diabetes", ".7"),
    ("SPC: Rate One (Total)", "Statin Therapy for Patients With Cardiovascular Disease: Received Statin Therapy (Total)", "At Risk Population - Cardiovascular", ".8"),
    ("SPC: Rate One (Females 40-75)", "Statin Therapy for Patients With Cardiovascular Disease: Received Statin Therapy (Females 40-75)", "At Risk Population - Cardiovascular", ".8"),
    ("SPC: Rate One (Males 21-75)", "Statin Therapy for Patients With Cardiovascular Disease: Received Statin Therapy (Males 21-75)", "At Risk Population - Cardiovascular", ".8"),
    ("SPC: Rate Two (Total)", "Statin Therapy for Patients With Cardiovascular Disease: Statin Adherence 80% (Total)", "At Risk Population - Cardiovascular", ".75"),
    ("SPC: Rate Two (Females 40-75)", "Statin Therapy for Patients With Cardiovascular Disease: Statin Adherence 80% (Females 40-75)", "At Risk Population - Cardiovascular", ".75"),
    ("SPC: Rate Two (Males 21-75)", "Statin Therapy for Patients With Cardiovascular Disease: Statin Adherence 80% (Males 21-75)", "At Risk Population - Cardiovascular", ".75"),
    ("PBH", "Persistence of Beta-Blockers after Heart Attack", "At Risk Population - Cardiovascular", ".85"),
    ("CIS - DTaP", "Childhood Immunization Status: DTap", "Preventive Health", ".80"),
    ("CIS - IPV", "Childhood Immunization Status: IPV", "Preventive Health", ".85"),
    ("CIS - HiB", "Childhood Immunization Status: HiB", "Preventive Health", ".85"),
    ("CIS - Pneumococcal Conjugate", "Childhood Immunization Status: Pneumococcal Conjugate", "Preventive Health", ".8"),
    ("CIS - Influenza", "Childhood Immunization Status: Influenza", "Preventive Health", ".65"),
    ("CIS - Hepatitis B", "Childhood Immunization Status: Hepatitis B", "Preventive Health", ".8"),
    ("CIS - Hepatitis A", "Childhood Immunization Status: Hepatitis A", "Preventive Health", ".85"),
    ("CIS - VZV", "Childhood Immunization Status: VZV", "Preventive Health", ".9"),
    ("CIS - Rotavirus", "Childhood Immunization Status: Rotavirus", "Preventive Health", ".75"),
    ("CIS - MMR", "Childhood Immunization Status: MMR", "Preventive Health", ".9"),
    ("PCR", "All-Cause Readmissions", "Care Coordination/Patient Safety", ".1"),
    ("MPM3", "Annual Monitoring for Patients on Persistent Medications: Diuretics", "Medication Management and Care Coordination", ".5"),
    ("CDC: HBA1C", "Comprehensive Diabetes Care: HbA1c Testing", "Diabetes", ".9"),
    ("CDC: NEP", "Comprehensive Diabetes Care: Medical Attention for Nephropathy", "Diabetes", ".9"),
    ("CDC: EYE", "Comprehensive Diabetes Care: Eye Exam", "Diabetes", ".5"),
    ("MMA", "Persistent Asthma Patients with >75% Medication Adherence", "Respiratory Conditions", ".4"),
    ("AAB", "Avoidance of Antibiotic Treatment in Adults With Acute Bronchitis", "Overuse/Appropriateness", "0.9"),
    ("PCP Followup: 7-Day", "PCP Follow-Up within 7 Days of Inpatient Hospital Discharge", "Transitions of Care", ".5"),
    ("PCP Followup: 14-Day", "PCP Follow-Up within 14 Days of Inpatient Hospital Discharge", "Transitions of Care", ".5"),
    ("AWV: Combined", "Medicare Annual Wellness Visits or Preventative Service Visits", "Preventive Health", ".3"),
    ("AWV: Combined Rolling", "Medicare Annual Wellness Visits or Preventative Service Visits past 12 months", "Preventive Health", ".3"),
    ("AWV: Medicare", "Medicare Annual Wellness Visits", "Preventive Health", ".3"),
    ("AWV: Medicare Rolling", "Medicare Annual Wellness Visits past 12 months", "Preventive Health", ".3"),
]
LOWER_IS_BETTER = {"PCR"}
RATE_MEASURES = {"PCR", "PCP Followup: 7-Day", "PCP Followup: 14-Day"}
PERCENT_FORMAT = "#,##0.0%"

# Medicare wellness visit codes (HCPCS).
MEDICARE_WELLNESS = [
    ("G0402", "Welcome to Medicare Initial Visit"),
    ("G0438", "Medicare AWV - Initial"),
    ("G0439", "Medicare AWV - Subsequent"),
]


def local_table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A few driver rows of text columns as a table whose size Spark knows.

    The size lets Spark decide on its own whether to broadcast the table.
    """
    names = columns.split()
    arrays = [pa.array([row[i] for row in rows], pa.string()) for i in range(len(names))]
    return spark.createDataFrame(pa.table(arrays, names=names))


def measure_catalogue(spark: SparkSession) -> DataFrame:
    """One row per reported measure; the target is text, as in a reference file."""
    rows = [
        (
            str(number),
            short,
            title,
            category,
            "Lower_Better" if short in LOWER_IS_BETTER else "Higher_Better",
            target,
            PERCENT_FORMAT,
            "Rate" if short in RATE_MEASURES else "Binary",
        )
        for number, (short, title, category, target) in enumerate(MEASURES, start=1)
    ]
    return local_table(
        spark,
        rows,
        "comp_quality_dual comp_quality_short comp_quality comp_quality_category "
        "comp_quality_direction comp_quality_target_value comp_quality_format_code "
        "comp_quality_calculation_type",
    ).withColumn("comp_quality_dual", F.col("comp_quality_dual").cast("int"))


def medicare_wellness_codes(spark: SparkSession) -> DataFrame:
    return local_table(
        spark,
        [("Well-Care-Custom", code, text, "HCPCS", None) for code, text in MEDICARE_WELLNESS],
        "value_set_name code definition code_system code_system_oid",
    )
