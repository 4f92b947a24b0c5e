"""Childhood immunization status at the second birthday."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from caregauge.functions import year_end
from caregauge.operators.intervals import enrolled_holes
from caregauge.operators.output import RESULT_COLUMNS, measure_rows
from caregauge.operators.valuesets import ClaimNeed, CodeBook, CodeRule
from caregauge.plans.base import QualityMeasure
from caregauge.plans.common import attach, flag, tagged_claims
from caregauge.sources.tables import table


@dataclass(frozen=True)
class Vaccine:
    value_set: str
    min_days: int = 0


# Value sets and the minimum age in days of each vaccine.
DTAP = Vaccine("DTaP Vaccine Administered", 42)
IPV = Vaccine("Inactivated Polio Vaccine (IPV) Administered", 42)
HIB = Vaccine("Haemophilus Influenzae Type B (HiB) Vaccine Administered", 42)
PNEUMOCOCCAL = Vaccine("Pneumococcal Conjugate Vaccine Administered", 42)
INFLUENZA = Vaccine("Influenza Vaccine Administered", 180)
HEP_B = Vaccine("Hepatitis B Vaccine Administered")
HEP_A = Vaccine("Hepatitis A Vaccine Administered")
VZV = Vaccine("Varicella Zoster (VZV) Vaccine Administered")
ROTA_2 = Vaccine("Rotavirus Vaccine (2 Dose Schedule) Administered", 42)
ROTA_3 = Vaccine("Rotavirus Vaccine (3 Dose Schedule) Administered", 42)
MMR = Vaccine("Measles, Mumps and Rubella (MMR) Vaccine Administered")
MEASLES_RUBELLA = Vaccine("Measles/Rubella Vaccine Administered")
MUMPS = Vaccine("Mumps Vaccine Administered")
MEASLES = Vaccine("Measles Vaccine Administered")
RUBELLA = Vaccine("Rubella Vaccine Administered")
VACCINES = (
    DTAP, IPV, HIB, PNEUMOCOCCAL, INFLUENZA, HEP_B, HEP_A, VZV, ROTA_2, ROTA_3,
    MMR, MEASLES_RUBELLA, MUMPS, MEASLES, RUBELLA,
)
HISTORIES = ("Hepatitis B", "Hepatitis A", "Varicella Zoster", "Mumps", "Measles", "Rubella")
NEWBORN_HEP_B = "Newborn Hepatitis B Vaccine Administered"
NEWBORN_DAYS = 8
SECOND_BIRTHDAY_DAYS = 730

CHILD_BOOK = CodeBook(
    *[CodeRule(vaccine.value_set, "hcpcs", (vaccine.value_set,)) for vaccine in VACCINES],
    *[CodeRule(name, "icddiag", (name,)) for name in HISTORIES],
    CodeRule(NEWBORN_HEP_B, "icdproc", (NEWBORN_HEP_B,)),
    version="digits",
)


class CIS(QualityMeasure):
    """Ten immunization rates for children whose second birthday is in the year.

    Fixes: ``cis_exclusion`` drops the children with enrollment gaps (as published,
    only they are kept); ``newborn_hep_b`` grants the extra hepatitis B dose to
    children vaccinated in their first week only (as published, everybody with a
    dose gets it).
    """

    FIXES = frozenset({"cis_exclusion", "newborn_hep_b"})

    def claims_needed(self, dfs_input, performance_yearstart):
        until = F.col("fromdate") <= F.lit(year_end(performance_yearstart))
        return ClaimNeed(
            CHILD_BOOK, table(dfs_input, "reference"), ("member_id", "fromdate"), until
        )

    def _calc_measure(self, dfs_input, performance_yearstart):
        member = table(dfs_input, "member")
        children = member.select(
            "member_id", "dob", F.date_add("dob", SECOND_BIRTHDAY_DAYS).alias("second_birthday")
        ).where(
            F.col("second_birthday").between(
                F.lit(performance_yearstart), F.lit(year_end(performance_yearstart))
            )
        )
        spans = (
            table(dfs_input, "member_time")
            .where(F.col("cover_medical") == "Y")
            .join(children.select("member_id"), "member_id", "left_semi")
        )
        early_hole = F.col("hole_start").between(F.date_sub("dob", 365), F.col("dob")) & (
            F.col("hole_days") - 1 >= 45
        )
        gapped = F.coalesce(F.col("early"), F.lit(False)) | (F.col("holes") > 1)
        eligible = (
            enrolled_holes(spans)
            .join(children, "member_id")
            .groupBy("member_id", "dob", "second_birthday")
            .agg(F.bool_or(early_hole).alias("early"), F.count("hole_start").alias("holes"))
            .where(~gapped if "cis_exclusion" in self.fixes else gapped)
            .select("member_id", "dob", "second_birthday")
        )
        # Only the children's rows, then one per child and day. Where the children are too many to
        # broadcast, the semi-join's exchange by member also serves the aggregate.
        tagged = (
            tagged_claims(dfs_input, self.claims_needed(dfs_input, performance_yearstart))
            .join(children.select("member_id"), "member_id", "left_semi")
            .groupBy("member_id", "fromdate")
            .agg(*CHILD_BOOK.merged())
        )
        # Every eligible child stays, with or without claims.
        tagged = eligible.join(tagged, "member_id", "left")
        seen = F.col("fromdate") <= F.col("second_birthday")
        age = F.datediff("fromdate", "dob")
        newborn = seen & CHILD_BOOK.has(NEWBORN_HEP_B) & (age < NEWBORN_DAYS)
        doses = tagged.groupBy("member_id", "second_birthday").agg(
            F.bool_or(newborn).alias("newborn"),
            *[
                F.count_if(seen & CHILD_BOOK.has(v.value_set) & (age >= v.min_days)).alias(
                    v.value_set
                )
                for v in VACCINES
            ],
            *[F.bool_or(seen & CHILD_BOOK.has(name)).alias(name) for name in HISTORIES],
        )

        def given(vaccine: Vaccine, count: int = 1) -> Column:
            return F.coalesce(F.col(f"`{vaccine.value_set}`"), F.lit(0)) >= count

        if "newborn_hep_b" in self.fixes:
            hep_b = given(HEP_B, 3) | (given(HEP_B, 2) & flag("newborn"))
        else:
            hep_b = given(HEP_B, 2)
        mumps = given(MUMPS) | flag("Mumps")
        mmr = (
            given(MMR)
            | (given(MEASLES_RUBELLA) & mumps)
            | ((given(MEASLES) | flag("Measles")) & mumps & (given(RUBELLA) | flag("Rubella")))
        )
        rotavirus = given(ROTA_2, 2) | given(ROTA_3, 3) | (given(ROTA_2) & given(ROTA_3, 2))
        in_denominator = F.col("second_birthday").isNotNull()
        numerators = {
            "CIS - DTaP": given(DTAP, 4),
            "CIS - IPV": given(IPV, 3),
            "CIS - MMR": mmr,
            "CIS - HiB": given(HIB, 3),
            "CIS - Hepatitis B": hep_b | flag("Hepatitis B"),
            "CIS - VZV": given(VZV) | flag("Varicella Zoster"),
            "CIS - Pneumococcal Conjugate": given(PNEUMOCOCCAL, 4),
            "CIS - Hepatitis A": given(HEP_A) | flag("Hepatitis A"),
            "CIS - Rotavirus": rotavirus,
            "CIS - Influenza": given(INFLUENZA, 2),
        }
        facts = attach(member.select("member_id"), doses)
        return measure_rows(
            facts, [(name, met, in_denominator) for name, met in numerators.items()]
        ).select(*RESULT_COLUMNS)
