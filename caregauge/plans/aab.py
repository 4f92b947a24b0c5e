"""Avoidance of antibiotics in adults with acute bronchitis."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caregauge.functions import add_days, age_on, day_number
from caregauge.operators.episodes import day_timeline, first_episode, within_days
from caregauge.operators.intervals import coverage_around
from caregauge.operators.output import measure_rows
from caregauge.operators.valuesets import (
    ClaimNeed,
    CodeBook,
    CodeRule,
    require,
)
from caregauge.plans.base import QualityMeasure
from caregauge.plans.common import FillNeed, drug_fills, on_list, tagged_claims, visit_rules
from caregauge.sources.tables import table

# Value sets, drug list and drug descriptions of the measure.
VISITS = ("Outpatient", "Observation", "ED")
BRONCHITIS = "Acute Bronchitis"
ADMISSION = "Inpatient Stay"
NEGATIVE_CONDITIONS = (
    "HIV",
    "HIV Type 2",
    "Malignant Neoplasms",
    "Emphysema",
    "COPD",
    "Cystic Fibrosis",
    "Comorbid Conditions",
    "Disorders of the Immune System",
)
COMPETING = ("Pharyngitis", "Competing Diagnosis")
ANTIBIOTIC_LIST = "AAB Antibiotic Medications"
ANTIBIOTICS = (
    "Aminoglycosides",
    "Aminopenicillins",
    "Beta-lactamase inhibitors",
    "First generation cephalosporins",
    "Fourth generation cephalosporins",
    "Ketolides",
    "Lincomycin derivatives",
    "Macrolides",
    "Miscellaneous antibiotics",
    "Natural penicillins",
    "Penicillinase-resistant penicillins",
    "Quinolones",
    "Rifamycin derivatives",
    "Second generation cephalosporins",
    "Sulfonamides",
    "Tetracyclines",
    "Third generation cephalosporins",
    "Urinary anti-infectives",
)
ICD = ("ICD10CM", "ICD9CM")

BRONCHITIS_BOOK = CodeBook(
    *visit_rules("visit", VISITS, VISITS),
    CodeRule("bronchitis", "icddiag", (BRONCHITIS,), versioned=False),
    CodeRule("admission", "revcode", (ADMISSION,)),
    CodeRule("negative", "icddiag", NEGATIVE_CONDITIONS, versioned=False),
    CodeRule("competing", "icddiag", COMPETING, versioned=False),
)


def check_references(reference: DataFrame, ndc: DataFrame) -> None:
    """Every value set and drug group has codes, in code systems the rules read."""
    require(
        reference,
        present=(*VISITS, BRONCHITIS, ADMISSION, *NEGATIVE_CONDITIONS, *COMPETING),
        one_system=(BRONCHITIS, ADMISSION),
        accounted={
            **{name: ("CPT", "HCPCS", "UBREV") for name in VISITS},
            **{name: ICD for name in (*NEGATIVE_CONDITIONS, *COMPETING)},
        },
    )
    require(
        ndc.where(on_list(ANTIBIOTIC_LIST)).withColumnRenamed("description", "value_set_name"),
        present=ANTIBIOTICS,
    )


class AAB(QualityMeasure):
    """First eligible bronchitis visit per member; numerator: no antibiotic follows.

    All date conditions around a visit are frames over one day timeline of the
    member that carries visits, diagnoses, admissions and antibiotic fills.
    """

    def claims_needed(self, dfs_input, performance_yearstart):
        first, last = performance_yearstart, self.last_day(performance_yearstart)
        # Reach of the frames below: a year back, a week ahead.
        near = F.col("fromdate").between(
            F.date_sub(F.lit(first), 365), F.date_add(F.lit(last), 7)
        ) | F.col("admitdate").between(F.lit(first), F.date_add(F.lit(last), 1))
        columns = ("member_id", "fromdate", "admitdate")
        return ClaimNeed(BRONCHITIS_BOOK, table(dfs_input, "reference"), columns, near)

    def fills_needed(self, performance_yearstart):
        first, last = performance_yearstart, self.last_day(performance_yearstart)
        # Filled in reach of the frames, or supplied until the first visit day.
        near = (F.col("fromdate") <= F.date_add(F.lit(last), 3)) & (
            (F.col("fromdate") >= F.date_sub(F.lit(first), 30))
            | (add_days("fromdate", F.col("dayssupply")) >= F.lit(first))
        )
        return [FillNeed(on_list(ANTIBIOTIC_LIST) & F.col("description").isin(*ANTIBIOTICS), near)]

    @staticmethod
    def last_day(performance_yearstart: datetime.date) -> datetime.date:
        """The last day of an index visit."""
        py = performance_yearstart
        return py.replace(year=py.year + 1) - datetime.timedelta(days=8)

    def timeline(self, dfs_input, performance_yearstart: datetime.date) -> DataFrame:
        """Per member and day: what happened, and the look-back/-ahead flags."""
        has = BRONCHITIS_BOOK.has
        tagged = tagged_claims(dfs_input, self.claims_needed(dfs_input, performance_yearstart))
        no = F.lit(False)
        visit_day = F.struct(
            F.col("fromdate").alias("day"),
            (has("visit") & has("bronchitis")).alias("index"),
            has("negative").alias("negative"),
            has("competing").alias("competing"),
            no.alias("admitted"),
        )
        admission_day = F.struct(
            F.col("admitdate").alias("day"),
            no.alias("index"),
            no.alias("negative"),
            no.alias("competing"),
            has("admission").alias("admitted"),
        )
        fills = drug_fills(dfs_input, self.fills_needed(performance_yearstart)[0]).select(
            "member_id",
            F.col("fromdate").alias("day"),
            F.lit(True).alias("antibiotic"),
            day_number(add_days("fromdate", F.col("dayssupply"))).alias("supplied_until"),
        )
        events = (
            tagged.select("member_id", F.inline(F.array(visit_day, admission_day)))
            .unionByName(fills, allowMissingColumns=True)
        )
        flags = ("index", "negative", "competing", "admitted", "antibiotic", "supplied_until")
        days = day_timeline(events, "member_id", "day", {name: F.col(name) for name in flags})

        def seen(flag: str, low: int, high: int):
            return F.coalesce(within_days(flag, low, high), F.lit(False))

        still_supplied = within_days("supplied_until", None, -1) >= F.col("_n")
        return days.select(
            "member_id",
            "day",
            "index",
            seen("admitted", 0, 1).alias("then_admitted"),
            seen("negative", -365, 0).alias("negative_condition"),
            seen("antibiotic", -30, -1).alias("recent_script"),
            F.coalesce(still_supplied, F.lit(False)).alias("active_supply"),
            seen("competing", -30, 7).alias("competing_diagnosis"),
            seen("antibiotic", 0, 3).alias("antibiotic_follows"),
        )

    def _calc_measure(self, dfs_input, performance_yearstart, *, check: bool = True):
        py = performance_yearstart
        if check:
            check_references(table(dfs_input, "reference"), table(dfs_input, "ndc"))
        last = self.last_day(py)
        # A disqualified visit still stands for its member when none qualifies.
        qualified = ~(
            F.col("negative_condition")
            | F.col("recent_script")
            | F.col("active_supply")
            | F.col("competing_diagnosis")
        )
        events = (
            self.timeline(dfs_input, py)
            .where(
                F.col("index")
                & ~F.col("then_admitted")
                & F.col("day").between(F.lit(py), F.lit(last))
            )
            .select(
                "member_id",
                F.struct("day", qualified.alias("qualified"), "antibiotic_follows").alias("event"),
                F.date_sub("day", 365).alias("lo"),
                F.date_add("day", 7).alias("hi"),
            )
        )
        too_young = age_on(py.replace(year=py.year - 1), days_per_year=365.25) < 18
        too_old = age_on(last, days_per_year=365.25) > 64
        members = table(dfs_input, "member").select(
            "member_id", F.when(too_young | too_old, False).otherwise(True).alias("of_age")
        )
        eligible = (
            F.col("event.qualified")
            & ~((F.col("gap_count") > 1) | (F.col("gap_days") > 45))
            & F.col("of_age")
        )
        episodes = (
            coverage_around(
                events,
                # Only spans that touch a window count: from a year before the first day on.
                table(dfs_input, "member_time").where(
                    (F.col("date_end") >= F.date_sub(F.lit(py), 366))
                    & (F.col("date_start") <= F.date_add(F.lit(last), 8))
                ),
            )
            .join(members, "member_id")
            .select(
                "member_id",
                (~eligible).alias("ineligible"),
                "event.day",
                "event.antibiotic_follows",
            )
        )
        first = first_episode(
            episodes, "member_id", ["ineligible", "day"], ["antibiotic_follows"]
        )
        denominator = ~F.col("ineligible")
        return measure_rows(
            first, [("AAB", denominator & ~F.col("antibiotic_follows"), denominator)]
        )
