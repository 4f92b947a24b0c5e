"""Plan all-cause readmissions."""

from __future__ import annotations

import datetime
import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caregauge.functions import age_on, year_end
from caregauge.operators.episodes import (
    distinct_stays,
    flag_planned_next,
    flag_readmissions,
    merge_transfers,
)
from caregauge.operators.intervals import coverage_around
from caregauge.operators.output import RESULT_COLUMNS
from caregauge.operators.valuesets import (
    CHANNEL_SYSTEMS,
    ORDINAL,
    ClaimNeed,
    CodeBook,
    CodeRule,
    require_value_sets,
)
from caregauge.plans.base import QualityMeasure
from caregauge.plans.common import tagged_claims
from caregauge.sources.tables import table

# Value sets that must have codes.
REQUIRED = (
    "Inpatient Stay",
    "Nonacute Inpatient Stay",
    "Pregnancy",
    "Perinatal Conditions",
    "Chemotherapy",
    "Rehabilitation",
    "Kidney Transplant",
    "Bone Marrow Transplant",
    "Organ Transplant Other Than Kidney",
    "Potentially Planned Procedures",
    "Acute Condition",
)
DIED = "20"
DIAGNOSIS = " (diagnosis)"
READMITTED = 30  # days from discharge to the readmission
TRANSPLANTS = ("Kidney Transplant", "Bone Marrow Transplant")


@functools.cache
def stay_book(any_position: tuple[str, ...]) -> CodeBook:
    """Rules of a stay's lines; diagnoses count in first position unless listed."""
    rules = []
    for name in REQUIRED:
        for channel, systems in CHANNEL_SYSTEMS.items():
            if channel == "icddiag":
                first_only = name not in any_position
                rules.append(
                    CodeRule(name + DIAGNOSIS, channel, (name,), systems, principal=first_only)
                )
            else:
                rules.append(CodeRule(name, channel, (name,), systems))
    return CodeBook(*rules, version="padded")


def last_index_discharge(performance_yearstart: datetime.date) -> datetime.date:
    return datetime.date(performance_yearstart.year, 12, 1)


def last_admission(performance_yearstart: datetime.date) -> datetime.date:
    """Last day on which a readmission or the next planned stay of an index stay can begin."""
    return last_index_discharge(performance_yearstart) + datetime.timedelta(days=READMITTED)


class PCR(QualityMeasure):
    """Counts of index stays (denominator) and of those followed by a readmission.

    Fix ``value_set_names``: rehabilitation counts as planned care, and kidney and
    bone marrow transplant diagnoses count in any position. As published, three
    misspelt names keep these rules from ever applying.

    Stays of later years leave before the windows. A stay that ends more than 30 days
    before it begins, admitted after the year, is no index stay.
    """

    FIXES = frozenset({"value_set_names"})

    def claims_needed(self, dfs_input, performance_yearstart):
        return ClaimNeed(
            stay_book(
                (
                    "Organ Transplant Other Than Kidney",
                    *(TRANSPLANTS if "value_set_names" in self.fixes else ()),
                )
            ),
            table(dfs_input, "reference"),
            ("member_id", "claimid", "admitdate", "dischdate", "dischargestatus"),
            F.col("dischdate") >= F.lit(performance_yearstart),
            also=F.col(ORDINAL) == 0,  # every line counts for dates and discharge status
        )

    def stays(
        self, dfs_input, performance_yearstart, admitted_until: datetime.date | None = None
    ) -> DataFrame:
        """Acute stays after merging transfers, with exclusion flags.

        With ``admitted_until``, stays admitted later are not all there.
        """
        repaired = "value_set_names" in self.fixes
        need = self.claims_needed(dfs_input, performance_yearstart)
        book = need.book
        rows = tagged_claims(dfs_input, need)
        per_claim = rows.groupBy("member_id", "claimid").agg(
            F.min("admitdate").alias("admitdate"),
            F.max("dischdate").alias("dischdate"),
            F.bool_or(F.coalesce(F.col("dischargestatus") == DIED, F.lit(False))).alias("died"),
            *book.merged(),
        )

        def any_of(*names: str) -> Column:
            return F.expr(
                " OR ".join(
                    f"({book.sql(name)} OR {book.sql(name + DIAGNOSIS)})" for name in names
                )
            )

        always_planned = ["Chemotherapy", *TRANSPLANTS, "Organ Transplant Other Than Kidney"]
        if repaired:
            always_planned.append("Rehabilitation")
        planned = any_of(*always_planned) | (
            any_of("Potentially Planned Procedures") & ~any_of("Acute Condition")
        )
        stays = distinct_stays(
            per_claim.where(any_of("Inpatient Stay") & ~any_of("Nonacute Inpatient Stay"))
            .select(
                "member_id",
                "claimid",
                "admitdate",
                "dischdate",
                (F.col("died") | any_of("Pregnancy", "Perinatal Conditions")).alias("exclude_base"),
                planned.alias("planned_flag"),
            ),
            ["exclude_base", "planned_flag"],
            admitted_until,
        )
        return flag_planned_next(
            merge_transfers(stays, ["exclude_base"], ["planned_flag"]), READMITTED
        )

    def index_stays(self, dfs_input, performance_yearstart) -> DataFrame:
        """Index stays with enough enrollment around them and their readmission flag."""
        last_discharge = last_index_discharge(performance_yearstart)
        until = last_admission(performance_yearstart)
        candidates = flag_readmissions(
            self.stays(dfs_input, performance_yearstart, until), ~F.col("exclude_base"), READMITTED
        ).where(
            (F.col("admitdate") != F.col("dischdate"))
            & ~F.col("exclude_base")
            & ~F.col("exclude_planned")
            & F.col("dischdate").between(F.lit(performance_yearstart), F.lit(last_discharge))
            & (F.col("admitdate") <= F.lit(until))
        )

        def period(name: str, before: int, after: int) -> Column:
            return F.struct(
                F.struct("transfer_claimid", "has_readmit", F.lit(name).alias("period")).alias(
                    "event"
                ),
                F.date_sub("dischdate", before).alias("lo"),
                F.date_add("dischdate", after).alias("hi"),
            )

        events = candidates.select(
            "member_id", F.inline(F.array(period("prior", 365, 0), period("after", 0, 30)))
        )
        lapsed = F.when(
            F.col("event.period") == "prior",
            (F.col("gap_count") > 1) | (F.col("gap_days") > 45),
        ).otherwise(F.col("gap_count") > 0)
        return (
            coverage_around(
                events,
                # Only spans that touch a window count: a year before to a month after discharge.
                table(dfs_input, "member_time").where(
                    (F.col("date_end") >= F.date_sub(F.lit(performance_yearstart), 366))
                    & (F.col("date_start") <= F.date_add(F.lit(last_discharge), 31))
                ),
            )
            .groupBy("member_id", F.col("event.transfer_claimid").alias("transfer_claimid"))
            .agg(
                F.bool_or(lapsed).alias("lapsed"),
                F.bool_or("event.has_readmit").alias("has_readmit"),
            )
            .where(~F.col("lapsed"))
            .drop("lapsed")
        )

    def _calc_measure(self, dfs_input, performance_yearstart, *, check: bool = True):
        if check:
            require_value_sets(table(dfs_input, "reference"), REQUIRED)
        of_age = (
            table(dfs_input, "member")
            .where(age_on(year_end(performance_yearstart)).between(18, 64))
            .select("member_id")
        )
        return (
            self.index_stays(dfs_input, performance_yearstart)
            .groupBy("member_id")
            .agg(
                F.count_if("has_readmit").alias("comp_quality_numerator"),
                F.count("*").alias("comp_quality_denominator"),
            )
            .join(of_age, "member_id")
            .select(
                "*",
                F.lit("PCR").alias("comp_quality_short"),
                F.lit(None).cast("string").alias("comp_quality_date_last"),
                F.lit(None).cast("string").alias("comp_quality_date_actionable"),
                F.lit(None).cast("string").alias("comp_quality_comments"),
            )
            .select(*RESULT_COLUMNS)
        )
