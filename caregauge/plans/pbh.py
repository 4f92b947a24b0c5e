"""Persistence of beta-blocker treatment after a heart attack."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from caregauge.functions import age_on, year_end
from caregauge.operators.episodes import direct_transfers, first_episode
from caregauge.operators.intervals import enrolled_holes
from caregauge.operators.output import measure_rows
from caregauge.operators.supply import covered_days_after_index
from caregauge.operators.valuesets import ClaimNeed, CodeBook, CodeRule, codes_unique_to
from caregauge.plans.base import QualityMeasure
from caregauge.plans.common import FillNeed, attach, drug_fills, on_list, tagged_claims
from caregauge.sources.tables import table

FOLLOW_UP_DAYS = 180
ACUTE_STAY = "Acute Inpatient Stay"
STAY_BOOK = CodeBook(
    CodeRule("acute", "revcode", (ACUTE_STAY,)),
    CodeRule("nonacute", "revcode", ("Nonacute Inpatient Stay",)),
    CodeRule("ami", "icddiag", ("AMI",)),
    version="digits",
)


class PBH(QualityMeasure):
    """Denominator: adults discharged alive from an acute stay with a heart attack.

    Numerator: at least 135 of the following 180 days covered by beta-blockers.
    """

    @staticmethod
    def window(performance_yearstart: datetime.date) -> tuple[Column, Column]:
        """First and last day of an index discharge."""
        year = performance_yearstart.year
        return F.lit(datetime.date(year - 1, 7, 1)), F.lit(datetime.date(year, 6, 30))

    def claims_needed(self, dfs_input, performance_yearstart):
        reference = table(dfs_input, "reference")
        # A stay is acute when its code belongs to the acute set alone.
        acute_codes = codes_unique_to(reference, "Inpatient Stay", "Nonacute Inpatient Stay")
        codes = acute_codes.withColumn("value_set_name", F.lit(ACUTE_STAY)).unionByName(reference)
        window = self.window(performance_yearstart)
        # A stay matters when it ends in the window or begins the day after an end there.
        near = F.col("dischdate").between(*window) | F.col("admitdate").between(
            F.date_add(window[0], 1), F.date_add(window[1], 1)
        )
        return ClaimNeed(STAY_BOOK, codes, ("member_id", "claimid", "admitdate", "dischdate"), near)

    def fills_needed(self, performance_yearstart):
        return [FillNeed(on_list("Beta-Blocker Medications"))]

    def _calc_measure(self, dfs_input, performance_yearstart):
        member = table(dfs_input, "member")
        in_window = F.col("dischdate").between(*self.window(performance_yearstart))
        lines = tagged_claims(dfs_input, self.claims_needed(dfs_input, performance_yearstart))
        index = first_episode(
            direct_transfers(
                lines,
                episode=STAY_BOOK.has("acute") & STAY_BOOK.has("ami") & in_window,
                transfer=STAY_BOOK.has("acute"),
                veto=STAY_BOOK.has("nonacute"),
            ),
            "member_id",
            ["dischdate", "claimid"],
        )

        spans = table(dfs_input, "member_time").where(
            (F.col("cover_medical") == "Y") & (F.col("cover_rx") == "Y")
        )
        adults = member.where(age_on(year_end(performance_yearstart)) >= 18).select("member_id")
        late_hole = F.col("hole_start").between(
            F.col("dischdate"), F.date_add("dischdate", FOLLOW_UP_DAYS - 1)
        ) & (F.col("hole_days") - 1 >= 45)
        # Each input is used once: a member has one index row, and hole rows are at
        # most one per day.
        eligible = (
            index.join(adults.distinct(), "member_id", "left_semi")
            .join(enrolled_holes(spans), "member_id")
            .groupBy("member_id", "dischdate")
            .agg(
                F.coalesce(F.bool_or(late_hole), F.lit(False)).alias("late"),
                F.count("hole_start").alias("holes"),
            )
            .where(~F.col("late") & (F.col("holes") <= 1))
        )
        fills = drug_fills(dfs_input, self.fills_needed(performance_yearstart)[0])
        covered = covered_days_after_index(fills, eligible, FOLLOW_UP_DAYS)
        facts = attach(member.select("member_id").distinct(), covered)
        return measure_rows(
            facts,
            [("PBH", F.col("covered_days") >= 135, F.col("covered_days").isNotNull())],
        )
