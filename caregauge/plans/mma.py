"""Medication adherence of members with persistent asthma."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caregauge.functions import in_year, in_years, year_end
from caregauge.operators.intervals import dealt_out, enrollment_gaps
from caregauge.operators.output import measure_rows
from caregauge.operators.supply import dispensing_events, proportion_days_covered
from caregauge.operators.valuesets import ClaimNeed, CodeBook, CodeRule
from caregauge.plans.base import QualityMeasure
from caregauge.plans.common import COUNTED_FILLS, FillNeed, attach, drug_list_fills, flag, tagged_claims
from caregauge.sources.tables import table

# Drug descriptions and name patterns of the measure.
LEUKOTRIENE = "Leukotriene modifiers"
ANTIBODY = "Antibody inhibitor"
CONTROLLERS = (
    "Antiasthmatic combinations",
    "Antibody inhibitor",
    "Inhaled steroid combinations",
    "Inhaled corticosteroids",
    "Leukotriene modifiers",
    "Mast cell stabilizers",
    "Methylxanthines",
)
RELIEVERS = ("Short-acting inhaled beta-2 agonists",)
EXCLUDED_DIAGNOSES = (
    "Emphysema|COPD|Obstructive Chronic Bronchitis|Chronic Respiratory Conditions"
    "|Cystic Fibrosis|Acute Respiratory Failure"
)

ASTHMA_BOOK = CodeBook(
    CodeRule("ed", "revcode", systems=("UBREV",), pattern=r"\bED\b"),
    CodeRule("acute", "revcode", systems=("UBREV",), pattern="Acute Inpatient"),
    CodeRule("ambulatory", "revcode", systems=("UBREV",), pattern="Outpatient|Observation"),
    CodeRule("asthma", "icddiag", pattern="Asthma", versioned=False),
    CodeRule("principal_asthma", "icddiag", pattern="Asthma", principal=True),
    CodeRule("excluded", "icddiag", pattern=EXCLUDED_DIAGNOSES, versioned=False),
    version="digits",
)


class MMA(QualityMeasure):
    """Members aged 5–64 with persistent asthma; numerator: 75% of days covered.

    Fixes: ``pdc_clamp`` as in the statin measures; ``duplicate_fills`` counts every
    controller fill once (as published, identical fills multiply each other, a fill
    counts once per event of its claim and day, and identical injected fills are one).
    """

    FIXES = frozenset({"pdc_clamp", "duplicate_fills"})

    def claims_needed(self, dfs_input, performance_yearstart):
        return ClaimNeed(ASTHMA_BOOK, table(dfs_input, "reference"), ("member_id", "fromdate"))

    def fills_needed(self, performance_yearstart):
        return [FillNeed(F.col("description").isin(*CONTROLLERS, *RELIEVERS))]

    def counted_fills(self, dfs_input) -> DataFrame:
        """Asthma fills, those of one drug code, day and supply as one row.

        ``same`` is their number in the fill table, ``rows`` how many rows of the event
        table they stand for. Events are joined back to all fills of their group, of any
        route: the oral events of a (day, supply, drug, claim) and one inhaled event of a
        (day, drug) each repeat every fill there. Injected fills count once for each
        distinct row of the fill table.
        """
        ndc, rx = table(dfs_input, "ndc"), table(dfs_input, "rx_claims")
        # Only fills of the listed drugs are shuffled to be counted.
        asthma = drug_list_fills(dfs_input, self.fills_needed(None)[0])
        fills = asthma.groupBy(*asthma.columns).agg(F.count("*").alias("_copies"))
        day = ("member_id", "fromdate", "drug_id")
        # Both windows and the grouping below stay within these tasks, which adaptive execution doesn't join.
        fills = dealt_out(fills, day)
        claim = Window.partitionBy(*day, "dayssupply", "claimid")
        same_day = Window.partitionBy(*day)
        oral = F.when(F.col("route") == "oral", dispensing_events())
        times = F.coalesce(F.max(oral).over(claim), F.lit(0)) + F.coalesce(
            F.max(F.col("route") == "inhalation").over(same_day), F.lit(False)
        ).cast("int")
        injected = (F.coalesce("route", F.lit("")) == "subcutaneous").cast("int")
        return (
            fills.withColumn("rows", F.col("_copies") * F.col("_listed") * times + injected)
            .groupBy("member_id", "ndc", "fromdate", "dayssupply", *sorted(set(ndc.columns) - set(rx.columns)))
            .agg(F.sum("rows").alias("rows"), F.sum("_copies").alias("same"))
            .where(F.col("rows") > 0)
            .withColumn("controller", F.col("description").isin(*CONTROLLERS))
        )

    def _drug_facts(self, fills: DataFrame, py: datetime.date) -> DataFrame:
        """Member-level facts about asthma fills.

        A dispensing event is a (drug code, day, kind), so fills are reduced to
        those first.
        """
        kind = F.col("description")
        events = fills.groupBy("member_id", "ndc", "fromdate", "controller").agg(
            F.sum("rows").alias("rows"),
            F.bool_or(kind == LEUKOTRIENE).alias("leukotriene"),
            F.bool_or(kind == ANTIBODY).alias("antibody"),
            F.bool_or(~kind.isin(LEUKOTRIENE, ANTIBODY)).alias("third"),
        )

        def any_in(condition, year):
            return F.coalesce(F.bool_or(condition & year), F.lit(False))

        def only_special(offset: int):
            """Both special descriptions in that year and no third one."""
            year = in_year("fromdate", py, offset)
            return (
                any_in(F.col("leukotriene"), year)
                & any_in(F.col("antibody"), year)
                & ~any_in(F.col("third"), year)
            )

        recent = in_years("fromdate", py)
        return events.groupBy("member_id").agg(
            F.count("*").alias("events"),
            (any_in(F.lit(True), recent) & ~any_in(F.col("controller"), recent)).alias(
                "no_controller"
            ),
            ((only_special(-1) | only_special(0)) & (F.sum("rows") >= 4)).alias("special_rule"),
        )

    def _claim_facts(self, dfs_input, py: datetime.date) -> DataFrame:
        """Member-level facts from one pass over the claims (reduced per day first)."""
        has = ASTHMA_BOOK.has
        seen = has("asthma") & (has("ed") | has("acute") | has("ambulatory"))
        rows = tagged_claims(dfs_input, self.claims_needed(dfs_input, py))
        daily = rows.groupBy("member_id", "fromdate").agg(
            F.bool_or(seen).alias("asthma_visit"),
            F.bool_or(has("asthma") & has("ambulatory")).alias("ambulatory_visit"),
            F.bool_or(has("principal_asthma") & (has("ed") | has("acute"))).alias("urgent_visit"),
            F.bool_or(has("excluded")).alias("excluded"),
        )
        return daily.groupBy("member_id").agg(
            F.bool_or("asthma_visit").alias("asthma_visit"),
            F.bool_or("urgent_visit").alias("urgent_visit"),
            F.count_if("ambulatory_visit").alias("ambulatory_days"),
            F.bool_or(
                F.col("excluded") & (F.col("fromdate") <= F.lit(year_end(py)))
            ).alias("claims_excluded"),
        )

    def _adherence(self, fills: DataFrame, py: datetime.date) -> DataFrame:
        """Proportion of days covered by controllers (fills from the last day of the
        previous year on)."""
        if "duplicate_fills" in self.fixes:
            copies = F.col("same")
        else:
            copies = F.col("rows") * F.col("same")
        window = F.col("fromdate").between(F.lit(year_end(py, -1)), F.lit(year_end(py)))
        return proportion_days_covered(
            fills.where(F.col("controller") & window),
            year_end(py),
            copies=copies,
            clamp="pdc_clamp" in self.fixes,
        ).select("member_id", (F.col("pdc") >= 0.75).alias("adherent"))

    def _calc_measure(self, dfs_input, performance_yearstart):
        py = performance_yearstart
        final = year_end(py)
        members = (
            table(dfs_input, "member")
            .where(F.abs(F.year("dob") - F.lit(final.year)).between(5, 64))
            .select("member_id")
            .distinct()
        )
        covered = table(dfs_input, "member_time").where(F.col("cover_medical") == "Y")
        enrolled = enrollment_gaps(covered, py, final).where(
            ~((F.col("largest_gap") >= 45) & (F.col("gap_count") > 1))
        )
        fills = dfs_input[COUNTED_FILLS] if COUNTED_FILLS in dfs_input else self.counted_fills(dfs_input)
        facts = attach(
            members.join(enrolled.select("member_id"), "member_id", "left_semi"),
            self._claim_facts(dfs_input, py),
            self._drug_facts(fills, py),
            self._adherence(fills, py),
        )
        events = F.coalesce("events", F.lit(0))
        persistent = (
            flag("urgent_visit")
            | ((F.coalesce("ambulatory_days", F.lit(0)) >= 4) & (events >= 2))
            | (events >= 4)
            | (flag("special_rule") & flag("asthma_visit"))
        )
        kept = facts.where(
            persistent & ~flag("claims_excluded") & ~flag("no_controller") & (events > 0)
        )
        denominator = flag("asthma_visit")
        return measure_rows(
            kept.where(denominator | flag("adherent")),
            [("MMA", flag("adherent"), denominator)],
        )
