"""PCP follow-up after discharge."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import functions as F

from caregauge.operators.output import RESULT_COLUMNS
from caregauge.plans.base import QualityMeasure
from caregauge.sources.tables import table

# Inpatient service lines that call for a follow-up.
INPATIENT_LINES = ("i11a", "i12", "i13a", "i13b", "i14a", "i14b")


# Usual names of the input columns.
COLUMNS = {
    "line": "service_line",
    "success": "pcp_followup_success_yn",
    "potential": "pcp_followup_potential_yn",
    "days_since": "pcp_followup_days_since",
}


class PCPFollowup(QualityMeasure):
    """Stays with a follow-up visit within ``cutoff`` days, per member.

    ``source`` names the input table, ``columns`` its columns where they are not called as
    in ``COLUMNS``; ``claimid`` and ``member_id`` keep their names.
    """

    def _calc_measure(
        self,
        dfs_input,
        performance_yearstart,
        *,
        cutoff: int,
        source: str = "followup_claims",
        columns: Mapping[str, str] | None = None,
    ):
        unknown = set(columns or ()) - set(COLUMNS)
        if unknown:
            raise ValueError(f"unknown columns {sorted(unknown)}; known are {sorted(COLUMNS)}")
        names = {**COLUMNS, **(columns or {})}
        potential = F.col("potential") == "Y"
        success = (F.col("success") == "Y") & F.col("days_since").between(0, cutoff)
        return (
            table(dfs_input, source)
            .where(F.lower(names["line"]).isin(*INPATIENT_LINES))
            .select(
                "member_id",
                "claimid",
                *[F.col(names[name]).alias(name) for name in ("success", "potential", "days_since")],
            )
            .distinct()
            .groupBy("member_id")
            .agg(
                F.count_if(success).alias("comp_quality_numerator"),
                F.count_if(potential).alias("comp_quality_denominator"),
            )
            .select(
                "*",
                F.lit(f"PCP Followup: {cutoff}-Day").alias("comp_quality_short"),
                F.lit(None).cast("string").alias("comp_quality_date_last"),
                F.lit(None).cast("string").alias("comp_quality_date_actionable"),
                F.lit(None).cast("string").alias("comp_quality_comments"),
            )
            .select(*RESULT_COLUMNS)
        )
