"""Shape of a measure result: output rows, contract, stacking, rates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_FIELDS = ("member_id",)
MEASURE_PREFIX = "comp_quality"
RESULT_COLUMNS = (
    "member_id",
    "comp_quality_short",
    "comp_quality_numerator",
    "comp_quality_denominator",
    "comp_quality_date_last",
    "comp_quality_date_actionable",
    "comp_quality_comments",
)


def measure_rows(
    members: DataFrame,
    rows: Sequence[tuple[Column | str, Column, Column]],
    date_type: str = "string",
) -> DataFrame:
    """One result row per member and (name, numerator, denominator) entry.

    The entries are columns of ``members``, so several rates of a measure come out
    of a single pass over its plan.
    """
    entries = [
        F.struct(
            (F.lit(name) if isinstance(name, str) else name).alias("name"),
            numerator.alias("met"),
            denominator.alias("counted"),
        )
        for name, numerator, denominator in rows
    ]
    return members.select(
        "member_id", F.explode(F.array(*entries)).alias("_row")
    ).selectExpr(
        "member_id",
        "_row.name AS comp_quality_short",
        "CASE WHEN _row.met THEN 1 ELSE 0 END AS comp_quality_numerator",
        "CASE WHEN _row.counted THEN 1 ELSE 0 END AS comp_quality_denominator",
        f"CAST(NULL AS {date_type}) AS comp_quality_date_last",
        f"CAST(NULL AS {date_type}) AS comp_quality_date_actionable",
        "CAST(NULL AS string) AS comp_quality_comments",
    )


def check_result(result: DataFrame, key_fields: Iterable[str] = KEY_FIELDS) -> DataFrame:
    """Return the result if its columns keep the contract, else raise."""
    if not isinstance(result, DataFrame):
        raise TypeError("a measure result must be a DataFrame")
    keys = list(key_fields)
    missing = [name for name in keys if name not in result.columns]
    if missing:
        raise ValueError(f"result lacks key fields {missing}")
    misnamed = [
        name
        for name in result.columns
        if name not in keys and not name.startswith(MEASURE_PREFIX)
    ]
    if misnamed:
        raise ValueError(f"result columns without the {MEASURE_PREFIX} prefix: {misnamed}")
    return result


def combine_results(results: Sequence[DataFrame]) -> DataFrame:
    """Stack measure results by column name, keep denominators, type the dates."""
    typed = [
        result.where(F.col("comp_quality_denominator") != 0).withColumns(
            {
                "comp_quality_date_last": F.col("comp_quality_date_last").cast("date"),
                "comp_quality_date_actionable": F.col("comp_quality_date_actionable").cast(
                    "date"
                ),
            }
        )
        for result in results
    ]
    return reduce(lambda a, b: a.unionByName(b.select(a.columns)), typed)


def measure_rates(results: DataFrame) -> DataFrame:
    """Numerator, denominator and rate of every measure; rate is null without rows."""
    return (
        results.groupBy("comp_quality_short")
        .agg(
            F.sum("comp_quality_numerator").cast("long").alias("comp_quality_numerator"),
            F.sum("comp_quality_denominator").cast("long").alias("comp_quality_denominator"),
        )
        .withColumn(
            "comp_quality_rate",
            F.try_divide("comp_quality_numerator", "comp_quality_denominator"),
        )
    )


def overall_rate(results: DataFrame) -> DataFrame:
    """One row over all results; nulls when there are none."""
    return results.agg(
        F.sum("comp_quality_numerator").cast("long").alias("comp_quality_numerator"),
        F.sum("comp_quality_denominator").cast("long").alias("comp_quality_denominator"),
    ).withColumn(
        "comp_quality_rate", F.try_divide("comp_quality_numerator", "comp_quality_denominator")
    )


def rates_against_target(rates: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Every rate next to its target; null where the catalogue has none."""
    lower = F.col("comp_quality_direction") == "Lower_Better"
    rate, target = F.col("comp_quality_rate"), F.col("comp_quality_target_value")
    return rates.join(
        catalogue.select(
            "comp_quality_short", "comp_quality_direction", "comp_quality_target_value"
        ),
        "comp_quality_short",
        "left",
    ).withColumn("comp_quality_target_met", F.when(lower, rate <= target).otherwise(rate >= target))
