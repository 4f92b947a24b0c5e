"""Drug supply: stockpiling, proportion of days covered, treatment days.

A fill is (member, drug, first day, days of supply). Fills of one drug that share
the first day and the supply are interchangeable, so they travel as one row with
a count; windows then run over (first day, supply) combinations instead of raw
fills, which bounds a window partition by the calendar even for a hot member.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caregauge.functions import add_days, as_date, day_number
from caregauge.operators.intervals import END, START, with_reach

# Longest array that a count is expanded through.
COPIES_PER_ROW = 10_000


def stockpile_runs(
    fills: DataFrame,
    keys: Sequence[str],
    start: str = "fromdate",
    supply: str = "dayssupply",
    copies: Column | None = None,
) -> DataFrame:
    """Stack overlapping fills of a key one behind the other, in run-length form.

    Fills are taken in order of (first day, last day); one that begins before the
    stock is used up moves, whole, to the day after. Result: keys, ``start`` and
    ``_length`` (as given), ``_copies`` of identical fills, and the day numbers
    ``_first`` … ``_last`` that these copies occupy back to back.
    """
    keys = list(keys)
    days = (F.col(supply) - 1).cast("int") + 1
    ordered = (
        Window.partitionBy(*keys)
        .orderBy("_day", "_length")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    used = F.col("_copies") * F.col("_length")
    return (
        fills.where(F.col(supply) > 0)
        .select(
            *keys,
            day_number(start).alias("_day"),
            days.alias("_length"),
            (F.lit(1) if copies is None else copies).cast("long").alias("_copies"),
        )
        .groupBy(*keys, "_day", "_length")
        .agg(F.sum("_copies").alias("_copies"))
        .withColumn("_total", F.sum(used).over(ordered))
        .withColumn(
            "_last",
            F.col("_total") + F.max(F.col("_day") - F.col("_total") + used).over(ordered) - 1,
        )
        .select(
            *keys,
            as_date("_day").alias(start),
            "_length",
            "_copies",
            (F.col("_last") - used + 1).alias("_first"),
            "_last",
        )
    )


def spread_copies(runs: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per copy number ``first`` … ``last`` as ``_copy``.

    Large counts are cut into blocks which are shuffled before the final explode,
    so that one key with very many copies is expanded by many tasks.
    """
    size = COPIES_PER_ROW
    blocks = (
        runs.withColumn("_low", first)
        .withColumn("_high", last)
        .where(F.col("_high") >= F.col("_low"))
        .withColumn(
            "_block",
            F.explode(
                F.sequence(F.lit(0).cast("long"), F.floor((F.col("_high") - F.col("_low")) / size))
            ),
        )
    )
    low = F.col("_low") + F.col("_block") * size
    return (
        blocks.repartition(*runs.columns, "_block")
        .withColumn(
            "_copy", F.explode(F.sequence(low, F.least(low + size - 1, F.col("_high"))))
        )
        .drop("_low", "_high", "_block")
    )


def stockpile_shift(
    fills: DataFrame,
    keys: Sequence[str],
    start: str = "fromdate",
    supply: str = "dayssupply",
) -> DataFrame:
    """Every fill with its shifted window ``date_start`` … ``date_end``."""
    runs = stockpile_runs(fills, keys, start, supply)
    begin = F.col("_first") + F.col("_copy") * F.col("_length")
    return spread_copies(runs, F.lit(0).cast("long"), F.col("_copies") - 1).select(
        *keys,
        start,
        as_date(begin).alias("date_start"),
        as_date(begin + F.col("_length") - 1).alias("date_end"),
    )


def proportion_days_covered(
    fills: DataFrame,
    period_end: datetime.date,
    key: str = "member_id",
    drug: str = "drug_id",
    start: str = "fromdate",
    supply: str = "dayssupply",
    copies: Column | None = None,
    clamp: bool = False,
) -> DataFrame:
    """``ipsd``, ``days_covered``, ``treatment_period`` and ``pdc`` per key.

    Supply is stacked per drug, the drugs are overlaid, and days up to
    ``period_end`` are counted. Fills must start on or before that day.

    Windows that the stacking pushes past ``period_end`` count *negative* days
    (end capped, start not): each distinct window edge e beyond it, except the
    very last, takes ``e - period_end - 1`` days off. ``clamp=True`` counts them
    as zero instead. ``pdc`` is null when the treatment period is empty.
    """
    final = (period_end - datetime.date(1970, 1, 1)).days
    runs = stockpile_runs(fills, [key, drug], start, supply, copies)

    # Every run gives one row for the days it covers up to the period end (copy -1)
    # and, unless clamped, one for each of its edges beyond it. Edges are dates, so a
    # drug has at most one per day of the calendar.
    low = f"greatest({final + 1} - _first + _length - 1, 0) div _length"
    blocks = f"CASE WHEN _last > {final} THEN (_copies - {low}) div {COPIES_PER_ROW} ELSE -1 END"
    blocked = runs.withColumn("_low", F.expr(low))
    if clamp:
        blocked = blocked.withColumn("_block", F.lit(-1))
    else:  # a long run's blocks are dealt out before they become copies
        blocked = blocked.withColumn("_block", F.expr(f"explode(sequence(-1L, {blocks}))"))
        blocked = blocked.repartition(key, drug, "_first", "_block")
    marks = (
        blocked.withColumn(
            "_copy",
            F.expr(
                "explode(CASE WHEN _block < 0 THEN array(-1L) ELSE "
                f"sequence(_low + _block * {COPIES_PER_ROW}, "
                f"least(_low + (_block + 1) * {COPIES_PER_ROW} - 1, _copies)) END)"
            ),
        )
        .where(f"_copy >= 0 OR _first <= {final}")
        .selectExpr(
            key,
            f"CASE WHEN _copy < 0 THEN _first ELSE _first + _copy * _length END AS {START}",
            f"CASE WHEN _copy < 0 THEN least(_last, {final}) END AS {END}",
        )
        .groupBy(key, START)
        .agg(F.max(END).alias(END))
    )
    new_days = F.expr(
        f"CASE WHEN {END} IS NOT NULL THEN "
        f"greatest({END} - greatest(coalesce(_reach, {START} - 1), {START} - 1), 0) END"
    )
    deduction = F.expr(f"CASE WHEN {END} IS NULL THEN {final + 1} - {START} END")
    covered = (
        with_reach(marks, key)
        .groupBy(key)
        .agg(
            F.min(START).alias("_ipsd"),
            (
                F.sum(new_days)
                + F.coalesce(F.sum(deduction) - F.min(deduction), F.lit(0))
            ).alias("_days"),
        )
    )
    return (
        covered.select(
            key,
            as_date("_ipsd").alias("ipsd"),
            F.col("_days").alias("days_covered"),
            (F.lit(final) - F.col("_ipsd")).alias("treatment_period"),
        )
        .withColumn("days_covered", F.least("days_covered", "treatment_period").cast("long"))
        .withColumn("pdc", F.round(F.try_divide("days_covered", "treatment_period"), 2))
    )


def treatment_days(
    fills: DataFrame,
    period_end: datetime.date,
    key: str = "member_id",
    start: str = "fromdate",
    supply: str = "dayssupply",
) -> DataFrame:
    """Sum of supplied days up to ``period_end``, overlaps counted twice."""
    until = F.least(add_days(start, F.col(supply)), F.lit(period_end))
    return (
        fills.where(F.col(supply) > 0)
        .groupBy(key)
        .agg(F.sum(F.datediff(until, start)).alias("treatment_days"))
    )


def covered_days_after_index(
    fills: DataFrame,
    index: DataFrame,
    days: int,
    key: str = "member_id",
    index_date: str = "dischdate",
    start: str = "fromdate",
    supply: str = "dayssupply",
) -> DataFrame:
    """Days covered by supply from an index date on, ``days`` days at most.

    ``index`` has one row per key; each comes back with its ``covered_days``, 0 when
    no fill reaches the window. Fills are first reduced to the furthest end per
    (key, first day), then clipped to the index window, merged, and summed as date
    differences.
    """
    reach = (
        fills.withColumn("_until", add_days(start, F.col(supply)))
        .groupBy(key, start)
        .agg(F.max("_until").alias("_until"))
    )
    begin = day_number(F.greatest(index_date, start))
    finish = day_number(F.least(F.date_add(index_date, days - 1), "_until"))
    usable = (F.col(START) < F.col(END)) & (
        (F.col("_until") >= F.col(index_date)) | (F.col(start) >= F.col(index_date))
    )
    clipped = (
        index.select(key, index_date)
        .join(reach, key, "left")
        .select(key, index_date, start, "_until", begin.alias(START), finish.alias(END))
        .select(
            key,
            F.when(usable, F.col(START)).alias(START),
            F.when(usable, F.col(END)).alias(END),
        )
        .groupBy(key, START)
        .agg(F.max(END).alias(END))
    )
    # Overlapping spans share their days; a span that only touches does not gain one.
    new_days = F.greatest(
        F.col(END) - F.greatest(F.coalesce(F.col("_reach"), F.col(START)), F.col(START)), F.lit(0)
    )
    return (
        with_reach(clipped, key)
        .groupBy(key)
        .agg(F.coalesce(F.sum(new_days), F.lit(0)).cast("long").alias("covered_days"))
    )


def dispensing_events(
    route: str = "route", supply: str = "dayssupply"
) -> Column:
    """Number of dispensing events of one fill row by route of intake.

    Oral supply counts one event per 30 days (half-even rounding up to 30 days,
    whole months beyond); inhaled and injected fills count once; other routes not.
    """
    months = F.col(supply) / F.lit(30)
    return (
        F.when(
            F.col(route) == "oral",
            F.when(F.col(supply) <= 30, F.bround(months)).otherwise(F.floor(months)),
        )
        .when(F.col(route).isin("inhalation", "subcutaneous"), F.lit(1))
        .otherwise(F.lit(0))
        .cast("int")
    )


def expand_dispensing_events(
    fills: DataFrame, route: str = "route", supply: str = "dayssupply"
) -> DataFrame:
    """One row per dispensing event, numbered from 1 in ``rx_event_number``."""
    return (
        fills.withColumn("_events", dispensing_events(route, supply))
        .where(F.col("_events") > 0)
        .withColumn("rx_event_number", F.explode(F.sequence(F.lit(1), F.col("_events"))))
        .drop("_events")
    )
