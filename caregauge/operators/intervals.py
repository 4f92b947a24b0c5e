"""Interval algebra on closed date spans.

How these operators stay safe when one key owns a large share of the rows:
before any window function the spans are reduced with a map-side combined
``groupBy`` to one row per (key, day). A window partition therefore never holds
more rows than there are days in the data, however many spans a key has, and
the reduction loses nothing (only the furthest end per start day can matter to
a union of spans; only the net count per edge day can matter to a split).
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caregauge.functions import as_date, day_number

START, END = "_start", "_end"


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def dealt_out(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` by ``keys`` in as many tasks as there are shuffle partitions, before a step that makes more rows.

    Adaptive execution joins partitions by the bytes they have before that step, and so gives
    one task rows that no longer fit its memory after it.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def furthest_end_per_start(
    df: DataFrame, keys: str | Sequence[str], start: str, end: str
) -> DataFrame:
    """One row per (key, start day) with the furthest end, as day numbers."""
    keys = _names(keys)
    return (
        df.select(*keys, day_number(start).alias(START), day_number(end).alias(END))
        .groupBy(*keys, START)
        .agg(F.max(END).alias(END))
    )


def with_reach(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Add ``_reach``: the furthest end among the spans that start earlier."""
    earlier = (
        Window.partitionBy(*_names(keys))
        .orderBy(START)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return df.withColumn("_reach", F.max(END).over(earlier))


def enrolled_holes(
    df: DataFrame, keys: str | Sequence[str] = "member_id", start: str = "date_start",
    end: str = "date_end",
) -> DataFrame:
    """Every key of ``df`` with the uncovered windows between its spans.

    One row per span start of the key; ``hole_start``, ``hole_end`` and ``hole_days``
    (inclusive) are null where no hole precedes it. Counting ``hole_start`` counts
    the holes, and keys without any hole are still there.
    """
    keys = _names(keys)
    hole = F.col(START) - F.col("_reach") - 1
    return with_reach(furthest_end_per_start(df, keys, start, end), keys).select(
        *keys,
        F.when(hole > 0, as_date(F.col("_reach") + 1)).alias("hole_start"),
        F.when(hole > 0, as_date(F.col(START) - 1)).alias("hole_end"),
        F.when(hole > 0, hole).alias("hole_days"),
    )


def coverage_holes(
    df: DataFrame, keys: str | Sequence[str], start: str = "date_start", end: str = "date_end"
) -> DataFrame:
    """Uncovered windows between the spans of a key (none before or after them).

    Columns: keys, ``hole_start``, ``hole_end``, ``hole_days`` (inclusive).
    """
    return enrolled_holes(df, keys, start, end).where("hole_start IS NOT NULL")


def merge_windows(
    df: DataFrame,
    keys: str | Sequence[str],
    start: str = "date_start",
    end: str = "date_end",
    touching: bool = True,
) -> DataFrame:
    """Merge overlapping spans of a key into maximal windows.

    With ``touching`` a span that begins the day after another ends joins it.
    """
    keys = _names(keys)
    ordered = Window.partitionBy(*keys).orderBy(START)
    slack = 1 if touching else 0
    opens = F.col("_reach").isNull() | (F.col(START) > F.col("_reach") + slack)
    return (
        with_reach(furthest_end_per_start(df, keys, start, end), keys)
        .withColumn("_island", F.sum(opens.cast("int")).over(ordered))
        .groupBy(*keys, "_island")
        .agg(F.min(START).alias(START), F.max(END).alias(END))
        .select(*keys, as_date(START).alias(start), as_date(END).alias(end))
    )


def split_windows(
    df: DataFrame,
    keys: str | Sequence[str],
    start: str = "date_start",
    end: str = "date_end",
    holes: bool = False,
) -> DataFrame:
    """Cut overlapping spans at every edge into disjoint closed windows.

    With ``holes`` the uncovered windows between spans are returned as well and a
    boolean column ``covered`` tells them apart.
    """
    keys = _names(keys)
    ordered = Window.partitionBy(*keys).orderBy("_day")
    edges = (
        df.select(
            *keys,
            F.inline(
                F.array(
                    F.struct(day_number(start).alias("_day"), F.lit(1).alias("_step")),
                    F.struct((day_number(end) + 1).alias("_day"), F.lit(-1).alias("_step")),
                )
            ),
        )
        .groupBy(*keys, "_day")
        .agg(F.sum("_step").alias("_step"))
    )
    pieces = edges.select(
        *keys,
        as_date("_day").alias(start),
        as_date(F.lead("_day").over(ordered) - 1).alias(end),
        (F.sum("_step").over(ordered) > 0).alias("covered"),
    ).where(F.col(end).isNotNull())
    return pieces if holes else pieces.where("covered").drop("covered")


def priority_windows(
    df: DataFrame,
    keys: str | Sequence[str],
    payload: Sequence[str],
    priority: str,
    start: str = "date_start",
    end: str = "date_end",
) -> DataFrame:
    """Disjoint windows in which the span of the lowest priority number wins.

    Any priority numbers may occur; a null one comes last. The columns of ``payload``
    come from the winning span; among equals the one that reaches furthest wins (then
    the larger payload).
    """
    keys = _names(keys)
    reach = F.struct(day_number(end).alias("until"), *payload)
    # One row per (key, day, priority) with the best reach; a group per day of the calendar.
    starts = (
        df.select(*keys, day_number(start).alias("_day"), F.col(priority).alias("_level"), reach.alias("_reach"))
        .groupBy(*keys, "_day", "_level")
        .agg(F.max("_reach").alias("_reach"))
    )
    ordered = Window.partitionBy(*keys).orderBy("_day")
    fragments = dealt_out(
        df.select(*keys, F.explode(F.array(day_number(start), day_number(end) + 1)).alias("_day")).distinct(), keys
    )
    fragments = fragments.withColumn("_last", F.lead("_day").over(ordered) - 1)
    # Each level of a key looks at each fragment of the key: its furthest reach so far.
    levels = starts.select(*[F.col(name).alias(f"_k{i}") for i, name in enumerate(keys)], "_level").distinct()
    same = reduce(and_, (F.col(name).eqNullSafe(F.col(f"_k{i}")) for i, name in enumerate(keys)))
    grid = fragments.join(levels, same).select(
        *keys, "_day", "_last", "_level", F.lit(None).cast(starts.schema["_reach"].dataType).alias("_reach")
    )
    by_level = Window.partitionBy(*keys, "_level").orderBy("_day")
    return (
        grid.unionByName(starts.withColumn("_last", F.lit(None).cast("int")))
        .groupBy(*keys, "_level", "_day")
        .agg(F.max("_last").alias("_last"), F.max("_reach").alias("_reach"))
        .withColumn("_reach", F.max("_reach").over(by_level))
        .where(F.col("_last").isNotNull() & (F.col("_reach.until") >= F.col("_day")))
        .groupBy(*keys, "_day", "_last")
        .agg(F.min_by("_reach", F.struct(F.col("_level").isNull(), "_level")).alias("_winner"))
        .select(
            *keys,
            as_date("_day").alias(start),
            as_date("_last").alias(end),
            *[F.col(f"_winner.{name}").alias(name) for name in payload],
        )
    )


def enrollment_gaps(
    member_time: DataFrame,
    period_start: Column | datetime.date,
    period_end: Column | datetime.date,
    key: str = "member_id",
) -> DataFrame:
    """Longest gap (inclusive days) and number of gaps inside a period, per member.

    Days before, between and after the spans count, and a span whose
    ``cover_medical`` is ``N`` covers nothing. A member who has spans but none in
    the period has one gap: the whole period.
    """
    first, last = day_number(period_start), day_number(period_end)
    covers = (
        F.coalesce(F.col("cover_medical") != "N", F.lit(True))
        & (day_number("date_end") >= first)
        & (day_number("date_start") <= last)
    )
    clipped = (
        member_time.select(
            key,
            F.when(covers, F.greatest(day_number("date_start"), first)).alias(START),
            F.when(covers, F.least(day_number("date_end"), last)).alias(END),
        )
        .groupBy(key, START)
        .agg(F.max(END).alias(END))
    )
    before = F.col(START) - F.coalesce(F.col("_reach"), first - 1) - 1
    trailing = last - F.coalesce(F.max(END), first - 1)
    return (
        with_reach(clipped, key)
        .withColumn("_gap", before)
        .groupBy(key)
        .agg(
            F.greatest(F.max("_gap"), trailing).alias("largest_gap"),
            (F.count_if(F.col("_gap") > 0) + (trailing > 0).cast("int")).alias("gap_count"),
        )
    )


def enrollment_gaps_of(
    member_time: DataFrame,
    periods: Sequence[tuple[datetime.date, datetime.date]],
    key: str = "member_id",
) -> DataFrame:
    """``enrollment_gaps`` of several periods from one pass: ``largest_gap_0``, ``gap_count_0``, …

    The reach of all earlier spans tells how far a period was covered before a span, as what ends
    before the period reaches no further than the day before it.
    """
    covers = F.coalesce(F.col("cover_medical") != "N", F.lit(True))
    starts = member_time.select(
        key,
        F.when(covers, day_number("date_start")).alias(START),
        F.when(covers, day_number("date_end")).alias(END),
    )
    spans = with_reach(starts.groupBy(key, START).agg(F.max(END).alias(END)), key)
    gaps = []
    for number, (start, end) in enumerate(periods):
        first, last = ((day - datetime.date(1970, 1, 1)).days for day in (start, end))
        inside = f"({END} >= {first} AND {START} <= {last})"
        gap = f"(CASE WHEN {inside} THEN greatest({START}, {first}) - greatest(coalesce(_reach, {first - 1}), {first - 1}) - 1 END)"
        trailing = f"({last} - coalesce(max(CASE WHEN {inside} THEN least({END}, {last}) END), {first - 1}))"
        gaps += [
            f"greatest(max({gap}), {trailing}) AS largest_gap_{number}",
            f"count_if({gap} > 0) + int({trailing} > 0) AS gap_count_{number}",
        ]
    return spans.groupBy(key).agg(*map(F.expr, gaps))


def flag_gaps(gaps: DataFrame, max_length: int = 0, max_count: int = 0) -> DataFrame:
    """``enrollment_gap_excluded`` = Y when a gap is too long or there are too many."""
    too_much = (F.col("largest_gap") > max_length) | (F.col("gap_count") > max_count)
    return gaps.select(
        "member_id", F.when(too_much, "Y").otherwise("N").alias("enrollment_gap_excluded")
    ).distinct()


def continuously_enrolled(
    spans: DataFrame, max_holes: int = 1, max_span: int = 45, key: str = "member_id"
) -> DataFrame:
    """Members of ``spans`` with few and short holes between their spans.

    A hole is too long when its last and first day are more than ``max_span``
    days apart (difference, not inclusive count).
    """
    hole = F.col(START) - F.col("_reach") - 1
    return (
        with_reach(furthest_end_per_start(spans, key, "date_start", "date_end"), key)
        .groupBy(key)
        .agg(
            F.count_if(hole > 0).alias("_holes"),
            F.coalesce(F.max(hole - 1), F.lit(-1)).alias("_longest"),
        )
        .where((F.col("_holes") <= max_holes) & (F.col("_longest") <= max_span))
        .select(key)
    )


def coverage_around(
    events: DataFrame, spans: DataFrame, key: str = "member_id"
) -> DataFrame:
    """Enrollment gaps inside a window of its own around every event.

    ``events`` has ``key``, ``event`` (any groupable value, usually a struct) and
    the window ``lo`` … ``hi`` (dates). ``spans`` has ``key``, ``date_start``,
    ``date_end``, ``cover_medical``. Only spans that touch the window are seen:
    a gap is a hole between two of them or an explicit ``N`` span (clipped to the
    window). Events that no span touches are dropped.

    Result: key, event, ``gap_count``, ``gap_days``.

    No event is paired with a span. Islands, ``N`` spans and the two ends of each
    window become rows of one per-member day timeline; running sums read at the
    end and just before the beginning of a window give its gaps by subtraction,
    so the work is linear in events plus spans.
    """
    # opened/closed: islands by first/last day; hole_in/hole_out: length of the hole
    # in front of / behind an island; n_*: the same for N spans, with their day sums.
    fields = [
        "opened", "closed", "hole_in", "hole_out",
        "n_opened", "n_closed", "n_open_days", "n_close_days",
    ]

    def step(day: str, **values: str) -> str:
        """SQL: one timeline row; absent fields are zero."""
        made = ", ".join(f"'{name}', bigint({values.get(name, '0')})" for name in fields)
        return f"named_struct('_day', {day}, {made})"

    per_start = (
        spans.select(
            key,
            day_number("date_start").alias(START),
            day_number("date_end").alias(END),
            F.col("cover_medical"),
        )
        .groupBy(key, START)
        .agg(
            F.max(END).alias(END),
            # At most one end per day of the calendar.
            F.collect_set(F.expr(f"CASE WHEN cover_medical = 'N' THEN {END} END")).alias("_n_ends"),
        )
    )
    in_order = Window.partitionBy(key).orderBy(START)
    # A row that begins beyond the reach of all earlier ones opens an island and
    # closes the one before it; the last row closes the last island.
    opens, hole = f"coalesce({START} > _reach + 1, true)", f"{START} - _reach - 1"
    islands = ", ".join(
        [
            f"CASE WHEN {opens} THEN {step(START, opened='1', hole_in=f'coalesce({hole}, 0)')} END",
            f"CASE WHEN {START} > _reach + 1 THEN {step('_reach', closed='1', hole_out=hole)} END",
            f"CASE WHEN _is_last THEN {step(f'greatest({END}, _reach)', closed='1')} END",
        ]
    )
    n_steps = ", ".join(
        [
            step(START, n_opened="1", n_open_days=START),
            step("n_end", n_closed="1", n_close_days="n_end"),
        ]
    )
    marks = (
        with_reach(per_start, key)
        .withColumn("_is_last", F.lead(START).over(in_order).isNull())
        .selectExpr(
            key,
            f"inline(concat(array_compact(array({islands})), "
            f"flatten(transform(_n_ends, n_end -> array({n_steps})))))",
        )
    )
    probes = events.select(
        key,
        "event",
        F.inline(
            F.array(
                F.struct(day_number("hi").alias("_day"), F.lit(1).alias("_side")),
                F.struct((day_number("lo") - 1).alias("_day"), F.lit(-1).alias("_side")),
            )
        ),
    )
    up_to_day = (
        Window.partitionBy(key)
        .orderBy("_day")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    read = (
        probes.unionByName(marks, allowMissingColumns=True)
        .select(
            key,
            "event",
            "_day",
            "_side",
            *[F.coalesce(F.sum(name).over(up_to_day), F.lit(0)).alias(name) for name in fields],
        )
        .where(F.col("_side").isNotNull())
    )
    at_end = F.col("_side") == 1

    def between(end_value: Column, begin_value: Column) -> Column:
        return F.sum(F.when(at_end, end_value).otherwise(-begin_value))

    n_days = (
        F.col("n_opened") * (F.col("_day") + 1)
        - F.col("n_open_days")
        - F.col("n_closed") * F.col("_day")
        + F.col("n_close_days")
    )
    return (
        read.groupBy(key, "event")
        .agg(
            between(F.col("opened"), F.col("closed")).alias("_islands"),
            between(F.col("hole_in"), F.col("hole_out")).alias("_hole_days"),
            between(F.col("n_opened"), F.col("n_closed")).alias("_n_spans"),
            between(n_days, n_days).alias("_n_days"),
        )
        .where(F.col("_islands") > 0)
        .select(
            key,
            "event",
            (F.col("_islands") - 1 + F.col("_n_spans")).alias("gap_count"),
            (F.col("_hole_days") + F.col("_n_days")).alias("gap_days"),
        )
    )
