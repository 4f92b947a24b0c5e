"""Episodes: stays, transfers, readmissions, look-back flags, first episode.

Range conditions between the events of one member ("an admission within 30 days
of the discharge", "a diagnosis in the year before the visit") are window frames
over a per-member day timeline. Nothing pairs the rows of a group with each
other, and the timeline has one row per day and kind, so neither its size nor
the work grows with the square of a member's claims.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caregauge.functions import as_date, day_number


def first_episode(
    events: DataFrame, key: str | Sequence[str], order: Sequence[str], payload: Sequence[str] = ()
) -> DataFrame:
    """First row per key by the columns of ``order`` (then of ``payload``).

    A minimum over a struct: combined on the map side, no sort, no window.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = [*order, *[name for name in payload if name not in order]]
    return (
        events.groupBy(*keys)
        .agg(F.min(F.struct(*columns)).alias("_first"))
        .select(*keys, *[F.col(f"_first.{name}").alias(name) for name in columns])
    )


def day_timeline(
    events: DataFrame, key: str, day: str, flags: Mapping[str, Column]
) -> DataFrame:
    """One row per (key, day) with the maximum of every flag; ``_n`` is the day number."""
    return (
        events.groupBy(key, day)
        .agg(*[F.max(value).alias(name) for name, value in flags.items()])
        .withColumn("_n", day_number(day))
    )


def within_days(flag: str, first: int | None, last: int, key: str = "member_id") -> Column:
    """Maximum of ``flag`` over the days ``first`` … ``last`` around each row's day.

    ``first=None`` reaches back without limit.
    """
    frame = (
        Window.partitionBy(key)
        .orderBy("_n")
        .rangeBetween(Window.unboundedPreceding if first is None else first, last)
    )
    return F.max(flag).over(frame)


def distinct_stays(
    stays: DataFrame, any_flags: Sequence[str], last_admission: datetime.date | None = None
) -> DataFrame:
    """One row per (member_id, admitdate, dischdate): the largest ``claimid``, flags or-ed.

    Of a member's stays admitted after ``last_admission``, if given, only the first one is
    left, which a stay before may be transferred to; the others meet no stay admitted until
    then. They leave in this grouping, on the map side, so windows over a member don't grow
    with the years that follow.
    """
    late = F.lit(False)
    if last_admission is not None:
        late = F.coalesce(F.col("admitdate") > F.lit(last_admission), late)
    # Largest for the earliest stay: of late stays the maxima below read only that one.
    earliest = ((-day_number("admitdate")).alias("a"), (-day_number("dischdate")).alias("d"))

    def of_earliest(name: str) -> Column:
        return F.max(F.struct(*earliest, F.col(name).alias("value"))).alias(name)

    return (
        stays.groupBy(
            "member_id",
            late.alias("_late"),
            F.when(~late, F.col("admitdate")).alias("_admit"),
            F.when(~late, F.col("dischdate")).alias("_disch"),
        )
        .agg(*[of_earliest(name) for name in ("claimid", *any_flags)])
        .select(
            "member_id",
            as_date(-F.col("claimid.a")).alias("admitdate"),
            as_date(-F.col("claimid.d")).alias("dischdate"),
            *[F.col(f"{name}.value").alias(name) for name in ("claimid", *any_flags)],
        )
    )


def merge_transfers(
    stays: DataFrame, any_flags: Sequence[str], lone_flags: Sequence[str] = ()
) -> DataFrame:
    """Join a stay to the one before it when it begins at most a day after that ends.

    ``stays`` has one row per (member_id, admitdate, dischdate) with ``claimid``.
    One hop: a stay takes the claim id of its direct predecessor. ``any_flags``
    are or-ed over the merged stay; ``lone_flags`` as well, but a transferred
    stay contributes false to them.
    """
    ordered = Window.partitionBy("member_id").orderBy("admitdate", "dischdate")
    transfer = F.coalesce(
        F.datediff("admitdate", F.lag("dischdate").over(ordered)) <= 1, F.lit(False)
    )
    marked = stays.select(
        "*",
        transfer.alias("is_transfer"),
        F.lag("claimid").over(ordered).alias("_previous"),
    )
    return (
        marked.withColumn(
            "transfer_claimid",
            F.when(F.col("is_transfer"), F.col("_previous")).otherwise(F.col("claimid")),
        )
        .groupBy("member_id", "transfer_claimid")
        .agg(
            F.min("admitdate").alias("admitdate"),
            F.max("dischdate").alias("dischdate"),
            F.bool_or("is_transfer").alias("is_transfer"),
            *[F.bool_or(name).alias(name) for name in any_flags],
            *[
                F.bool_or(F.col(name) & ~F.col("is_transfer")).alias(name)
                for name in lone_flags
            ],
        )
    )


def flag_planned_next(stays: DataFrame, days: int = 30) -> DataFrame:
    """``exclude_planned``: the next stay begins within ``days`` and is planned."""
    ordered = Window.partitionBy("member_id").orderBy(
        "admitdate", "dischdate", "transfer_claimid"
    )
    soon = F.datediff(F.lead("admitdate").over(ordered), "dischdate") <= days
    planned = F.lead("planned_flag").over(ordered)
    return stays.withColumn("exclude_planned", F.coalesce(soon & planned, F.lit(False)))


def flag_readmissions(
    stays: DataFrame,
    counts_as_readmission: Column,
    days: int = 30,
    key: str = "member_id",
    stay_id: str = "transfer_claimid",
) -> DataFrame:
    """Add ``has_readmit``: another counted stay begins 0 … ``days`` after discharge.

    ``stays`` has one row per stay, as ``merge_transfers`` or a grouping by admission
    and discharge leaves them: a member then has no more stays than the calendar has
    pairs of days, whatever the number of claims.

    Admissions and discharges share one timeline; the smallest and largest stay id
    admitted in the frame tell whether any of them is a different stay.
    """
    payload = [name for name in stays.columns if name != key]
    admission = F.struct(
        day_number("admitdate").alias("_n"),
        F.when(counts_as_readmission, F.col(stay_id)).alias("_admitted"),
        F.lit(None).cast(stays.select(F.struct(*payload)).schema[0].dataType).alias("_stay"),
    )
    discharge = F.struct(
        day_number("dischdate").alias("_n"),
        F.lit(None).cast("string").alias("_admitted"),
        F.struct(*payload).alias("_stay"),
    )
    frame = Window.partitionBy(key).orderBy("_n").rangeBetween(0, days)
    own = F.col(f"_stay.{stay_id}")
    other = (F.col("_low") != own) | (F.col("_high") != own)
    return (
        stays.select(key, F.inline(F.array(admission, discharge)))
        .select(
            key,
            "_stay",
            F.min("_admitted").over(frame).alias("_low"),
            F.max("_admitted").over(frame).alias("_high"),
        )
        .where(F.col("_stay").isNotNull())
        .select(key, "_stay.*", F.coalesce(other, F.lit(False)).alias("has_readmit"))
    )


def far_apart(
    events: DataFrame, keys: Sequence[str], day: str, days: int
) -> DataFrame:
    """Keys with two events at least ``days`` apart: last minus first, no self-join."""
    return (
        events.groupBy(*keys)
        .agg(F.datediff(F.max(day), F.min(day)).alias("_spread"))
        .where(F.col("_spread") >= days)
        .select(*keys)
    )


def direct_transfers(
    lines: DataFrame,
    episode: Column,
    transfer: Column,
    veto: Column,
    key: str = "member_id",
    episode_id: str = "claimid",
) -> DataFrame:
    """Episodes with their discharge date moved along a direct transfer.

    ``lines`` has key, episode id, ``admitdate`` and ``dischdate``; the conditions
    say which lines are episodes, which are stays an episode can be transferred to,
    and which rule it out. A transfer begins the day after the episode's discharge.
    The result has one row per (key, discharge day): the smallest episode id and the
    earliest discharge of the transfers, if any.

    Discharges and the days before admissions meet on one (key, day) grouping, so
    the lines are read once and never joined with themselves.
    """
    before = F.date_sub("admitdate", 1)
    discharged = F.struct(
        F.col("dischdate").alias("day"),
        F.when(episode, F.col(episode_id)).alias("episode"),
        F.lit(None).cast("date").alias("moved"),
        F.lit(False).alias("vetoed"),
    )
    admitted = F.struct(
        before.alias("day"),
        F.lit(None).cast("string").alias("episode"),
        F.when(transfer, F.coalesce("dischdate", before)).alias("moved"),
        veto.alias("vetoed"),
    )
    return (
        lines.select(key, F.inline(F.array(discharged, admitted)))
        .where("episode IS NOT NULL OR moved IS NOT NULL OR vetoed")
        .groupBy(key, "day")
        .agg(
            F.min("episode").alias(episode_id),
            F.coalesce(F.min("moved"), F.col("day")).alias("dischdate"),
            F.bool_or("vetoed").alias("_vetoed"),
        )
        .where(F.col(episode_id).isNotNull() & ~F.col("_vetoed"))
        .select(key, episode_id, "dischdate")
    )
