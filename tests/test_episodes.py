"""Stays, transfers, readmissions, timelines."""

import datetime
import random

from pyspark.sql import functions as F

from caregauge.operators.episodes import (
    day_timeline,
    direct_transfers,
    distinct_stays,
    far_apart,
    first_episode,
    flag_planned_next,
    flag_readmissions,
    merge_transfers,
    within_days,
)
from tests.helpers import day, rows, table

STAY = "member_id string, claimid string, admitdate date, dischdate date, excl int, plan int"


def stays(spark, text):
    return table(spark, STAY, text).selectExpr(
        "member_id", "claimid", "admitdate", "dischdate",
        "excl = 1 AS exclude_base", "plan = 1 AS planned_flag",
    )


def test_transfers_merge_one_hop(spark):
    merged = merge_transfers(
        stays(
            spark,
            """
            m a 2018-01-01 2018-01-05 0 1
            m b 2018-01-06 2018-01-09 1 1
            m c 2018-01-10 2018-01-12 0 0
            m d 2018-02-01 2018-02-02 0 1
            n e 2018-01-06 2018-01-07 0 0
            """,
        ),
        ["exclude_base"],
        ["planned_flag"],
    )
    # c follows b, but takes b's own id, not the one b was merged into.
    assert rows(
        merged, "transfer_claimid", "admitdate", "dischdate", "is_transfer", "exclude_base",
        "planned_flag",
    ) == sorted(
        [
            ("a", day("2018-01-01"), day("2018-01-09"), True, True, True),
            ("b", day("2018-01-10"), day("2018-01-12"), True, False, False),
            ("d", day("2018-02-01"), day("2018-02-02"), False, False, True),
            ("e", day("2018-01-06"), day("2018-01-07"), False, False, False),
        ],
        key=repr,
    )


def test_planned_next_stay(spark):
    flagged = flag_planned_next(
        stays(
            spark,
            """
            m a 2018-01-01 2018-01-05 0 0
            m b 2018-02-04 2018-02-05 0 1
            m c 2018-03-20 2018-03-21 0 1
            n d 2018-01-01 2018-01-05 0 0
            n e 2018-02-05 2018-02-06 0 1
            """,
        ).withColumnRenamed("claimid", "transfer_claimid")
    )
    assert rows(flagged.where("exclude_planned"), "transfer_claimid") == [("a",)]


def test_readmissions_against_pairs(spark):
    rng = random.Random(5)
    zero = datetime.date(2018, 1, 1)
    data, seen = [], set()
    for i in range(300):
        member = f"m{rng.randint(0, 25)}"
        admit = rng.randint(0, 330)
        discharge = admit + rng.randint(0, 9)
        if (member, admit, discharge) in seen:
            continue
        seen.add((member, admit, discharge))
        data.append((member, f"c{i}", admit, discharge, rng.random() < 0.3))
    expected = sorted(
        (
            c,
            any(
                om == m and oc != c and not ox and 0 <= oa - d <= 30
                for om, oc, oa, _, ox in data
            ),
        )
        for m, c, _, d, _ in data
    )
    frame = spark.createDataFrame(
        [
            (m, c, zero + datetime.timedelta(days=a), zero + datetime.timedelta(days=d), x)
            for m, c, a, d, x in data
        ],
        "member_id string, transfer_claimid string, admitdate date, dischdate date, bad boolean",
    )
    found = flag_readmissions(frame, ~F.col("bad"))
    assert sorted(map(tuple, found.select("transfer_claimid", "has_readmit").collect())) == expected


def test_stays_of_later_years_change_nothing_before(spark):
    """All flags of stays admitted until the bound, with and without the later stays."""
    rng = random.Random(11)
    zero, bound = datetime.date(2018, 1, 1), datetime.date(2018, 12, 31)
    data = []
    for i in range(1500):
        admit = zero + datetime.timedelta(days=rng.choice((rng.randint(300, 420), rng.randint(0, 1000))))
        discharge = admit + datetime.timedelta(days=rng.randint(0, 40))
        data += [(f"m{rng.randint(0, 40)}", f"c{i}{j}", admit, discharge, rng.random() < 0.2, rng.random() < 0.3) for j in range(rng.choice((1, 1, 2)))]
    data += [("none", "x", None, zero, True, False), ("none", "y", None, zero, False, False), ("late", "z", bound + datetime.timedelta(days=9), bound + datetime.timedelta(days=9), False, True)]
    claims = spark.createDataFrame(
        data, "member_id string, claimid string, admitdate date, dischdate date, exclude_base boolean, planned_flag boolean"
    )
    flags = ["exclude_base", "planned_flag"]
    plain = claims.groupBy("member_id", "admitdate", "dischdate").agg(
        F.max("claimid").alias("claimid"), *[F.bool_or(name).alias(name) for name in flags]
    )
    columns = ("member_id", "admitdate", "dischdate", "claimid", *flags)
    assert rows(distinct_stays(claims, flags), *columns) == rows(plain, *columns)
    cut = distinct_stays(claims, flags, bound)
    assert {row["n"] for row in cut.where(F.col("admitdate") > bound).groupBy("member_id").agg(F.count("*").alias("n")).collect()} == {1}

    def flagged(stays):
        merged = flag_planned_next(merge_transfers(stays, ["exclude_base"], ["planned_flag"]))
        found = flag_readmissions(merged, ~F.col("exclude_base"))
        found = found.where((F.col("admitdate") <= bound) & (F.col("dischdate") <= bound - datetime.timedelta(days=30)))
        return rows(found, "member_id", "transfer_claimid", "admitdate", "dischdate", "is_transfer", *flags, "exclude_planned", "has_readmit")

    expected = flagged(plain)
    assert flagged(cut) == expected and len(expected) > 300


def test_frames_on_the_day_timeline(spark):
    events = table(
        spark,
        "member_id string, day date, hit int",
        """
        m 2018-01-01 1
        m 2018-01-01 0
        m 2018-01-31 0
        m 2018-02-01 0
        n 2018-01-31 0
        """,
    )
    days = day_timeline(events, "member_id", "day", {"hit": F.col("hit")})
    assert days.count() == 4
    back = days.withColumn("recent", within_days("hit", -30, -1))
    assert rows(back.where("recent = 1"), "member_id", "day") == [("m", day("2018-01-31"))]
    ever = days.withColumn("before", within_days("hit", None, -1))
    assert rows(ever.where("before = 1"), "day") == [(day("2018-01-31"),), (day("2018-02-01"),)]


def test_first_episode_breaks_ties(spark):
    events = table(
        spark,
        "member_id string, day date, id string, extra int",
        """
        m 2018-01-02 a 1
        m 2018-01-01 z 2
        m 2018-01-01 b 3
        n 2018-05-05 q 4
        """,
    )
    first = first_episode(events, "member_id", ["day", "id"], ["extra"])
    assert rows(first, "member_id", "id", "extra") == [("m", "b", 3), ("n", "q", 4)]


def test_far_apart(spark):
    events = table(
        spark,
        "member_id string, day date",
        """
        m 2018-01-01
        m 2018-01-15
        n 2018-01-01
        n 2018-01-14
        """,
    )
    assert rows(far_apart(events, ["member_id"], "day", 14), "member_id") == [("m",)]


def test_direct_transfers(spark):
    lines = table(
        spark,
        "member_id string, claimid string, admitdate date, dischdate date, kind string",
        """
        moved e1 2018-01-01 2018-01-05 attack
        moved t1 2018-01-06 2018-01-20 acute
        moved t2 2018-01-06 2018-01-10 acute
        vetoed e2 2018-01-01 2018-01-05 attack
        vetoed v1 2018-01-06 2018-01-07 nonacute
        plain e3 2018-01-01 2018-01-05 attack
        plain t3 2018-01-07 2018-01-09 acute
        """,
    )
    kind = F.col("kind")
    found = direct_transfers(lines, kind == "attack", kind != "nonacute", kind == "nonacute")
    assert rows(found, "claimid", "dischdate") == [
        ("e1", day("2018-01-10")),
        ("e3", day("2018-01-05")),
    ]
