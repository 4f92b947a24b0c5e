"""Enrollment gaps: golden cases and the operators built on them."""

import datetime

from caregauge.operators.intervals import (
    continuously_enrolled,
    coverage_holes,
    enrollment_gaps,
    enrollment_gaps_of,
    flag_gaps,
)
from tests.helpers import rows, table

SPANS = """
no_gaps 2017-01-01 2018-12-31 Y
one_small_gap 2017-01-01 2018-11-30 Y
one_small_gap 2018-12-15 2018-12-31 Y
two_small_gaps 2017-01-01 2017-11-30 Y
two_small_gaps 2017-12-10 2017-12-31 Y
two_small_gaps 2018-01-15 2018-12-31 Y
one_large_gap 2017-01-01 2017-12-31 Y
one_large_gap 2018-01-01 2018-01-01 Y
three_same_length_gap 2017-01-01 2017-12-30 Y
three_same_length_gap 2018-01-01 2018-01-01 Y
three_same_length_gap 2018-01-03 2018-01-03 Y
three_same_length_gap 2018-01-05 2018-12-31 Y
mid_gap_and_gap_to_end 2017-01-01 2017-12-31 Y
mid_gap_and_gap_to_end 2018-01-15 2018-01-31 Y
mid_gap_and_gap_to_end 2018-02-01 2018-11-30 Y
early_gap 2017-03-01 2018-12-31 Y
outside 2016-01-01 2016-12-31 Y
overlapping 2017-01-01 2018-06-30 Y
overlapping 2017-02-01 2017-03-01 Y
overlapping 2018-07-11 2019-05-01 Y
explicit_no 2017-01-01 2017-05-31 Y
explicit_no 2017-06-01 2017-06-30 N
explicit_no 2017-07-05 2018-12-31 Y
"""
PERIOD = (datetime.date(2017, 1, 1), datetime.date(2018, 12, 31))
EXPECTED = {
    "no_gaps": (0, 0, "N"),
    "one_small_gap": (14, 1, "N"),
    "two_small_gaps": (14, 2, "Y"),
    "one_large_gap": (364, 1, "Y"),
    "three_same_length_gap": (1, 3, "Y"),
    "mid_gap_and_gap_to_end": (31, 2, "Y"),
    "early_gap": (59, 1, "Y"),
    "outside": (730, 1, "Y"),
    "overlapping": (10, 1, "N"),
    "explicit_no": (34, 1, "N"),
}


def spans(spark):
    return table(
        spark, "member_id string, date_start date, date_end date, cover_medical string", SPANS
    )


def test_gap_length_and_count(spark):
    gaps = enrollment_gaps(spans(spark), *PERIOD)
    found = {r["member_id"]: (r["largest_gap"], r["gap_count"]) for r in gaps.collect()}
    assert found == {member: (longest, n) for member, (longest, n, _) in EXPECTED.items()}


def test_exclusion_flag(spark):
    flags = flag_gaps(enrollment_gaps(spans(spark), *PERIOD), 45, 1)
    found = {r["member_id"]: r["enrollment_gap_excluded"] for r in flags.collect()}
    assert found == {member: flag for member, (_, _, flag) in EXPECTED.items()}


def test_holes_lie_between_spans_only(spark):
    holes = coverage_holes(spans(spark).where("member_id = 'mid_gap_and_gap_to_end'"), "member_id")
    assert rows(holes, "hole_start", "hole_end", "hole_days") == [
        (datetime.date(2018, 1, 1), datetime.date(2018, 1, 14), 14)
    ]


def test_hole_limits_use_the_day_difference(spark):
    edge = table(
        spark,
        "member_id string, date_start date, date_end date",
        """
        d45 2018-01-01 2018-01-31
        d45 2018-03-19 2018-12-31
        d46 2018-01-01 2018-01-31
        d46 2018-03-20 2018-12-31
        """,
    )
    # 2018-02-01 … 2018-03-18 is 45 days apart (46 inclusive) and still allowed.
    assert rows(continuously_enrolled(edge, 1, 45), "member_id") == [("d45",)]


def test_several_periods_from_one_pass(spark):
    """Equal to one pass a period: overlapping, one-day, far and reversed in order."""
    day = datetime.date
    periods = [PERIOD, (day(2017, 6, 1), day(2018, 1, 1)), (day(2018, 1, 3), day(2018, 1, 3)), (day(2030, 1, 1), day(2030, 1, 31)), (day(2016, 6, 1), day(2017, 7, 1))]
    got = enrollment_gaps_of(spans(spark), periods)
    for number, period in enumerate(periods):
        one = rows(enrollment_gaps(spans(spark), *period), "member_id", "largest_gap", "gap_count")
        assert rows(got, "member_id", f"largest_gap_{number}", f"gap_count_{number}") == one
