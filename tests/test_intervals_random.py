"""Interval and supply operators against plain day-by-day models on random groups."""

from __future__ import annotations

import datetime
import random
from itertools import pairwise

import pytest
from pyspark.sql import functions as F

from caregauge.operators.intervals import (
    coverage_around,
    merge_windows,
    priority_windows,
    split_windows,
)
from caregauge.operators.supply import proportion_days_covered, stockpile_shift
from tests.helpers import rows

ZERO = datetime.date(2018, 1, 1)
END = datetime.date(2018, 12, 31)


def at(n: int) -> datetime.date:
    return ZERO + datetime.timedelta(days=n)


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(7)
    made = {}
    for g in range(120):
        spans = []
        for _ in range(rng.randint(1, 9)):
            start = rng.randint(0, 90)
            spans.append((start, start + rng.randint(0, 25), rng.randint(0, 2), rng.choice("ab")))
        made[f"g{g}"] = spans
    return made


@pytest.fixture(scope="module")
def spans(spark, groups):
    data = [
        (key, at(s), at(e), level, payload)
        for key, members in groups.items()
        for s, e, level, payload in members
    ]
    return spark.createDataFrame(
        data, "k string, date_start date, date_end date, level int, payload string"
    )


def cut(members):
    edges = sorted({s for s, *_ in members} | {e + 1 for _, e, *_ in members})
    return [(a, b - 1) for a, b in pairwise(edges)]


def test_split_windows(spans, groups):
    expected = []
    for key, members in groups.items():
        for a, b in cut(members):
            covered = any(s <= a and b <= e for s, e, *_ in members)
            expected.append((key, at(a), at(b), covered))
    found = rows(split_windows(spans, "k", holes=True), "k", "date_start", "date_end", "covered")
    assert found == sorted(expected, key=repr)
    only = rows(split_windows(spans, "k"), "k", "date_start", "date_end")
    assert only == sorted((row[:3] for row in expected if row[3]), key=repr)


def test_priority_windows(spans, groups):
    expected = []
    for key, members in groups.items():
        for a, b in cut(members):
            active = [m for m in members if m[0] <= a and b <= m[1]]
            if active:
                best = min(active, key=lambda m: (m[2], -m[1], -ord(m[3])))
                expected.append((key, at(a), at(b), best[3]))
    found = rows(
        priority_windows(spans, "k", ["payload"], "level"),
        "k", "date_start", "date_end", "payload",
    )
    assert found == sorted(expected, key=repr)


def test_priority_windows_take_any_level(spark):
    spans = spark.sql(
        "SELECT k, level, payload, date'2018-01-01' + s AS date_start, date'2018-01-01' + e AS date_end FROM VALUES "
        "('a', 7, 'x', 0, 9), ('a', 1, 'y', 3, 4), ('a', NULL, 'z', 8, 12), (NULL, -5, 'n', 0, 1), ('b', NULL, 'u', 0, 0) "
        "AS t(k, level, payload, s, e)"
    )
    found = rows(priority_windows(spans, "k", ["payload"], "level"), "k", "date_start", "date_end", "payload")
    assert found == sorted(
        [
            ("a", at(0), at(2), "x"), ("a", at(3), at(4), "y"), ("a", at(5), at(7), "x"), ("a", at(8), at(9), "x"),
            ("a", at(10), at(12), "z"), (None, at(0), at(1), "n"), ("b", at(0), at(0), "u"),
        ],
        key=repr,
    )


@pytest.mark.parametrize("touching", [True, False])
def test_merge_windows(spans, groups, touching):
    expected = []
    for key, members in groups.items():
        merged = []
        for s, e, *_ in sorted(members):
            if merged and s <= merged[-1][1] + (1 if touching else 0):
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        expected += [(key, at(s), at(e)) for s, e in merged]
    found = rows(merge_windows(spans, "k", touching=touching), "k", "date_start", "date_end")
    assert found == sorted(expected, key=repr)


def stack(fills):
    """Sequential shift of (start, length) fills in order."""
    shifted, last = [], None
    for start, length in sorted(fills):
        begin = start if last is None or start > last else last + 1
        last = begin + length - 1
        shifted.append((start, begin, last))
    return shifted


@pytest.fixture(scope="module")
def fills():
    rng = random.Random(11)
    made = {}
    for g in range(100):
        made[f"m{g}"] = [
            (rng.choice("xyz"), rng.randint(0, 364), rng.choice([1, 7, 30, 30, 60, 90]))
            for _ in range(rng.randint(1, 12))
        ]
    # Many identical fills, and all supply beyond the year end.
    made["same"] = [("x", 100, 3)] * 200
    made["late"] = [("x", 364, 30)] * 3 + [("y", 364, 10)] * 4
    made["last_day"] = [("x", 364, 1)]
    return made


@pytest.fixture(scope="module")
def fill_table(spark, fills):
    return spark.createDataFrame(
        [(m, d, at(s), float(n)) for m, group in fills.items() for d, s, n in group],
        "member_id string, drug_id string, fromdate date, dayssupply double",
    )


def test_stockpile_shift(fill_table, fills):
    expected = []
    for member, group in fills.items():
        for drug in {d for d, _, _ in group}:
            mine = [(s, n) for d, s, n in group if d == drug]
            expected += [(member, drug, at(s), at(b), at(e)) for s, b, e in stack(mine)]
    found = rows(
        stockpile_shift(fill_table, ["member_id", "drug_id"]),
        "member_id", "drug_id", "fromdate", "date_start", "date_end",
    )
    assert found == sorted(expected, key=repr)


@pytest.mark.parametrize("clamp", [False, True])
def test_proportion_days_covered(fill_table, fills, clamp):
    final = (END - ZERO).days
    expected = {}
    for member, group in fills.items():
        windows = []
        for drug in {d for d, _, _ in group}:
            windows += [(b, e) for _, b, e in stack([(s, n) for d, s, n in group if d == drug])]
        days = 0
        for a, b in cut(windows):
            if any(s <= a and b <= e for s, e in windows):
                covered = min(b, final) - a + 1
                days += max(covered, 0) if clamp else covered
        first = min(s for s, _ in windows)
        days = min(days, final - first)
        expected[member] = (at(first), days, final - first)
    found = {
        row["member_id"]: (row["ipsd"], row["days_covered"], row["treatment_period"])
        for row in proportion_days_covered(fill_table, END, clamp=clamp).collect()
    }
    assert found == expected


def test_pdc_is_null_for_an_empty_period(fill_table):
    only = fill_table.where("member_id = 'last_day'")
    assert [row["pdc"] for row in proportion_days_covered(only, END).collect()] == [None]


def test_one_very_frequent_fill_is_spread(spark):
    """Identical fills beyond one block come back whole."""
    many = spark.range(25_000).select(
        F.lit("m").alias("member_id"),
        F.lit("d").alias("drug_id"),
        F.lit(ZERO).alias("fromdate"),
        F.lit(1.0).alias("dayssupply"),
    )
    shifted = stockpile_shift(many, ["member_id", "drug_id"])
    assert shifted.agg(F.count("*"), F.countDistinct("date_start")).collect()[0][:] == (
        25_000,
        25_000,
    )


def test_coverage_around(spark):
    rng = random.Random(3)
    spans, events = [], []
    model = {}
    for g in range(80):
        key, cursor, mine = f"c{g}", rng.randint(0, 40), []
        for _ in range(rng.randint(1, 8)):
            length = rng.randint(0, 60)
            mine.append((cursor, cursor + length, rng.choice("YYYN")))
            cursor += length + 1 + rng.choice([0, 0, rng.randint(1, 50)])
        spans += [(key, at(s), at(e), c) for s, e, c in mine]
        for _ in range(4):
            lo = rng.randint(-50, 300)
            hi = lo + rng.randint(0, 200)
            events.append((key, f"{lo}-{hi}", at(lo), at(hi)))
            seen = [(max(s, lo), min(e, hi), c) for s, e, c in mine if e >= lo and s <= hi]
            if seen:
                gaps = [(s, e) for s, e, c in seen if c == "N"]
                for (_, before, _), (after, _, _) in pairwise(sorted(seen)):
                    if after > before + 1:
                        gaps.append((before + 1, after - 1))
                model[(key, f"{lo}-{hi}")] = (len(gaps), sum(e - s + 1 for s, e in gaps))
    found = coverage_around(
        spark.createDataFrame(events, "member_id string, event string, lo date, hi date").distinct(),
        spark.createDataFrame(
            spans, "member_id string, date_start date, date_end date, cover_medical string"
        ),
    )
    assert {
        (r["member_id"], r["event"]): (r["gap_count"], r["gap_days"]) for r in found.collect()
    } == model


def test_priority_windows_are_dealt_out_before_the_grid(spark):
    """A plain exchange is joined by its bytes, and one task then holds every level of all fragments."""
    spans = spark.sql("SELECT 1L k, DATE'2020-01-01' date_start, DATE'2020-02-01' date_end, 1 level, 'x' payload")
    plan = priority_windows(spans, "k", ["payload"], "level")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k#" in plan and "8), REPARTITION_BY_NUM" in plan
