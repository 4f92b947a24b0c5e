"""Hard negatives against brute force."""

import numpy as np
import pytest

from caregauge.llm import negatives
from caregauge.llm.common import table

SCHEMA = "vec_id long, embedding array<double>, label int, score double, rank string"


def brute_force(df, is_anchor, positives, count, low=30, high=90):
    rows = {}
    for r in df.collect():
        v = r["embedding"]
        if r["vec_id"] is None or r["label"] is None or not v or not all(x is not None and np.isfinite(x) for x in v):
            continue
        x = [int(np.floor(max(-(2.0**56), min(2.0**56, c * 256)))) for c in v]
        rows[r["vec_id"]] = min(rows.get(r["vec_id"], (r["label"], x)), (r["label"], x))
    out = set()
    for a, (label, v) in rows.items():
        if not is_anchor(a):
            continue
        scored = [(sum(p * q for p, q in zip(v, w)), i, k) for i, (k, w) in rows.items() if i != a and len(w) == len(v)]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for ps, p, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [s for s in scored if s[2] != label and low * ps <= 100 * s[0] <= high * ps][:count]
            out |= {(a, p, n, i, clip(ps), clip(s)) for n, (s, i, _) in enumerate(inside, 1)}
    return out


def clip(score):
    return max(-(2**63), min(2**63 - 1, score))


def found(df, *options, **more):
    got = [tuple(r) for r in negatives.hard_negatives(df, *options, **more).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=4)
    rows = [(k, [float(x) for x in (base + rng.normal(size=4)).round(1)], int(rng.integers(0, 3)), 1.0, "x") for k in range(120)]
    rows += [(200 + k, [0.5, 0.5, 0.25, 1.0], k % 2, 1.0, "x") for k in range(60)]  # ties, a hot vector
    rows += [rows[3], (7, rows[7][1], 2, 0.0, None), (8, [9.0] * 4, 0, 0.0, None)]  # repeated rows and ids
    rows += [(300, None, 1, 1.0, "x"), (310, [], 1, 1.0, "x"), (320, [1.0, None, 0.0, 0.0], 1, 1.0, "x"), (None, [1.0] * 4, 1, 1.0, "x")]
    rows += [(330, [float("nan")] * 4, 1, 1.0, "x"), (340, [float("inf")] + [0.0] * 3, 1, 1.0, "x"), (350, [0.0] * 4, 1, 1.0, "x")]
    rows += [(360, [1.0, 2.0], 1, 1.0, "x"), (361, [1.0, 2.0], 1, 1.0, "x"), (362, [0.5, 1.0], 0, 1.0, "x"), (370, [1.0] * 4, None, 1.0, "x")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("positives, count", [(5, 10), (1, 1), (200, 3), (8, 500)])
def test_odd_rows(odd, positives, count):
    got = found(odd, "vec_id % 10 = 0", positives, count)
    assert got and got == brute_force(odd, lambda i: i % 10 == 0, positives, count)


def test_overlapping_windows_of_other_limits(odd):
    for low, high in ((0, 100), (80, 81), (50, 50)):
        assert found(odd, "vec_id % 10 = 0", 6, 7, low, high) == brute_force(odd, lambda i: i % 10 == 0, 6, 7, low, high)


def test_several_blocks(odd, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 8 * 4 * 16)
    monkeypatch.setattr(negatives, "SCORES", 50)
    assert found(odd, "vec_id % 3 = 0") == brute_force(odd, lambda i: i % 3 == 0, 5, 10)


def test_huge_components_end_nothing(spark, odd):
    rows = [(400, [3e9, 1.0, 1.0, 1.0], 0, 0.0, ""), (401, [2e9, 0.0, 0.0, 0.0], 0, 0.0, ""), (402, [1e9, 0.0, 0.0, 0.0], 1, 0.0, "")]
    rows += [(410, [1e300, 0.0, 0.0, 0.0], 0, 0.0, ""), (411, [-1e300, 0.0, 0.0, 0.0], 1, 0.0, ""), (412, [2.0**47, 0.0, 0.0, 0.0], 1, 0.0, "")]
    df = odd.unionByName(spark.createDataFrame(rows, SCHEMA))
    got = found(df, "vec_id % 10 = 0")
    assert got == brute_force(df, lambda i: i % 10 == 0, 5, 10)
    assert any(r[0] == 410 for r in got)


def test_empty_table_and_no_anchor(odd):
    assert found(odd.limit(0), "vec_id = 1") == found(odd, "vec_id = -1") == set()


def test_slots():
    assert negatives.slots_of(np.array([10, 9, 5, 4, -3]), [9, 4]).tolist() == [-1, 0, 0, 1, 1]
    rng = np.random.default_rng(1)
    for k in (1, 3, 50):
        x = rng.integers(0, 9, 40)
        assert negatives.first_k(x, k).tolist() == sorted(range(40), key=lambda i: (-x[i], i))[:k]
        assert negatives.first_k(x.astype(object), k).tolist() == sorted(range(40), key=lambda i: (-x[i], i))[:k]


def test_no_rows_of_a_kind_beyond_those_asked_for_leave_a_block(odd):
    """What the combiner passes on is bounded by anchors, slots and k, whatever the label's size."""
    rows = negatives.labelled_vectors(odd, "label", "vec_id", "embedding", 256)
    anchors = rows.where("vec_id % 50 = 0").selectExpr("*", "array(cast(400000 as decimal(38,0)), cast(1000 as decimal(38,0))) limits", "cast(-400000 as decimal(38,0)) least")
    n = negatives.in_blocks(anchors, rows, 1, 1, negatives.best_by_slot(2)).groupBy("anchor_id", "slot").count()
    assert n.agg({"count": "max"}).first()[0] == 2


def test_the_query(spark):
    from caregauge.llm import queries

    sf = "/root/testdata/sf0.01"
    got = {tuple(r) for r in queries.QUERIES["op13_hard_negative_mining"](spark, sf).collect()}
    df = table(spark, sf, "embeddings").selectExpr("vec_id", "embedding", "if(vec_id % 7 = 0, (label + 1) % 10, label) label")
    assert got == brute_force(df, lambda i: i % 100 == 0, 5, 10)
