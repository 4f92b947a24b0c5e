"""Exact top-k and approximate neighbours against brute force."""

import numpy as np
import pytest

from caregauge.llm import ann, bitslice
from caregauge.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in rng.normal(size=5).round(1)], 7, 1.0) for k in range(60)]
    rows += [(100 + k, [0.5, -0.5, 0.0, 1.0, 0.25], 7, 1.0) for k in range(40)]  # a group of equal vectors
    rows += [(100, [0.5, -0.5, 0.0, 1.0, 0.25], 7, 1.0), (3, rows[3][1], 7, 1.0)]  # repeated rows
    rows += [(200, None, 7, 1.0), (210, [], 7, 1.0), (220, [1.0, None, 0.0, 0.0, 0.0], 7, 1.0), (None, [1.0] * 5, 7, 1.0)]
    rows += [(230, [float("nan")] * 5, 7, 1.0), (240, [float("inf")] + [0.0] * 4, 7, 1.0), (250, [0.0] * 5, 7, 1.0), (260, [1.0, 2.0], 7, 1.0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, score double")


def vectors_of(df, zero: bool) -> dict[int, np.ndarray]:
    got = {}
    for r in df.collect():
        v = r["embedding"]
        if r["vec_id"] is not None and v and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v)):
            got[r["vec_id"]] = np.array(v, float)
    return got


def brute_force(vectors, chosen, k, score, descending):
    out = set()
    for q in filter(chosen, vectors):
        found = [(score(vectors[q], v), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q])]
        found.sort(key=lambda x: (-x[0] if descending else x[0], x[1]))
        out |= {(q, rank, i, s) for rank, (s, i) in enumerate(found[:k], 1)}
    return out


def product(a, b):
    return int(np.floor(a * 256).astype(np.int64) @ np.floor(b * 256).astype(np.int64))


@pytest.mark.parametrize("k", [1, 5, 200])
def test_exact_top_k_of_odd_rows(odd, k):
    got = {tuple(r) for r in bitslice.top_k(odd, "vec_id % 10 = 0", k).collect()}
    assert got == brute_force(vectors_of(odd, True), lambda i: i % 10 == 0, k, product, True)


def test_exact_top_k_of_the_table(spark):
    df = table(spark, SF, "embeddings")
    got = {tuple(r) for r in bitslice.top_k(df, "vec_id % 50 = 0", 5).collect()}
    assert got == brute_force(vectors_of(df, True), lambda i: i % 50 == 0, 5, product, True)


def test_blocks_and_digits(odd, monkeypatch):
    monkeypatch.setattr(bitslice, "BLOCK_ROWS", 16)
    monkeypatch.setattr(bitslice, "QUERY_ROWS", 3)
    got = {tuple(r) for r in bitslice.top_k(odd, "vec_id % 10 = 0", 5).collect()}
    assert got == brute_force(vectors_of(odd, True), lambda i: i % 10 == 0, 5, product, True)


def test_slices_add_up():
    rng = np.random.default_rng(4)
    for rows in (1, 63, 64, 65, 1000):
        values, weights = rng.integers(-300, 300, (rows, 9)), rng.integers(0, 40, 9)
        slices, least, n = bitslice.build_index(values)
        total = bitslice.add_slices(slices, weights)
        bits = np.array([np.unpackbits(t.view(np.uint8), bitorder="little")[:n] for t in total], np.int64)
        assert ((bits << np.arange(len(total))[:, None]).sum(axis=0) == (values - least) @ weights).all()


def test_top_rows_with_ties():
    score = np.array([3, 7, 7, 1, 7, 3], np.uint64)
    slices = [np.packbits((score >> np.uint64(b) & np.uint64(1)).astype(np.uint8), bitorder="little") for b in range(3)]
    slices = [np.concatenate((s, np.zeros(7, np.uint8))).view(np.uint64) for s in slices]
    assert [sorted(bitslice.top_rows(slices, k, 6).tolist()) for k in (1, 2, 4, 6, 9)] == [[1], [1, 2], [0, 1, 2, 4], [0, 1, 2, 3, 4, 5], [0, 1, 2, 3, 4, 5]]


def test_scores_at_any_size():
    """Blocks with components up to the saturation bound are picked as Python's integers say."""
    rng = np.random.default_rng(6)
    for most in (2**40, bitslice.LARGEST):
        values = rng.integers(-300, 300, (100, 5))
        values[17], values[40] = most, -most
        queries = np.concatenate((rng.integers(-300, 300, (4, 5)), values[[17, 40]]))
        got = bitslice.best_of_block(np.arange(100), values, queries, 6)
        for query, (best, score) in zip(queries, got, strict=True):
            exact = [sum(int(a) * int(b) for a, b in zip(v, query, strict=True)) for v in values]
            want = sorted(range(100), key=lambda i: (-exact[i], i))[:6]
            assert sorted(best.tolist()) == sorted(want)
            assert score.tolist() == [max(-(2**63), min(2**63 - 1, exact[i])) for i in best]


def test_one_large_component_ends_no_query(spark):
    rows = [(i, [float(i), 1.0]) for i in range(20)] + [(20, [3e9, 0.0]), (21, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in bitslice.top_k(df, "vec_id = 1", 3).orderBy("rank").collect()]
    assert got == [(1, 1, 21, 256 * 2**61 if 256 * 2**61 < 2**63 else 2**63 - 1), (1, 2, 20, 256 * 256 * 3 * 10**9), (1, 3, 19, 256 * 256 * 20)]


def test_wide_vectors_come_in_small_blocks():
    import tracemalloc

    rows = bitslice.BLOCK_CELLS // 768
    values = np.random.default_rng(8).integers(-1024, 1024, (rows, 768))
    tracemalloc.start()
    next(bitslice.best_of_block(np.arange(rows), values, values[:1], 6))
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()


@pytest.fixture(scope="module")
def several(spark):
    """An id with 40 vectors beside each query, queries with two vectors, and other rows."""
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(60)]
    rows += [(1000, [float(x) for x in np.array(rows[0][1]) + rng.normal(size=4) * 0.01]) for _ in range(40)]
    rows += [(20, [float(x) for x in np.array(rows[0][1]) * 1.5]), (20, rows[40][1])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.mark.parametrize("blocks", [16, 10_000])
@pytest.mark.parametrize("name", ["top_k", "nearest"])
def test_an_id_with_several_vectors_counts_once(several, monkeypatch, name, blocks):
    monkeypatch.setattr(bitslice, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(ann, "LIST_BLOCK", blocks)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 2)
    rows = [(r["vec_id"], np.array(r["embedding"])) for r in several.collect()]
    operator, score, sign = (bitslice.top_k, product, -1) if name == "top_k" else (ann.nearest, distance, 1)
    want = set()
    for q in (0, 20, 40):
        best: dict[int, float] = {}
        for i, v in rows:
            if i != q:
                for own in (x for j, x in rows if j == q):
                    s = sign * score(own, v)
                    best[i] = min(best.get(i, s), s)
        want |= {(q, rank, i) for rank, (s, i) in enumerate(sorted((s, i) for i, s in best.items())[:10], 1)}
    assert {tuple(r)[:3] for r in operator(several, "vec_id in (0, 20, 40)", 10).collect()} == want


def test_queries_of_a_list_are_dealt_to_shares(odd, monkeypatch):
    monkeypatch.setattr(ann, "QUERY_BLOCK", 3)
    monkeypatch.setattr(ann, "LIST_BLOCK", 20)
    monkeypatch.setattr(ann, "DISTANCES", 50)
    want = brute_force({i: v for i, v in vectors_of(odd, False).items() if len(v) == 5}, lambda i: i % 5 == 0, 10, distance, False)
    assert {tuple(r)[:3] for r in ann.nearest(odd, "vec_id % 5 = 0", 10).collect()} == {x[:3] for x in want}


def distance(a, b):
    return float(np.sqrt(((a - b) ** 2).sum()))


def test_neighbours_of_odd_rows(odd):
    want = brute_force({i: v for i, v in vectors_of(odd, False).items() if len(v) == 5}, lambda i: i % 10 == 0, 10, distance, False)
    got = {tuple(r) for r in ann.nearest(odd, "vec_id % 10 = 0", 10).collect()}
    assert {x[:3] for x in got} == {x[:3] for x in want}
    assert np.allclose(sorted(x[3] for x in got), sorted(x[3] for x in want))


def test_fewer_candidates_than_asked_for(odd):
    got = ann.nearest(odd.where("vec_id < 4"), "vec_id = 0", 10).collect()
    assert [r["rank"] for r in got] == [1, 2, 3]


@pytest.mark.parametrize("operator", [lambda d: bitslice.top_k(d, "vec_id % 50 = 0", 5), lambda d: ann.nearest(d, "vec_id % 50 = 0", 5)])
def test_empty_table(odd, operator):
    assert operator(odd.limit(0)).collect() == []


def test_recall_on_the_table(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_BLOCK", 20)
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    vectors = vectors_of(df, False)
    ids, x = np.array(list(vectors)), np.stack(list(vectors.values()))
    got = {}
    for r in ann.nearest(df, "vec_id % 100 = 0", 10).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
        assert r["score"] == pytest.approx(distance(vectors[r["query_id"]], vectors[r["vec_id"]]), abs=1e-12)
    hits = 0
    for q, found in got.items():
        assert len(found) == 10
        d = ((x - vectors[q]) ** 2).sum(axis=1)
        hits += len(found & set(ids[np.argsort(d)][1:11].tolist()))
    assert len(got) == (ids % 100 == 0).sum() and hits >= 0.9 * 10 * len(got)


def test_every_vector_is_in_a_list():
    x = np.random.default_rng(1).normal(size=(500, 8))
    centroids = ann.balanced_centroids(x, 16)
    graph = ann.nearest_graph(centroids)
    met = ann.search_graph(x, centroids, graph, 8)
    row, _, first = ann.chosen_lists(met)
    assert sorted(row[first].tolist()) == list(range(500))
    exact = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (met.argmin(axis=1) == exact.argmin(axis=1)).mean() > 0.95
