"""Approximate nearest neighbours over balanced posting lists.

A bounded sample is halved again and again at the median of its main direction, which gives
clusters of equal size; their means are the centroids. A graph joins each centroid to its nearest
ones and is searched best-first. Every vector goes to its nearest centroid's list and, when it
lies near the boundary, also to the lists of other centroids that are hardly farther. A query reads
the lists whose centroids are within a distance ratio of the nearest one, and takes exact distances
there. The ratio is fitted: for a bounded sample of queries the true neighbours among all vectors are
found by brute force, and the ratio is the one within which the wanted share of them lies.

Every vector is in a list. Long lists are cut into blocks, and their queries dealt to shares, which meet in
tasks of their own. Sample,
centroids and graph are bounded by parameters, not by the data.

Defined results: vectors that are null, all zero, or hold null or non-finite components take no
part, nor do rows without an id; vectors of another length than the most frequent one of the sample
take no part either; equal rows count once; rows with the query's id are its own; an id with
several vectors counts with its nearest; an empty table gives an empty result; other columns are
ignored. A query gets ``k`` results whenever there are as many candidates.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caregauge.llm.common import bounded_batches
from caregauge.llm.vectors import by_block, candidates, different, first_places, found_rows, ranked, sides, valid_vectors
from caregauge.sources.scratch import stored

#: Vectors for each centroid, centroids, and sampled vectors for each centroid, at most.
LIST_ROWS = 128
MAX_CENTROIDS = 4096
SAMPLE_PER_CENTROID = 32
#: Edges of a centroid; nearest centroids that a search looks for, for a vector to place and for a query.
DEGREE = 24
BEAM = 24
QUERY_BEAM = 128
#: A vector is also put to lists whose centroid is up to this much farther, to so many lists at most.
REPLICA_RATIO = 1.1
REPLICAS = 4
#: Share of the true neighbours that the fitted ratio reaches, and queries that it is fitted on.
RECALL = 0.95
FIT_QUERIES = 128
#: Rows of a list and its queries that meet in one task; distances that the task holds at once.
LIST_BLOCK = 8192
QUERY_BLOCK = 8192
DISTANCES = 4 << 20


def balanced_centroids(sample: np.ndarray, count: int) -> np.ndarray:
    """Means of ``count`` clusters of equal size."""
    clusters = [np.arange(len(sample))]
    while len(clusters) < count:
        clusters.sort(key=len)
        members = clusters.pop()
        if len(members) < 2:
            clusters.append(members)
            break
        x = sample[members] - sample[members].mean(axis=0)
        direction = x[np.argmax((x**2).sum(axis=1))]
        for _ in range(4):  # power iteration towards the main direction
            direction = x.T @ (x @ direction)
            direction = direction / (np.linalg.norm(direction) or 1.0)
        order = np.argsort(x @ direction, kind="stable")
        clusters += [members[order[: len(order) // 2]], members[order[len(order) // 2 :]]]
    return np.stack([sample[m].mean(axis=0) for m in clusters])


def nearest_graph(centroids: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Neighbours of every centroid: half its nearest, half drawn by a fixed rule from all, so that no part is cut off."""
    n = len(centroids)
    norm = (centroids**2).sum(axis=1)
    out = np.zeros((n, degree), np.int32)
    for low in range(0, n, 512):
        d = norm[None, :] - 2 * centroids[low : low + 512] @ centroids.T
        near = np.argsort(d, axis=1, kind="stable")[:, 1 : degree * 3 // 4 + 1]
        out[low : low + 512, : near.shape[1]] = near
        at = np.arange(low, min(n, low + 512))[:, None]
        far = (at + 1 + (np.arange(degree - near.shape[1]) * 2654435761 + at * 40503) % max(n - 1, 1)) % n
        out[low : low + 512, near.shape[1] :] = far
    return out


def search_graph(x: np.ndarray, centroids: np.ndarray, graph: np.ndarray, beam: int) -> np.ndarray:
    """Squared distances of every vector to the centroids that its search met, infinite elsewhere.

    Best-first: each round expands the nearest centroids not yet expanded, and a search ends when
    none of its ``beam`` nearest is left.
    """
    n, k = len(x), len(centroids)
    norm = (centroids**2).sum(axis=1)
    own = (x**2).sum(axis=1)
    distance = np.full((n, k), np.inf)
    expanded = np.zeros((n, k), bool)

    def visit(row: np.ndarray, to: np.ndarray) -> None:
        flat = row * k + to
        flat = np.unique(flat[np.isinf(distance.ravel()[flat])])
        row, to = np.divmod(flat, k)
        distance[row, to] = np.maximum(own[row] + norm[to] - 2 * np.einsum("ij,ij->i", x[row], centroids[to]), 0)

    entries = np.unique(np.linspace(0, k - 1, min(k, 24)).astype(np.int64))
    visit(np.repeat(np.arange(n), len(entries)), np.tile(entries, n))
    active = np.arange(n)
    beam = min(beam, k)
    while len(active):
        d = distance[active]
        limit = np.partition(d, beam - 1, axis=1)[:, beam - 1]
        waiting = np.where(expanded[active], np.inf, d)
        width = min(8, k)
        nearest = np.argpartition(waiting, width - 1, axis=1)[:, :width]
        value = np.take_along_axis(waiting, nearest, axis=1)
        use = (value <= limit[:, None]) & np.isfinite(value)
        row = np.repeat(active, use.sum(axis=1))
        chosen = nearest[use]
        expanded[row, chosen] = True
        visit(np.repeat(row, graph.shape[1]), graph[chosen].ravel().astype(np.int64))
        active = active[use.any(axis=1)]
    return distance


def chosen_lists(distance: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vector number, list, is it the vector's nearest) of every list that a vector goes to."""
    most = min(REPLICAS, distance.shape[1])
    near = np.argsort(distance, axis=1, kind="stable")[:, :most]
    d = np.take_along_axis(distance, near, axis=1)
    close = d <= d[:, :1] * REPLICA_RATIO**2
    close[:, 0] = True
    row, nth = np.nonzero(close)
    return row, near[row, nth], nth == 0


def probed_lists(
    distance: np.ndarray, centroids: np.ndarray, x: np.ndarray, firsts: np.ndarray, k: int, ratio: float
) -> list[np.ndarray]:
    """Lists that every query reads: within ``ratio`` of the nearest, and enough to hold ``k`` + 1 vectors."""
    out = []
    for row, q in zip(distance, x, strict=True):
        order = np.argsort(row, kind="stable")
        use = int((row[order] <= row[order[0]] * ratio**2).sum())
        held = np.cumsum(firsts[order[: int(np.isfinite(row).sum())]])
        if not len(held) or held[-1] < k + 1:  # the search met too few: all centroids in order
            order = np.argsort(((centroids - q) ** 2).sum(axis=1), kind="stable")
            held = np.cumsum(firsts[order])
        use = max(use, int(np.searchsorted(held, k + 1)) + 1)
        out.append(order[:use])
    return out


def fitted_ratio(pool: DataFrame, asked: list[tuple[int, list[float]]], k: int, centroids: np.ndarray, graph: np.ndarray) -> float:
    """Distance ratio within which the lists hold RECALL of the true neighbours of the queries ``asked`` (id, vector)."""
    if not asked:
        return 1.0
    own, q = np.array([a for a, _ in asked]), np.array([v for _, v in asked])
    width = q.shape[1]

    def closest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The task's k nearest of every query; no more than that is held."""
        d, ids, near = np.zeros((len(q), 0)), np.zeros((len(q), 0), np.int64), np.zeros((len(q), 0, width))
        for part in parts:
            x, at = _matrix(part.column(1), width)
            if not len(x):
                continue
            here = part.column(0).to_numpy()[at]
            rough = (x**2).sum(axis=1)[None, :] - 2 * q @ x.T
            rough[own[:, None] == here[None, :]] = np.inf
            best = np.argpartition(rough, min(k, len(x)) - 1, axis=1)[:, :k]
            far = np.isinf(np.take_along_axis(rough, best, axis=1))
            d = np.concatenate((d, np.where(far, np.inf, np.sqrt(((x[best] - q[:, None]) ** 2).sum(axis=2)))), axis=1)
            ids = np.concatenate((ids, here[best]), axis=1)
            near = np.concatenate((near, x[best]), axis=1)
            keep = np.argsort(d, axis=1, kind="stable")[:, :k]
            d, ids = np.take_along_axis(d, keep, axis=1), np.take_along_axis(ids, keep, axis=1)
            near = np.take_along_axis(near, keep[:, :, None], axis=1)
        vs = pa.ListArray.from_arrays(pa.array(np.arange(d.size + 1, dtype=np.int32) * width), pa.array(near.ravel()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(q)), d.shape[1])), pa.array(ids.ravel()), vs, pa.array(d.ravel())], ["qkey", "vec_id", "v", "d"]
        )

    order = Window.partitionBy("qkey").orderBy("d", "vec_id")
    true = (
        pool.select("vec_id", "v")
        .mapInArrow(closest, "qkey long, vec_id long, v array<double>, d double")
        .where(F.col("d") < float("inf"))
        .withColumn("_nth", F.row_number().over(order))
        .where(F.col("_nth") <= k)
        .select("qkey", "v")
        .collect()
    )
    if not true:
        return 1.0
    distance = search_graph(q, centroids, graph, QUERY_BEAM)
    row, to, _ = chosen_lists(search_graph(np.array([r["v"] for r in true]), centroids, graph, BEAM))
    query = np.array([r["qkey"] for r in true])[row]
    nearest_one = np.maximum(distance.min(axis=1), 1e-300)
    needed = np.full(len(true), np.inf)
    np.minimum.at(needed, row, np.sqrt(distance[query, to] / nearest_one[query]))
    return max(1.0, float(np.quantile(needed, RECALL, method="higher")))


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of that many components, and their numbers."""
    sizes = column.value_lengths().to_numpy()
    at = np.flatnonzero(sizes == width)
    begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    return column.flatten().to_numpy()[begin[at][:, None] + np.arange(width)], at


def sampled(pool: DataFrame, rows: int, wanted: int) -> np.ndarray:
    """About ``wanted`` of the ``rows`` vectors, those with the smallest hashes, in the order of these.

    A bound on the hash picks them in each task, so the driver gets no more than the sample, in
    floats of four bytes. Vectors of another length than the commonest are left out.
    """
    h = F.shiftrightunsigned(F.xxhash64("vec_id", "v"), 1)
    bound = min(2**63 - 1, (2**63 - 1) * (wanted + 1000) // max(rows, 1))
    got = pool.where(h <= bound).select(h.alias("h"), "vec_id", F.col("v").cast("array<float>").alias("v")).toArrow()
    if not len(got):
        return np.zeros((1, 1))
    got = got.sort_by([("h", "ascending"), ("vec_id", "ascending")])
    vectors = got.column("v").combine_chunks()
    sizes = Counter(vectors.value_lengths().to_pylist())
    return _matrix(vectors, min((-n, w) for w, n in sizes.items())[1])[0].astype(float)


def nearest(df: DataFrame, is_query, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every query row, by Euclidean distance."""
    spark = df.sparkSession
    bounded_batches(spark)
    vectors = stored(valid_vectors(df, key, vector, True), "vectors")
    pool = stored(candidates(vectors, k + 1), "candidates")
    rows = pool.count()
    lists = min(MAX_CENTROIDS, max(1, math.ceil(rows / LIST_ROWS)))
    sample = sampled(pool, rows, SAMPLE_PER_CENTROID * lists)
    width = sample.shape[1]
    centroids = balanced_centroids(sample, lists)
    edges = nearest_graph(centroids)
    given = spark.sparkContext.broadcast((centroids, edges))

    def dealt(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, graph = given.value
        for part in parts:
            x, at = _matrix(part.column(1), width)
            for low in range(0, len(x), 512):
                row, to, first = chosen_lists(search_graph(x[low : low + 512], centres, graph, BEAM))
                took = part.take(pa.array(at[low : low + 512][row]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to.astype(np.int32)), pa.array(first), *took.columns], ["list", "first", "vec_id", "v"]
                )

    postings = stored(pool.select("vec_id", "v").repartition("vec_id").mapInArrow(dealt, "list int, first boolean, vec_id long, v array<double>"), "postings")
    sizes = postings.groupBy("list").agg(F.count("*").alias("n"), F.count_if("first").alias("firsts")).collect()  # a row a centroid
    firsts, blocks = np.zeros(len(centroids), np.int64), np.zeros(len(centroids), np.int64)
    for r in sizes:
        firsts[r["list"]], blocks[r["list"]] = r["firsts"], math.ceil(r["n"] / LIST_BLOCK)

    asked = vectors.where(is_query).where(F.size("v") == width).distinct()
    prints = different(asked)
    queries = asked.join(prints, "v").select(F.col("vec_id").alias("query_id"), "qkey")
    few = prints.orderBy(F.xxhash64("v"), "first").limit(FIT_QUERIES).collect()
    ratio = fitted_ratio(pool, [(r["first"], r["v"]) for r in few], k, centroids, edges)

    def probed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, graph = given.value
        for part in parts:
            x, at = _matrix(part.column(1), width)
            for low in range(0, len(x), 512):
                q = x[low : low + 512]
                chosen = probed_lists(search_graph(q, centres, graph, QUERY_BEAM), centres, q, firsts, k, ratio)
                source, target = np.repeat(at[low : low + 512], [len(c) for c in chosen]), np.concatenate(chosen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(target.astype(np.int32)), part.column(0).take(pa.array(source))], ["list", "qkey"]
                )

    # which lists a query reads is written without its vector, so that lists of many queries are known
    probes = stored(prints.select("qkey", "v").repartition("qkey").mapInArrow(probed, "list int, qkey long"), "probes")
    shares = {r["list"]: math.ceil(r["n"] / QUERY_BLOCK) for r in probes.groupBy("list").agg(F.count("*").alias("n")).collect()}
    cut = [(k_, int(n), shares[k_]) for k_, n in enumerate(blocks) if n and k_ in shares]  # a row a centroid
    cut = F.broadcast(spark.createDataFrame(cut, "list int, blocks int, shares int"))

    def all_of(n: str):
        return F.sequence(F.lit(0), F.col(n) - 1)

    block, share = F.pmod(F.xxhash64("vec_id", "v"), "blocks").cast("int"), F.pmod(F.xxhash64("qkey"), "shares").cast("int")
    held = postings.join(cut, "list").select("list", "vec_id", "v", F.explode(F.transform(all_of("shares"), lambda s: block * F.col("shares") + s)).alias("b"))
    asks = probes.join(cut, "list").select("list", "qkey", F.explode(F.transform(all_of("blocks"), lambda b: b * F.col("shares") + share)).alias("b"))
    asks = asks.join(prints.select("qkey", "v"), "qkey")
    both = held.select("list", "b", F.lit(None).cast("long").alias("qkey"), "vec_id", "v").unionByName(
        asks.select("list", "b", "qkey", F.lit(None).cast("long").alias("vec_id"), "v")
    )

    def scan(rows: pa.Table) -> pa.RecordBatch:
        out = []
        for keys, q, ids, c in sides(rows):
            size, own = (c**2).sum(axis=1), (q**2).sum(axis=1)
            step = max(1, DISTANCES // len(c))
            for low in range(0, len(q), step):
                rough = size[None, :] - 2 * q[low : low + step] @ c.T
                # with room for rounding, so that ties at the boundary are all met
                most = np.partition(rough, min(k, len(c) - 1), axis=1)[:, min(k, len(c) - 1)] + 1e-12 * (size.max() + own[low : low + step])
                for n, (row, bound) in enumerate(zip(rough, most, strict=True), low):
                    at = np.flatnonzero(row <= bound)
                    if len(np.unique(ids[at])) <= k and len(at) < len(c):  # an id with several vectors
                        at = np.arange(len(c))
                    d = np.sqrt(((c[at] - q[n]) ** 2).sum(axis=1))
                    order = np.lexsort((ids[at], d))
                    order = order[first_places(ids[at][order], k + 1)]
                    out.append((np.full(len(order), keys[n]), ids[at][order], d[order]))
        return found_rows(out, pa.float64())

    found = (
        both.repartition("list", "b")
        .sortWithinPartitions("list", "b")
        .mapInArrow(by_block(scan), "qkey long, vec_id long, score double")
    )
    return ranked(queries, found, k, largest=False)
