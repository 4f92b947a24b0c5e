"""Exact top-k by inner product over a bit-sliced index.

Components are quantised to integers. A block of vectors is stored as bitmaps: one for each
component and binary digit (bit-sliced index). For a query the slices are added with bitmap
arithmetic, each as often as its weight's binary digits say (three bitmaps of one weight become a
sum and a carry by a full adder, for all vectors of the block at once), which gives the slices of
the score. From the most significant slice downwards the best k are narrowed down; what ties at the
boundary is resolved by the smaller id.

Negative weights work on complemented slices, so that only sums of non-negative terms occur.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do
rows without an id or with no component; vectors of another length than a query's are no
candidates of it; equal rows count once, and rows with the query's id are its own; an id with several
vectors counts with its best; an empty table gives an empty result; other columns are ignored.
Quantised components saturate at 2**61. Rows of a block are picked exactly at any size; a score that a
long can't hold is given as the nearest long, and among such scores the smaller id comes first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caregauge.llm.common import bounded_batches
from caregauge.llm.vectors import (
    block_of,
    by_block,
    candidates,
    different,
    found_rows,
    parts_for,
    ranked,
    sides,
    valid_vectors,
)
from caregauge.sources.scratch import stored

#: Candidates and queries that meet in one task, and components of each that it holds: wide vectors come in fewer rows.
BLOCK_ROWS, BLOCK_CELLS = 16_384, 1 << 20
QUERY_ROWS, QUERY_CELLS = 512, 1 << 18
SCALE = 256
#: Quantised components saturate here, so that differences fit a long.
LARGEST = 2**61


def build_index(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(slices, least, rows): bitmaps [component, digit, words] of ``values - least``."""
    least = values.min(axis=0)
    offset = (values - least).astype(np.uint64)
    digits = max(int(offset.max()).bit_length(), 1)
    padded = np.zeros((-(-len(values) // 64) * 64, values.shape[1]), np.uint64)
    padded[: len(values)] = offset
    slices = np.empty((values.shape[1], digits, len(padded) // 64), np.uint64)
    for d in range(digits):
        bits = (padded >> np.uint64(d) & np.uint64(1)).astype(np.uint8)
        slices[:, d] = np.ascontiguousarray(np.packbits(bits, axis=0, bitorder="little").T).view(np.uint64)
    return slices, least, len(values)


def add_slices(slices: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Slices of the sum over components of weight times value, least significant first.

    ``slices`` [component, digit, words]; ``weights`` are not negative. Bitmaps of equal
    significance are added three at a time until one is left.
    """
    n_digits = slices.shape[1]
    columns: list[list[np.ndarray]] = [[] for _ in range(n_digits + int(weights.max(initial=0)).bit_length() + 12)]
    for b in range(int(weights.max(initial=0)).bit_length()):
        some = np.flatnonzero(weights >> b & 1)
        if len(some):
            for d in range(n_digits):
                columns[b + d].append(slices[some, d])
    total = []
    for place in range(len(columns)):
        rows = columns[place]
        pile = np.concatenate(rows) if rows else np.zeros((0, slices.shape[2]), np.uint64)
        while len(pile) > 1:
            third = len(pile) // 3
            if third:
                a, b, c = pile[:third], pile[third : 2 * third], pile[2 * third : 3 * third]
                half = a ^ b
                kept, carry = half ^ c, a & b | half & c
                pile = np.concatenate((kept, pile[3 * third :]))
            else:
                carry, pile = pile[:1] & pile[1:], pile[:1] ^ pile[1:]
            if place + 1 == len(columns):
                columns.append([])
            columns[place + 1].append(carry)
        total.append(pile[0] if len(pile) else np.zeros(slices.shape[2], np.uint64))
    while len(columns) > len(total):
        total.append(np.concatenate(columns[len(total)])[0])
    return total


def top_rows(score: list[np.ndarray], k: int, rows: int) -> np.ndarray:
    """Row numbers of the best ``k``; equal scores by the smaller row number."""
    words = len(score[0])
    sure = np.zeros(words, np.uint64)
    open_ = np.zeros(words * 64, np.uint8)
    open_[:rows] = 1
    open_ = np.packbits(open_, bitorder="little").view(np.uint64)
    for bits in reversed(score):
        more = open_ & bits
        taken = int(np.bitwise_count(sure | more).sum())
        if taken > k:
            open_ = more
        else:
            sure = sure | more
            open_ = open_ & ~bits
            if taken == k:
                return _rows(sure, rows)
    certain, boundary = _rows(sure, rows), _rows(open_, rows)
    return np.concatenate((certain, boundary[: k - len(certain)]))


def _rows(bitmap: np.ndarray, rows: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:rows])


def best_of_block(
    ids: np.ndarray, values: np.ndarray, queries: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, scores) of rows of a block that hold the best ``k`` ids of every query."""
    slices, _, rows = build_index(values)
    flipped = ~slices
    largest = np.abs(values).max(axis=0).astype(float)
    repeated = len(np.unique(ids)) < rows
    for query in queries:
        up = np.where((query < 0)[:, None, None], flipped, slices)
        score, take = add_slices(up, np.abs(query)), k
        best = top_rows(score, take, rows)
        while repeated and take < rows and len(np.unique(ids[best])) < k:
            take *= 2
            best = top_rows(score, take, rows)
        yield best, _products(values[best], query, float(largest @ np.abs(query.astype(float))))


def _products(values: np.ndarray, query: np.ndarray, bound: float) -> np.ndarray:
    """Inner products, in Python's integers where ``bound`` says that longs may not hold them."""
    if bound < 2.0**62:
        return values @ query
    exact = values.astype(object) @ query.astype(object)
    return np.array([max(-(2**63), min(2**63 - 1, x)) for x in exact], np.int64)


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v: array<bigint>): floor(scale * x) of every component, within LARGEST."""
    bound = F.lit(float(LARGEST))
    return vectors.select("vec_id", F.transform("v", lambda x: F.floor(F.least(F.greatest(x * float(scale), -bound), bound))).alias("v"))


def top_k(
    df: DataFrame, is_query, k: int, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest scores of every query row.

    ``is_query``: condition on ``vec_id``. Every block of candidates meets every block of queries;
    rows are dealt to blocks by hash, equal vectors beforehand reduced to those that can be results.
    """
    bounded_batches(df.sparkSession)
    vectors = stored(quantised(valid_vectors(df, key, vector, False), scale), "vectors")
    asked = vectors.where(is_query).distinct()
    prints = different(asked)
    queries = asked.join(prints, "v").select(F.col("vec_id").alias("query_id"), "qkey")
    pool = stored(candidates(vectors, k + 1), "candidates")
    rows, width = pool.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    blocks = parts_for(rows, min(BLOCK_ROWS, max(64, BLOCK_CELLS // width)))
    query_blocks = parts_for(prints.count(), min(QUERY_ROWS, max(1, QUERY_CELLS // width)))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    right = pool.select(block_of(blocks, "vec_id", "v").alias("b"), every(query_blocks).alias("q"), F.lit(None).cast("long").alias("qkey"), "vec_id", "v")
    left = prints.select(every(blocks).alias("b"), block_of(query_blocks, "qkey").alias("q"), "qkey", F.lit(None).cast("long").alias("vec_id"), "v")
    dealt = right.unionByName(left).repartition(max(1, blocks * query_blocks), "b", "q").sortWithinPartitions("b", "q", "vec_id")

    def block(rows: pa.Table) -> pa.RecordBatch:
        out = []
        for keys, asked_for, ids, values in sides(rows):
            for key, (best, score) in zip(keys, best_of_block(ids, values, asked_for, k + 1), strict=True):
                out.append((np.full(len(best), key), ids[best], score))
        return found_rows(out, pa.int64())

    found = dealt.mapInArrow(by_block(block), "qkey long, vec_id long, score long")
    return ranked(queries, found, k, largest=True)
