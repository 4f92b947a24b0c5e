"""What the two vector searches share: valid vectors, distinct ones, blocks, the merge of lists."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caregauge.sources.scratch import stored


def valid_vectors(df: DataFrame, key: str, vector: str, nonzero: bool) -> DataFrame:
    """(vec_id: long, v: array<double>) of the rows that take part: an id, some components, all finite.

    Repeated rows count once.
    """
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(key).cast("long").alias("vec_id"), v.alias("v"))
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    keep = F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite
    if nonzero:
        keep = keep & F.exists(v, lambda x: x != 0)
    return rows.where(keep)


def candidates(vectors: DataFrame, per_vector: int) -> DataFrame:
    """Of every group of equal vectors the ``per_vector`` smallest ids.

    Equal vectors score alike and ties go to the smaller id, so no other of the group can be among
    the nearest ``per_vector - 1`` of any query. The rank is limited before the shuffle, so a group
    of a third of all rows sends a few rows a task. Repeated rows fall together here.
    """
    order = Window.partitionBy("v").orderBy("vec_id")
    return (
        vectors.withColumn("_nth", F.dense_rank().over(order))
        .where(F.col("_nth") <= per_vector)
        .drop("_nth")
        .dropDuplicates(["vec_id", "v"])
    )


def block_of(parts: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int")


def parts_for(rows: int, size: int) -> int:
    return max(1, math.ceil(rows / size))


def different(asked: DataFrame) -> DataFrame:
    """(v, first, qkey): each different vector of ``asked`` once, its smallest id and a number of its own.

    An id may have several vectors, so ids can't number them. The numbers are fixed by writing them.
    """
    once = asked.groupBy("v").agg(F.min("vec_id").alias("first"))
    return stored(once.withColumn("qkey", F.monotonically_increasing_id()), "queries")


def first_places(ids: np.ndarray, most: int) -> np.ndarray:
    """Places at which the first ``most`` different ``ids`` appear."""
    return np.sort(np.unique(ids, return_index=True)[1])[:most]


def ranked(queries: DataFrame, found: DataFrame, k: int, largest: bool) -> DataFrame:
    """(query_id, rank, vec_id, score) from ``found`` (qkey, vec_id, score) and ``queries`` (query_id, qkey).

    Of an id's several scores the best counts, on either side. Both exchanges serve an aggregate and a window.
    """
    top = (F.max if largest else F.min)("score").alias("score")
    best_first = F.col("score").desc() if largest else F.col("score")
    # of a query's vector k + 1 ids suffice, as only the query's own id falls away
    best = Window.partitionBy("qkey").orderBy(best_first, "vec_id")
    found = found.repartition("qkey").groupBy("qkey", "vec_id").agg(top)
    found = found.withColumn("_nth", F.row_number().over(best)).where(F.col("_nth") <= k + 1).drop("_nth")
    joined = queries.join(found, "qkey").where("query_id <> vec_id")
    joined = joined.repartition("query_id").groupBy("query_id", "vec_id").agg(top)
    order = Window.partitionBy("query_id").orderBy(best_first, "vec_id")
    rank = F.row_number().over(order)
    return (
        joined.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def by_block(compute: Callable[[pa.Table], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Calls ``compute`` for the rows of each value pair of the first two columns; rows come in their order."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at = None
        for part in parts:
            b, q = part.column(0).to_numpy(), part.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(b) != 0) | (np.diff(q) != 0)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(b)], strict=True):
                if held and (b[low], q[low]) != at:
                    yield compute(pa.Table.from_batches(held))
                    held = []
                at = (b[low], q[low])
                held.append(part.slice(low, high - low))
        if held:
            yield compute(pa.Table.from_batches(held))

    return batches


def sides(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(keys and vectors of the queries, ids and vectors of the candidates) of a block, for each vector length."""
    vs = rows.column("v").combine_chunks()
    sizes = vs.value_lengths().to_numpy()
    flat, begin = vs.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sizes)))
    of_query = rows.column("qkey").is_valid().to_numpy()
    for width in np.unique(sizes[of_query]):
        q, c = (np.flatnonzero((sizes == width) & is_) for is_ in (of_query, ~of_query))
        if len(c):
            keys, ids = rows.column("qkey").take(pa.array(q)).to_numpy(), rows.column("vec_id").take(pa.array(c)).to_numpy()
            at = np.arange(width)
            yield keys, flat[begin[q][:, None] + at], ids, flat[begin[c][:, None] + at]


def found_rows(out: list[tuple[np.ndarray, np.ndarray, np.ndarray]], kind: pa.DataType) -> pa.RecordBatch:
    """(qkey, vec_id, score) of all parts; ``kind``: type of the score."""
    key, ids, score = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids), pa.array(score, kind)], ["qkey", "vec_id", "score"])
