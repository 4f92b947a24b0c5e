"""Hard negatives by slot-decomposed selection.

An anchor's positives are its best rows of the same label. Each positive opens a window of scores for
negatives: from ``low`` to ``high`` hundredths of its own score. Windows of one anchor overlap, so
they are not searched one by one: their upper limits split the scores into disjoint slots, a
negative belongs to one slot, and every task keeps only the best k of each slot (a combiner; so
does the merge of the tasks). A window then is the suffix of slots below its upper limit: slot
after slot, in falling order, is appended until k rows are there, and what is below the lower limit
is cut off. That is exact, as a window's first k rows are among the first k of each of its slots.

Anchors meet rows in blocks: each task scores one block of anchors against one block of rows, both
dealt by hash, whatever their labels; a label with a third of all rows changes nothing.

Defined results: rows with a null id, label or vector, without components, or with a null or
non-finite component take no part; equal rows count once, and of differing rows with one id the one
of the smallest label, then vector, counts; an anchor's candidates have its number of components;
quantised components saturate at 2**56, scores are compared exactly at any size, and what is
returned of them saturates at the range of a long; anchors without positives and windows without
negatives give no rows (a positive of negative score has an empty window); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caregauge.llm.common import bounded_batches
from caregauge.llm.vectors import block_of, by_block, parts_for
from caregauge.sources.scratch import stored

#: Bytes of vectors on either side of a task, and scores that it holds at once.
BLOCK_BYTES = 8 << 20
SCORES = 4 << 20
#: Scores below this bound are whole numbers of a double, or of a long.
_DOUBLE, _LONG = 2.0**53, 2.0**62
#: Quantised components saturate here, so that scores of 16,384 components fit decimal(38).
MOST = 2.0**56
SCALE = 256


def labelled_vectors(df: DataFrame, label: Column | str, key: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, label, v: array<bigint>): one quantised row of each id that takes part."""
    label = F.col(label) if isinstance(label, str) else label
    given = F.col(vector).cast("array<double>")
    finite = F.forall(given, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    takes_part = F.col(key).isNotNull() & label.isNotNull() & (F.size(given) > 0) & finite

    def quantised(c: Column) -> Column:
        return F.floor(F.least(F.greatest(c * F.lit(float(scale)), F.lit(-MOST)), F.lit(MOST)))

    rows = df.where(takes_part).select(
        F.col(key).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.transform(given, quantised).alias("v")
    )
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row")).select("vec_id", "row.label", "row.v")


def scores_of(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products [anchor, row] of integer vectors: doubles, longs or Python integers."""
    bound = float(np.abs(anchors.astype(float)).max(initial=0)) * float(np.abs(rows.astype(float)).sum(axis=1).max(initial=0))
    if bound < _DOUBLE:
        return anchors.astype(float) @ rows.astype(float).T
    if bound < _LONG:
        return anchors @ rows.T
    return anchors.astype(object) @ rows.astype(object).T


def first_k(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` greatest scores, falling; equal ones by their place."""
    if len(scores) > k and scores.dtype != object:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        at = np.concatenate((above, np.flatnonzero(scores == least)[: k - len(above)]))
        at.sort()
    else:
        at = np.arange(len(scores))
    order = sorted(at.tolist(), key=lambda i: (-scores[i], i)) if scores.dtype == object else at[np.argsort(-scores[at], kind="stable")]
    return np.array(order[:k], np.int64)


def slots_of(scores: np.ndarray, limits: list) -> np.ndarray:
    """Slot of every score: 0 holds what is at most ``limits[0]`` and above ``limits[1]``, and so on;
    -1 above all limits. ``limits`` fall strictly."""
    slot = np.full(len(scores), -1)
    for limit in limits:
        slot += scores <= limit
    return slot


def _pairs(rows: pa.Table) -> Iterator[tuple[int, int, list | None, int | None, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, label, limits, floor, ids, labels, scores) of every anchor of a block, rows by id."""
    vs = rows.column("v").combine_chunks()
    sizes = vs.value_lengths().to_numpy()
    flat, begin = vs.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sizes)))
    asks = rows.column("is_anchor").to_numpy()
    ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
    for width in np.unique(sizes[asks]):
        a, c = (np.flatnonzero((sizes == width) & side) for side in (asks, ~asks))
        if not len(c):
            continue
        at = np.arange(width)
        left, right = flat[begin[a][:, None] + at], flat[begin[c][:, None] + at]
        limits = rows.column("limits").take(pa.array(a)).to_pylist()
        floors = rows.column("least").take(pa.array(a)).to_pylist()
        step = max(1, SCORES // len(c))
        for low in range(0, len(a), step):
            scores = scores_of(left[low : low + step], right)
            for i, score in enumerate(scores, low):
                yield int(ids[a[i]]), int(labels[a[i]]), limits[i], floors[i], ids[c], labels[c], score


def _found(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["anchor_id", "slot", "vec_id", "score"])


FOUND = "anchor_id long, slot int, vec_id long, score decimal(38,0)"


def best_positives(k: int):
    """Combiner of the first pass: each anchor's best ``k`` rows of its own label in the block."""

    def block(rows: pa.Table) -> pa.RecordBatch:
        out = []
        for anchor, label, _, _, ids, labels, score in _pairs(rows):
            same = np.flatnonzero((labels == label) & (ids != anchor))
            out += [(anchor, 0, int(ids[i]), int(score[i])) for i in same[first_k(score[same], k)]]
        return _found(out)

    return block


def best_by_slot(k: int):
    """Combiner of the second pass: the best ``k`` rows of other labels in each slot of an anchor."""

    def block(rows: pa.Table) -> pa.RecordBatch:
        out = []
        for anchor, label, limits, least, ids, labels, score in _pairs(rows):
            limits = [int(x) for x in limits]
            other = np.flatnonzero((labels != label) & (score >= int(least)) & (score <= limits[0]))
            slot = slots_of(score[other], limits)
            for s in np.unique(slot).tolist():
                mine = other[slot == s]
                out += [(anchor, s, int(ids[i]), int(score[i])) for i in mine[first_k(score[mine], k)]]
        return _found(out)

    return block


def _every(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def in_blocks(anchors: DataFrame, rows: DataFrame, blocks: int, anchor_blocks: int, compute) -> DataFrame:
    """FOUND rows of ``compute`` for every block of ``anchors`` (vec_id, label, v, limits, least) with
    every block of ``rows`` (vec_id, label, v)."""
    none = (F.lit(None).cast("array<decimal(38,0)>").alias("limits"), F.lit(None).cast("decimal(38,0)").alias("least"))
    right = rows.select(
        block_of(blocks, "vec_id").alias("b"), _every(anchor_blocks).alias("q"), F.lit(False).alias("is_anchor"), "vec_id", "label", "v", *none
    )
    left = anchors.select(
        _every(blocks).alias("b"), block_of(anchor_blocks, "vec_id").alias("q"), F.lit(True).alias("is_anchor"), "vec_id", "label", "v", "limits", "least"
    )
    dealt = right.unionByName(left).repartition(blocks * anchor_blocks, "b", "q").sortWithinPartitions("b", "q", "vec_id")
    return dealt.mapInArrow(by_block(compute), FOUND)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each anchor's slot over all blocks, with their ``rank``."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _long(score: str) -> Column:
    within = F.least(F.greatest(F.col(score), F.lit(-(2**63)).cast("decimal(38,0)")), F.lit(2**63 - 1).cast("decimal(38,0)"))
    return within.cast("long")


def hard_negatives(
    df: DataFrame,
    is_anchor: Column | str,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    label: Column | str = "label",
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor``: condition on ``vec_id``. Of each anchor and each of its first ``positives`` rows of
    the same label: the first ``negatives`` rows of other labels whose score is at least ``low`` and at
    most ``high`` hundredths of the positive's. Higher scores come first, ties by the smaller id.
    """
    bounded_batches(df.sparkSession)
    rows = stored(labelled_vectors(df, label, key, vector, scale), "labelled")
    is_anchor = F.expr(is_anchor) if isinstance(is_anchor, str) else is_anchor
    size = rows.agg(F.count("*"), F.count_if(is_anchor), F.max(F.size("v"))).first()
    held = max(1, BLOCK_BYTES // (8 * (size[2] or 1)))
    blocks, anchor_blocks = parts_for(size[0], held), parts_for(size[1], held)
    anchors = rows.where(is_anchor)

    no_limits = anchors.select("*", F.lit(None).cast("array<decimal(38,0)>").alias("limits"), F.lit(None).cast("decimal(38,0)").alias("least"))
    best = _merged(in_blocks(no_limits, rows, blocks, anchor_blocks, best_positives(positives)), positives)
    best = stored(best.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # whole scores of a window: least ... limit; products of a decimal(38) by 100 don't fit, its floor by remainder does
    hundredth = F.expr("floor(positive_score / 100)").cast("decimal(38,0)")
    rest = F.col("positive_score") - hundredth * 100
    windows = best.where("positive_score >= 0").select(
        "*",
        (hundredth * high + F.floor(rest * high / 100)).cast("decimal(38,0)").alias("limit"),
        (hundredth * low + F.ceil(rest * low / 100)).cast("decimal(38,0)").alias("floor"),
    )
    slots = windows.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_set("limit"), False).alias("limits"), F.min("floor").alias("least")
    )
    asked = anchors.join(slots, "vec_id")
    lists = _merged(in_blocks(asked, rows, blocks, anchor_blocks, best_by_slot(negatives)), negatives)

    # at most positives x negatives rows of an anchor; slots rise as scores fall
    falling = F.sort_array(F.collect_list(F.struct("slot", "rank", "vec_id", "score"))).alias("falling")
    suffixes = lists.groupBy("anchor_id").agg(falling)
    slot_of = F.array_position("limits", F.col("limit")) - 1
    opened = windows.join(slots.withColumnRenamed("vec_id", "anchor_id"), "anchor_id").join(suffixes, "anchor_id")
    suffix = F.filter("falling", lambda r: r["slot"] >= F.col("own_slot"))
    within = F.filter(F.slice(suffix, 1, negatives), lambda r: r["score"] >= F.col("floor"))
    return (
        opened.withColumn("own_slot", slot_of)
        .select("anchor_id", "positive_id", _long("positive_score").alias("positive_score"), F.posexplode(within).alias("at", "negative"))
        .select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("negative.vec_id").alias("negative_id"), "positive_score", F.col("negative.score").alias("negative_score"))
        .withColumn("negative_score", _long("negative_score"))
    )
